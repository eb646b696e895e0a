"""PNG pictures as rows: chunk lists, decoded pixels, and the richest run of colours."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

SIGNATURE = b"\x89PNG\r\n\x1a\n"
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def chunk_list(data: bytes) -> list[tuple[str, bytes]]:
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    out, at = [], 8
    while at + 12 <= len(data):
        (size,) = struct.unpack(">I", data[at : at + 4])
        out.append((data[at + 4 : at + 8].decode("latin-1"), data[at + 8 : at + 8 + size]))
        at += 12 + size
    return out


def decode_png(data: bytes) -> np.ndarray:
    """Rows x columns x RGB, 8 bits. 8 and 16 bit, grey, RGB, palette, with or without alpha; no interlacing."""
    chunks = chunk_list(data)
    width, height, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", dict(chunks)["IHDR"])
    if depth not in (8, 16) or interlaced or colour not in _CHANNELS:
        raise ValueError("this kind of PNG is not supported")
    step = _CHANNELS[colour] * depth // 8
    raw = np.frombuffer(zlib.decompress(b"".join(d for k, d in chunks if k == "IDAT")), np.uint8).reshape(height, 1 + width * step)
    out = np.zeros((height, width * step), np.uint8)
    before = np.zeros(width * step, np.uint8)
    for y in range(height):
        out[y] = before = _unfiltered(raw[y, 0], raw[y, 1:], before, step)
    pixels = out.reshape(height, width, _CHANNELS[colour], depth // 8)[..., 0]
    if colour == 3:
        palette = np.frombuffer(dict(chunks)["PLTE"], np.uint8).reshape(-1, 3)
        return palette[pixels[..., 0]]
    return np.repeat(pixels[..., :1], 3, axis=2) if colour in (0, 4) else pixels[..., :3]


def _unfiltered(kind: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    if kind == 0:
        return line
    if kind == 2:
        return line + above
    if kind == 1:  # each byte adds the one a pixel before: a running sum per channel
        return np.cumsum(line.reshape(-1, step), axis=0, dtype=np.uint8).reshape(-1)
    now, up = bytearray(line.tobytes()), above.tobytes()
    for i in range(len(now)):
        left, corner = (now[i - step], up[i - step]) if i >= step else (0, 0)
        if kind == 3:
            guess = (left + up[i]) >> 1
        else:
            p = left + up[i] - corner
            guess = min((abs(p - left), 0, left), (abs(p - up[i]), 1, up[i]), (abs(p - corner), 2, corner))[2]
        now[i] = (now[i] + guess) & 255
    return np.frombuffer(bytes(now), np.uint8)


def encode_png(pixels: np.ndarray) -> bytes:
    """A plain RGB PNG without metadata."""
    height, width, _ = pixels.shape
    raw = np.concatenate([np.zeros((height, 1), np.uint8), pixels.astype(np.uint8).reshape(height, -1)], axis=1).tobytes()
    part = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return SIGNATURE + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")


def _each(df: DataFrame, columns: str, step) -> DataFrame:
    """Replace ``content`` by what ``step`` makes of it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [step(bytes(c)) for c in pdf["content"]]
            yield pdf.drop(columns="content").assign(**{k: [m[k] for m in made] for k in (x.split()[0] for x in columns.split(", "))})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != "content")
    return df.mapInPandas(run, f"{schema}, {columns}")


def png_chunks(df: DataFrame) -> DataFrame:
    """chunks: the types in order (null if it is no PNG)."""

    def step(data: bytes) -> dict:
        try:
            return {"chunks": [k for k, _ in chunk_list(data)]}
        except ValueError:
            return {"chunks": None}

    return _each(df, "chunks array<string>", step)


def frames(df: DataFrame, crop_rows: int = 0) -> DataFrame:
    """width, height and pixels (r, g, b in turn, row by row) below the first ``crop_rows`` rows; one row per picture."""

    def step(data: bytes) -> dict:
        try:
            p = decode_png(data)[crop_rows:]
            return {"height": p.shape[0], "width": p.shape[1], "pixels": p.reshape(-1).astype(np.int32)}
        except (ValueError, KeyError, zlib.error):
            return {"height": None, "width": None, "pixels": None}

    return _each(df, "height int, width int, pixels array<int>", step)


def run_colours(pixels: np.ndarray, every: int = 4, share: int = 10) -> tuple[int, int]:
    """Most distinct colours on a stretch without background of at least a ``share``-th of the width, and the longest stretch.

    Background is the commonest colour of every ``every``-th pixel, of equals the one that comes first.
    """
    colour = (pixels[..., 0].astype(np.int64) << 16) | (pixels[..., 1].astype(np.int64) << 8) | pixels[..., 2]
    values, first, counts = np.unique(colour[::every, ::every], return_index=True, return_counts=True)
    back = values[np.lexsort((first, -counts))[0]]
    least = pixels.shape[1] // share
    best = longest = 0
    for row in colour:
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (row != back).astype(np.int8), [0]])))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            longest = max(longest, b - a)
            if b - a >= least and b - a > best:
                best = max(best, len(np.unique(row[a:b])))
    return best, longest


def richest_run(df: DataFrame) -> DataFrame:
    """colours and longest: see :func:`run_colours`; width; error, if the picture can't be read (the others are null then)."""

    def step(data: bytes) -> dict:
        try:
            pixels = decode_png(data)
            colours, longest = run_colours(pixels)
            return {"colours": colours, "longest": longest, "width": pixels.shape[1], "error": None}
        except (ValueError, KeyError, zlib.error) as e:
            return {"colours": None, "longest": None, "width": None, "error": f"can't read the picture: {e}"}

    return _each(df, "colours int, longest int, width int, error string", step)

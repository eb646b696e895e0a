"""Byte-level BPE ids of whole texts at scan speed.

The tokenizers library spends most of its time on splitting and on offsets. Byte-level BPE never merges across the
pieces of its pre-tokeniser, so texts are split here with numpy, Arrow finds the distinct pieces of a chunk, and the
library encodes each distinct piece once per worker. Texts that hold an added token go to the library whole, and so
does everything if the tokenizer file has another normaliser or pre-tokeniser than the one handled here.
"""

from __future__ import annotations

import functools
import itertools
import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from tidemark.llm.common import pieces, utf8_of

#: Distinct pieces whose ids a worker keeps (about 50 bytes each); it starts anew beyond that, so memory stays bounded.
CACHE_PIECES = 500_000
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)
_APOSTROPHE = ord("'")


def _byte_chars() -> dict[int, int]:
    """Byte-level BPE writes each byte as a character: itself if it prints in Latin-1, else the next one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: 0x100 + i for i, b in enumerate(rest)}


_BYTE_CHARS = np.arange(256, dtype="<u2")
for _byte, _char in _byte_chars().items():
    _BYTE_CHARS[_byte] = _char


@functools.cache
def _classes() -> np.ndarray:
    """The class of each code point: letter, number, white space or other."""
    kind = np.zeros(0x110000, dtype=np.uint8)
    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    for code, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
        kind[np.frombuffer("".join(regex.findall(pattern, every)).encode("utf-32-le"), np.uint32)] = code
    return kind


def is_alphanumeric(codes: np.ndarray) -> np.ndarray:
    kind = _classes()[codes]
    return (kind == _LETTER) | (kind == _NUMBER)


def split_points(codes: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Where the pieces of the byte-level pre-tokeniser start. ``doc_starts``: offsets at which a text starts."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    kind = _classes()[codes]
    head = np.zeros(n + 1, dtype=bool)
    head[doc_starts] = True
    start = np.ones(n, dtype=bool)
    start[1:] = kind[1:] != kind[:-1]
    start |= head[:n]
    # The last white-space character before a run stands alone, or leads the run if it is a blank.
    run = np.flatnonzero(start & (kind != _SPACE) & ~head[:n])
    run = run[kind[run - 1] == _SPACE]
    start[run - 1] = True
    start[run[codes[run - 1] == 0x20]] = False
    # 's 't 'm 'd 're 've 'll split off where a piece starts with the apostrophe.
    mark = np.flatnonzero(start & (codes == _APOSTROPHE))
    if len(mark):
        padded = np.concatenate([codes, np.zeros(2, codes.dtype)])
        one, two = padded[mark + 1], padded[mark + 2]
        one = np.where(head[np.minimum(mark + 1, n)], 0, one)
        two = np.where(head[np.minimum(mark + 2, n)] | (one == 0), 0, two)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        for hit, size in ((mark[short], 2), (mark[long & ~short], 3)):
            start[hit + 1] = False
            after = hit + size
            start[after[after < n]] = True
    return np.flatnonzero(start)


class SubwordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.plain = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and spec["model"]["type"] == "BPE"
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.pool, self.pool_off = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, new: pa.Array) -> None:
        tokenize = self.tokenizer.model.tokenize
        data, off = utf8_of(new)
        chars, at = _BYTE_CHARS[data].tobytes().decode("utf-16-le"), off.tolist()
        made = [[t.id for t in tokenize(chars[a:b])] for a, b in itertools.pairwise(at)]
        self.known = pa.concat_arrays([self.known, new])
        self.pool = np.concatenate([self.pool, np.array([i for ids in made for i in ids], np.uint32)])
        self.pool_off = np.concatenate([self.pool_off, self.pool_off[-1] + np.cumsum([len(ids) for ids in made], dtype=np.int64)])

    def _ids_of(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > CACHE_PIECES:
            self._forget()
        at = pc.index_in(distinct, value_set=self.known)
        new = distinct.filter(pc.is_null(at))
        at = at.to_numpy(zero_copy_only=False) if not len(new) else pc.fill_null(at, -1).to_numpy(zero_copy_only=False).copy()
        if len(new):
            at[at < 0] = len(self.known) + np.arange(len(new))
            self._learn(new)
        return self.pool_off[at], self.pool_off[at + 1] - self.pool_off[at]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind one another (uint32), and the number of ids of each text."""
        whole = np.zeros(len(texts), dtype=bool) if self.plain else np.ones(len(texts), dtype=bool)
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._encode_plain(texts)
        out, sizes = [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            ids = np.array(self.tokenizer.encode(t.as_py(), add_special_tokens=False).ids, np.uint32) if whole[i] else self._encode_plain(texts.slice(i, 1))[0]
            out.append(ids)
            sizes[i] = len(ids)
        return np.concatenate(out), sizes

    def _encode_plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, off = utf8_of(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        lead = np.flatnonzero((data & 0xC0) != 0x80)  # the first byte of each character
        codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        doc = np.searchsorted(lead, off)
        at = split_points(codes, doc)
        per_text = np.diff(np.searchsorted(at, doc))
        coded = pieces(data, np.append(lead[at], len(data))).dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False)
        begin, size = self._ids_of(coded.dictionary)
        sizes = size[which]
        ends = np.cumsum(sizes)
        total = int(ends[-1])
        index = np.repeat(begin[which] - (ends - sizes), sizes) + np.arange(total)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text)])]
        return self.pool[index], np.diff(bounds)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> SubwordEncoder:
    """One encoder per worker process and file."""
    return SubwordEncoder(path)


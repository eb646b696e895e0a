"""Fill-in-the-middle rearrangement of texts by succinct rank and select.

The texts of a chunk lie behind one another as UTF-8. One packed bit per byte tells whether a code point begins there,
and a directory holds the number of set bits before every block of 512. A document's code points are the difference of
two ranks, and select on the rank of a cut gives its byte, so texts are never decoded and no table of 64-bit offsets per
code point exists: the index takes 1.25 bits per byte.

Where a text is cut, and which form it takes, depends on its id alone (sha256), so reruns and other partitionings agree.

Cases: a null text counts as empty and, like any empty text, stays plain; a null id hashes as no digits; a text that holds
one of the marks stays plain, so that every output can be taken apart again; repeated rows give equal rows; very long
texts are handled whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, utf8_of

#: Marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Of 100 texts: those rearranged, and of 100 rearranged ones those that begin with the suffix.
REARRANGED, SUFFIX_FIRST, SEED = 90, 20, 1
#: Words of 64 bits in one block of the directory.
BLOCK = 8


class Boundaries:
    """Rank and select over the bits that mark where code points begin in UTF-8 ``data``."""

    def __init__(self, data: np.ndarray):
        packed = np.packbits((data & 0xC0) != 0x80, bitorder="little")
        self.words = np.zeros((len(packed) // (8 * BLOCK) + 1) * BLOCK, "<u8")
        self.words.view(np.uint8)[: len(packed)] = packed
        #: Set bits before each block, and in all.
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).reshape(-1, BLOCK).sum(axis=1, dtype=np.int64))])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        block = word // BLOCK
        # The words of the block that lie wholly before the position, then the lower bits of its own word.
        lane = np.arange(BLOCK)
        counts = np.bitwise_count(self.words[block[:, None] * BLOCK + lane])
        own = np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
        return self.before[block] + np.where(lane < (word % BLOCK)[:, None], counts, 0).sum(axis=1, dtype=np.int64) + own

    def select(self, k: np.ndarray, end: int) -> np.ndarray:
        """Position of the set bit with ``k`` set bits before it; ``end`` where there is none."""
        out = np.full(len(k), end, np.int64)
        live = k < self.before[-1]
        k = k[live]
        block = np.searchsorted(self.before, k, side="right") - 1
        counts = np.cumsum(np.bitwise_count(self.words[block[:, None] * BLOCK + np.arange(BLOCK)]), axis=1, dtype=np.int64)
        left = k - self.before[block]
        lane = (counts <= left[:, None]).sum(axis=1)
        left -= np.where(lane > 0, np.take_along_axis(counts, np.maximum(lane - 1, 0)[:, None], axis=1)[:, 0], 0)
        word = block * BLOCK + lane
        bits = np.unpackbits(self.words[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out[live] = word * 64 + (np.cumsum(bits, axis=1, dtype=np.int64) <= left[:, None]).sum(axis=1)
        return out


def _draws(ids: list[int | None], seed: int) -> np.ndarray:
    """The first four 32-bit groups of the sha256 of ``seed:id``."""
    raw = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(raw, ">u4").reshape(-1, 4).astype(np.int64)


def _rearrange(rearranged: int, suffix_first: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts = batch.column("text")
            data, off = utf8_of(texts)
            marks = Boundaries(data)
            first = marks.rank(off)
            n = np.diff(first)
            h = _draws(batch.column("doc_id").to_pylist(), seed)
            one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
            low, high = np.minimum(one, two), np.maximum(one, two)
            marked = [pc.match_substring(texts, m.decode()).to_numpy(zero_copy_only=False) for m in (PREFIX, SUFFIX, MIDDLE)]
            plain = (n == 0) | np.logical_or.reduce(marked) | (h[:, 2] % 100 >= rearranged)
            spm = ~plain & (h[:, 3] % 100 < suffix_first)
            # A cut behind the last code point is the next document's first one, or the end of the data.
            a, b = (marks.select(first[:-1] + k, len(data)).tolist() for k in (low, high))
            raw, out = data.tobytes(), []
            for s, x, y, e, flat, turned in zip(off[:-1].tolist(), a, b, off[1:].tolist(), plain.tolist(), spm.tolist(), strict=True):
                if flat:
                    out.append(raw[s:e])
                elif turned:
                    out.append(b"".join((SUFFIX, raw[y:e], PREFIX, raw[s:x], MIDDLE, raw[x:y])))
                else:
                    out.append(b"".join((PREFIX, raw[s:x], SUFFIX, raw[y:e], MIDDLE, raw[x:y])))
            form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(n), pa.array(form), pa.array(low, mask=plain), pa.array(high - low, mask=plain), pa.array(out, pa.binary()).cast(pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return run


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rearranged: int = REARRANGED, suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> DataFrame:
    """doc_id, n (code points), form (plain, psm or spm), prefix_chars and middle_chars (null if plain), output."""
    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(_rearrange(rearranged, suffix_first, seed), "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(form: Column, output: Column) -> Column:
    """The text again, from its form and output. Texts with a mark are plain, so each mark stands once in all others."""
    part = F.split(output, "<[PSM]>")
    return F.when(form == "plain", output).when(form == "psm", F.concat(part[1], part[3], part[2])).otherwise(F.concat(part[2], part[3], part[1]))


def digests(docs: DataFrame) -> DataFrame:
    """Of every document what the rearrangement did, with the digests of its output and of the text rebuilt from it."""
    out = fill_in_middle(docs)
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(restored(F.col("form"), F.col("output")).cast("binary"), 256).alias("restored_sha256"),
    )


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), d AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS one, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS two,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
         WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM t
), c AS (
  SELECT *, substr(text, 1, least(one, two)) AS prefix, substr(text, least(one, two) + 1, greatest(one, two) - least(one, two)) AS middle, substr(text, greatest(one, two) + 1) AS suffix FROM d
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(one, two) END AS prefix_chars, CASE WHEN form <> 'plain' THEN greatest(one, two) - least(one, two) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM c
"""

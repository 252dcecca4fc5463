"""Quality rules: counts of words and repeats, and bands of the zstandard ratio.

A text passes if its base counts pass and it is neither too repetitive nor incompressible. Both
are judged by bytes / compressed bytes, over the whole text and over chunks of fixed length, each
against the limits of its length: a short text compresses less, a long one more. The bytes behind
the last full chunk are judged by the chunk that ends with the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .tables import only
from .words import SPACED, Slice, chain, counts, hashes, mix, owners, slices, sums, windows, words

SYMBOLS = "#*$%&|<>"
#: (bytes from, smallest ratio, largest ratio); shorter texts are not judged.
BANDS = ((128, 0.80, 3.5), (256, 1.00, 4.0), (512, 1.20, 5.0), (1024, 1.35, 6.0), (4096, 1.50, 8.0),
         (16384, 1.60, 12.0), (65536, 1.60, 30.0))
#: Length of the chunks of longer texts, and their band.
CHUNK_BYTES = 4096
CHUNK_BAND = (1.40, 8.0)
#: Share of bytes in chunks out of band that rejects a text.
BAD_CHUNKS = 0.5
LEVEL = 3
WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, ratio double, n_chunks long, n_bad_chunks long, reason string, kept boolean")

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS.encode())] = True


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Marks the values that occur twice or more."""
    order = np.argsort(keys)
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _later(keys: np.ndarray) -> np.ndarray:
    """Marks all but one of each group of equal values."""
    order = np.argsort(keys, kind="stable")
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:][keys[order][1:] == keys[order][:-1]]] = True
    return out


def base(texts: Slice) -> dict[str, np.ndarray]:
    """The base counts of each text."""
    w = words(texts, SPACED)
    data, edges = texts.data, texts.offsets
    chars = sums(w.end - w.start, w.bounds) - counts((data & 0xC0) == 0x80, edges)

    at, keys = windows(w, WINDOW)
    row = owners(w.bounds)
    found = at[_repeated(mix(keys ^ mix(row[at].astype(np.uint64))))] if len(at) else at
    edge = np.zeros(len(w.start) + 1, dtype=np.int64)
    np.add.at(edge, found, 1)
    np.add.at(edge, found + WINDOW, -1)
    covered = np.cumsum(edge)[:-1] > 0

    breaks = np.flatnonzero(data == 10)
    opened = np.unique(np.concatenate([edges[:-1], breaks + 1]))
    opened = opened[opened < len(data)]
    closed = np.concatenate([opened[1:], [len(data)]]) if len(opened) else opened
    closed = closed - ((closed > opened) & (data[np.maximum(closed, 1) - 1] == 10) if len(opened) else 0)
    full = np.searchsorted(w.start, closed) > np.searchsorted(w.start, opened)
    opened, closed = opened[full], closed[full]
    line_row = np.searchsorted(edges, opened, "right") - 1
    dup = _later(chain([hashes(data, opened, closed), line_row.astype(np.uint64)])) if len(opened) else full[:0]
    return {"n_words": np.diff(w.bounds), "word_chars": chars, "n_symbols": counts(_SYMBOL[data], edges),
            "n_dup_lines": np.bincount(line_row[dup], minlength=texts.rows),
            "n_repeat_words": sums(covered, w.bounds)}


def bands(text: bytes, packer: zstandard.ZstdCompressor) -> tuple[float | None, int, int, str | None]:
    """(ratio of the whole text, chunks, chunks out of band, reason to reject)."""
    n = len(text)
    ratio = n / len(packer.compress(text)) if n else None
    chunks = bad = bad_bytes = 0
    reason = None
    for least, low, high in reversed(BANDS):
        if n >= least:
            reason = "incompressible" if ratio < low else "repetitive" if ratio > high else None
            break
    if n > CHUNK_BYTES:
        for i in range(0, n, CHUNK_BYTES):
            end = min(i + CHUNK_BYTES, n)
            part = CHUNK_BYTES / len(packer.compress(text[end - CHUNK_BYTES:end]))
            chunks += 1
            if not CHUNK_BAND[0] <= part <= CHUNK_BAND[1]:
                bad += 1
                bad_bytes += end - i
        if reason is None and bad_bytes > BAD_CHUNKS * n:
            reason = "chunks"
    return ratio, chunks, bad, reason


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: base counts, ratios and the verdict.

    A null text counts as empty: no words, so the base rules fail. A null key stays null, repeated
    rows are judged each, an empty table gives no rows, other columns are not looked at. ``ratio``
    is null for an empty text.
    """

    def run(batches):
        packer = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            ids = batch.column(0)
            for s in slices(batch.column(1)):
                got = base(s)
                raw, at = s.data.tobytes(), s.offsets.tolist()
                each = [bands(raw[a:b], packer) for a, b in zip(at[:-1], at[1:])]
                failed = (got["n_words"] < MIN_WORDS) | (100 * got["n_repeat_words"] > REPEAT_PERCENT * got["n_words"])
                reason = ["base" if f else e[3] for f, e in zip(failed, each)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(s.first, s.rows), *[pa.array(v.astype(np.int64)) for v in got.values()],
                     pa.array(failed), *[pa.array([e[i] for e in each], t)
                                         for i, t in enumerate((pa.float64(), pa.int64(), pa.int64()))],
                     pa.array(reason, pa.string()), pa.array([r is None for r in reason])],
                    names=[c.split()[0] for c in SCHEMA.split(", ")])

    return only(docs, key, text).mapInArrow(run, SCHEMA)


def filtered(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns, judged where they lie.

    No join: the verdict of a row is found in the task that holds it, so repeated or null keys
    need no care. Null and empty texts go.
    """
    place = docs.columns.index(text)

    def run(batches):
        packer = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for s in slices(batch.column(place)):
                got = base(s)
                good = (got["n_words"] >= MIN_WORDS) & (100 * got["n_repeat_words"] <= REPEAT_PERCENT * got["n_words"])
                for i in np.flatnonzero(good):
                    raw = s.data[s.offsets[i]:s.offsets[i + 1]].tobytes()
                    keep[s.first + i] = bands(raw, packer)[3] is None
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)

"""Benchmark decontamination with an FM-index per shard of the training texts.

A shard is a slice of an Arrow batch. Its words become symbols of the benchmark's vocabulary; a
word that no benchmark phrase contains ends a run, and a run shorter than the shortest phrase can
hold no phrase, so neither is indexed. Over the runs stand a suffix array, its Burrows-Wheeler
column in a wavelet matrix, and sampled suffix positions. All phrases are searched backwards at
once; rows found are walked to the next sample; places are merged into removal spans.

Benchmark texts become stored rows of word hashes in tasks, in numbered blocks of a bounded size. A pass over the
documents searches one block, which alone is sent to the tasks; what several passes find in a
document is merged by its row. So neither the driver nor a worker ever holds more than one block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tables import in_blocks, only, stored
from .words import ALNUM, Slice, Words, slices, sums, words

WINDOW = 13
#: A text is contaminated if at least this share of its words is hit (1 / 20).
SHARE = 20
#: Every so many symbols of the text keep their suffix position.
SAMPLE = 32
#: Words of a block, and of a stretch of a benchmark text that is kept in one row.
BLOCK_WORDS, SEGMENT_WORDS = 1 << 20, 1 << 14


@dataclass
class Phrases:
    """Windows of benchmark items: places in the symbols of their texts, which are 1.. of a vocabulary of word hashes."""

    vocabulary: np.ndarray
    symbols: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    owner: np.ndarray
    items: list[str]


def segments(batch: pa.RecordBatch, window: int, size: int) -> Iterator[tuple[str, np.ndarray]]:
    """(item, word hashes) of stretches of the texts: every window stands in one of them. Rows without an id or words have none."""
    names = batch.column(0).to_pylist()
    for s in slices(batch.column(1), lower=True):
        w = words(s, ALNUM)
        for row in range(s.rows):
            own = w.hash[w.bounds[row]:w.bounds[row + 1]]
            if names[s.first + row] is not None and len(own):
                for a in range(0, max(1, len(own) - window + 1), size):
                    yield names[s.first + row], own[a:a + size + window - 1]


def windows_of(parts: list[tuple[str, np.ndarray]], window: int) -> Phrases:
    """The windows of stretches; a stretch shorter than a window is one."""
    names = sorted({i for i, _ in parts})
    number = {n: k for k, n in enumerate(names)}
    length = np.array([len(h) for _, h in parts], dtype=np.int64)
    each = np.maximum(length - window + 1, np.minimum(length, 1))
    begin = np.cumsum(length) - length
    starts = np.arange(each.sum()) + np.repeat(begin - np.cumsum(each) + each, each)
    vocabulary, symbols = np.unique(np.concatenate([h for _, h in parts]) if parts else np.empty(0, np.uint64), return_inverse=True)
    return Phrases(vocabulary, symbols.astype(np.int64) + 1, starts, np.repeat(np.minimum(length, window), each),
                   np.repeat(np.array([number[i] for i, _ in parts], dtype=np.int64), each), names)


def phrases(items: list[tuple[str, str | None]], window: int = WINDOW) -> Phrases:
    """The windows of some items' texts."""
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in items], pa.string()), pa.array([t for _, t in items], pa.string())], names=["item", "text"])
    return windows_of(list(segments(batch, window, SEGMENT_WORDS)), window)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``text``; a 0 ends a run, and each 0 differs from every other.

    Prefix doubling; a round sorts only those suffixes that still share their rank.
    """
    n = len(text)
    ends = np.flatnonzero(text == 0)
    rank = text + len(ends)
    rank[ends] = np.arange(len(ends))
    order = np.argsort(rank, kind="stable")
    ordered = rank[order]
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    rank[order] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    step = 1
    while not fresh.all():
        # the slots whose suffix is not alone in its group
        shared = ~fresh
        shared[:-1] |= ~fresh[1:]
        slots = np.flatnonzero(shared)
        at = order[slots]
        key = rank[at] * np.int64(n + 1) + rank[np.minimum(at + step, n - 1)]
        by = np.argsort(key, kind="stable")
        key, at = key[by], at[by]
        order[slots] = at
        new = np.ones(len(slots), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        fresh[slots] = new
        rank[at] = slots[np.flatnonzero(new)[np.cumsum(new) - 1]]
        step *= 2
    return order


class Wavelet:
    """Ranks of symbols in a sequence: one bit vector a level, zeros before ones."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.bits = max(1, int(largest).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(self.bits - 1, -1, -1):
            bit = (symbols >> level & 1).astype(bool)
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]))
            self.zeros.append(int(len(bit) - self.ones[-1][-1]))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k in range(self.bits):
            ones = self.ones[k][at]
            at = np.where(symbol >> (self.bits - 1 - k) & 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        return self._down(symbol, at) - self._down(symbol, np.zeros_like(at))


class FMIndex:
    """Backward search and location over runs of symbols that end with 0."""

    def __init__(self, text: np.ndarray, largest: int):
        order = suffix_array(text)
        self.last = text[order - 1]
        self.wavelet = Wavelet(self.last, largest)
        count = np.bincount(text, minlength=largest + 1)
        self.before = np.cumsum(count) - count
        sampled = np.arange(len(text)) % SAMPLE == 0
        sampled[1:] |= text[:-1] == 0
        self.marked = sampled[order]
        self.index = np.cumsum(self.marked) - 1
        self.positions = order[self.marked]
        self.size = len(text)

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.before[symbol] + self.wavelet.rank(symbol, at)

    def search(self, p: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, first row, end row) of the phrases that occur."""
        live = np.arange(len(p.starts))
        low = np.zeros(len(live), dtype=np.int64)
        high = np.full(len(live), self.size, dtype=np.int64)
        left = p.lengths.copy()
        found = []
        while len(live):
            symbol = p.symbols[p.starts[live] + left[live] - 1]
            low, high = self.step(symbol, low), self.step(symbol, high)
            left[live] -= 1
            some = low < high
            live, low, high = live[some], low[some], high[some]
            done = left[live] == 0
            found.append((live[done], low[done], high[done]))
            live, low, high = live[~done], low[~done], high[~done]
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (live, low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the text of the given rows."""
        rows = rows.copy()
        walked = np.zeros(len(rows), dtype=np.int64)
        open_ = np.flatnonzero(~self.marked[rows])
        while len(open_):
            at = rows[open_]
            rows[open_] = self.step(self.last[at], at)
            walked[open_] += 1
            open_ = open_[~self.marked[rows[open_]]]
        return self.positions[self.index[rows]] + walked


def places(w: Words, p: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, index of its first word in the slice) of every occurrence."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if not len(p.starts) or not len(w.hash):
        return none
    seen = np.zeros(1 << 16, dtype=bool)
    seen[(p.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
    at = np.flatnonzero(seen[(w.hash & np.uint64(0xFFFF)).astype(np.int64)])
    slot = np.minimum(np.searchsorted(p.vocabulary, w.hash[at]), len(p.vocabulary) - 1)
    known = p.vocabulary[slot] == w.hash[at]
    at, symbol = at[known], slot[known] + 1
    if not len(at):
        return none
    # runs of neighbouring known words of one text
    opens = np.ones(len(at), dtype=bool)
    opens[1:] = at[1:] != at[:-1] + 1
    first_word = np.zeros(len(w.hash) + 1, dtype=bool)
    first_word[w.bounds[:-1]] = True
    opens |= first_word[at]
    begin = np.flatnonzero(opens)
    length = np.diff(np.concatenate([begin, [len(at)]]))
    keep = length >= p.lengths.min()
    if not keep.any():
        return none
    inside = np.repeat(keep, length)
    at, symbol, length = at[inside], symbol[inside], length[keep]
    # each run and a 0 behind it
    shift = np.repeat(np.arange(len(length)), length)
    text = np.zeros(len(at) + len(length), dtype=np.int64)
    text[np.arange(len(at)) + shift] = symbol
    origin = np.full(len(text), -1, dtype=np.int64)
    origin[np.arange(len(at)) + shift] = at
    index = FMIndex(text, len(p.vocabulary))
    phrase, low, high = index.search(p)
    times = high - low
    rows = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return np.repeat(phrase, times), origin[index.locate(rows)]


def hits(s: Slice, blocks: list[Phrases]) -> tuple[Words, np.ndarray, list[list[str]], np.ndarray]:
    """(words, mark of each hit word, item ids of each text, number of hit words of each text)."""
    w = words(s, ALNUM)
    edge = np.zeros(len(w.start) + 1, dtype=np.int64)
    items: list[set[str]] = [set() for _ in range(s.rows)]
    for p in blocks:
        phrase, at = places(w, p)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + p.lengths[phrase], -1)
        if len(at):
            row = np.searchsorted(w.bounds, at, "right") - 1
            for key in np.unique(row * np.int64(len(p.items)) + p.owner[phrase]).tolist():
                items[key // len(p.items)].add(p.items[key % len(p.items)])
    hit = np.cumsum(edge)[:-1] > 0
    return w, hit, [sorted(i) for i in items], sums(hit, w.bounds)


def blocks_of(benchmark: DataFrame, key: str, text: str, window: int, block_words: int) -> tuple[DataFrame, int]:
    """(stored stretches of the benchmark's texts with their block, number of blocks)."""

    def run(batches):
        for batch in batches:
            rows = list(segments(batch, window, SEGMENT_WORDS))
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.string()), pa.array([h.tobytes() for _, h in rows], pa.binary())],
                                             names=["item", "hashes"])

    texts = benchmark.select(F.col(f"`{key}`").cast("string").alias("item"), F.col(f"`{text}`").cast("string").alias("text"))
    return in_blocks(stored(texts.mapInArrow(run, "item string, hashes binary"), "benchmark"), ["item", "hashes"], F.octet_length("hashes") / 8, block_words)


def sent_block(parts: DataFrame, block: int, window: int):
    """The windows of one block as a broadcast; the driver gathers no more than that block."""
    rows = parts.where(F.col("block") == block).select("item", "hashes").collect()
    made = windows_of([(r["item"], np.frombuffer(r["hashes"], np.uint64)) for r in rows], window)
    return parts.sparkSession.sparkContext.broadcast(made)


def _spans(hit: np.ndarray, a: int, b: int) -> list[dict[str, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[a:b].astype(np.int8), [0]])))
    return [{"first_word": int(x), "end_word": int(y)} for x, y in zip(edge[::2], edge[1::2])]


FOUND = "row long, n_words long, items array<string>, spans array<struct<first_word:long,end_word:long>>"
_SPANS = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64())]))


def searched(rows: DataFrame, block, every: bool) -> DataFrame:
    """What one block's windows hit in (row, text): the words of each text, items and spans; only texts with a hit unless ``every``."""

    def run(batches):
        for batch in batches:
            for s in slices(batch.column(1), lower=True):
                w, hit, items, n_hit = hits(s, [block.value])
                keep = np.arange(s.rows) if every else np.flatnonzero(n_hit)
                spans = [_spans(hit, w.bounds[i], w.bounds[i + 1]) if n_hit[i] else [] for i in keep]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.first, s.rows).take(pa.array(keep)), pa.array(np.diff(w.bounds)[keep]),
                     pa.array([items[i] for i in keep], pa.list_(pa.string())), pa.array(spans, _SPANS)],
                    names=["row", "n_words", "items", "spans"])

    return rows.mapInArrow(run, FOUND)


def merged(found: DataFrame) -> DataFrame:
    """One row for each row of several passes: items of all, spans united where they touch or overlap."""

    def run(batches):
        for batch in batches:
            items, spans = [], []
            for passes in batch.column(2).to_pylist():
                items.append(sorted({i for p in passes for i in p["items"]}))
                out: list[dict[str, int]] = []
                for s in sorted((s for p in passes for s in p["spans"]), key=lambda s: s["first_word"]):
                    if out and s["first_word"] <= out[-1]["end_word"]:
                        out[-1]["end_word"] = max(out[-1]["end_word"], s["end_word"])
                    else:
                        out.append(dict(s))
                spans.append(out)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(items, pa.list_(pa.string())), pa.array(spans, _SPANS)],
                                             names=["row", "n_words", "items", "spans"])

    passes = F.collect_list(F.struct("items", "spans"))  # one of each pass at most
    return found.groupBy("row").agg(F.max("n_words").alias("n_words"), passes.alias("passes")).mapInArrow(run, FOUND)


def in_passes(rows: DataFrame, parts: DataFrame, blocks: int, window: int) -> DataFrame:
    """What all blocks hit in stored (row, text): a pass for each, merged by row."""
    found = None
    for b in range(blocks):
        block = sent_block(parts, b, window)
        own = stored(searched(rows, block, b == 0), "hits")
        block.unpersist()
        found = own if found is None else found.unionByName(own)
    return merged(found)


def judged(found: DataFrame, share: int) -> DataFrame:
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end_word"] - s["first_word"])
    found = found.withColumn("n_hit", n_hit)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def scan(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
         item_text: str = "text", window: int = WINDOW, share: int = SHARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of ``docs``: hit words, ids of the items found (sorted) and the word spans to remove.

    A null or empty text has no words and is never contaminated; a null key stays null; repeated
    rows are judged each. Benchmark rows without an id or without words are passed over; an empty
    benchmark hits nothing. Other columns are not looked at. The texts are read once for each block.
    """
    parts, blocks = blocks_of(benchmark, item, item_text, window, block_words)
    rows = only(docs, key, text)
    if blocks == 1:  # nothing to merge: a row needs no number
        found = searched(rows, sent_block(parts, 0, window), True).withColumnRenamed("row", "doc_id")
    else:
        rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
        found = in_passes(rows.select("row", "text"), parts, blocks, window).join(rows.select("row", "doc_id"), "row")
    return judged(found, share).select("doc_id", "n_words", "n_hit", "items", "spans", "contaminated")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
          window: int = WINDOW, share: int = SHARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns and unchanged texts.

    Null and empty texts have no words and stay; repeated rows and rows without a key are judged
    each. A benchmark of one block is searched where the rows lie.
    """
    parts, blocks = blocks_of(benchmark, item, item_text, window, block_words)
    if blocks == 1:
        sent, place = sent_block(parts, 0, window), docs.columns.index(text)

        def run(batches):
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                for s in slices(batch.column(place), lower=True):
                    w, _, _, n_hit = hits(s, [sent.value])
                    keep[s.first:s.last] = (n_hit == 0) | (share * n_hit < np.diff(w.bounds))
                yield batch.filter(pa.array(keep))

        return docs.mapInArrow(run, docs.schema)
    row = "row"
    while row in docs.columns:
        row += "_"
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    texts = rows.select(F.col(row).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    left = judged(in_passes(texts, parts, blocks, window), share).where("NOT contaminated")
    return rows.join(left.select(F.col("row").alias(row)), row, "left_semi").select(docs.columns)

"""Ranked lexical search: the best documents for each item, by term weights and lengths.

The documents pass once and leave what the items ask for: their length and how often they hold each
term of an item. These rows are made into posting lists, some thousand documents at a time (a
shard), and every item is searched in every shard:

* its short lists are materialised: contributions are summed up document by document (term at a
  time), and the accumulators become one list with a bound of its own;
* that list and the long lists are passed document at a time, in blocks of documents. A block whose
  bounds (of the accumulators and of each long list in this block) cannot reach the item's 50th score
  so far is skipped. In other blocks the lists are added from the highest bound down, and a block
  is left as soon as what is open cannot lift any document of it to that score; when few documents
  are left, only they are looked up in the lists to come.

The best of all shards meet in one window per item, of which Spark keeps ``TOP`` rows per task.
All scores are 64-bit integers, so the order of summing does not matter.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .tables import in_blocks, only, stored
from .words import ALNUM, owners, slices, words

TOP = 50
#: (item, term) pairs that are sent to the tasks at once; more items take more passes.
BLOCK_PAIRS = 1 << 18
#: Postings of a shard; a document with more is a shard of its own.
SHARD_POSTINGS = 1 << 21
#: Documents whose bounds are compared at once.
BLOCK_DOCS = 1024
#: Lists that hold at most this share of a shard's documents together are summed up first.
SHORT = 0.25
#: Documents of a block that are looked up one by one instead of adding whole lists.
FEW = 24
#: Share of the score due to a document's length, in hundredths.
LENGTH_PERCENT = 50
UNIT = 1_000_000_000


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def parts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What one unit of weight gives for each posting: (UNIT * tf) div (1000 * tf + 20 * m)."""
    if len(n) and LENGTH_PERCENT * n_docs * int(n.max()) >= 1 << 63:
        n = n.astype(object)
    m = (100 - LENGTH_PERCENT + (LENGTH_PERCENT * n * n_docs) // n_terms).astype(np.int64)
    return (UNIT * tf) // (1000 * tf + 20 * m)


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item_id, term) pairs, each once. A term is a 64-bit hash of its bytes, as a long."""

    def run(batches):
        for batch in batches:
            for s in slices(batch.column(1), lower=True):
                w = words(s, ALNUM)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.first, s.rows).take(pa.array(owners(w.bounds))), pa.array(w.hash.view(np.int64))],
                    names=["item_id", "term"])

    return only(items, key, text).toDF("item_id", "text").mapInArrow(run, "item_id long, term long").distinct()


def forward(docs: DataFrame, key: str, text: str, vocabulary) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term; only terms of the vocabulary (a broadcast
    of sorted hashes) are listed, by their number in it."""

    def run(batches):
        known = vocabulary.value
        for batch in batches:
            ids = batch.column(0)
            for s in slices(batch.column(1), lower=True):
                w = words(s, ALNUM)
                at = np.minimum(np.searchsorted(known, w.hash), len(known) - 1)
                hit = known[at] == w.hash
                pairs, tf = np.unique(owners(w.bounds)[hit] * len(known) + at[hit], return_counts=True)
                row, term = pairs // len(known), pairs % len(known)
                n = np.diff(w.bounds)
                some = np.flatnonzero(n)
                ends = pa.array(np.concatenate([[0], np.searchsorted(row, some, "right")]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(v.astype(np.int32))) for v in (term, tf)]
                yield pa.RecordBatch.from_arrays([ids.slice(s.first, s.rows).take(pa.array(some)), pa.array(n[some].astype(np.int64)), *lists],
                                                 names=["doc_id", "n", "terms", "tfs"])

    return only(docs, key, text).mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


@dataclass
class Best:
    """The best documents of an item so far."""

    scores: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    absent: np.ndarray = field(default_factory=lambda: np.empty(0, bool))
    #: A document below this score is not wanted.
    least: int = 1

    def add(self, scores: np.ndarray, ids: np.ndarray, absent: np.ndarray, top: int) -> None:
        scores, ids, absent = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids]), np.concatenate([self.absent, absent])
        order = np.lexsort([ids, absent, -scores])[:top]
        self.scores, self.ids, self.absent = scores[order], ids[order], absent[order]
        if len(order) == top:
            self.least = max(1, int(self.scores[-1]))


class Shard:
    """Posting lists of some documents, and the search in them."""

    def __init__(self, ids, absent, doc, term, gain, n_terms: int):
        """Documents with their keys; ``gain`` is what a term adds to the score of a document, postings by document."""
        order = np.argsort(term, kind="stable")
        self.ids, self.absent, self.docs = ids, absent, len(ids)
        self.doc, self.gain = doc[order], gain[order]
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.blocks = -(-self.docs // BLOCK_DOCS)
        self.edges = np.minimum(np.arange(self.blocks + 1) * BLOCK_DOCS, self.docs)
        self.cuts: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def cut(self, doc: np.ndarray, gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each block begins in a list, and the list's greatest gain in each block."""
        at = np.searchsorted(doc, self.edges)
        most = np.zeros(self.blocks, np.int64)
        full = np.flatnonzero(at[1:] > at[:-1])
        if len(full):
            most[full] = np.maximum.reduceat(gain, at[full])
        return at, most

    def long_list(self, t: int):
        a, b = self.start[t], self.start[t + 1]
        if t not in self.cuts:
            self.cuts[t] = self.cut(self.doc[a:b], self.gain[a:b])
        return self.doc[a:b], self.gain[a:b], *self.cuts[t]

    def summed(self, terms: list[int]):
        """Accumulators of short lists: documents in order and their sums."""
        doc = np.concatenate([self.doc[self.start[t]:self.start[t + 1]] for t in terms] or [np.empty(0, np.int64)])
        gain = np.concatenate([self.gain[self.start[t]:self.start[t + 1]] for t in terms] or [np.empty(0, np.int64)])
        order = np.argsort(doc, kind="stable")
        doc, gain = doc[order], gain[order]
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.empty(0, np.int64)
        doc, gain = doc[first], np.add.reduceat(gain, first) if len(first) else gain
        return doc, gain, *self.cut(doc, gain)

    def search(self, terms: np.ndarray, best: Best, top: int) -> None:
        size = self.start[terms + 1] - self.start[terms]
        terms = terms[size > 0]
        size = size[size > 0]
        order = np.argsort(size, kind="stable")
        terms, size = terms[order], size[order]
        short = int(np.searchsorted(np.cumsum(size), SHORT * self.docs, "right"))
        lists = [self.summed(terms[:short].tolist()), *[self.long_list(t) for t in terms[short:].tolist()]]
        bounds = np.stack([x[3] for x in lists])
        total = bounds.sum(0)
        for b in range(self.blocks):
            if total[b] >= best.least:
                self.block(b, lists, bounds[:, b], best, top)

    def block(self, b: int, lists, bounds: np.ndarray, best: Best, top: int) -> None:
        low = self.edges[b]
        score = np.zeros(self.edges[b + 1] - low, np.int64)
        open_ = int(bounds.sum())
        left = None
        for i in [0, *(1 + np.argsort(-bounds[1:], kind="stable")).tolist()]:
            doc, gain, at, _ = lists[i]
            own, more = doc[at[b]:at[b + 1]], gain[at[b]:at[b + 1]]
            open_ -= int(bounds[i])
            if left is None:
                score[own - low] += more
                # a document needs what is open besides its sum
                left = np.flatnonzero(score + open_ >= best.least)
            elif len(own):
                place = np.minimum(np.searchsorted(own, left + low), len(own) - 1)
                score[left] += np.where(own[place] == left + low, more[place], 0)
                left = left[score[left] + open_ >= best.least]
            if not len(left):
                return
            if len(left) > FEW:
                left = None
        if left is None:
            left = np.flatnonzero(score >= best.least)
        best.add(score[left], self.ids[left + low], self.absent[left + low], top)


def _gathered(batches):
    """Record batches of forward rows in groups of about SHARD_POSTINGS postings."""
    held, size = [], 0
    for batch in batches:
        at = 0
        ends = np.asarray(batch.column(2).offsets)
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(ends, ends[at] + SHARD_POSTINGS - size, "right")) - 1)
            upto = min(upto, batch.num_rows)
            held.append(batch.slice(at, upto - at))
            size += int(ends[upto] - ends[at])
            at = upto
            if size >= SHARD_POSTINGS:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def shards(batches, weights: np.ndarray, n_docs: int, n_terms: int):
    """(shard, keys of its documents, which of them are null) for batches of forward rows."""
    for table in _gathered(batches):
        ids = table.column(0).combine_chunks()
        absent = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        terms, tfs = (table.column(i).combine_chunks() for i in (2, 3))
        doc = np.repeat(np.arange(len(ids)), terms.value_lengths().to_numpy())
        term, tf = (v.flatten().to_numpy().astype(np.int64) for v in (terms, tfs))
        gain = weights[term] * parts(tf, table.column(1).to_numpy()[doc], n_docs, n_terms)
        yield Shard(ids, absent, doc, term, gain, len(weights)), ids, absent


def found(rows: DataFrame, asked, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(item_id, doc_id, score): the best documents of each task for each item of ``asked``."""

    def run(batches):
        item_ids, terms_of, weights = asked.value
        best = [Best() for _ in item_ids]
        for shard, _, _ in shards(batches, weights, n_docs, n_terms):
            for terms, b in zip(terms_of, best):
                shard.search(terms, b, top)
        item = [i for i, b in zip(item_ids, best) for _ in range(len(b.scores))]
        if item:
            ids, absent, scores = (np.concatenate([getattr(b, k) for b in best]) for k in ("ids", "absent", "scores"))
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(ids, mask=absent), pa.array(scores)],
                                             names=["item_id", "doc_id", "score"])

    return rows.mapInArrow(run, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
           top: int = TOP, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above 0.

    Equal scores are ranked by doc_id, a null doc_id behind all others; repeated rows are documents
    of their own. Rows of one item_id are one item, so are those without an item_id. Null and empty
    texts have no terms: such a document is not counted, such an item has no rows. With no documents
    or no items the result is empty. Other columns are not looked at.
    """
    spark = docs.sparkSession
    # all terms of an item are in one block
    pairs, blocks = in_blocks(stored(item_terms(items, item, item_text), "item_terms"), ["item_id"], F.lit(1), block_pairs)
    out = None
    for b in range(blocks):
        asked = pairs.where(F.col("block") == b).select("item_id", "term").toArrow()
        if not asked.num_rows:
            continue
        known, number = np.unique(asked.column("term").to_numpy().view(np.uint64), return_inverse=True)
        terms_of: dict = {}
        for k, t in zip(asked.column("item_id").to_pylist(), number.tolist()):
            terms_of.setdefault(k, []).append(t)
        vocabulary = spark.sparkContext.broadcast(known)
        rows = stored(forward(docs, key, text, vocabulary), "forward")
        n_docs, n_terms = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if n_docs:
            df = rows.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
            weights = np.zeros(len(known), np.int64)
            weights[df.column("term").to_numpy()] = [weight(n_docs, c) for c in df.column("count").to_pylist()]
            sent = spark.sparkContext.broadcast((list(terms_of), [np.array(sorted(t)) for t in terms_of.values()], weights))
            best = stored(found(rows, sent, n_docs, n_terms, top), "found")
            out = best if out is None else out.unionByName(best)
            sent.unpersist()
        vocabulary.unpersist()
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")

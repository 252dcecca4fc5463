"""N-gram Jaccard join: sets of word shingles in one global order, joined in prefix trees.

1. One pass finds the size and a digest of every document's set, and shingles that are frequent
   within a slice. Equal sets are one entity from here on.
2. Shingles are ordered: rare ones by their hash, the frequent ones behind them by their count. Two
   sets that are similar enough share a shingle among the first ones of both (the prefix), so a
   pass emits (shingle, entity) for prefixes. Entities that share one meet at the smallest of them,
   each with a parity bitmap of its set: bits that differ are shingles that differ, so pairs with too
   many are no link. What is left falls into connected components, and links lie within them.
3. The sets of entities in components of two or more go to cells. A cell stores the sets of a
   component in a trie and sends every set down it; sets share the overlaps of their common
   beginnings, and a subtree is left when what remains of either side can no longer reach the
   overlap that the threshold asks for. A component too large for one cell is cut into blocks
   and every two blocks meet in a cell.

All pairs of a component are compared, each pair in one cell. :func:`linked` counts the links of every document and
names its component, :func:`links` gives the pairs themselves.

Order and frequency lists only decide how much work there is, never which links are found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .tables import only, stored
from .words import SPACED, Slice, chain, mix, owners, slices, sums, windows, words

NGRAM = 5
PERCENT = 80
#: A shingle in so many texts of one slice counts as frequent there; so many are kept in all.
FREQUENT_IN_SLICE, FREQUENT_KEPT = 5, 65_536
#: Bits of the first digest of a set (less in tests); the second has 64.
DIGEST_BITS = 64
#: Bits of the map of candidate entities; a false mark costs a row in a shuffle.
MAP_BITS = 24
#: Shingles in a cell, and bitmaps in a cell: small groups are put together up to it, large ones cut.
CELL_SHINGLES = 4_000_000
CELL_BITMAPS = 20_000
#: Symbols of a trie edge compared before the bounds are looked at again.
STRIDE = 64


class Sets:
    """Distinct shingles of the texts of a slice, sorted within each text."""

    def __init__(self, s: Slice, ngram: int):
        w = words(s, SPACED)
        n_words = np.diff(w.bounds)
        at, key = windows(w, ngram)
        row = owners(w.bounds)[at]
        short = np.flatnonzero((n_words > 0) & (n_words < ngram))
        if len(short):
            first = w.bounds[short]
            whole = np.zeros(len(short), dtype=np.uint64)
            for k in range(ngram):
                inside = k < n_words[short]
                part = w.hash[np.minimum(first + k, max(len(w.hash) - 1, 0))]
                whole = np.where(inside, chain([whole, part]), whole)
            key, row = np.concatenate([key, mix(whole)]), np.concatenate([row, short])
        key = key >> np.uint64(1)
        order = np.argsort(key)
        order = order[np.argsort(row[order].astype(np.uint16) if s.rows < 65_536 else row[order], kind="stable")]
        key, row = key[order], row[order]
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
        self.key, self.row = key[fresh], row[fresh]
        self.bounds = np.searchsorted(self.row, np.arange(s.rows + 1))
        self.size = np.diff(self.bounds)

    def ordered(self, frequent: np.ndarray) -> Sets:
        """The same sets in the global order: frequent shingles, by their place, behind the others.

        ``frequent`` has a row (shingle, place) for each, sorted by shingle.
        """
        if not len(frequent) or not len(self.key):
            return self
        slot = np.minimum(np.searchsorted(frequent[:, 0], self.key), len(frequent) - 1)
        known = frequent[slot, 0] == self.key
        rare = np.flatnonzero(~known)
        often = np.flatnonzero(known)
        often = often[np.lexsort((frequent[slot[often], 1], self.row[often]))]
        before = np.searchsorted(rare, self.bounds)
        key = np.empty_like(self.key)
        key[self.bounds[self.row[rare]] + np.arange(len(rare)) - before[self.row[rare]]] = self.key[rare]
        first = np.searchsorted(self.row[often], self.row[often])
        key[self.bounds[self.row[often]] + np.diff(before)[self.row[often]] + np.arange(len(often)) - first] = (
            frequent[slot[often], 1] | np.uint64(1 << 63))
        self.key = key
        return self


def digests(sets: Sets, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set (of shingles as they are, without the frequency order); ``bits`` of the first are kept."""
    spread = [mix(sets.key), mix(sets.key * np.uint64(3) + np.uint64(1))]
    total = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)]) for x in spread]
    sums_ = [t[sets.bounds[1:]] - t[sets.bounds[:-1]] for t in total]
    size = sets.size.astype(np.uint64)
    return tuple((chain(parts) >> np.uint64(64 - b)).view(np.int64) for parts, b in (([*sums_, size], bits), ([size, *sums_[::-1]], 64)))


def entities(sets: Sets, clashes: np.ndarray, bits: int) -> np.ndarray:
    """What each set is known by: its first digest, or the second where the first is that of other sets too."""
    first, second = digests(sets, bits)
    return np.where(np.isin(first, clashes), second, first) if len(clashes) else first


def bitmaps(sets: Sets) -> list[bytes]:
    """For each set, how often (odd or even) its shingles fall on each of 64, 128, .. bits, no fewer than shingles."""
    bits = 1 << np.maximum(np.ceil(np.log2(np.maximum(sets.size, 1))).astype(np.int64), 6)
    begin = np.cumsum(bits) - bits
    at = begin[sets.row] + (mix(sets.key) & (bits[sets.row] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(at, minlength=int(bits.sum())) & 1).astype(np.uint8)
    raw = np.packbits(odd, bitorder="little").tobytes()
    return [raw[a:a + n] for a, n in zip((begin // 8).tolist(), (bits // 8).tolist())]


def profile(docs: DataFrame, ngram: int) -> DataFrame:
    """(doc_id, size, entity, check, bitmap) of every row, and (shingle, times) of the frequent shingles of slices."""
    schema = "doc_id long, size long, entity long, check long, bitmap binary, shingle long, times long"
    bits = DIGEST_BITS

    def run(batches):
        for batch in batches:
            for s in slices(batch.column(1), lower=True):
                sets = Sets(s, ngram)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.first, s.rows), pa.array(sets.size), *map(pa.array, digests(sets, bits)),
                     pa.array(bitmaps(sets), pa.binary()), *[pa.nulls(s.rows, pa.int64())] * 2],
                    names=[c.split()[0] for c in schema.split(", ")])
                shingle, times = np.unique(sets.key, return_counts=True)
                often = times >= FREQUENT_IN_SLICE
                n = int(often.sum())
                yield pa.RecordBatch.from_arrays(
                    [*[pa.nulls(n, pa.int64())] * 4, pa.nulls(n, pa.binary()), pa.array(shingle[often].view(np.int64)), pa.array(times[often])],
                    names=[c.split()[0] for c in schema.split(", ")])

    return docs.mapInArrow(run, schema)


def prefix(size: np.ndarray, percent: int) -> np.ndarray:
    """How many of a set's first shingles must hold one of any set similar enough."""
    return np.where(size > 0, size - (percent * size + 99) // 100 + 1, 0)


def postings(docs: DataFrame, frequent, clashes: np.ndarray, ngram: int, percent: int) -> DataFrame:
    """(shingle, entity) of the prefixes; a task emits each entity once."""
    bits = DIGEST_BITS

    def run(batches):
        met: set[int] = set()
        for batch in batches:
            for s in slices(batch.column(1), lower=True):
                sets = Sets(s, ngram)
                entity = entities(sets, clashes, bits)
                new = np.zeros(s.rows, dtype=bool)
                for i, e in enumerate(entity.tolist()):
                    if e not in met:
                        met.add(e)
                        new[i] = True
                sets.ordered(frequent.value)
                place = np.arange(len(sets.key)) - sets.bounds[sets.row]
                keep = new[sets.row] & (place < prefix(sets.size, percent)[sets.row])
                yield pa.RecordBatch.from_arrays([pa.array(sets.key[keep].view(np.int64)), pa.array(entity[sets.row[keep]])],
                                                 names=["shingle", "entity"])

    return docs.mapInArrow(run, "shingle long, entity long")


def apart(rows: DataFrame, key: str, *sums) -> DataFrame:
    """Sums by a key whose rows are not yet dealt by the key alone: the hash among the grouping columns keeps
    the shuffle of the sums apart from that of a join with them, which adaptive execution can then split."""
    return rows.groupBy(key, F.xxhash64(key).alias("_mix")).agg(*sums).drop("_mix")


def stars(posted: DataFrame) -> DataFrame:
    """(low, high): for each shingle, its smallest entity with each of the others.

    A frequent shingle (below 0) may be in a large share of all prefixes: its smallest entity is found by a
    sum and joined back, where a hot shingle is split. Each of the others is in no more texts than
    the least frequent of the ``FREQUENT_KEPT``, so its entities fit one task.
    """
    inside = Window.partitionBy("shingle").orderBy("entity")
    rare = posted.where("shingle >= 0").withColumn("low", F.first("entity").over(inside)).select("low", "entity")
    often = posted.where("shingle < 0")
    often = often.join(apart(often, "shingle", F.min("entity").alias("low")), "shingle").select("low", "entity")
    return rare.union(often).where("low != entity").select("low", F.col("entity").alias("high")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (low, high); the root is the smallest node reachable.

    Large and small stars in turn, each round written to the shared folder, until nothing changes.
    """
    edges = edges.select(F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high")).where("low < high")
    edges = stored(edges.distinct(), "edges")
    known = None
    while True:
        # every larger neighbour of a node moves to the smallest node next to it
        both = edges.select(F.col("low").alias("node"), F.col("high").alias("next")).union(
            edges.select(F.col("high").alias("node"), F.col("low").alias("next")))
        least = apart(both, "node", F.min("next").alias("least")).select("node", F.least("least", "node").alias("least"))
        large = both.join(least, "node").where("next > node").select(F.col("least").alias("low"), F.col("next").alias("high"))
        large = large.where("low < high").distinct()
        # every node and its smaller neighbours move to the smallest of them
        floor = apart(large, "high", F.min("low").alias("least"))
        moved = large.join(floor, "high")
        small = (moved.select(F.col("least").alias("low"), F.col("low").alias("high"))
                 .union(floor.select(F.col("least").alias("low"), "high")).where("low < high").distinct())
        edges = stored(small, "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first()
        if state == known:
            return edges.select(F.col("high").alias("node"), F.col("low").alias("root")).union(
                edges.select(F.col("low").alias("node"), F.col("low").alias("root"))).distinct()
        known = state


class Trie:
    """Sorted sets as a tree of common beginnings. A node is a range of sets in lexicographic order
    and the stretch of symbols they share beyond their parent; its symbols are read from its first set."""

    def __init__(self, sets: list[np.ndarray]):
        # sets hold dense symbols; big-endian bytes compare as the sequences do
        raw = [x.astype(">u4").tobytes() for x in sets]
        self.order = sorted(range(len(sets)), key=raw.__getitem__)
        ordered = [sets[i] for i in self.order]
        self.size = np.array([len(x) for x in ordered], dtype=np.int64)
        self.flat = np.concatenate(ordered)
        self.at = np.cumsum(self.size) - self.size
        common = []
        for a, b in zip(ordered[:-1], ordered[1:]):
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            common.append(int(differ[0]) if len(differ) else n)
        low, high, begin, end, children = [], [], [], [], []
        todo = [(0, len(sets), 0, -1)]
        while todo:
            a, b, depth, parent = todo.pop()
            shared = min(common[a:b - 1], default=int(self.size[a]))
            me = len(low)
            for column, value in zip((low, high, begin, end, children), (a, b, depth, shared, [])):
                column.append(value)
            if parent >= 0:
                children[parent].append(me)
            cut = a
            if b - a > 1:
                for k in range(a, b - 1):
                    if common[k] == shared:
                        if self.size[cut] > shared:
                            todo.append((cut, k + 1, shared, me))
                        cut = k + 1
                if self.size[cut] > shared:
                    todo.append((cut, b, shared, me))
        self.low, self.high, self.begin, self.end = (np.array(x, dtype=np.int64) for x in (low, high, begin, end))
        count = np.array([len(c) for c in children], dtype=np.int64)
        self.child_at, self.child_n = np.cumsum(count) - count, count
        self.child = np.array([c for cs in children for c in cs], dtype=np.int64)
        self.least = np.minimum.reduceat(self.size, self.low) if len(low) == 1 else np.array([self.size[a:b].min() for a, b in zip(low, high)])
        self.most = np.array([self.size[a:b].max() for a, b in zip(low, high)])

    def similar(self, probe: np.ndarray, symbols: int, wanted: np.ndarray, percent: int) -> np.ndarray:
        """Sets (in the trie's order) among the wanted ones whose Jaccard with ``probe`` reaches the threshold."""
        n = len(probe)
        mark = np.zeros(symbols + 1, dtype=np.int64)
        mark[probe + 1] = 1
        passed = np.cumsum(mark)  # passed[x + 1]: symbols of the probe up to x
        total = np.concatenate([[0], np.cumsum(wanted)])
        node, pos, over = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        found = []
        while len(node):
            # leave subtrees without a wanted set, of other lengths, or that cannot reach the overlap any more
            last = self.flat[self.at[self.low[node]] + np.maximum(pos, 1) - 1]
            left = np.where(pos > 0, n - passed[last + 1], n)
            reach = over + np.minimum(left, self.most[node] - pos)
            need = -(-percent * (n + np.maximum(self.least[node], pos)) // (100 + percent))
            live = ((total[self.high[node]] > total[self.low[node]]) & (reach >= need)
                    & (100 * self.most[node] >= percent * n) & (percent * self.least[node] <= 100 * n))
            node, pos, over = node[live], pos[live], over[live]
            if not len(node):
                break
            step = np.minimum(self.end[node] - pos, STRIDE)
            ends = np.cumsum(step)
            index = np.arange(ends[-1]) + np.repeat(self.at[self.low[node]] + pos - ends + step, step)
            seen = np.concatenate([[0], np.cumsum(mark[self.flat[index] + 1])])
            over = over + seen[ends] - seen[ends - step]
            pos = pos + step
            done = pos == self.end[node]
            at_end, its = node[done], over[done]
            # sets that end at this node come first in its range
            first = self.low[at_end]
            while len(first):
                full = (first < self.high[at_end]) & (self.size[np.minimum(first, len(self.size) - 1)] == self.end[at_end])
                first, at_end_, its_ = first[full], at_end[full], its[full]
                hit = 100 * its_ >= percent * (n + self.size[first] - its_)
                found.append(first[hit & wanted[first]])
                at_end, its, first = at_end_, its_, first + 1
            node_, over_ = node[done], over[done]
            each = self.child_n[node_]
            down = self.child[np.arange(each.sum()) + np.repeat(self.child_at[node_] - np.cumsum(each) + each, each)]
            node = np.concatenate([node[~done], down])
            over = np.concatenate([over[~done], np.repeat(over_, each)])
            pos = np.concatenate([pos[~done], self.begin[down]])
        return np.concatenate(found) if found else np.empty(0, np.int64)


def linked_sets(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """All links of the given sets: (number of a set, numbers of sets it links with), each pair once."""
    if len(sets) < 2:
        return
    bounds = np.cumsum([0, *map(len, sets)])
    symbols, flat = np.unique(np.concatenate(sets), return_inverse=True)
    dense = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    trie = Trie(dense)
    order = np.array(trie.order)
    wanted = np.ones(len(sets), dtype=bool)
    for k, i in enumerate(trie.order):
        wanted[k] = False
        found = trie.similar(dense[i], len(symbols), wanted, percent)
        if len(found):
            yield i, order[found]


def candidates_of(docs: DataFrame, frequent, clashes: np.ndarray, marked, ngram: int) -> DataFrame:
    """(entity, size, payload: its shingles) of the documents whose entity is marked; a task emits each entity once."""
    digest_bits = DIGEST_BITS

    def run(batches):
        met: set[int] = set()
        for batch in batches:
            for s in slices(batch.column(1), lower=True):
                sets = Sets(s, ngram)
                entity = entities(sets, clashes, digest_bits)
                slot = entity.view(np.uint64) >> np.uint64(64 - MAP_BITS)
                bits = marked.value[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)
                rows = [i for i in np.flatnonzero(bits).tolist() if entity[i] not in met]
                if not rows:
                    continue
                sets.ordered(frequent.value)
                out = []
                for i in rows:
                    if int(entity[i]) not in met:
                        met.add(int(entity[i]))
                        out.append((int(entity[i]), int(sets.size[i]), sets.key[sets.bounds[i]:sets.bounds[i + 1]].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))],
                                                 names=["entity", "size", "payload"])

    return docs.mapInArrow(run, "entity long, size long, payload binary")


def alike(size: np.ndarray, raw: list[bytes], percent: int) -> np.ndarray:
    """For each bitmap, the first one that pairs with few enough differing bits lead to.

    Sets whose Jaccard reaches the threshold differ in at most (100 - percent) / (100 + percent) of the
    sum of their sizes, and no bit differs without a shingle. A longer bitmap is folded onto a shorter one.
    """
    label = np.full(len(size), -1, dtype=np.int64)
    width = np.array([len(r) for r in raw]) // 8
    rows = {w: np.flatnonzero(width == w) for w in np.unique(width).tolist()}
    bits = {w: np.frombuffer(b"".join([raw[i] for i in r]), dtype="<u8").reshape(len(r), w) for w, r in rows.items()}
    place = np.empty(len(size), dtype=np.int64)
    for r in rows.values():
        place[r] = np.arange(len(r))
    free = {w: np.ones(len(r), dtype=bool) for w, r in rows.items()}
    for root in range(len(size)):
        if label[root] >= 0:
            continue
        label[root] = root
        free[int(width[root])][place[root]] = False
        todo = [root]
        while todo:
            x = todo.pop()
            w = int(width[x])
            own = bits[w][place[x]]
            for other in (w // 2, w, w * 2):
                if other not in rows:
                    continue
                left = np.flatnonzero(free[other])
                n = size[rows[other][left]]
                left = left[(100 * n >= percent * size[x]) & (percent * n <= 100 * size[x])]
                if not len(left):
                    continue
                theirs, mine = bits[other][left], own
                if other < w:
                    mine = own[:other] ^ own[other:]
                elif other > w:
                    theirs = theirs[:, :w] ^ theirs[:, w:]
                differ = np.bitwise_count(theirs ^ mine).sum(axis=1, dtype=np.int64)
                near = left[(100 + percent) * differ <= (100 - percent) * (size[rows[other][left]] + size[x])]
                free[other][near] = False
                found = rows[other][near]
                label[found] = root
                todo += found.tolist()
    return label


def dealt(rows: DataFrame, weight: str, limit: int) -> DataFrame:
    """``rows`` (root, entity, ..) with the cell (cell, a, b) they go to, and their own block of ``blocks``.

    Groups up to ``limit`` (the sum of ``weight``) are put together in a cell; a larger one is cut
    into blocks by a hash, and every two blocks meet in a cell.
    """
    columns = rows.columns
    spark = rows.sparkSession
    sizes = rows.groupBy("root").agg(F.sum(F.expr(weight)).alias("volume"))
    sizes = sizes.withColumn("blocks", F.ceil(F.col("volume") / limit).cast("int"))
    small = sizes.where("blocks <= 1").agg(F.coalesce(F.sum("volume"), F.lit(0))).first()[0]
    groups = int(small) // limit * 2 + 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.join(sizes.select("root", "blocks"), "root").withColumn("own", F.pmod(F.xxhash64("entity"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.when(F.col("blocks") > 1, F.array_except(
        F.sequence(F.lit(0), F.col("blocks") - 1), F.array("own"))).otherwise(F.array(F.lit(0)))))
    return rows.select(
        F.when(F.col("blocks") > 1, F.col("root")).otherwise(F.pmod(F.xxhash64("root"), F.lit(groups))).alias("cell"),
        F.when(F.col("blocks") > 1, F.least("own", "other")).otherwise(F.lit(-1)).alias("a"),
        F.greatest("own", "other").alias("b"), *columns, "own", "blocks")


def groups_of(root: np.ndarray, entity: np.ndarray) -> Iterator[np.ndarray]:
    """The rows of each root, one of each entity."""
    order = np.lexsort((entity, root))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (entity[order][1:] != entity[order][:-1]) | (root[order][1:] != root[order][:-1])
    order = order[fresh]
    cuts = np.flatnonzero(np.concatenate([[True], root[order][1:] != root[order][:-1], [True]]))
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield order[a:b]


def cells(rows: DataFrame, weight: str, limit: int, run) -> DataFrame:
    """(low, high) that ``run`` finds in the groups of ``rows`` (root, entity, size, payload).

    ``run`` gets the sizes and payloads of a group and returns, for each, the first one it is connected to.
    """

    def meet(table: pa.Table) -> pa.Table:
        root, entity, size = (table.column(c).to_numpy() for c in ("root", "entity", "size"))
        raw = table.column("payload").to_pylist()
        low, high = [], []
        for mine in groups_of(root, entity):
            label = run(size[mine], [raw[i] for i in mine.tolist()])
            linked = np.flatnonzero(label != np.arange(len(label)))
            low.append(entity[mine[label[linked]]])
            high.append(entity[mine[linked]])
        return pa.table({"low": np.concatenate(low) if low else np.empty(0, np.int64),
                         "high": np.concatenate(high) if high else np.empty(0, np.int64)})

    rows = dealt(rows.select("root", "entity", "size", "payload"), weight, limit).drop("own", "blocks")
    return rows.groupBy("cell", "a", "b").applyInArrow(meet, "low long, high long")


def all_links(table: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """All links of a cell of :func:`dealt`: (rows of a group, number of one in it, numbers of those it links with).

    Every pair of entities is given in one cell only: two of different blocks meet once, and those of
    one block are paired where it meets the block after it.
    """
    root, entity, own, blocks, a, b = (table.column(c).to_numpy() for c in ("root", "entity", "own", "blocks", "a", "b"))
    home = (blocks <= 1) | (np.where(own == a, b, a) == (own + 1) % np.maximum(blocks, 1))
    raw = table.column("payload").to_pylist()
    for mine in groups_of(root, entity):
        block, at_home = own[mine], home[mine]
        for i, found in linked_sets([np.frombuffer(raw[k], dtype=np.uint64) for k in mine.tolist()], percent):
            found = found[(block[found] != block[i]) | at_home[found]]
            if len(found):
                yield mine, i, found


def pairs(candidates: DataFrame, percent: int) -> DataFrame:
    """(low, high): every two different sets that link, once, named by their entities."""

    def meet(table: pa.Table) -> pa.Table:
        entity = table.column("entity").to_numpy()
        low, high = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for mine, i, found in all_links(table, percent):
            one, others = entity[mine[i]], entity[mine[found]]
            low.append(np.minimum(one, others))
            high.append(np.maximum(one, others))
        return pa.table({"low": np.concatenate(low), "high": np.concatenate(high)})

    return dealt(candidates, "size", CELL_SHINGLES).groupBy("cell", "a", "b").applyInArrow(meet, "low long, high long")


def counted(candidates: DataFrame, percent: int) -> DataFrame:
    """(low, null, n): n links of the set ``low`` with texts of other sets, in parts to be added up; and
    (low, high, null): links enough to connect what is connected. ``candidates`` has ``times``, the texts of a set."""

    def meet(table: pa.Table) -> pa.Table:
        entity, times = (table.column(c).to_numpy() for c in ("entity", "times"))
        n = np.zeros(len(entity), dtype=np.int64)
        label = np.arange(len(entity))
        low, high = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for mine, i, found in all_links(table, percent):
            one, others = mine[i], mine[found]
            n[one] += times[others].sum()
            n[others] += times[one]
            fresh, first = np.unique(label[others], return_index=True)
            new = fresh != label[one]
            if new.any():
                ends = entity[others[first[new]]]
                low.append(np.full(len(ends), entity[one]))
                high.append(ends)
                label[mine[np.isin(label[mine], fresh[new])]] = label[one]
        rows = np.flatnonzero(n)
        low, high = np.concatenate([*low, entity[rows]]), np.concatenate(high)
        return pa.table({"low": low, "high": pa.concat_arrays([pa.array(high), pa.nulls(len(rows), pa.int64())]),
                         "n": pa.concat_arrays([pa.nulls(len(high), pa.int64()), pa.array(n[rows])])})

    return dealt(candidates, "size", CELL_SHINGLES).groupBy("cell", "a", "b").applyInArrow(meet, "low long, high long, n long")


def compared(docs: DataFrame, ngram: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The stored :func:`profile`, and (entity, size, payload, root) of the sets that may have links; links lie within a root."""
    spark = docs.sparkSession
    first = stored(profile(docs, ngram), "profile")
    often = (first.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("times").alias("times"))
             .orderBy(F.desc("times"), "shingle").limit(FREQUENT_KEPT).select("shingle").collect())
    table = np.array([(r[0], len(often) - i) for i, r in enumerate(often)], dtype=np.int64).reshape(-1, 2)
    frequent = spark.sparkContext.broadcast(table[np.argsort(table[:, 0])].view(np.uint64))  # the most frequent one last

    # sets are told apart by two digests: where the first alone would not do, the second stands for the set
    shared = (first.where("shingle IS NULL").groupBy("entity").agg(F.min("check").alias("low"), F.max("check").alias("high"))
              .where("low != high").select("entity").collect())  # some n * n / 2**65 of n different sets
    clashes = np.array(sorted(r[0] for r in shared), dtype=np.int64)
    if len(clashes):
        first = first.withColumn("entity", F.when(F.col("entity").isin(clashes.tolist()), F.col("check")).otherwise(F.col("entity")))

    met = stars(stored(postings(docs, frequent, clashes, ngram, percent), "postings")).select("low", F.explode(F.array("low", "high")).alias("entity")).distinct()
    bitmap = (first.where("shingle IS NULL").groupBy("entity").agg(F.first("size").alias("size"), F.first("bitmap").alias("payload")))
    met = stored(met.select(F.col("low").alias("root"), "entity").join(bitmap, "entity"), "met")
    near = stored(components(cells(met, "1", CELL_BITMAPS, lambda size, raw: alike(size, raw, percent))), "near")
    slot = F.shiftrightunsigned("node", 64 - MAP_BITS)
    bits = (near.groupBy(F.shiftright(slot, 6).alias("word"))
            .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(node, {64 - MAP_BITS}) & 63 as int))")).alias("bits")).collect())
    marks = np.zeros(1 << (MAP_BITS - 6), dtype=np.int64)
    for r in bits:
        marks[r["word"]] = r["bits"]
    marked = spark.sparkContext.broadcast(marks.view(np.uint64))

    sets = candidates_of(docs, frequent, clashes, marked, ngram)
    candidates = stored(sets.join(near.select(F.col("node").alias("entity"), "root"), "entity"), "candidates")
    return first, candidates


def named(first: DataFrame, links: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and entity of every document of ``first``; ``links`` are the :func:`components`."""
    rows = first.where("shingle IS NULL").select("doc_id", "size", "entity")
    rows = rows.join(links.select(F.col("node").alias("entity"), "root"), "entity", "left")
    rows = rows.withColumn("class", F.coalesce("root", "entity"))
    least = apart(rows.where("size > 0"), "class", F.min("doc_id").alias("least"))
    return rows.join(least, "class", "left").select(
        "doc_id", F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"), "entity")


def linked(docs: DataFrame, key: str = "doc_id", text: str = "text", ngram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links of every row of ``docs``.

    Two texts link when 100 * common shingles >= percent * all their shingles. component_id is the
    smallest doc_id that links lead to, n_links the number of other rows that a row links with: all pairs of
    different sets are compared, a link with a set counts for each of its rows, and rows of equal
    sets link with each other. A text without words (null, empty, blank) has size 0, links with nothing
    and keeps its own doc_id. Repeated rows are equal sets; a row without a doc_id connects others
    but names no component (null if there is no other row). An empty table gives no rows. Other
    columns are not looked at.
    """
    first, candidates = compared(only(docs, key, text), ngram, percent)
    profiles = first.where("shingle IS NULL")
    times = profiles.groupBy("entity").agg(F.count("*").alias("times"))
    found = stored(counted(candidates.join(times, "entity"), percent), "links")
    rows = named(first, components(found.where("high IS NOT NULL").select("low", "high")))
    # what a set's links add up to beside the number of its rows, in one sum by set
    totals = apart(profiles.select("entity", F.lit(1).alias("one"), F.lit(0).alias("n")).union(
        found.where("high IS NULL").select(F.col("low").alias("entity"), F.lit(0).alias("one"), "n")), "entity",
        (F.sum("one") + F.sum("n") - 1).alias("others"))
    rows = rows.join(totals, "entity")
    return rows.select("doc_id", "n_shingles", "component_id", F.when(F.col("n_shingles") > 0, F.col("others")).otherwise(0).cast("long").alias("n_links"))


def links(docs: DataFrame, key: str = "doc_id", text: str = "text", ngram: int = NGRAM,
          percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): doc_id, n_shingles and entity of every row, and (low, high) of every two entities that link.

    An entity stands for all rows with one set. The pairs of a group of near copies are as many as its links.
    """
    first, candidates = compared(only(docs, key, text), ngram, percent)
    members = first.where("shingle IS NULL").select("doc_id", F.col("size").alias("n_shingles"), "entity")
    return members, stored(pairs(candidates, percent), "pairs")

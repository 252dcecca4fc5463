"""Best-fit packing by bin completion over the histogram of lengths.

Documents become ids and an end id; longer ones are cut into full sequences, the rest of such a
document being its first piece. Which pieces share a sequence depends on their lengths alone, and
there are at most ``capacity`` lengths, so the plan is made on the driver from that many counts,
whatever the number of documents. It is a list of fillings, each with how often it is used; every
piece then finds its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .ids import encoder, public_path
from .tables import numbered, only, stored
from .words import slices

CAPACITY = 2048
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"
#: Fillings tried around a largest piece in the first, narrow search; nodes of both searches together.
BRANCHES, NODES = 4, 60_000

Filling = tuple[tuple[int, int], ...]  # (length, how many), largest first

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID) -> DataFrame:
    """The pieces of every row of ``docs``; ids are little-endian unsigned 32-bit integers.

    A null or empty text is one piece that holds the end id; a null key stays null; each of several
    equal rows is packed.
    """

    def run(batches):
        texts = encoder(tokenizer, leading=True).texts
        end = np.array([end_id], dtype="<u4").tobytes()
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for s in slices(batch.column(1)):
                flat, at = texts(s)
                rows = []
                for doc, a, b in zip(keys[s.first:s.last], at[:-1].tolist(), at[1:].tolist()):
                    ids = flat[a:b].tobytes() + end
                    n = b - a + 1
                    cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                    for k, (c, d) in enumerate(zip(cuts[:-1], cuts[1:])):
                        part = ids[4 * c:4 * d]
                        rows.append((doc, k, c, d - c, zlib.crc32(part), part))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                                 names=[c.split()[0] for c in PIECES.split(", ")])

    return only(docs, key, text).mapInArrow(run, PIECES)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: by volume, and by pieces too long to share one."""
    if not counts:
        return 0
    lengths = sorted(counts)
    number = np.array([counts[s] for s in lengths], dtype=object)
    size = np.array(lengths, dtype=object)
    best = -(-int((number * size).sum()) // capacity)
    # for each alpha: pieces over capacity - alpha stand alone, those over half don't pair, the rest fill gaps
    for alpha in [0, *[s for s in lengths if 2 * s <= capacity]]:
        alone = sum(counts[s] for s in lengths if s > capacity - alpha)
        half = [(s, counts[s]) for s in lengths if 2 * s > capacity and s <= capacity - alpha]
        small = sum(s * counts[s] for s in lengths if alpha <= s and 2 * s <= capacity)
        free = sum((capacity - s) * c for s, c in half)
        best = max(best, alone + sum(c for _, c in half) + max(0, -(-(small - free) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing over groups of equal sequences: (filling, how many sequences)."""
    room: dict[int, list[tuple[Filling, int]]] = {}
    keys: list[int] = []

    def put(left: int, filling: Filling, times: int) -> None:
        if left not in room:
            room[left] = []
            keys.insert(bisect_right(keys, left), left)
        room[left].append((filling, times))

    for s in sorted(counts, reverse=True):
        todo = counts[s]
        while todo:
            i = bisect_right(keys, s - 1)
            if i == len(keys):
                left, filling, times = capacity, (), todo
            else:
                left = keys[i]
                filling, times = room[left].pop()
                if not room[left]:
                    del room[left]
                    keys.pop(i)
            each = min(left // s, todo)
            full = min(times, todo // each)
            if times > full and filling:
                put(left, filling, times - full)
            put(left - each * s, (*filling, (s, each)), full)
            todo -= each * full
    return [g for group in room.values() for g in group]


def completions(counts: dict[int, int], lengths: list[int], largest: int, capacity: int) -> Iterator[Filling]:
    """A few good ways to fill a sequence around its largest piece, least waste first.

    Fillings of two pieces use for each first the longest second that fits; the rest of a filling is
    completed by the longest that still fits. :func:`undominated` gives all ways.
    """
    rest = capacity - largest

    def longest(limit: int, used: dict[int, int]) -> int:
        i = bisect_right(lengths, limit) - 1
        while i >= 0 and counts[lengths[i]] - used.get(lengths[i], 0) <= 0:
            i -= 1
        return lengths[i] if i >= 0 else 0

    def complete(first: tuple[int, ...]) -> tuple[int, dict[int, int]]:
        used = {largest: 1}
        left = rest
        for s in first:
            used[s] = used.get(s, 0) + 1
            left -= s
        while left > 0 and (s := longest(left, used)):
            k = min(left // s, counts[s] - used.get(s, 0))
            used[s] = used.get(s, 0) + k
            left -= k * s
        return left, used

    single = longest(rest, {largest: 1})
    found = [complete(())]
    if single and single < rest:
        i = bisect_right(lengths, rest) - 1
        while i >= 0 and 2 * lengths[i] >= single and found[0][0] > 0:
            s = lengths[i]
            i -= 1
            if counts[s] - (s == largest) <= 0:
                continue
            second = longest(rest - s, {largest: 1, s: 1 + (s == largest)})
            if second and s + second > single:
                found.append(complete((s, second)))
                if found[-1][0] == 0 and len(found) > BRANCHES:
                    break
    seen = set()
    for _, used in sorted(found, key=lambda f: f[0]):
        filling = tuple(sorted(used.items(), reverse=True))
        if filling not in seen:
            seen.add(filling)
            yield filling
        if len(seen) >= BRANCHES:
            return


def undominated(counts: dict[int, int], lengths: list[int], largest: int, capacity: int,
                waste: int) -> Iterator[Filling | None]:
    """All undominated ways to fill a sequence around its largest piece but for ``waste``, longest pieces first, as asked for.

    A filling is dominated if some of its pieces (none, one or several) can give way to one free piece that
    is longer than them together and still fits, or to one of just their length that replaces several.
    None stands for a filling that is left out, so that the caller can count it.
    """
    free = sum(1 << s for s in lengths if counts[s] > (s == largest))
    chosen: list[tuple[int, int]] = []
    small = [0]  # volume of the free pieces of the first lengths
    for s in lengths:
        small.append(small[-1] + s * (counts[s] - (s == largest)))

    def dominated(room: int) -> bool:
        # bit x of any, one, two: some, one or more, two or more chosen pieces are x long together
        any_, one, two, left = 1, 0, 0, free
        for s, k in chosen:
            for _ in range(k):
                any_, one, two = any_ | any_ << s, one | any_ << s, two | one << s
            if counts[s] - (s == largest) == k:
                left &= ~(1 << s)
        if two & left:
            return True
        if not room:
            return False
        reach, width = any_ << 1, 1  # sums made longer by 1 to width
        while width < room:
            step = min(width, room - width)
            reach |= reach << step
            width += step
        return bool(reach & left)

    def fill(n: int, room: int, most: int) -> Iterator[Filling | None]:
        # pieces of the first n lengths are left to choose from; no more than ``most`` may stay empty
        n = min(n, bisect_right(lengths, room))
        while n and room - small[n] <= most:
            n -= 1
            s = lengths[n]
            number = counts[s] - (s == largest)
            for k in range(min(room // s, number), 0, -1):
                chosen.append((s, k))
                yield from fill(n, room - k * s, most if k == number else min(most, s - 1))
                chosen.pop()
            if number:
                most = min(most, s - 1)  # where such a piece still fits, it belongs
        if room > most or dominated(room):
            yield None
            return
        used = {largest: 1}
        for s, k in chosen:
            used[s] = used.get(s, 0) + k
        yield tuple(sorted(used.items(), reverse=True))

    yield from fill(len(lengths), capacity - largest, waste)


@dataclass
class Plan:
    """Fillings with how often each is used, the sequences that makes, how many any packing needs at least, and
    whether the plan is known to be minimal (it meets the bound, or the whole search came to its end)."""

    fillings: list[tuple[Filling, int]]
    used: int
    bound: int
    minimal: bool


def plan(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> Plan:
    """Fillings that use every piece once: bin completion with best fit as the first incumbent.

    A narrow search tries a few fillings, each as often as the counts allow; if it ends without
    meeting the lower bound, a whole one tries all undominated fillings and every number of times.
    A branch is left when the sequences so far and the volume of the rest cannot beat the
    incumbent; both searches end when the incumbent meets the lower bound, or after ``nodes`` nodes
    together, with the best packing so far. No clock: the same counts give the same plan anywhere.
    """
    counts = {s: c for s, c in counts.items() if c}
    bound = lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    used = sum(t for _, t in best)
    if used > bound:
        best, ended = _searched(counts, capacity, nodes, best, used, bound)
        used = sum(t for _, t in best)
    return Plan(best, used, bound, used == bound or ended)


def _searched(counts: dict[int, int], capacity: int, nodes: int, best: list[tuple[Filling, int]], used: int,
              bound: int) -> tuple[list[tuple[Filling, int]], bool]:
    """The best packing that ``nodes`` nodes find, and whether all were looked at."""
    left = dict(counts)
    lengths = sorted(left)
    volume = sum(s * c for s, c in left.items())
    path: list[tuple[Filling, int]] = []
    taken = tried = 0

    def most(filling: Filling) -> int:
        return min(left[s] // k for s, k in filling)

    def few() -> Iterator[tuple[Filling, int] | None]:
        return iter([(f, most(f)) for f in completions(left, lengths, lengths[-1], capacity)])

    def all_(closed: set[Filling]) -> Iterator[tuple[Filling, int] | None]:
        # what was tried around the same largest piece before needs no second try after the others
        own = []
        waste = (used - 1 - taken) * capacity - volume
        for filling in undominated(left, lengths, lengths[-1], capacity, waste):
            if filling is None or filling in closed:
                yield None
                continue
            closed.add(filling)
            own.append(filling)
            for times in range(most(filling), 0, -1):
                yield filling, times
        closed.difference_update(own)

    def give_back() -> None:
        nonlocal taken, volume
        filling, times = path.pop()
        taken -= times
        for s, k in filling:
            if left[s] == 0:
                lengths.insert(bisect_right(lengths, s), s)
            left[s] += k * times
            volume += s * k * times

    for whole in (False, True):
        stack = [(lengths[-1], closed := set(), all_(closed) if whole else few())]
        while stack:
            largest, closed, moves = stack[-1]
            move = next(moves, ())
            tried += 1
            if tried > nodes:
                return best, False
            if move is None:
                continue
            if not move:
                stack.pop()
                if path:
                    give_back()
                continue
            filling, times = move
            path.append((filling, times))
            taken += times
            for s, k in filling:
                left[s] -= k * times
                volume -= s * k * times
                if left[s] == 0:
                    lengths.pop(bisect_right(lengths, s) - 1)
            if volume == 0 and taken < used:
                best, used = list(path), taken
                if used == bound:
                    return best, True
            if volume == 0 or taken + math.ceil(volume / capacity) >= used:
                give_back()
            else:
                closed = closed if lengths[-1] == largest else set()
                stack.append((lengths[-1], closed, all_(closed) if whole else few()))
    return best, True


@dataclass
class Slots:
    """Where the pieces of each length go: ranks from ``first`` to the next one lie in consecutive
    sequences from ``sequence`` at ``offset``. Sorted by (length, first)."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces with these ranks among those of their length."""
        width = np.int64(1) << np.int64(44)
        i = np.searchsorted(self.length * width + self.first, length * width + rank, "right") - 1
        return self.sequence[i] + rank - self.first[i], self.offset[i]


def slots(fillings: list[tuple[Filling, int]]) -> Slots:
    ranks: dict[int, int] = {}
    rows = []
    sequence = 0
    for filling, times in fillings:
        offset = 0
        for s, k in filling:
            for _ in range(k):
                rows.append((s, ranks.get(s, 0), sequence, offset))
                ranks[s] = ranks.get(s, 0) + times
                offset += s
        sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return Slots(*table.T.copy())


def planned(parts: DataFrame, capacity: int = CAPACITY) -> tuple[Plan, dict[int, int]]:
    """The plan for stored pieces, and how many pieces there are of each length (at most ``capacity`` numbers)."""
    counts = {r["length"]: r["count"] for r in parts.groupBy("length").count().toLocalIterator()}
    return plan(counts, capacity), counts


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Places for ``parts`` (a stored table of :func:`pieces`): its columns but the ids, with
    sequence_id and offset. An empty table gives no rows.

    Pieces are ranked within their length by doc_id, piece, start and checksum, so it depends on them
    alone which of them share a sequence.
    """
    made, counts = planned(parts, capacity)
    sent = parts.sparkSession.sparkContext.broadcast((slots(made.fillings), before(counts)))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def run(batches):
        places, first = sent.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            sequence, offset = places.of(length, batch.column("position").to_numpy() - first[length])
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                                             names=[c.split()[0] for c in schema.split(", ")])

    rows = numbered(parts.select("doc_id", "piece", "start", "length", "ids_crc32"), ["length", "doc_id", "piece", "start", "ids_crc32"], "ranked")
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("position").cast("long")).mapInArrow(run, schema)


def before(counts: dict[int, int]) -> np.ndarray:
    """For each length, the number of shorter pieces."""
    out = np.zeros(max(counts, default=0) + 1, dtype=np.int64)
    for s, c in counts.items():
        out[s] = c
    return np.cumsum(out) - out


def sequences(parts: DataFrame, places: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, their pieces in order and their ids.

    A sequence has at most ``capacity`` ids, so no group is large. A piece is known by its document, number, place
    and checksum, a null doc_id too; pieces equal in all of these are one another's copies and
    stand for each other, so repeated rows come out as often as they went in. No places give no rows.
    """
    name = ["doc_id", "piece", "start", "ids_crc32"]
    once = parts.groupBy(*name).agg(F.first("ids").alias("ids")).withColumnsRenamed({c: f"_{c}" for c in name})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in name]
    rows = places.join(once, same).drop(*[f"_{c}" for c in name])
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    return (rows.groupBy("sequence_id").agg(inside.alias("pieces"))
            .select("sequence_id", F.transform("pieces", lambda p: p.dropFields("ids")).alias("pieces"),
                    F.aggregate("pieces", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids")))


def packed(docs: DataFrame, tokenizer: str | None = None, key: str = "doc_id", text: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Encodes ``docs`` once into the shared folder and packs the pieces."""
    tokenizer = tokenizer or public_path(TOKENIZER)
    return pack(stored(pieces(docs, tokenizer, key, text, capacity, end_id), "pieces"), capacity)

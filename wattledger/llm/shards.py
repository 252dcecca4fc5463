"""Sharding by histogram sort, in DataFrame functions only.

Documents are ordered by a hash of their text, then by their key, so equal texts stand together.
A boundary between shards is looked for by counting: the exact bytes between evenly spaced probes
are summed over all partitions, the two probes around the wanted share become the next round's
range, until a probe's share is close enough. Where one text alone outweighs the tolerance, the
boundary is refined among the keys of that text. Only sums between probes reach the driver, at
most ``PROBES`` for each boundary. Then the documents move once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from .tables import numbered, stored

SHARDS = 16
#: Distance of a boundary from its exact share at which the search ends, as a part of a shard.
TOLERANCE = 0.001
PROBES = 1024
LOW, HIGH = -(1 << 63), (1 << 63) - 1
LAW = "bytes"


@dataclass
class Search:
    """The range that one boundary is looked for in, and the best place so far."""

    wanted: int
    low: int = LOW  # the boundary is in low..high
    high: int = HIGH
    below: int = 0  # bytes below low
    best: int = LOW
    distance: int = field(default=1 << 62)
    rows: int = 0  # documents in the range

    @property
    def step(self) -> int:
        return max(1, -(-(self.high - self.low) // PROBES))

    def offer(self, place: int, below: int) -> None:
        if abs(below - self.wanted) < self.distance:
            self.best, self.distance = place, abs(below - self.wanted)


def between(key: Column, low: int, high: int) -> Column:
    return (key >= F.lit(low)) & (key < F.lit(high)) if high < HIGH else key >= F.lit(low)


def refine(rows: DataFrame, searches: list[Search], tolerance: int) -> None:
    """Rounds of counting for boundaries on column ``key`` (long) of ``rows``, until each is within the
    tolerance or its range is a single value."""
    for s in searches:
        s.offer(s.low, s.below)
    while open_ := [s for s in searches if s.distance > tolerance and s.high - s.low > 1]:
        ranges = sorted({(s.low, s.high) for s in open_})
        number = {r: i for i, r in enumerate(ranges)}
        range_of = F.coalesce(*[F.when(between(F.col("key"), a, b), F.lit(i)) for i, (a, b) in enumerate(ranges)])
        # the distance from the low end needs 65 bits where a range spans all longs
        probe = F.coalesce(*[F.when(F.lit(i) == F.col("which"), F.floor(
            (F.col("key").cast("decimal(20,0)") - F.lit(a).cast("decimal(20,0)")) / F.lit(max(1, -(-(b - a) // PROBES))).cast("decimal(20,0)")))
            for i, (a, b) in enumerate(ranges)])
        sums = (rows.withColumn("which", range_of).where("which IS NOT NULL").withColumn("probe", probe.cast("int"))
                .groupBy("which", "probe").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).collect())
        cells: dict[int, dict[int, int]] = {}
        count = {(r["which"], r["probe"]): r["rows"] for r in sums}
        for r in sums:
            cells.setdefault(r["which"], {})[r["probe"]] = r["size"]
        for s in open_:
            which, below, step, low = number[s.low, s.high], s.below, s.step, s.low
            found = cells.get(which, {})
            for i in sorted(found):
                s.offer(low + i * step, below)
                if below + found[i] >= s.wanted:
                    s.low, s.high, s.below = low + i * step, min(low + (i + 1) * step, s.high), below
                    s.offer(s.high, below + found[i])
                    s.rows = count[which, i]
                    break
                below += found[i]
                s.offer(min(low + (i + 1) * step, s.high), below)
            else:
                s.low = s.high


def splitters(rows: DataFrame, shards: int, tolerance: float) -> list[tuple[int, int]]:
    """Boundaries (hash, key) of ``rows`` (hash, id, size): a document belongs to the shard whose number is
    that of the boundaries not above it."""
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    allowed = int(total / shards * tolerance)
    searches = [Search(total * i // shards) for i in range(1, shards)]
    refine(rows.select(F.col("hash").alias("key"), "size"), searches, allowed)
    out = []
    for s in searches:
        if s.distance <= allowed or s.high - s.low > 1 or s.rows < 2:
            out.append((s.best, LOW))
            continue
        # one text holds the boundary: look among the keys of its copies
        inner = Search(s.wanted, below=s.below)
        refine(rows.where(F.col("hash") == F.lit(s.low)).select(F.col("id").alias("key"), "size"), [inner], allowed)
        out.append((s.low, inner.best) if inner.distance < s.distance else (s.best, LOW))
    return sorted(out)


def _measured(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, text, size, text_crc32 of every row, and what it is ordered by: hash and id."""
    body = F.coalesce("text", F.lit(""))
    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")).select(
        "doc_id", "text", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.xxhash64(body).alias("hash"), F.coalesce("doc_id", F.lit(LOW)).alias("id"))


def _dealt(rows: DataFrame, shards: int, tolerance: float) -> DataFrame:
    """Measured rows, moved to their place in the order, with law, shard, slot and grown_shard."""
    narrow = stored(rows.select("hash", "id", "size"), "sizes")
    cuts = splitters(narrow, shards, tolerance)
    shard = sum([((F.col("hash") > F.lit(h)) | ((F.col("hash") == F.lit(h)) & (F.col("id") >= F.lit(k)))).cast("int") for h, k in cuts], F.lit(0))
    counts = {r["shard"]: r["count"] for r in narrow.groupBy(shard.alias("shard")).count().collect()}
    before = [sum(counts.get(s, 0) for s in range(n)) for n in range(shards)]
    # shards are ranges of the order, so a slot is a position less the rows of the shards before
    return numbered(rows, ["hash", "id", "size", "text_crc32"], "ordered").withColumn("shard", shard).select(
        *[c for c in rows.columns if c not in ("hash", "id")], F.lit(LAW).alias("law"), "shard",
        (F.col("position") - F.get(F.array(*[F.lit(n) for n in before]), F.col("shard"))).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def placed(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of ``docs``; no text moves.

    A null text has size 1 and the checksum of nothing, a null key stands before all others; rows
    equal in key and text stand together, whatever their number. Slots of a shard are gapless from
    0, in the order of the text's hash, then the key, at any size. An empty table gives no rows. Under
    the law ``bytes`` growth is not asked for: grown_shard is null.
    """
    return _dealt(_measured(docs, key, text).drop("text"), shards, tolerance)


def sharded(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """:func:`placed` with the texts, which move once."""
    return _dealt(_measured(docs, key, text), shards, tolerance)


def write(docs: DataFrame, path: str, **options) -> None:
    """Writes the shards with their texts, a folder for each."""
    sharded(docs, **options).write.partitionBy("shard").parquet(path)

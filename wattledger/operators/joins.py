"""Joins. Equality columns always take part, so none of them becomes a nested loop."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def keep_keys(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``: one join in place of one query per key."""
    return rows.join(distinct_apart(keys.select(*on).dropna()), on, "left_semi")


def keep_known(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """:func:`keep_keys` for stored keys that are distinct and complete already: they are joined as they are read."""
    return rows.join(merged(keys.select(*on)), on, "left_semi")


def merged(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the facts: sorted and merged, never gathered on the driver.

    Spark's size check goes by stored bytes, and compressed keys and dates take many times as much once read.
    """
    return side.hint("merge")


def drop_keys(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key does not occur in ``keys``."""
    return rows.join(distinct_apart(keys.select(*on)), on, "left_anti")


def distinct_apart(keys: DataFrame) -> DataFrame:
    """Distinct keys that are not yet partitioned by the key alone.

    Joined directly, the shuffle of a distinct would also serve the join, and adaptive
    execution splits a hot partition only where both sides of a join come straight from
    shuffles of their own. The hash among the grouping columns keeps the two apart.
    """
    return keys.withColumn("__mix", F.xxhash64(*keys.columns)).distinct().drop("__mix")


def lookup(rows: DataFrame, names: DataFrame, on: dict[str, str], take: dict[str, str]) -> DataFrame:
    """Left join to a lookup table that holds one row per key.

    ``on`` maps row column to lookup column, ``take`` maps lookup column to result column. The
    table is joined as it is, so Spark knows its size and broadcasts a small one; that its keys
    are unique is checked once per table, by :func:`repeated_keys`.
    """
    named = names.select(*[F.col(b).alias(f"__k_{b}") for b in on.values()], *[F.col(c).alias(out) for c, out in take.items()])
    cond = reduce(and_, [rows[a] == F.col(f"__k_{b}") for a, b in on.items()])
    return rows.join(named, cond, "left").drop(*[f"__k_{b}" for b in on.values()])


def repeated_keys(names: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that several rows of a lookup table share, with their number; NULL keys are never looked up."""
    return (names.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def inside(points: DataFrame, windows: DataFrame, equal: dict[str, str], at: str,
           start: str, end: str, open_end: Column | None = None,
           how: str = "inner") -> DataFrame:
    """Rows of ``points`` with the windows they lie in, both ends included.

    A missing window end is replaced by ``open_end``. The two sides must not share names. Points and
    windows meet by entity and month: a window stands in each month it touches, a point in its own, so
    a point is compared only with windows near it, and each pair meets once. A window of twelve months or
    more stands in the years it touches instead (in an inner join), so it is not repeated for all its months. A window
    without an end stands in no month after the last point, however long it has been open. Spark's size
    check takes the repeated windows for as small as the stored ones, so both sides are sorted and merged
    and neither is gathered on the driver.
    """
    stop = F.col(end) if open_end is None else F.coalesce(F.col(end), open_end)
    last = stop if open_end is None else F.least(stop, points.agg(F.max(at)).scalar())
    ordered = F.col(start) <= last
    long = F.months_between(F.trunc(F.to_date(last), "month"), F.trunc(F.to_date(start), "month")) >= 12

    def met(some: Column, unit: str) -> DataFrame:
        places = F.sequence(F.trunc(F.to_date(start), unit), F.trunc(F.to_date(last), unit), F.expr(f"interval 1 {unit}"))
        spread = windows.where(ordered & some).withColumn("__place", F.explode(places))
        dated = points.withColumn("__at", F.trunc(F.to_date(at), unit))
        cond = (F.col("__at") == F.col("__place")) & (F.col(at) >= F.col(start)) & (F.col(at) <= stop)
        for left, right in equal.items():
            cond = cond & (F.col(left) == F.col(right))
        return dated.join(merged(spread), cond, how).drop("__at", "__place")

    if how != "inner":  # rows without a partner must not be told twice
        return met(F.lit(True), "month")
    return met(~long, "month").unionByName(met(long, "year"))


def both_sides(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join; the key columns of the result are filled from either side."""
    return left.join(right, keys, "full")


def with_latest_before(rows: DataFrame, marks: DataFrame, entity: str, end: str,
                       mark_code: str, mark_date: str, wanted: dict[str, int | None]) -> DataFrame:
    """Latest date of each wanted code at or before the row's end.

    ``wanted`` maps result column to code; a code that is None gives NULL. Only distinct
    (entity, code, date) marks matter, so they are reduced to those before the shuffle;
    then marks and rows pass one window per entity in date order, which is linear where a
    join would pair every mark with every row.
    """
    codes = sorted({c for c in wanted.values() if c is not None})
    if not codes:
        return rows.select("*", *[F.lit(None).cast("date").alias(n) for n in wanted])
    dated = (marks.where(F.col(mark_code).isin(codes) & F.col(mark_date).isNotNull())
             .select(F.col(entity), F.col(mark_code).alias("__code"),
                     F.col(mark_date).cast("date").alias("__at")).distinct())
    tagged = rows.withColumn("__at", F.col(end).cast("date")).withColumn("__own", F.lit(1))
    both = tagged.unionByName(dated.withColumn("__own", F.lit(0)), allowMissingColumns=True)
    order = (W.partitionBy(entity).orderBy(F.col("__at").asc_nulls_first(), F.col("__own"))
             .rowsBetween(W.unboundedPreceding, W.currentRow))
    seen = {name: (F.lit(None).cast("date") if code is None else
                   F.max(F.when(F.col("__code") == code, F.col("__at"))).over(order))
            for name, code in wanted.items()}
    return (both.select("*", *[v.alias(n) for n, v in seen.items()])
            .where(F.col("__own") == 1)
            .drop("__at", "__own", "__code"))


def siblings(members: DataFrame, drivers: DataFrame, entity: str, group: str) -> DataFrame:
    """All members of the groups that hold a driver entity."""
    groups = keep_keys(members, drivers, [entity]).select(group)
    return keep_keys(members, groups, [group])


def overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many distinct keys each side has and how many both have."""
    tagged = (left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r"))
              .unionByName(right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))))
    per_key = (tagged.where(F.col(key).isNotNull()).groupBy(key)
               .agg(F.max("l").alias("l"), F.max("r").alias("r")))
    zero = F.lit(0)
    return per_key.agg(F.coalesce(F.sum("l"), zero).alias("n_left"),
                       F.coalesce(F.sum("r"), zero).alias("n_right"),
                       F.coalesce(F.sum(F.col("l") * F.col("r")), zero).alias("n_both"))

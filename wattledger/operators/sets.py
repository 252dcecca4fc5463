"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def union_distinct(*parts: DataFrame) -> DataFrame:
    """One layout, matched by name, without repeated rows."""
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def union_tagged(tag: str, **parts: DataFrame) -> DataFrame:
    """All rows of all parts, each with the name of its part."""
    return reduce(lambda a, b: a.unionByName(b),
                  [df.withColumn(tag, F.lit(name)) for name, df in parts.items()])


def distinct_keys(rows: DataFrame, keys: list[str], needed: list[str] | None = None) -> DataFrame:
    """Distinct key combinations; NULLs are dropped on all keys, or only on ``needed``."""
    return rows.select(*keys).dropna(subset=keys if needed is None else needed).distinct()


def shared_values(left: DataFrame, left_col: str, right: DataFrame, right_col: str) -> DataFrame:
    """Values both columns hold; each side is made distinct before the two meet."""
    return (left.select(F.col(left_col).cast("string").alias("value")).distinct()
            .intersect(right.select(F.col(right_col).cast("string").alias("value")).distinct()))


def first_available(key: str, *candidates: DataFrame, k: int = 1) -> DataFrame:
    """The first k keys of the first candidate set that has any.

    Each set is cut to its k smallest keys before the union, so one small set is left.
    """
    ranked = [df.select(key).distinct().orderBy(F.col(key).asc()).limit(k)
              .withColumn("preference", F.lit(i)) for i, df in enumerate(candidates, 1)]
    every = reduce(lambda a, b: a.unionByName(b), ranked)
    # a window over at most k rows of each candidate
    best = F.min("preference").over(W.partitionBy(F.lit(1)))
    return every.withColumn("__best", best).where(F.col("preference") == F.col("__best")).select(key, "preference")


def column_difference(wanted: list[str], found: list[str]) -> dict[str, list[str]]:
    """Missing and surplus column names; schema only, no data is read."""
    return {"missing": [c for c in wanted if c not in found],
            "surplus": [c for c in found if c not in wanted]}

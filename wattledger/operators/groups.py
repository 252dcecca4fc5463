"""Aggregations, and totals put back on each row.

A grain that is small by meaning (a bill's line, a cell's device) is counted by a window. A group
that may be large (a contract, a category) is aggregated first, with partial sums on the map side,
and its totals are joined back, where adaptive execution splits a hot key.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.codes import col


def sum_where(condition: Column, value: str | Column) -> Column:
    return F.sum(F.when(condition, col(value)))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def any_true(condition: str | Column) -> Column:
    """True when a row satisfies the condition, false otherwise, also for unknown."""
    return F.bool_or(F.coalesce(col(condition), F.lit(False)))


def only_value(value: str | Column) -> Column:
    """The value when the group has exactly one, NULL when it has several or none."""
    v = col(value)
    return F.when(F.min(v) == F.max(v), F.max(v))


def sorted_set(value: str | Column) -> Column:
    """Distinct values in order, NULLs left out. For code and device columns."""
    return F.sort_array(F.collect_set(col(value)))


def steepness(computed: str, previous: str, current: str) -> Column:
    """Computed use per unit the dial advanced; NULL unless it advanced."""
    return F.when(F.col(current) > F.col(previous),
                  F.col(computed) / (F.col(current) - F.col(previous)))


def full_lap(digits: str, previous: str, current: str) -> Column:
    """Units a dial counted if it passed its highest number; NULL unless it went back."""
    lap = F.pow(F.lit(10.0), F.col(digits)) - F.col(previous) + F.col(current)
    went_back = (F.col(digits) > 0) & (F.col(current) < F.col(previous)) & (lap > 0)
    return F.when(went_back, lap)


def attach_totals(rows: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of rows to one-row-per-key totals; NULL keys match NULL keys.

    The totals are dealt anew for the join, apart from the shuffle that aggregated them: adaptive
    execution splits a hot key only where both sides of a join come straight from shuffles of their own.
    """
    extra = [c for c in totals.columns if c not in keys]
    mixed = totals.withColumn("__mix", F.xxhash64(*extra)).groupBy(*keys, "__mix").agg(*[F.max(c).alias(c) for c in extra])
    named = mixed.select(*[F.col(k).alias(f"__t_{k}") for k in keys], *extra)
    same_key = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__t_{k}")) for k in keys])
    kept = [c for c in extra if c not in rows.columns]
    return rows.join(named, same_key, "left").select(*rows.columns, *kept)


def with_group_size(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Number of rows that share the keys, on each row; for groups of any size."""
    return attach_totals(rows, rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)), keys)


def with_grain_rows(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Number of rows that share the keys, on each row; for grains that hold few rows by meaning."""
    return rows.withColumn(name, F.count(F.lit(1)).over(W.partitionBy(*keys)))


def distinct_rows(rows: DataFrame) -> DataFrame:
    """Rows equal in every column are one fact."""
    return rows.distinct()


def nest(rows: DataFrame, keys: list[str], entries: list[str], name: str) -> DataFrame:
    """One row per key with the sorted list of its entries.

    The keys are a business grain whose lists are short by meaning (the lines of a bill for one
    concept, cause and period; a day's comments of a kind), whatever the size of the data.
    """
    return rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*entries))).alias(name))


def cross_tab(rows: DataFrame, keys: list, name: str = "n_rows") -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def several_values(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Groups with more than one distinct value."""
    return (rows.groupBy(*keys).agg(F.countDistinct(value).alias(name))
            .where(F.col(name) > 1))


def average_group_size(rows: DataFrame, key: str) -> DataFrame:
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.count(F.lit(1)).alias("n_groups"), F.max("n").alias("largest"),
                     F.avg("n").alias("average"))


def frequency_top(rows: DataFrame, value: str, k: int) -> DataFrame:
    """The k most frequent values; equal counts are ordered by the value."""
    return (rows.groupBy(value).agg(F.count(F.lit(1)).alias("n_rows"))
            .orderBy(F.col("n_rows").desc(), F.col(value).asc_nulls_last()).limit(k))


def top_by(rows: DataFrame, measure: str, ties: list[str], k: int) -> DataFrame:
    """The k rows with the largest measure, NULLs last, ties by further columns."""
    order = [F.col(measure).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]]
    return rows.orderBy(*order).limit(k)


def runs_as_columns(log: DataFrame, key: str, run: str, runs: list, value: str) -> DataFrame:
    """One column per named run."""
    return log.groupBy(key).pivot(run, runs).agg(F.max(value))

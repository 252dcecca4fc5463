"""Changes to small managed tables, as joins and overwrites."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(table: DataFrame, seed: DataFrame, keys: list[str], managed: list[str],
           changed_at: tuple[str, datetime] | None = None) -> DataFrame:
    """Seed values win in managed columns, other columns keep what the table holds.

    Rows only in the table stay, rows only in the seed are added.
    """
    t, s = table.withColumn("__in_t", F.lit(True)), seed.withColumn("__in_s", F.lit(True))
    cond = reduce(and_, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    both = t.alias("t").join(s.alias("s"), cond, "full")
    seeded = F.col("__in_s").isNotNull()
    out: list[Column] = []
    for c in table.columns:
        if c in keys:
            out.append(F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")).alias(c))
        elif changed_at and c == changed_at[0]:
            out.append(F.when(seeded, F.lit(changed_at[1])).otherwise(F.col(f"t.{c}")).alias(c))
        elif c in managed and c in seed.columns:
            out.append(F.when(seeded, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        elif c in seed.columns:
            out.append(F.when(F.col("__in_t").isNull(), F.col(f"s.{c}"))
                       .otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return both.select(*out)


def add_missing(table: DataFrame, seed: DataFrame, keys: list[str]) -> DataFrame:
    """Seed rows whose key the table lacks are added; nothing else changes."""
    new = seed.join(table.select(*keys), keys, "left_anti")
    return table.unionByName(new, allowMissingColumns=True)


def replace_value(table: DataFrame, where: Column, column: str, old, new) -> DataFrame:
    """Replace a value only where it is still exactly the old one."""
    hit = where & F.col(column).eqNullSafe(F.lit(old))
    return table.withColumn(column, F.when(hit, F.lit(new)).otherwise(F.col(column)))


def retire(table: DataFrame, key: str, retired: list, active: str, note: str | None = None,
           remark: str = "note") -> DataFrame:
    """Switch rows off instead of deleting them; rows already off keep their note."""
    hit = F.col(key).isin(retired) & F.col(active)
    out = table
    if note is not None:
        out = out.withColumn(remark, F.when(hit, F.lit(note)).otherwise(F.col(remark)))
    return out.withColumn(active, F.when(hit, F.lit(False)).otherwise(F.col(active)))


def resolve_parent(table: DataFrame, links: DataFrame, name: str, ident: str,
                   parent: str) -> DataFrame:
    """Set the parent id from (child, parent) name pairs; other rows keep theirs."""
    ids = table.select(F.col(name).alias("__parent_name"), F.col(ident).alias("__parent_id"))
    pairs = (links.toDF("__child", "__parent_name")
             .join(ids, "__parent_name", "left").drop("__parent_name")
             .withColumn("__linked", F.lit(True)))
    value = F.when(F.col("__linked"), F.col("__parent_id")).otherwise(F.col(parent))
    return (table.join(pairs, F.col(name) == F.col("__child"), "left")
            .withColumn(parent, value).select(*table.columns))


def evolve(rows: DataFrame, added: dict[str, str]) -> DataFrame:
    """Absent columns are added at the end, typed and NULL; present ones stay."""
    return rows.select("*", *[F.lit(None).cast(t).alias(c) for c, t in added.items()
                              if c not in rows.columns])


def snapshot_totals(rows: DataFrame, run: str, measure: str) -> DataFrame:
    """Sum and row count per stored run."""
    return rows.groupBy(run).agg(F.sum(measure).alias("total"), F.count(F.lit(1)).alias("n_rows"))


def snapshot_diff(rows: DataFrame, run: str, before, after, keys: list[str], values: list[str], measure: str) -> DataFrame:
    """What changed between two stored runs: (outcome, n_rows, total_before, total_after).

    Outcomes are added, removed, changed and same. Only the two runs are read where rows are stored by
    run; both pass one aggregation by key, which holds one row of each, so nothing is joined. A key that
    a run repeats counts as changed unless both hold it equally often with equal values.
    """
    two = rows.where(F.col(run).isin(before, after))
    old, new = F.col(run) == F.lit(before), F.col(run) == F.lit(after)
    content = F.xxhash64(*values)
    cells = two.groupBy(*keys).agg(
        F.count_if(old).alias("__n_old"), F.count_if(new).alias("__n_new"),
        F.sum(F.when(old, content).cast("decimal(38,0)")).alias("__old"), F.sum(F.when(new, content).cast("decimal(38,0)")).alias("__new"),
        F.sum(F.when(old, F.col(measure))).alias("__m_old"), F.sum(F.when(new, F.col(measure))).alias("__m_new"))
    outcome = (F.when(F.col("__n_old") == 0, "added").when(F.col("__n_new") == 0, "removed")
               .when((F.col("__n_old") == F.col("__n_new")) & (F.col("__old") == F.col("__new")), "same").otherwise("changed"))
    return cells.groupBy(outcome.alias("outcome")).agg(
        F.sum(F.greatest("__n_old", "__n_new")).alias("n_rows"), F.sum("__m_old").alias("total_before"), F.sum("__m_new").alias("total_after"))

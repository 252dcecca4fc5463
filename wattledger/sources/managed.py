"""Managed tables in stored versions.

A Parquet table cannot be written over the files it is read from, and files of a table that is being
replaced are missed by its readers. So every change writes a version of its own, in a folder that
nobody reads yet, is checked there, and becomes current by one switch of the table's location. Until
then, and if the writer stops at any place before, readers find the version before, whole. The
paths of all versions are table properties, so an older one stays readable by its number.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce
from operator import or_

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import upkeep
from .contracts import check_order
from .files import literal

_PROPERTY = "stored.version."


def location(spark: SparkSession, table: str) -> str:
    """The folder a table is read from now."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return rows.first()["data_type"].rstrip("/")


def versions(spark: SparkSession, table: str) -> dict[int, str]:
    """Number and folder of every version written, oldest first; the last may never have become current."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key").startswith(_PROPERTY)).collect()
    return dict(sorted((int(r["key"].removeprefix(_PROPERTY)), r["value"]) for r in rows))


def current(spark: SparkSession, table: str) -> int:
    """Number of the version that readers get."""
    now = location(spark, table)
    return next(n for n, path in reversed(versions(spark, table).items()) if _same(path, now))


def _same(a: str, b: str) -> bool:
    """Equal folders; Spark shows a local one with its scheme in front."""
    return a.removeprefix("file:").replace("//", "/") == b.removeprefix("file:").replace("//", "/")


def create(df: DataFrame, table: str, folder: str) -> None:
    """A new table whose first version holds the rows of ``df``. Column comments of ``df`` are kept."""
    spark = df.sparkSession
    path = _place(folder, 1)
    df.write.parquet(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT {literal(f.metadata['comment'])}" if f.metadata.get("comment") else "")
                        for f in df.schema)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION {literal(path)} "
              f"TBLPROPERTIES ({literal(_PROPERTY + '1')} = {literal(path)}, 'stored.folder' = {literal(folder)})")


def _place(folder: str, number: int) -> str:
    return f"{folder.rstrip('/')}/version-{number:06d}-{uuid.uuid4().hex[:8]}"


def read(spark: SparkSession, table: str, number: int | None = None) -> DataFrame:
    """The rows of one version, of the current one if none is named.

    The files of that version are read whatever becomes current afterwards.
    """
    path = location(spark, table) if number is None else versions(spark, table)[number]
    return spark.read.schema(spark.table(table).schema).parquet(path)


def observed(counts: Observation, name: str) -> int | None:
    """A count taken during a write that has ended; None where the optimizer saw that there was nothing to count."""
    try:
        return counts.get.get(name)
    except Py4JJavaError:
        return None


class Refused(ValueError):
    """A version was written and does not pass; the table is as before."""


def write_version(df: DataFrame, table: str, keys: list[str], allow_empty: bool = False) -> int:
    """Writes and checks a new version; nobody reads it before :func:`switch`. Returns its number.

    Names and order must be those of the table. Rows are counted while they are written; an empty
    version, a null key and a repeated key are errors, and the table stays as it is.
    """
    spark = df.sparkSession
    target = spark.table(table).schema
    check_order(df, [c.lower() for c in target.names])
    number = max(versions(spark, table)) + 1
    folder = spark.sql(f"SHOW TBLPROPERTIES {table}").where("key = 'stored.folder'").first()["value"]
    path = _place(folder, number)
    counts = Observation(f"{table} {number}")
    no_key = reduce(or_, [F.col(k).isNull() for k in keys], F.lit(False))
    rows = df.select([F.col(a).cast(f.dataType).alias(f.name) for a, f in zip(df.columns, target)])
    rows.observe(counts, F.count(F.lit(1)).alias("rows"), F.count_if(no_key).alias("no_key")).write.parquet(path)
    if not observed(counts, "rows") and not allow_empty:
        raise Refused(f"{table}: no rows in the new version")
    if observed(counts, "no_key"):
        raise Refused(f"{table}: {observed(counts, 'no_key')} rows without a key")
    if keys:
        repeated = spark.read.schema(target).parquet(path).groupBy(*keys).count().where("count > 1").limit(3).collect()
        if repeated:
            raise Refused(f"{table}: repeated keys {[tuple(r)[:-1] for r in repeated]}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({literal(_PROPERTY + str(number))} = {literal(path)})")
    return number


def switch(spark: SparkSession, table: str, number: int, seen: int | None = None) -> None:
    """Makes a written version current, by one change of the catalog.

    ``seen`` is the version the new one was made from; if another has become current since, the new
    one would undo it, and nothing is switched.
    """
    if seen is not None and current(spark, table) != seen:
        raise ValueError(f"{table}: version {current(spark, table)} became current since version {seen} was read")
    spark.sql(f"ALTER TABLE {table} SET LOCATION {literal(versions(spark, table)[number])}")
    spark.catalog.refreshTable(table)


def change(spark: SparkSession, table: str, make: Callable[[DataFrame], DataFrame], keys: list[str], allow_empty: bool = False) -> int:
    """The current rows changed by ``make``, written, checked and switched to. Returns the new version's number."""
    seen = current(spark, table)
    number = write_version(make(read(spark, table, seen)), table, keys, allow_empty)
    switch(spark, table, number, seen)
    return number


def upsert(spark: SparkSession, table: str, seed: DataFrame, keys: list[str], managed: list[str],
           changed_at: tuple[str, datetime] | None = None) -> int:
    """Stored :func:`upkeep.upsert`. The same seed once more leaves the same rows."""
    return change(spark, table, lambda rows: upkeep.upsert(rows, seed, keys, managed, changed_at), keys)


def add_missing(spark: SparkSession, table: str, seed: DataFrame, keys: list[str]) -> int:
    """Stored :func:`upkeep.add_missing`."""
    return change(spark, table, lambda rows: upkeep.add_missing(rows, seed, keys).select(rows.columns), keys)


def replace_value(spark: SparkSession, table: str, keys: list[str], where: Column, column: str, old, new) -> int:
    """Stored :func:`upkeep.replace_value`; done twice, the second finds nothing of the old value."""
    return change(spark, table, lambda rows: upkeep.replace_value(rows, where, column, old, new), keys)


def retire(spark: SparkSession, table: str, keys: list[str], key: str, retired: list, active: str, note: str | None = None,
           remark: str = "note") -> int:
    """Stored :func:`upkeep.retire`; rows stay, older versions show when they were active."""
    return change(spark, table, lambda rows: upkeep.retire(rows, key, retired, active, note, remark), keys)


def replace_all(df: DataFrame, table: str, keys: list[str], allow_empty: bool = False) -> int:
    """A whole load as the new version of a table; an empty one is refused before readers see it."""
    spark = df.sparkSession
    number = write_version(df, table, keys, allow_empty)
    switch(spark, table, number)
    return number

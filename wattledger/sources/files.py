"""Parquet landing files and stored tables."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .contracts import check_order


def read_landing(spark: SparkSession, path: str, dropped: tuple[str, ...] = ("iteration",)) -> DataFrame:
    """Landing file with lower-case names and without helper columns."""
    df = spark.read.parquet(path)
    return df.toDF(*[c.lower() for c in df.columns]).drop(*dropped)


def read_source(spark: SparkSession, url: str, table: str, key: str, bounds: tuple[int, int],
                parts: int, **options: str) -> DataFrame:
    """A relational source table, read in ``parts`` key ranges by as many tasks."""
    return (spark.read.format("jdbc").options(url=url, dbtable=table, **options)
            .option("partitionColumn", key).option("lowerBound", bounds[0])
            .option("upperBound", bounds[1]).option("numPartitions", parts).load())


def normalise_source(df: DataFrame) -> DataFrame:
    """Source numbers without decimals become long, others double; dates become timestamps."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("bigint" if f.dataType.scale == 0 else "double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("timestamp")
        out.append(c.alias(f.name))
    return df.select(out)


def write_landing(df: DataFrame, path: str) -> None:
    """Replace a landing file. No rows is fine, no columns is an error."""
    if not df.columns:
        raise ValueError(f"nothing to write to {path}: the frame has no columns")
    df.write.mode("overwrite").parquet(path)


@contextmanager
def own_partitions(spark: SparkSession):
    """Inside, an overwrite replaces the partitions that the new rows have and leaves the others as they are."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _overwrite(df: DataFrame, table: str) -> None:
    with own_partitions(df.sparkSession):
        df.write.insertInto(table, overwrite=True)


def overwrite_by_position(df: DataFrame, table: str) -> None:
    """Replace the rows of an existing table after a check of names and order.

    Of a partitioned table only the partitions that ``df`` has rows of are replaced, so a run replaces its own.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist; create it from its contract first")
    check_order(df, [c.lower() for c in spark.table(table).columns])
    _overwrite(df, table)


def overwrite_by_name(df: DataFrame, table: str) -> None:
    """As :func:`overwrite_by_position`, with columns matched by name."""
    target = df.sparkSession.table(table).columns
    missing = [c for c in target if c not in df.columns]
    surplus = [c for c in df.columns if c not in target]
    if missing or surplus:
        raise ValueError(f"{table}: missing {missing}, surplus {surplus}")
    _overwrite(df.select(*target), table)


def commented(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """The frame with comments on its columns; Spark stores them with a table written from it."""
    return df.select([F.col(f"`{c}`").alias(c, metadata={"comment": comments[c]}) if comments.get(c) else F.col(f"`{c}`") for c in df.columns])


def replace_table(df: DataFrame, table: str, comments: dict[str, str] | None = None, comment: str | None = None,
                  path: str | None = None, partitions: tuple[str, ...] = ()) -> None:
    """Create or replace a table as a query's result, with comments on columns and table."""
    spark = df.sparkSession
    writer = commented(df, comments or {}).write.mode("overwrite").option("overwriteSchema", "true")
    if path:
        writer = writer.option("path", path)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.saveAsTable(table)
    if comment:
        spark.sql(f"COMMENT ON TABLE {table} IS {literal(comment)}")


def register_table(spark: SparkSession, table: str, path: str, schema: T.StructType, comment: str) -> None:
    """A table of the catalog over files that are there, with the comments of ``schema``; dropping it leaves the files."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT {literal(f.metadata['comment'])}" if f.metadata.get("comment") else "")
                        for f in schema)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION {literal(path)} COMMENT {literal(comment)}")


def replace_view(df: DataFrame, name: str, comments: dict[str, str] | None = None) -> DataFrame:
    """Session view with column comments."""
    noted = commented(df, comments or {})
    noted.createOrReplaceTempView(name)
    return noted


def replace_stored_view(spark: SparkSession, name: str, select: str, columns: dict[str, str], comment: str) -> None:
    """Create or replace a view of the catalog over a query, with a comment on each column and on the view.

    ``columns`` has the names of the query's columns in their order, each with its comment; a view without
    a comment on every column is refused.
    """
    if bare := [c for c, text in columns.items() if not text.strip()]:
        raise ValueError(f"{name}: columns without a comment {bare}")
    shown = ", ".join(f"`{c}` COMMENT {literal(text)}" for c, text in columns.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} ({shown}) COMMENT {literal(comment)} AS {select}")


def literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def merged_schema(spark: SparkSession, paths: list[str]) -> T.StructType:
    """Columns of several versions of one table, oldest first: later ones go last, a type is the widest met.

    Names are compared without case. Types that do not widen into each other are an error.
    """
    fields: dict[str, T.StructField] = {}
    for path in paths:
        for f in spark.read.parquet(path).schema:
            known = fields.get(f.name.lower())
            kind = f.dataType if known is None else wider(known.dataType, f.dataType)
            if kind is None:
                raise ValueError(f"{path}: {f.name} is {f.dataType.simpleString()}, before {known.dataType.simpleString()}")
            fields[f.name.lower()] = T.StructField(f.name.lower(), kind, True)
    return T.StructType(list(fields.values()))


_WIDER = (("tinyint", "smallint", "int", "bigint"), ("tinyint", "smallint", "int", "double"), ("float", "double"), ("date", "timestamp_ntz"))


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The one of two types that holds all values of both; None if neither does."""
    names = a.simpleString(), b.simpleString()
    if names[0] == names[1]:
        return a
    for row in _WIDER:
        if names[0] in row and names[1] in row:
            return a if row.index(names[0]) > row.index(names[1]) else b
    return None


def read_evolved(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Old and new files of one table as one frame: absent columns are NULL, narrower numbers come as the widest."""
    return spark.read.schema(merged_schema(spark, paths)).parquet(*paths)


def require_rows(df: DataFrame, name: str, allow_empty: bool = False) -> None:
    """An empty load would replace good data by nothing; stop unless that is allowed."""
    if not allow_empty and df.isEmpty():
        raise ValueError(f"{name}: no rows after the load")


def freshness(tables: dict[str, tuple[DataFrame, str | None]], as_of, max_hours: float) -> DataFrame:
    """(object, n_files, newest, hours, stale, written_after) of each table.

    ``tables`` maps a name to its frame and the time column that tells how new its data are; without
    one the time of its files does. A table is stale if that lies over ``max_hours`` before ``as_of`` (a
    time, or a column of one row such as a scalar subquery), or if it has none. ``written_after`` is
    false where the files are older than the data they are said to hold. One scan per table; all of
    them are in the result, so all offenders show at once.
    """
    limit = as_of if isinstance(as_of, Column) else F.lit(as_of)
    rows = []
    for name, (df, at) in tables.items():
        written = F.col("_metadata.file_modification_time")
        newest = written if at is None else F.col(f"`{at}`")
        rows.append(df.select(F.col("_metadata.file_path").alias("file"), written.alias("written"), newest.cast("timestamp").alias("newest"))
                    .agg(F.count_distinct("file").alias("n_files"), F.max("written").alias("written"), F.max("newest").alias("newest"))
                    .select(F.lit(name).alias("object"), "n_files", "newest", "written"))
    hours = (F.unix_micros(limit.cast("timestamp")) - F.unix_micros("newest")) / 3.6e9
    return reduce(DataFrame.unionByName, rows).select(
        "object", "n_files", "newest", hours.alias("hours"), F.coalesce(hours > max_hours, F.lit(True)).alias("stale"),
        F.coalesce(F.col("written") >= F.col("newest"), F.lit(False)).alias("written_after"))


def stale_files(spark: SparkSession, paths: dict[str, str], as_of: datetime,
                max_hours: float) -> list[tuple[str, str]]:
    """All (name, reason) whose newest file is missing or too old; 0 hours switches it off.

    Only file metadata is listed, of all paths in one job.
    """
    if max_hours <= 0:
        return []
    limit = as_of - timedelta(hours=max_hours)
    written: dict[str, datetime | None] = dict.fromkeys(paths)
    rows = []
    for name, path in paths.items():
        try:
            listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        except AnalysisException:
            continue
        rows.append(listed.agg(F.max("modificationTime").alias("newest")).select(F.lit(name).alias("name"), "newest"))
    if rows:
        written |= {r["name"]: r["newest"] for r in reduce(DataFrame.unionByName, rows).collect()}
    return [(name, "missing or not readable" if newest is None else f"written {newest:%Y-%m-%d %H:%M}, before {limit:%Y-%m-%d %H:%M}")
            for name, newest in written.items() if newest is None or newest < limit]

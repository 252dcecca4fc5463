"""Contracts of columns as rows: what a table should look like beside what it looks like."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.contracts import VERDICT_WORDS
from .quality import FAIL, OK

FOUND = "object string, position int, column string, type string, comment string"


def columns_of(tables: dict[str, DataFrame]) -> DataFrame:
    """(object, position, column, type, comment) of the columns of frames; only their schemas are looked at."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(name, i, f.name.lower(), f.dataType.simpleString(), f.metadata.get("comment"))
            for name, df in tables.items() for i, f in enumerate(df.schema, 1)]
    return spark.createDataFrame(rows, FOUND)


def catalog_columns(spark: SparkSession, tables: list[str]) -> DataFrame:
    """The same of tables and views of the catalog, as it holds them."""
    rows = [(name, i, c.name.lower(), c.dataType, c.description) for name in tables for i, c in enumerate(spark.catalog.listColumns(name), 1)]
    return spark.createDataFrame(rows, FOUND)


def declared(spark: SparkSession, contracts: dict[str, list[tuple[str, str]]]) -> DataFrame:
    """(object, position, column, type) of declared columns in their order."""
    rows = [(name, i, column.lower(), kind) for name, columns in contracts.items() for i, (column, kind) in enumerate(columns, 1)]
    return spark.createDataFrame(rows, "object string, position int, column string, type string")


def schema_contract(found: DataFrame, wanted: DataFrame, words: tuple[str, ...] = VERDICT_WORDS) -> DataFrame:
    """(object, column, status, expected, obtained): one row for each declared or found column.

    A column is wrong if it is missing, surplus, of another type, at another place, or if its name holds
    one of ``words``. The place is that among the columns which both sides have, so one missing
    column does not put all later ones out of place.
    """
    w, f = wanted.alias("w"), found.alias("f")
    both = w.join(f, ["object", "column"], "full").select(
        "object", "column", F.col("w.type").alias("want"), F.col("f.type").alias("have"), F.col("w.position").alias("w_at"),
        F.col("f.position").alias("f_at"))
    shared = both.where("w_at IS NOT NULL AND f_at IS NOT NULL").groupBy("object").agg(
        F.array_sort(F.collect_list("w_at")).alias("w_order"), F.array_sort(F.collect_list("f_at")).alias("f_order"))
    rows = both.join(shared, "object", "left")
    moved = F.array_position("w_order", F.col("w_at")) != F.array_position("f_order", F.col("f_at"))
    forbidden = F.lit(False)
    for word in words:
        forbidden = forbidden | F.contains("column", F.lit(word))
    fault = F.concat_ws(", ", F.when(F.col("have").isNull(), "missing"), F.when(F.col("want").isNull(), "surplus"),
                        F.when(F.col("want") != F.col("have"), F.concat(F.lit("type "), "have")),
                        F.when(moved, F.concat(F.lit("place "), F.col("f_at").cast("string"))), F.when(forbidden & F.col("have").isNotNull(), "name"))
    return rows.select("object", "column", F.when(fault == "", OK).otherwise(FAIL).alias("status"),
                       F.coalesce(F.col("want"), F.lit("no column")).alias("expected"), F.when(fault == "", F.col("have")).otherwise(fault).alias("obtained"))


def comment_coverage(found: DataFrame) -> DataFrame:
    """(object, n_columns, n_commented, status): a table is right if every column has a comment."""
    has = F.length(F.trim(F.coalesce("comment", F.lit("")))) > 0
    n = found.groupBy("object").agg(F.count(F.lit(1)).alias("n_columns"), F.count_if(has).alias("n_commented"))
    return n.withColumn("status", F.when(F.col("n_columns") == F.col("n_commented"), OK).otherwise(FAIL))


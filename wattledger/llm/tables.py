"""Tables that outlive an executor: written once into the shared folder, read from there."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import shared_folder


#: Bytes a Parquet writer holds before it writes a row group; several writers share an executor.
ROW_GROUP_BYTES = 16 << 20


def new_folder(spark: SparkSession, name: str) -> str:
    """A place in the shared folder (spark.checkpoint.dir) that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Writes ``df`` into the shared folder (spark.checkpoint.dir) and reads it back.

    It cuts the lineage as checkpoint() does, but the columns that a later step does not use
    are not read again.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", codec).option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def only(df: DataFrame, key: str, text: str) -> DataFrame:
    """The two columns an operator works on, under names of its own.

    Other columns stay out of the work, whatever their names are.
    """
    return df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def numbered(rows: DataFrame, order: list, name: str) -> DataFrame:
    """``rows``, stored, with ``position``: gapless numbers from 0 in the given order, by one rule at any size.

    The rows move once, to ranges of the order, so a task numbers the rows of its range, and the numbers
    of rows in the ranges before are added. Rows that tie in ``order`` are told apart by their place in the
    input, so many equal ones are cut into ranges as well.
    """
    tied = rows.withColumn("_place", F.monotonically_increasing_id())
    keys = [*order, "_place"]
    # an id holds the number of the partition and that of the row in it
    ranges = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_place").withColumn("_at", F.monotonically_increasing_id())
    at = stored(ranges, name)
    part = F.shiftright("_at", 33).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = at.groupBy(part).count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    within = F.col("_at") - F.shiftleft("_part", 33)
    return (at.withColumn("_part", F.shiftright("_at", 33)).join(starts, "_part")
            .withColumn("position", within + F.col("_start")).drop("_at", "_part", "_start"))


def in_blocks(rows: DataFrame, keys: list[str], weight: Column, most: int) -> tuple[DataFrame, int]:
    """``rows`` (stored) with the number of their ``block``, and how many blocks there are.

    Rows with equal keys share a block. Blocks are made more until none weighs over twice ``most``, or until
    what does is one key; so whoever gathers one block knows how much it can be.
    """
    count = max(1, -(-int(rows.agg(F.sum(weight)).first()[0] or 0) // most))
    while True:
        cut = rows.withColumn("block", F.pmod(F.xxhash64(*keys), F.lit(count)))
        full = cut.groupBy("block").agg(F.sum(weight).alias("weight"), F.count_distinct(F.struct(*keys)).alias("keys"))
        if full.where((F.col("weight") > 2 * most) & (F.col("keys") > 1)).isEmpty():
            return cut, count
        count *= 2

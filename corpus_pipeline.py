"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattledger.llm import contamination, jaccard, packing, quality
from wattledger.llm.tables import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands.

    Each row is judged where it lies: null and empty texts go, repeated rows and rows without a
    doc_id are judged like any other, an empty table stays empty, extra columns stay as they are.
    """
    return quality.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest doc_id, among equal ones any one.

    Every row is a document of its own, whatever its doc_id: rows with one doc_id and different texts are
    different documents, repeated rows are copies, and so are equal texts without a doc_id (which give
    way to those with one). A text without words has no copies and stays. Rows get a number for this
    stage, under a name that no column has.
    """
    row = "row"
    while row in docs.columns:
        row += "_"
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = jaccard.linked(rows, key=row).select(F.col("doc_id").alias(row), F.col("component_id").alias("class"))
    ids = found.join(rows.select(row, F.col("doc_id").cast("long").alias("id")), row)
    first = ids.groupBy("class").agg(F.min(F.struct(F.col("id").isNull(), "id", row)).alias("first"))
    return rows.join(first.select(F.col(f"first.{row}").alias(row)), row, "left_semi").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a notable share of benchmark words.

    Each row is judged where it lies: null and empty texts have no words and stay, so do repeated rows
    and rows without a doc_id if they are clean; with an empty benchmark all stay.
    """
    return contamination.clean(docs, spark.read.parquet(f"{str(sf_dir).rstrip('/')}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences.

    A null or empty text is one end token. Repeated rows are packed each; a null doc_id stays null. No
    documents give no pieces.
    """
    return packing.packed(docs)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("best_fit_packing", best_fit_packing)]

#: zstandard ratios and a tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{str(sf_dir).rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

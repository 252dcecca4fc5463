import zlib

import pytest
from pyspark.sql import functions as F

from wattledger.llm import shards

from .conftest import given


def check(df, n, rows, slack):
    got = df.collect()
    assert sorted(repr((r["doc_id"], r["text"])) for r in got) == sorted(map(repr, rows))
    inside = {}
    for r in got:
        body = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(body) + 1, zlib.crc32(body), "bytes", None)
        inside.setdefault(r["shard"], []).append(r)
    assert set(inside) <= set(range(n))
    for own in inside.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    sizes = [sum(r["size"] for r in inside.get(s, [])) for s in range(n)]
    assert max(sizes) - min(sizes) <= slack
    return inside


@pytest.mark.parametrize("partitions", ["2", "37"])
def test_shards_of_awkward_documents(spark, docs, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    rows = given(docs)
    check(shards.sharded(docs, shards=3), 3, rows, 2 * max(len((t or "").encode()) + 1 for _, t in rows))
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_slots_follow_the_order_of_the_sort_at_any_size(spark):
    for n, shuffled in ((30, "3"), (5000, "16")):
        spark.conf.set("spark.sql.shuffle.partitions", shuffled)
        df = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 700).alias("text"))
        got = shards.sharded(df, shards=5).withColumn("hash", F.xxhash64("text")).collect()
        assert [(r["shard"], r["slot"]) for r in sorted(got, key=lambda r: (r["hash"], r["doc_id"]))] == sorted((r["shard"], r["slot"]) for r in got)
        narrow = {r["doc_id"]: (r["shard"], r["slot"]) for r in shards.placed(df, shards=5).collect()}
        assert narrow == {r["doc_id"]: (r["shard"], r["slot"]) for r in got}
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_written_shards_hold_their_documents(spark, tmp_path):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") % 20).cast("int")).alias("text"))
    shards.write(df, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["doc_id"], r["text"]) for r in back.collect()) == sorted((r["doc_id"], r["text"]) for r in df.collect())
    for s in range(4):
        own = spark.read.parquet(str(tmp_path / f"out/shard={s}")).collect()
        assert sorted(r["slot"] for r in own) == list(range(len(own))) and own


def test_a_hot_text_is_split_and_small_groups_stay_together(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot text").otherwise(
        F.concat(F.lit("text "), F.floor(F.col("id") / 30))).alias("text"))
    inside = check(shards.sharded(df), 16, given(df), 100)
    homes = {}
    for s, own in inside.items():
        for r in own:
            homes.setdefault(r["text"], set()).add(s)
    assert len(homes["hot text"]) > 3
    assert sum(len(h) > 1 for t, h in homes.items() if t != "hot text") <= 15


def test_repeated_rows_and_empty_table(spark, empty):
    df = spark.createDataFrame([(1, "same")] * 50 + [(None, None)] * 2, "doc_id long, text string")
    check(shards.sharded(df, shards=4), 4, given(df), 10_000)
    assert shards.sharded(empty).count() == 0


def test_main_path_runs_no_python(docs):
    plan = shards.placed(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

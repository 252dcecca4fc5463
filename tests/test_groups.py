from collections import Counter

import pytest
from pyspark.sql import functions as F

from wattledger.operators import groups


def keyed(spark):
    """A third of the rows under one key, another part under a NULL key, copies included."""
    rows = [(1, "hot", i % 7) for i in range(400)] + [(None, "none", i % 3) for i in range(300)]
    rows += [(k, f"k{k % 5}", k % 4) for k in range(2, 500)]
    return rows, spark.createDataFrame(rows, "k int, name string, v int").repartition(7)


def counted(rows):
    n = Counter(k for k, _, _ in rows)
    return Counter((k, name, v, n[k]) for k, name, v in rows)


@pytest.mark.parametrize("count", [groups.with_group_size, groups.with_grain_rows])
def test_group_size_of_hot_and_null_keys(spark, count):
    rows, df = keyed(spark)
    assert Counter(tuple(r) for r in count(df, ["k"], "n").collect()) == counted(rows)


def test_hot_groups_are_split_by_adaptive_execution(spark):
    """A join with both sides from shuffles of their own: Spark marks the join as skewed and splits the key."""
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
              "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
              "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(40_000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
        sized = groups.with_group_size(df.repartition(12, "v"), ["k"], "n")
        sized.collect()
        assert "skew=true" in sized._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_totals_on_two_keys(spark):
    rows, df = keyed(spark)
    totals = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"), F.max("name").alias("top"))
    got = groups.attach_totals(df, totals, ["k", "v"])
    n = Counter((k, v) for k, _, v in rows)
    assert Counter(tuple(r) for r in got.collect()) == Counter((k, nm, v, n[k, v], nm if k != 1 else "hot")
                                                              for k, nm, v in rows)


def test_nested_lists_keep_every_entry(spark):
    rows, df = keyed(spark)
    got = groups.nest(df, ["k"], ["name", "v"], "entries").collect()
    back = Counter((r["k"], e["name"], e["v"]) for r in got for e in r["entries"])
    assert back == Counter(rows) and len({r["k"] for r in got}) == len(got)
    assert all(list(r["entries"]) == sorted(r["entries"]) for r in got)


def test_only_value(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x"), (2, "y"), (3, None)], "g int, v string")
    got = {r["g"]: (r["v"], r["n"]) for r in df.groupBy("g").agg(
        groups.only_value("v").alias("v"), F.countDistinct("v").alias("n")).collect()}
    assert got == {1: ("x", 1), 2: (None, 2), 3: (None, 0)}


def test_any_true_and_sets(spark):
    df = spark.createDataFrame([(1, None, "b"), (1, None, "a"), (2, True, None)], "g int, f boolean, v string")
    got = {r["g"]: (r["f"], r["s"]) for r in df.groupBy("g").agg(
        groups.any_true("f").alias("f"), groups.sorted_set("v").alias("s")).collect()}
    assert got == {1: (False, ["a", "b"]), 2: (True, [])}


def test_full_lap(spark):
    df = spark.createDataFrame([(4, 9990.0, 110.0, 30.0), (4, 10.0, 20.0, 6.0), (0, 9.0, 1.0, 1.0)],
                               "d int, p double, c double, b double")
    got = [r[0] for r in df.select(F.round(F.col("b") / groups.full_lap("d", "p", "c"), 4)).collect()]
    assert got == [0.25, None, None]


def test_runs_as_columns(spark):
    df = spark.createDataFrame([("a", "r1", 5), ("a", "r2", 6), ("b", "r1", 1)], "o string, r string, n int")
    got = {r["o"]: (r["r1"], r["r2"]) for r in groups.runs_as_columns(df, "o", "r", ["r1", "r2"], "n").collect()}
    assert got == {"a": (5, 6), "b": (1, None)}

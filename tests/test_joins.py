import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattledger.operators import joins, sets


def test_repeated_keys_of_a_lookup_are_found(spark):
    names = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "code int, text string")
    assert [tuple(r) for r in joins.repeated_keys(names, ["code"]).collect()] == [(1, 2)]
    assert joins.repeated_keys(names, ["code", "text"]).count() == 0


def test_windows_over_months_meet_each_point_once(spark):
    rnd = random.Random(8)
    day = datetime(2026, 1, 1)
    points = [(rnd.randrange(3), day + timedelta(hours=rnd.randrange(4000)), i) for i in range(80)] + [(1, None, 99), (None, day, 98)]
    spans = [(rnd.randrange(3), day + timedelta(hours=a), day + timedelta(hours=a + rnd.randrange(-50, 3000)), i)
             for i, a in enumerate(rnd.randrange(4000) for _ in range(30))] + [(0, day, None, 50)]
    p = spark.createDataFrame(points, "e int, at timestamp, p int")
    w = spark.createDataFrame(spans, "w_e int, s timestamp, n timestamp, w int")
    last = datetime(2026, 9, 1)
    got = joins.inside(p, w, {"e": "w_e"}, "at", "s", "n", open_end=F.lit(last)).select("p", "w").collect()
    want = [(i, j) for e, at, i in points for x, a, b, j in spans if at and e == x and a <= at <= (b or last)]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_lookup_keeps_rows(spark):
    rows = spark.createDataFrame([(1, "S"), (1, "N"), (9, "S"), (None, "S"), (None, "S")], "k int, s string")
    names = spark.createDataFrame([(1, "S", "yes"), (2, "S", "no")], "code int, st string, text string")
    got = joins.lookup(rows, names, {"k": "code", "s": "st"}, {"text": "t"})
    assert sorted(tuple(r) for r in got.fillna("-").fillna(-1).collect()) == [
        (-1, "S", "-"), (-1, "S", "-"), (1, "N", "-"), (1, "S", "yes"), (9, "S", "-")]


def test_latest_mark_against_brute_force(spark):
    rnd = random.Random(3)
    day = date(2026, 1, 1)
    cells = [(e, p, day + timedelta(days=10 * p), day + timedelta(days=10 * p + 9)) for e in range(5) for p in range(6)]
    cells += [(0, 9, None, None)]
    marks = [(rnd.randrange(6), rnd.choice([300, 56, 1]), day + timedelta(days=rnd.randrange(-5, 70)))
             for _ in range(60)] + [(0, 300, None), (1, None, day)]
    rows = spark.createDataFrame(cells, "e int, p int, s date, d date")
    dated = spark.createDataFrame(marks, "e int, c int, at date")
    got = joins.with_latest_before(rows, dated, "e", "d", "c", "at", {"re": 300, "su": 56, "off": None}).collect()
    assert len(got) == len(cells)
    for r in got:
        for name, code in (("re", 300), ("su", 56)):
            want = [a for e, c, a in marks if e == r["e"] and c == code and a and r["d"] and a <= r["d"]]
            assert r[name] == max(want, default=None)
        assert r["off"] is None


def test_siblings_by_group(spark):
    members = spark.createDataFrame([(1, "A", 7), (2, "A", 7), (3, "B", 7)], "s int, contract string, premises int")
    drivers = spark.createDataFrame([(1,)], "s int")
    got = joins.siblings(members, drivers, "s", "contract").collect()
    assert sorted(r["s"] for r in got) == [1, 2]


def test_overlap(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    assert tuple(joins.overlap(a, b, "k").first()) == (2, 2, 1)
    assert tuple(joins.overlap(a.limit(0), b.limit(0), "k").first()) == (0, 0, 0)


def test_inside_uses_the_open_end(spark):
    day = [date(2026, 1, 1) + timedelta(days=i) for i in range(60)]
    points = spark.createDataFrame([(1, day[5]), (1, day[50])], "e int, at date")
    windows = spark.createDataFrame([(1, day[1], None), (1, day[40], day[45])], "o int, s date, t date")
    got = joins.inside(points, windows, {"e": "o"}, "at", "s", "t", open_end=F.lit(day[20])).collect()
    assert [(r["at"], r["s"]) for r in got] == [(day[5], day[1])]


def test_no_join_compares_all_pairs(spark):
    a = spark.createDataFrame([(1, date(2026, 1, 5))], "e int, at date")
    b = spark.createDataFrame([(1, date(2026, 1, 1), date(2026, 1, 9))], "o int, s date, t date")
    plan = joins.inside(a, b, {"e": "o"}, "at", "s", "t")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_hot_keys_of_joins_are_split(spark, tmp_path):
    """Adaptive execution splits the hot partition, since both sides have shuffles of their own."""
    path = str(tmp_path / "rows")
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
    spark.range(60_000, numPartitions=8).select(hot.alias("k"), F.xxhash64("id").alias("v")).write.parquet(path)
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1",
               "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
               "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
               "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k"}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        rows = spark.read.parquet(path)
        for got, n in ((joins.keep_keys(rows, rows.where("k % 2 = 1"), ["k"]), 20_000 + 20_000),
                       (joins.drop_keys(rows, rows.where("k % 2 = 0"), ["k"]), 20_000 + 20_000),
                       (joins.lookup(rows, rows.where("k <> 7"), {"k": "k"}, {"v": "found"}), 60_000)):
            assert len(got.collect()) == n
            assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in changed:
            spark.conf.unset(k)


@pytest.mark.parametrize("key", [1, None])
def test_keys_kept_and_dropped(spark, key):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    keys = spark.createDataFrame([(key,), (key,)], "k int")
    kept = {r["v"] for r in joins.keep_keys(rows, keys, ["k"]).collect()}
    assert kept == ({"a", "b"} if key else set())
    dropped = {r["v"] for r in joins.drop_keys(rows, keys, ["k"]).collect()}
    assert dropped == {"a", "b", "c", "d"} - kept


def test_sets(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "k int, v string")
    b = spark.createDataFrame([("x", 1), ("y", None)], "v string, k int")
    assert sets.union_distinct(a, b).count() == 2
    assert sets.union_tagged("t", one=a, two=b).where("t = 'two'").count() == 2
    assert sets.distinct_keys(b, ["k", "v"]).count() == 1
    assert sets.distinct_keys(b, ["v", "k"], ["v"]).count() == 2
    assert [r[0] for r in sets.shared_values(a, "v", b, "v").collect()] == ["x"]
    assert sets.column_difference(["a", "b"], ["b", "c"]) == {"missing": ["a"], "surplus": ["c"]}


def test_first_available(spark):
    none = spark.createDataFrame([], "k int")
    some = spark.createDataFrame([(5,), (3,)], "k int")
    every = spark.createDataFrame([(1,)], "k int")
    assert [tuple(r) for r in sets.first_available("k", none, some, every).collect()] == [(3, 2)]


def test_an_open_window_stands_in_no_month_after_the_last_point(spark):
    points = spark.createDataFrame([(1, datetime(2026, 2, 3)), (1, datetime(2026, 3, 1)), (2, datetime(2026, 1, 5))], "k int, at timestamp")
    windows = spark.createDataFrame([(1, datetime(2025, 12, 20), None), (1, datetime(2026, 3, 2), None), (2, datetime(2026, 1, 6), None)],
                                    "w int, opened timestamp, ended timestamp")
    far = F.lit(datetime(2126, 1, 1))
    met = joins.inside(points, windows, {"k": "w"}, "at", "opened", "ended", open_end=far)
    assert sorted((r["k"], r["at"].month, r["opened"].month) for r in met.collect()) == [(1, 2, 12), (1, 3, 12)]
    generated = [n for n in nodes(met._jdf.queryExecution().executedPlan()) if n.nodeName().startswith("Generate")]
    assert sum(n.metrics().apply("numOutputRows").value() for n in generated) == 4 + 3
    assert joins.inside(points.limit(0), windows, {"k": "w"}, "at", "opened", "ended", open_end=F.lit(datetime(2026, 6, 1))).count() == 0


def test_repeated_windows_are_not_broadcast_and_long_ones_stand_in_years(spark, tmp_path):
    """Their size on disk says nothing of how often they are repeated."""
    day = datetime(2000, 1, 15)
    spark.range(200).select((F.col("id") % 50).alias("w"), F.lit(day).alias("opened"), F.when(F.col("id") % 2 == 0, F.lit(day + timedelta(days=20))).alias("ended"),
                            F.col("id").alias("n")).write.parquet(str(tmp_path / "windows"))
    at = [day + timedelta(days=d) for d in (-1, 0, 20, 21, 400, 10_000)]
    spark.createDataFrame([(k, a) for k in range(50) for a in at], "k long, at timestamp").write.parquet(str(tmp_path / "points"))
    points, windows = spark.read.parquet(str(tmp_path / "points")), spark.read.parquet(str(tmp_path / "windows"))
    met = joins.inside(points, windows, {"k": "w"}, "at", "opened", "ended", open_end=F.lit(datetime(2126, 1, 1)))
    rows = met.collect()
    assert len(rows) == len({(r["n"], r["at"]) for r in rows}) == 100 * 2 + 100 * 5
    plan = met._jdf.queryExecution().executedPlan()
    assert "BroadcastExchange" not in plan.toString()
    generated = [n for n in nodes(plan) if n.nodeName().startswith("Generate")]
    years = at[-1].year - day.year + 1
    assert sum(n.metrics().apply("numOutputRows").value() for n in generated) == 100 * 2 + 100 * years
    kept = joins.inside(points, windows, {"k": "w"}, "at", "opened", "ended", open_end=F.lit(datetime(2126, 1, 1)), how="left")
    assert kept.where("n IS NULL").count() == 125 and kept.count() == 125 + 700


def nodes(plan):
    """All nodes of an executed plan, those of its stages too."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    yield plan
    below = [plan.plan()] if "QueryStage" in plan.nodeName() else [plan.children().apply(i) for i in range(plan.children().size())]
    for child in below:
        yield from nodes(child)

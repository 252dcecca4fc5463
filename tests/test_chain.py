"""The chain of extracts: what drives what, empty steps, and how later sources are pruned."""

import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wattledger.catalog import chain_queries, extract_queries, roles
from wattledger.catalog.registry import Tables
from wattledger.functions import codes
from wattledger.operators import joins
from wattledger.plans import chain, extract
from wattledger.session import written
from wattledger.sources import contracts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF)


@pytest.fixture(scope="module")
def built(tables):
    return chain_queries.built_chain(tables)


def keys(df, *columns):
    return {tuple(r) for r in df.select(*columns).distinct().collect()}


def test_every_step_is_within_the_keys_before(built):
    got = {n: built.get(n) for n in chain_queries.TABLES}
    services = keys(got["services"], "service")
    for n in ("readings", "bills", "charges", "requests", "investigations", "loss_files", "review_orders"):
        assert keys(got[n], "service") <= services, n
    assert keys(got["consumption"], "service", "period") == keys(got["readings"], "service", "period")
    assert keys(got["services"], "premises") <= keys(got["open_orders"], "premises")
    assert keys(got["order_comments"], "order") <= keys(got["review_orders"], "order")
    assert keys(got["charges"], "bill") <= keys(got["bills"], "bill")
    for n, df in got.items():
        assert df.columns == [own for own, _, _ in contracts.fields(n)] and df.count() > 0, n
    # some bills are in, some are not
    assert 0 < got["bills"].count() < built.spark.read.parquet(f"{SF}/orders.parquet").count()


def test_later_sources_are_pruned_by_handed_keys(spark, tables, built):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    lines = tables.lineitem.select(F.col("l_orderkey").alias("bill"), "l_quantity")
    customers = tables.orders.select(F.col("o_custkey").alias("service"), "o_orderkey")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for rows, step, key in ((lines, "bills", "bill"), (customers, "services", "service")):
            kept = built.keep(rows, step, key)
            plan = kept._jdf.queryExecution().optimizedPlan().toString()
            assert "might_contain" in plan and "bloom" in plan.lower() and "NestedLoop" not in plan
            assert f"(step#" in kept._jdf.queryExecution().executedPlan().toString()  # noqa: F541  only the step's keys are read
            assert kept.count() == rows.join(built.handed(step, key), key).count() > 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_no_open_order_gives_empty_tables(spark, tables, tmp_path):
    sources = chain_queries.sources(tables)
    landing = chain.Landing(spark, str(tmp_path / "landing"))
    got = chain.landing_chain(landing, sources | {"orders": sources["orders"].limit(0)}, chain_queries.names(tables), chain_queries.AS_OF)
    assert list(got) and all(df.count() == 0 for df in got.values())


def test_missing_keys_drive_nothing(spark, tmp_path):
    landing = chain.Landing(spark, str(tmp_path))
    landing.hand("a", spark.createDataFrame([(1, 1), (1, 1), (None, 2), (3, None)], "service long, period long"))
    landing.hand("b", spark.createDataFrame([(7,)], "service long"))
    assert [tuple(r) for r in landing.handed("a", "service", "period").collect()] == [(1, 1)]
    rows = spark.createDataFrame([(1, 1), (1, 2), (7, 1), (None, 1)], "service long, period long")
    assert [tuple(r) for r in landing.keep(rows, "a", "service", "period").collect()] == [(1, 1)]
    assert [tuple(r) for r in landing.keep(rows, "b", "service").collect()] == [(7, 1)]
    landing.hand("a", spark.createDataFrame([(9, 9)], "service long, period long"))  # a step once more replaces its keys, no others
    assert landing.handed("a", "service").collect()[0][0] == 9 and landing.handed("b", "service").collect()[0][0] == 7


def test_comments_have_the_service_of_an_activity_and_the_name_of_their_kind(spark):
    from wattledger.plans import extract
    reviews = spark.createDataFrame([(1, 10, 3, 5), (2, 20, None, 5)], "order long, service long, kind long, period long").withColumns(
        {"opened_at": F.lit(datetime(2026, 1, 1)), "ended_at": F.lit(None).cast("timestamp")})
    at = datetime(2026, 1, 5)
    comments = spark.createDataFrame([(1, 7, at, "a\n|b"), (2, 8, at, None), (3, 7, at, "other order")], "order long, kind_code int, recorded_at timestamp, comment string")
    activities = spark.createDataFrame([(1, 11), (1, 10), (1, 11)], "order long, service long")
    kinds = spark.createDataFrame([(7, "SEVEN")], "code int, text string")
    seen = spark.createDataFrame([(10, 3, 5, at, "seen"), (10, 3, 6, at, "other period")], "service long, kind long, period long, observed_at timestamp, comment string")
    got = extract.order_comments(reviews, comments, seen, activities, kinds, datetime(2026, 2, 1)).collect()
    assert sorted((r["order"], r["service"] or 0, r["comment_kind"] or "", r["comment"] or "") for r in got) == [
        (1, 10, "REVISION ANALISTA", "seen"), (1, 10, "SEVEN", "ab"), (2, 0, "", "")]


def test_latest_is_one_row_per_key_under_ties(spark):
    from wattledger.operators import series
    rows = spark.createDataFrame([(1, 5, 9, "b"), (1, 5, 9, "a"), (1, 4, 99, "z"), (2, 1, 1, None), (2, 1, 1, "x"), (None, 1, 1, "q"), (3, None, 1, "q")],
                                 "key int, at int, id int, value string")
    df = series.latest(rows, ["key"], ["at", "id"], ["value"])
    assert sorted(map(tuple, df.collect())) == [(1, "a"), (2, "x")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Join" not in plan
    assert series.latest(rows.where("key IS NULL"), ["key"], ["at"], ["value"]).count() == 0


def test_charges_meet_their_bills_before_they_are_summed(spark):
    """A sum by bill and period before the join has about as many groups as lines, all held by a task at once."""
    lines = spark.createDataFrame([(1, 10, 7, 7, "DB", 5.0), (1, 10, 7, None, "DB", 2.0), (1, 10, 7, 6, "CR", 1.5), (1, 10, 7, 6, "XX", 9.0),
                                   (1, 10, 8, 7, "DB", 3.0), (2, 11, 7, 5, "DB", 4.0), (2, 11, 7, 5, "DB", None), (None, 12, 7, 7, "DB", 1.0)],
                                  "service long, bill long, bill_period long, period long, sign string, amount double")
    bills = spark.createDataFrame([(1, 10, 7, 7), (2, 11, 7, 7), (2, 11, 7, 7), (None, 12, 7, 7), (3, 13, 7, 7)],
                                  "service long, bill long, bill_period long, period long")
    got = extract.own_and_recovered(lines, bills)
    assert sorted(tuple(r) for r in got.collect()) == [(10, 7.0, -1.5), (11, None, 8.0)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and plan.index("Aggregate [") < plan.index("Join Inner")


def test_sides_that_grow_with_the_facts_are_not_gathered_on_the_driver(spark, tables, tmp_path):
    spark.range(100).select(F.col("id").alias("service"), F.lit("s").alias("step")).write.parquet(str(tmp_path / "keys"))
    keys = spark.read.parquet(str(tmp_path / "keys"))
    for made in (chain_queries.sold_lines(tables), roles.charge_lines(tables), extract_queries.order_activities(tables),
                 joins.keep_known(spark.range(100_000).withColumnRenamed("id", "service"), keys, ["service"])):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_charges_and_activities_are_the_stored_lines(tables):
    """The orders meet the lines once; the months there are come from a small stored table, not from another scan of all lines."""
    sources = chain_queries.sources(tables)
    for name in ("activities", "charge_lines", "use_lines", "criticals", "cases", "observations", "use_periods", "bill_windows"):
        plan = sources[name]._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "lineitem.parquet" not in plan and "orders.parquet" not in plan, name
    for name, made in (("activities", extract_queries.order_activities(tables)), ("charge_lines", roles.charge_lines(tables))):
        assert sources[name].columns == made.columns or set(sources[name].columns) == set(made.columns)
        own = sources[name].select(*made.columns)
        assert own.exceptAll(made).count() == made.exceptAll(own).count() == 0, name


def test_the_shuffle_files_of_a_step_go_as_it_ends(spark, tmp_path):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def kept():
        found = blocks.getAllBlocks()
        return {str(found.apply(i)) for i in range(found.size()) if str(found.apply(i)).startswith("shuffle_")}

    landing = chain.Landing(spark, str(tmp_path))
    rows = spark.range(1000).select((F.col("id") % 7).alias("service"), "id")
    before = kept()
    assert landing.store("sums", rows.groupBy("service").agg(F.sum("id").alias("n"))).count() == 7  # the count itself leaves its own
    landing.hand("all", rows.select("service"))
    written(rows.groupBy("service").count(), "counts")
    until = time.time() + 20
    while len(kept() - before) > 2 and time.time() < until:
        time.sleep(0.2)
    assert len(kept() - before) <= 2
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_a_step_deals_its_rows_by_service_once(spark, tmp_path):
    landing = chain.Landing(spark, str(tmp_path))
    landing.hand("services", spark.createDataFrame([(1,), (2,)], "service long"))
    cells = spark.createDataFrame([(1, 5, 3), (2, 5, 3), (3, 5, 3)], "service long, period long, kind long")
    lines = spark.createDataFrame([(1, 5, 3, 2.0), (1, 5, 3, 1.0), (2, 6, 3, 1.0), (3, 5, 3, 1.0), (None, 5, 3, 1.0)],
                                  "service long, period long, kind long, amount double")
    kept = landing.keep(lines, "services", "service")
    sums = kept.groupBy("service", "period", "kind").agg(F.sum("amount").alias("amount"))
    with landing.step():
        both = sums.join(joins.merged(cells), ["service", "period", "kind"])
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert [tuple(r) for r in both.collect()] == [(1, 5, 3, 3.0)]
    assert plan.count("Exchange hashpartitioning") == 3  # lines, keys and cells: the sums stay where they are
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_observations_outside_the_reviewed_cells_are_not_stored(built):
    reviews, stored = built.get("review_orders"), built.spark.read.parquet(built.path("stored/observations"))
    reviewed = keys(reviews.select("service", codes.leading_code("kind_text").cast("bigint").alias("kind"), "period").dropna(), "service", "kind", "period")
    assert stored.count() > 0 and keys(stored, "service", "kind", "period") <= reviewed

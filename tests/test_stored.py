"""Managed versions, overwrites of partitions, logged loads, comments, contracts and snapshots."""

import os
import time
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattledger.catalog import stored_queries
from wattledger.catalog.registry import Tables
from wattledger.checks import ledger, schemas
from wattledger.operators import upkeep
from wattledger.sources import contracts, files, managed

SF = "/root/testdata/sf0.001"


@pytest.fixture
def table(spark, tmp_path):
    """A managed table of four rows, one of them with a note by hand."""
    name = f"m_{uuid.uuid4().hex[:8]}"
    rows = [(1, "a", True, "by hand"), (2, "b", True, None), (3, "c", False, "off before"), (4, "b", True, None)]
    managed.create(spark.createDataFrame(rows, "key long, kind string, active boolean, note string"), name, str(tmp_path / name))
    yield name
    spark.sql(f"DROP TABLE {name}")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def seed_of(spark, *rows):
    return spark.createDataFrame(list(rows), "key long, kind string, active boolean, note string")


def test_upsert_keeps_what_is_not_managed_and_the_version_before(spark, table):
    before = rows_of(spark.table(table))
    number = managed.upsert(spark, table, seed_of(spark, (1, "z", False, "seed"), (9, "n", True, "seed")), ["key"], ["kind", "active"])
    assert number == 2 == managed.current(spark, table)
    want = [(1, "z", False, "by hand"), (2, "b", True, None), (3, "c", False, "off before"), (4, "b", True, None), (9, "n", True, "seed")]
    assert rows_of(spark.table(table)) == sorted(want, key=repr) == rows_of(managed.read(spark, table))
    assert rows_of(managed.read(spark, table, 1)) == before


def test_same_change_twice_changes_nothing(spark, table):
    seed = seed_of(spark, (1, "z", False, "seed"), (9, "n", True, "seed"))
    for change in (lambda: managed.upsert(spark, table, seed, ["key"], ["kind"]), lambda: managed.add_missing(spark, table, seed, ["key"]),
                   lambda: managed.replace_value(spark, table, ["key"], F.lit(True), "kind", "b", "B"),
                   lambda: managed.retire(spark, table, ["key"], "kind", ["B"], "active", note="retired")):
        change()
        once = rows_of(spark.table(table))
        change()
        assert rows_of(spark.table(table)) == once
    assert managed.current(spark, table) == 9 and len(managed.versions(spark, table)) == 9
    assert (2, "B", False, "retired") in once and (3, "c", False, "off before") in once


def test_a_stop_between_write_and_switch_leaves_the_old_version_whole(spark, table, monkeypatch):
    before = rows_of(spark.table(table))

    def stopped(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(managed, "switch", stopped)
        with pytest.raises(KeyboardInterrupt):
            managed.upsert(spark, table, seed_of(spark, (1, "z", False, "seed")), ["key"], ["kind"])
    assert managed.current(spark, table) == 1 and rows_of(spark.table(table)) == before
    assert len(managed.versions(spark, table)) == 2
    # the next change starts from the version that readers have, and the stopped one is in nobody's way
    assert managed.replace_value(spark, table, ["key"], F.col("key") == 2, "kind", "b", "q") == 3
    assert rows_of(spark.table(table)) == sorted([r if r[0] != 2 else (2, "q", True, None) for r in before], key=repr)


def test_readers_of_a_version_are_not_disturbed(spark, table):
    reader = managed.read(spark, table)
    managed.replace_all(seed_of(spark, (7, "x", True, None)), table, ["key"])
    assert reader.count() == 4 and spark.table(table).count() == 1


@pytest.mark.parametrize("rows, said", [([], "no rows"), ([(None, "x", True, None)], "1 rows without a key"),
                                        ([(1, "x", True, None), (1, "y", True, None)], "repeated keys")])
def test_bad_versions_are_refused(spark, table, rows, said):
    before = rows_of(spark.table(table))
    with pytest.raises(managed.Refused, match=said):
        managed.replace_all(spark.createDataFrame(rows, "key long, kind string, active boolean, note string"), table, ["key"])
    assert rows_of(spark.table(table)) == before and managed.current(spark, table) == 1


def test_other_columns_and_a_lost_race_are_refused(spark, table):
    with pytest.raises(ValueError, match="missing \\['note'\\]"):
        managed.change(spark, table, lambda rows: rows.drop("note"), ["key"])

    def while_another_writes(rows):
        managed.replace_value(spark, table, ["key"], F.lit(True), "kind", "a", "other")
        return rows

    with pytest.raises(ValueError, match="version 2 became current since version 1"):
        managed.change(spark, table, while_another_writes, ["key"])
    assert (1, "other", True, "by hand") in rows_of(spark.table(table))


def test_seed_with_repeated_keys_does_not_reach_the_table(spark, table):
    with pytest.raises(managed.Refused, match="repeated keys \\[\\(1,\\)\\]"):
        managed.upsert(spark, table, seed_of(spark, (1, "x", True, None), (1, "y", True, None)), ["key"], ["kind"])
    assert managed.current(spark, table) == 1


# --- overwrites --------------------------------------------------------------------------


def partition_files(spark, table):
    rows = spark.table(table).select("p", "_metadata.file_path", "_metadata.file_modification_time").distinct().collect()
    out = {}
    for p, path, at in rows:
        out.setdefault(p, set()).add((path, at))
    return out


@pytest.mark.parametrize("how", ["position", "name"])
def test_a_run_replaces_its_own_partitions_only(spark, tmp_path, how):
    name = f"p_{uuid.uuid4().hex[:8]}"
    df = spark.range(30).select("id", F.lit("first").alias("run"), (F.col("id") % 3).alias("p"))
    files.replace_table(df, name, path=str(tmp_path / name), partitions=("p",))
    before = partition_files(spark, name)
    new = spark.range(2).select("id", F.lit("second").alias("run"), F.lit(1).cast("long").alias("p"))
    if how == "position":
        files.overwrite_by_position(new, name)
    else:
        files.overwrite_by_name(new.select("p", "run", "id"), name)
    after = partition_files(spark, name)
    assert after[0] == before[0] and after[2] == before[2] and not after[1] & before[1]
    assert sorted(r["id"] for r in spark.table(name).where("p = 1").collect()) == [0, 1] and spark.table(name).count() == 22
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    with pytest.raises(ValueError, match="expected id"):
        files.overwrite_by_position(new.select("p", "run", "id"), name)
    with pytest.raises(ValueError, match="surplus \\['more'\\]"):
        files.overwrite_by_name(new.withColumn("more", F.lit(1)), name)
    assert partition_files(spark, name) == after
    spark.sql(f"DROP TABLE {name}")


# --- loads and their log -----------------------------------------------------------------


def test_log_counts_come_from_the_write_and_an_attempt_stays_one_row(spark, tmp_path):
    log, at = str(tmp_path / "log"), datetime(2026, 1, 1)
    scans = []

    def source():
        marked = F.udf(lambda x: x, "long")
        return spark.range(100).withColumn("id", marked("id"))

    clock = iter([at, at + timedelta(seconds=5), at, at + timedelta(seconds=9)])
    for n in (10, 20):
        out = str(tmp_path / f"out{n}")
        ledger.logged_load(source(), lambda df, n=n: df.where(F.col("id") < n), lambda df, out=out: scans.append(df.write.parquet(out)), log, "a1",
                           now=lambda: next(clock), object="t", run="r", writer="w")
    row, = ledger.read_log(spark, log).collect()
    assert (row["read"], row["written"], row["status"], row["seconds"], row["attempt"], row["message"]) == (100, 20, "EXITOSO", 9.0, "a1", None)


def test_log_of_a_failure(spark, tmp_path, table):
    log = str(tmp_path / "log")
    with pytest.raises(ValueError, match="no columns"):
        ledger.logged_load(spark.range(3), lambda df: df.select(), lambda df: files.write_landing(df, str(tmp_path / "x")), log, "a", object="x")
    with pytest.raises(managed.Refused):
        ledger.logged_load(spark.table(table), lambda df: df.limit(0), lambda df: managed.replace_all(df, table, ["key"]), log, "b", object="y")
    got = {r["attempt"]: (r["status"], r["written"], "no columns" in r["message"] or "no rows" in r["message"], r["ended_at"] is not None)
           for r in ledger.read_log(spark, log).collect()}
    assert got["a"] == ("FALLIDO", None, True, True) and got["b"] in [("FALLIDO", n, True, True) for n in (0, None)]
    assert spark.table(table).count() == 4


def test_the_guard_does_not_run_the_load_twice(spark, table):
    runs = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        runs.add(1)
        return x

    rows = spark.table(table).select(counted("key").alias("key"), "kind", "active", "note")
    managed.replace_all(rows, table, ["key"])
    assert runs.value == 4


# --- views, comments and contracts -------------------------------------------------------


def test_comments_of_tables_and_views(spark, tmp_path):
    name = f"c_{uuid.uuid4().hex[:8]}"
    files.replace_table(spark.createDataFrame([(1, "x")], "a int, b string"), name, {"a": "it's \\ a number"}, "the table", str(tmp_path / name))
    files.replace_stored_view(spark, f"{name}_v", f"SELECT b, a FROM {name}", {"text": "the text", "number": "the number"}, "the view")
    found = schemas.catalog_columns(spark, [name, f"{name}_v"])
    assert rows_of(found) == sorted([(name, 1, "a", "int", "it's \\ a number"), (name, 2, "b", "string", None),
                                     (f"{name}_v", 1, "text", "string", "the text"), (f"{name}_v", 2, "number", "int", "the number")], key=repr)
    assert rows_of(schemas.comment_coverage(found)) == sorted([(name, 2, 1, "FALLA"), (f"{name}_v", 2, 2, "OK")], key=repr)
    assert spark.catalog.getTable(name).description == "the table" and spark.catalog.getTable(f"{name}_v").description == "the view"
    assert [tuple(r) for r in spark.table(f"{name}_v").collect()] == [("x", 1)]
    with pytest.raises(ValueError, match="without a comment \\['number'\\]"):
        files.replace_stored_view(spark, f"{name}_v", f"SELECT b, a FROM {name}", {"text": "the text", "number": " "}, "the view")
    managed.create(files.commented(spark.createDataFrame([(1,)], "a int"), {"a": "kept"}), f"{name}_m", str(tmp_path / "m"))
    assert rows_of(schemas.catalog_columns(spark, [f"{name}_m"])) == [(f"{name}_m", 1, "a", "int", "kept")]
    for kind, n in (("VIEW", f"{name}_v"), ("TABLE", name), ("TABLE", f"{name}_m")):
        spark.sql(f"DROP {kind} {n}")


def test_schema_contract_names_every_fault(spark):
    good = {"t": (("a", "int"), ("b", "string"), ("c", "double"))}
    wanted = schemas.declared(spark, good)

    def judged(ddl):
        found = schemas.columns_of({"t": spark.createDataFrame([], ddl)})
        return {r["column"]: (r["status"], r["obtained"]) for r in schemas.schema_contract(found, wanted).collect()}

    assert judged("A int, b string, c double") == {"a": ("OK", "int"), "b": ("OK", "string"), "c": ("OK", "double")}
    assert judged("a bigint, c double") == {"a": ("FALLA", "type bigint"), "b": ("FALLA", "missing"), "c": ("OK", "double")}
    assert judged("b string, a int, c double, decision_final int") == {
        "a": ("FALLA", "place 2"), "b": ("FALLA", "place 1"), "c": ("OK", "double"), "decision_final": ("FALLA", "surplus, name")}


def test_landing_contracts_against_their_own_frames(spark):
    names = [t for t in contracts.tables() if t not in ("open_orders", "review_orders")]
    frames = {t: spark.createDataFrame([], contracts.stored_schema(t)) for t in names}
    wanted = schemas.declared(spark, {t: [(stored, kind) for _, stored, kind in contracts.fields(t)] for t in names})
    rows = schemas.schema_contract(schemas.columns_of(frames), wanted).collect()
    assert len(rows) == sum(len(contracts.fields(t)) for t in names) and {r["status"] for r in rows} == {"OK"}


# --- versions, snapshots, freshness ------------------------------------------------------


def test_evolved_read_fills_and_widens(spark, tmp_path):
    a, b, c = (str(tmp_path / x) for x in "abc")
    spark.sql("SELECT 1 AS id, CAST(1.5 AS FLOAT) AS x, DATE'2026-01-02' AS day").write.parquet(a)
    spark.sql("SELECT CAST(5000000000 AS BIGINT) AS ID, 'new' AS more, CAST(2.5 AS DOUBLE) AS x, TIMESTAMP_NTZ'2026-01-03 04:00:00' AS day").write.parquet(b)
    rows = files.read_evolved(spark, [a, b])
    assert [(f.name, f.dataType.simpleString()) for f in rows.schema] == [("id", "bigint"), ("x", "double"), ("day", "timestamp_ntz"), ("more", "string")]
    assert rows_of(rows) == sorted([(1, 1.5, datetime(2026, 1, 2), None), (5000000000, 2.5, datetime(2026, 1, 3, 4), "new")], key=repr)
    spark.sql("SELECT 'text' AS id").write.parquet(c)
    with pytest.raises(ValueError, match="id is string, before bigint"):
        files.merged_schema(spark, [a, b, c])


def test_snapshot_diff(spark, tmp_path):
    rows = [("r1", 1, "x", 1.0), ("r1", 2, "x", 2.0), ("r1", 3, "x", 3.0), ("r1", 5, None, 5.0), ("r2", 2, "x", 2.0), ("r2", 3, "y", 4.0), ("r2", 4, "x", 9.0),
            ("r2", 5, None, 5.0), ("r3", 1, "far", 100.0), ("r1", 6, "x", 1.0), ("r1", 6, "y", 1.0), ("r2", 6, "y", 1.0), ("r2", 6, "x", 1.0)]
    path = str(tmp_path / "snap")
    spark.createDataFrame(rows, "run string, key int, value string, amount double").write.partitionBy("run").parquet(path)
    stored = spark.read.parquet(path)
    got = {r["outcome"]: tuple(r)[1:] for r in upkeep.snapshot_diff(stored, "run", "r1", "r2", ["key"], ["value"], "amount").collect()}
    assert got == {"added": (1, None, 9.0), "removed": (1, 1.0, None), "changed": (1, 3.0, 4.0), "same": (4, 9.0, 9.0)}


def test_snapshot_diff_reads_two_partitions(spark):
    rows = stored_queries.stored_snapshots(Tables(spark, SF))
    assert rows.select("run").distinct().count() > 20
    diff = upkeep.snapshot_diff(rows, "run", *stored_queries.RUNS, ["service", "kind"], ["n", "top"], "total")
    diff.collect()
    scan = next(n for n in nodes(diff._jdf.queryExecution().executedPlan()) if n.nodeName().startswith("Scan parquet"))
    assert scan.metrics().apply("numPartitions").value() == 2 and scan.metrics().apply("numFiles").value() >= 2
    assert not [n for n in nodes(diff._jdf.queryExecution().executedPlan()) if "Join" in n.nodeName()]


def nodes(plan):
    """All nodes of an executed plan, those of its stages too."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    yield plan
    below = [plan.plan()] if "QueryStage" in plan.nodeName() else [plan.children().apply(i) for i in range(plan.children().size())]
    for child in below:
        yield from nodes(child)


def test_freshness_by_files_and_by_data(spark, tmp_path):
    now = datetime.now()
    for name, at in (("new", now - timedelta(hours=1)), ("old", now - timedelta(days=9))):
        spark.createDataFrame([(1, at)], "id int, at timestamp").coalesce(1).write.parquet(str(tmp_path / name))
    spark.createDataFrame([], "id int, at timestamp").write.parquet(str(tmp_path / "none"))
    tables = {n: (spark.read.parquet(str(tmp_path / n)), "at") for n in ("new", "old", "none")}
    got = {r["object"]: (r["stale"], r["written_after"]) for r in files.freshness(tables, now, 24).collect()}
    assert got == {"new": (False, True), "old": (True, True), "none": (True, False)}
    # by the files alone: those written two days ago are stale, and they are older than the data they are said to hold
    for f in (tmp_path / "new").glob("*.parquet"):
        os.utime(f, (time.time() - 2 * 86400,) * 2)
    by_files = {n: (spark.read.parquet(str(tmp_path / n)), None) for n in ("new", "old")}
    assert {r["object"]: (r["n_files"], r["stale"]) for r in files.freshness(by_files, now, 24).collect()} == {"new": (1, True), "old": (1, False)}
    again = files.freshness({"new": (spark.read.parquet(str(tmp_path / "new")), "at")}, now, 24).first()
    assert not again["stale"] and not again["written_after"]

from datetime import datetime

from pyspark.sql import functions as F

from wattledger.checks import ledger, quality


def states(report):
    return {(r["check"], r["status"], r["obtained"]) for r in report.collect()}


def test_grain_finds_repeats_and_nulls(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, None)], "a int, b int")
    assert states(quality.grain(df, "t", ["a", "b"])) == {("unique grain", "FALLA", "1"), ("key without NULL", "FALLA", "1")}
    assert {r["status"] for r in quality.grain(df.dropna().distinct(), "t", ["a", "b"]).collect()} == {"OK"}


def test_coverage_of_an_empty_table_is_not_judged(spark):
    df = spark.createDataFrame([(1, None, 1)] * 3 + [(None, None, 1)], "a int, b int, c int")
    got = {r["check"]: r["status"] for r in quality.coverage(df, "t", {"a": 95, "b": 95, "c": 95}).collect()}
    assert got == {"coverage of a": "REVISAR", "coverage of b": "FALLA", "coverage of c": "OK"}
    assert quality.coverage(df.limit(0), "t", {"a": 95}).first()["status"] == "N/A"


def test_gap_cause(spark):
    df = spark.createDataFrame([(None, None), (None, 1), (1, 1)], "v int, c int")
    got = {r["check"]: (r["status"], r["obtained"]) for r in quality.gap_cause(df, "t", "v", "c").collect()}
    assert got["gaps explained"] == ("REVISAR", "1")


def test_domain_names_the_first_odd_value(spark):
    df = spark.createDataFrame([("S",), ("Z",), (None,)], "f string")
    allowed = spark.createDataFrame([("S",), ("N",)], "f string")
    assert states(quality.domain(df, "t", "f", allowed)) == {("domain of f", "REVISAR", "1 Z")}
    assert quality.domain(df.where("f = 'S'"), "t", "f", allowed).first()["status"] == "OK"


def test_prefix_order_ambiguity_and_parts(spark):
    df = spark.createDataFrame([("S", "S-YES", 1, 2, None, 2, True, True, True), ("N", "X-NO", 3, 2, "v", 2, True, False, True)],
                               "c string, t string, s int, e int, v string, n int, w boolean, a boolean, b boolean")
    assert quality.code_prefix(df, "t", "c", "t").first()["obtained"] == "1"
    assert quality.date_order(df, "t", "s", "e").first()["obtained"] == "1"
    assert ("ambiguous v is NULL", "FALLA", "1") in states(quality.ambiguity(df, "t", "v", "n"))
    assert quality.composed(df, "t", "w", ["a", "b"]).first()["obtained"] == "1"


def test_row_preservation_and_orphans(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1,), (1,)], "k int")
    assert quality.row_preservation(left, right, ["k"], "t").first()["obtained"] == "2 to 3"
    assert quality.orphans(left, "t", right, "k").first()["obtained"] == "1"


def test_signals(spark):
    df = spark.createDataFrame([(None, 1, True, False, None)], "e int, f int, p boolean, z boolean, o boolean")
    got = {r["check"]: r["status"] for r in quality.signals(df, "t", ["e"], ["f"], ["p", "z", "o"]).collect()}
    assert got == {"e all NULL": "OK", "f has values": "OK", "p is true somewhere": "OK",
                   "z is true somewhere": "REVISAR", "o is true somewhere": "OK"}


def test_recompute_and_definition(spark):
    source = spark.createDataFrame([(1, 2.0, True), (1, 3.0, False), (2, 1.0, True)], "k int, m double, new boolean")
    shown = spark.createDataFrame([(1, 5.0), (1, 5.0), (2, 9.0)], "k int, m double")
    assert quality.recompute(shown, source, ["k"], "m", "t").first()["obtained"] == "1"
    assert quality.definition_moved(source, "t", F.lit(True), F.col("new"), "m").first()["status"] == "OK"
    assert quality.definition_moved(source, "t", F.col("new"), F.col("new"), "m").first()["status"] == "FALLA"


def test_settings_as_expected(spark):
    schema = "domain string, key string, value string, active boolean"
    found = spark.createDataFrame([("c", "list", "87, 90", True), ("c", "off", "1", True)], schema)
    want = spark.createDataFrame([("c", "list", "87,90", True), ("c", "off", "1", False), ("c", "none", "1", True)], schema)
    got = {r["object"]: (r["status"], r["obtained"]) for r in
           quality.settings_as_expected(found, want, ["domain", "key"]).collect()}
    assert got == {"c.list": ("OK", "87, 90 active=true"), "c.off": ("FALLA", "1 active=true"), "c.none": ("FALLA", "missing")}


def log(spark):
    at = lambda d, h=0: datetime(2026, 1, d, h)
    rows = [(1, "a", "9", at(1), at(1, 1), "EXITOSO", 100, "w1"), (2, "a", "10", at(2), at(2, 1), "EXITOSO", 80, "w1"),
            (3, "b", "9", at(1), at(1, 1), "EXITOSO", 5, "w1"), (4, "b", "10", at(2), at(2, 2), "EXITOSO", 0, "w2"),
            (5, "c", "9", at(1), at(1, 3), "FALLIDO", None, "w1"), (6, "c", "10", at(3), None, "INICIADO", None, "w1")]
    return spark.createDataFrame(rows, "log_id int, object string, run string, started_at timestamp, ended_at timestamp, "
                                       "status string, written bigint, writer string")


def test_ledger(spark):
    rows = log(spark)
    assert {r["object"]: r["status"] for r in ledger.latest_status(rows).collect()} == {
        "a": "EXITOSO", "b": "EXITOSO", "c": "INICIADO"}
    assert {r["run"] for r in ledger.last_run(rows).collect()} == {"10"}
    got = {r["object"]: (r["before"], r["now"], r["delta_pct"], r["large"]) for r in ledger.volume_delta(rows).collect()}
    assert got == {"a": (100, 80, -20.0, True), "b": (5, 0, -100.0, True)}
    assert [r["log_id"] for r in ledger.zero_row_success(rows).collect()] == [4]
    assert [r["log_id"] for r in ledger.recent_failures(rows, datetime(2026, 1, 5)).collect()] == [5]
    assert {r["object"]: r["late"] for r in ledger.laggards(rows).collect()} == {"a": False, "b": False, "c": True}
    assert {r["object"]: (r["n_writers"], r["only_writer"]) for r in ledger.writers(rows).collect()} == {
        "a": (1, "w1"), "b": (2, None), "c": (1, "w1")}
    assert [r["object"] for r in ledger.written_after(rows, datetime(2026, 1, 2), ["a", "c"]).collect()] == ["a"]
    assert {r["object"]: r["same"] for r in ledger.counts_by_run(rows, ["10", "9"]).collect()} == {"a": False, "b": False}


def test_plan_against_log(spark):
    wanted = spark.createDataFrame([("a",), ("d",)], "object string")
    assert [r[0] for r in ledger.missing_from_log(wanted, log(spark)).collect()] == ["d"]
    live = spark.createDataFrame([("a", True), ("d", False)], "object string, active boolean")
    assert ledger.plan_matches(live, "active", wanted, "p").first()["status"] == "REVISAR"


def test_attempts_are_appended_with_their_whole_message(spark, tmp_path):
    path = str(tmp_path / "log")
    start = datetime(2026, 1, 1)
    ledger.append_attempt(spark, path, object="a", run="1", started_at=start, status=ledger.STARTED)
    ledger.append_attempt(spark, path, object="a", run="1", started_at=start, ended_at=datetime(2026, 1, 1, 0, 1),
                          status=ledger.FAILED, message="x" * 5000)
    got = {r["status"]: (r["seconds"], r["message"]) for r in spark.read.parquet(path).collect()}
    assert got == {ledger.STARTED: (None, None), ledger.FAILED: (60.0, "x" * 5000)}

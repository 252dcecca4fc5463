from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattledger import settings
from wattledger.operators import upkeep
from wattledger.session import shared_folder, written
from wattledger.sources import contracts, files


def test_order_contract():
    class Frame:
        def __init__(self, *columns):
            self.columns = list(columns)

    wanted = ["bill", "total", "paid"]
    contracts.check_order(Frame("BILL", "total", "Paid"), wanted)
    for found, said in ((("bill", "paid"), "missing \\['total'\\]"), (("bill", "total", "paid", "note"), "surplus \\['note'\\]"),
                        (("bill", "paid", "total"), "column 1 is paid, expected total")):
        with pytest.raises(ValueError, match=said):
            contracts.check_order(Frame(*found), wanted)


@pytest.mark.parametrize("table, columns", [
    ("open_orders", 8), ("services", 23), ("readings", 24), ("consumption", 15), ("review_orders", 12),
    ("order_comments", 5), ("bills", 16), ("charges", 18), ("requests", 11), ("contract_consumption", 12),
    ("investigations", 9), ("loss_files", 11), ("consumption_history", 39), ("charge_history", 38), ("features", 49)])
def test_contract_sizes(table, columns):
    rows = contracts.fields(table)
    assert len(rows) == columns == len({stored for _, stored, _ in rows}) == len({own for own, _, _ in rows})


def test_no_published_column_is_a_verdict():
    for table in contracts.tables():
        if table not in ("open_orders", "review_orders"):
            assert contracts.verdict_columns([stored for _, stored, _ in contracts.fields(table)]) == []
    assert contracts.verdict_columns(["decision_final", "n_medidores"]) == ["decision_final"]


def test_landing_names_and_types(spark):
    source = spark.createDataFrame([(1, "x", 2)], "SERVICIO_SUSCRITO int, ID_SOLICITUD string, OTHER int")
    rest = [F.lit(None).cast("string").alias(s) for _, s, _ in contracts.fields("requests")[2:]]
    got = contracts.from_landing(source.select("*", *rest), "requests")
    assert got.columns == [own for own, _, _ in contracts.fields("requests")]
    assert (got.first()["service"], got.first()["request"]) == (1, None)


def test_type_differences_and_comments(spark):
    df = spark.createDataFrame([(1, 2.0)], "servicio_suscrito bigint, id_solicitud double")
    found = contracts.type_differences(df, "requests")
    assert ("id_solicitud", "bigint", "double") in found and ("comentario", "string", "missing") in found
    view = files.replace_view(df, "noted", {"id_solicitud": "request id"})
    assert contracts.uncommented(view) == ["servicio_suscrito"]
    assert spark.table("noted").count() == 1


def test_landing_write_and_read(spark, tmp_path):
    path = str(tmp_path / "landing")
    files.write_landing(spark.createDataFrame([], "A int, ITERATION int"), path)
    back = files.read_landing(spark, path)
    assert back.columns == ["a"] and back.count() == 0
    with pytest.raises(ValueError, match="no columns"):
        files.write_landing(spark.createDataFrame([], "a int").select(), path)


def test_stale_files_are_all_named(spark, tmp_path):
    path = str(tmp_path / "fresh")
    spark.range(3).write.parquet(path)
    paths = {"fresh": path, "gone": str(tmp_path / "gone")}
    now = datetime.now()
    assert [n for n, _ in files.stale_files(spark, paths, now, 6)] == ["gone"]
    assert [n for n, _ in files.stale_files(spark, paths, now + timedelta(days=3), 6)] == ["fresh", "gone"]
    assert files.stale_files(spark, paths, now + timedelta(days=3), 0) == []


def test_table_overwrites(spark):
    spark.sql("DROP TABLE IF EXISTS w_target")
    with pytest.raises(ValueError, match="does not exist"):
        files.overwrite_by_position(spark.range(1).toDF("a"), "w_target")
    files.replace_table(spark.createDataFrame([(1, "x")], "a int, b string"), "w_target")
    files.overwrite_by_position(spark.createDataFrame([(2, "y")], "A int, B string"), "w_target")
    assert [tuple(r) for r in spark.table("w_target").collect()] == [(2, "y")]
    files.overwrite_by_name(spark.createDataFrame([("z", 3)], "b string, a int"), "w_target")
    assert [tuple(r) for r in spark.table("w_target").collect()] == [(3, "z")]
    with pytest.raises(ValueError, match="missing \\['b'\\]"):
        files.overwrite_by_name(spark.range(1).toDF("a"), "w_target")
    with pytest.raises(ValueError, match="expected a"):
        files.overwrite_by_position(spark.createDataFrame([("z", 3)], "b string, a int"), "w_target")
    spark.sql("DROP TABLE w_target")


def test_empty_guard(spark):
    files.require_rows(spark.range(1), "t")
    files.require_rows(spark.range(0), "t", allow_empty=True)
    with pytest.raises(ValueError, match="t: no rows"):
        files.require_rows(spark.range(0), "t")


def test_source_types(spark):
    df = spark.sql("SELECT CAST(5 AS DECIMAL(10,0)) a, CAST(5.25 AS DECIMAL(10,2)) b, DATE'2026-01-01' c, 'x' d")
    assert [f.dataType.simpleString() for f in files.normalise_source(df).schema] == ["bigint", "double", "timestamp", "string"]


def test_written_tables_lie_in_the_shared_folder(spark):
    assert shared_folder(spark) == shared_folder(spark)
    back = written(spark.range(5), "five")
    assert back.count() == 5 and all(shared_folder(spark).removeprefix("file:").rstrip("/") in f for f in back.inputFiles())


# --- settings ----------------------------------------------------------------------------


@pytest.mark.parametrize("value, kind, want", [
    ("-12", "BIGINT", -12), (" 4, 6,31 ", "INT_LIST", [4, 6, 31]), ("1e-3", "DOUBLE", 0.001), ("1", "BOOLEAN", True),
    ("100 % \\ \"as is\"", "STRING", "100 % \\ \"as is\"")])
def test_typed_settings(value, kind, want):
    assert settings.typed(value, kind, "k") == want


@pytest.mark.parametrize("value, kind", [("3.5", "INT"), ("7; 8", "LONG"), (" , ", "INT_LIST"), ("4-6", "INT_LIST"),
                                         ("1,5", "DOUBLE"), ("2", "BOOLEAN"), (None, "BIGINT")])
def test_bad_settings_raise(value, kind):
    with pytest.raises(ValueError, match="setting k"):
        settings.typed(value, kind, "k")


def test_inactive_settings_resolve_to_none(spark):
    loaded = settings.load(settings.seed(spark))
    assert loaded.values == settings.DEFAULTS.values
    assert loaded["false_lap_tolerance"] is None and loaded["measured_concepts"] == [87, 90, 545, 546]
    with pytest.raises(KeyError):
        loaded["unknown"]


def test_settings_are_joined_on_their_stored_keys(spark):
    table = settings.seed(spark)
    with pytest.raises(ValueError, match="without a row: recovery_token"):
        settings.load(table.where("clave <> 'token_recuperacion'"))
    other = spark.createDataFrame([("otro", "clave_ajena", "x", "INT", True)], table.schema)
    assert settings.load(table.union(other)).values == settings.DEFAULTS.values


# --- upkeep ------------------------------------------------------------------------------


def control(spark):
    return spark.createDataFrame([("a", 1, "hand", True, None), ("b", 2, "hand", True, None), ("c", 3, "hand", False, 9)],
                                 "name string, place int, note string, active boolean, parent int")


def test_upsert_keeps_manual_columns(spark):
    seed = spark.createDataFrame([("b", 20, "seed"), ("d", 40, "seed")], "name string, place int, note string")
    got = {r["name"]: (r["place"], r["note"]) for r in
           upkeep.upsert(control(spark), seed, ["name"], ["place"]).collect()}
    assert got == {"a": (1, "hand"), "b": (20, "hand"), "c": (3, "hand"), "d": (40, "seed")}


def test_insert_if_missing_is_idempotent(spark):
    seed = spark.createDataFrame([("b", 20), ("d", 40)], "name string, place int")
    once = upkeep.add_missing(control(spark), seed, ["name"])
    assert sorted((r["name"], r["place"]) for r in once.collect()) == [("a", 1), ("b", 2), ("c", 3), ("d", 40)]
    assert upkeep.add_missing(once, seed, ["name"]).count() == 4


def test_guarded_update_and_retirement(spark):
    got = upkeep.replace_value(control(spark), F.col("name") != "a", "place", 2, 7)
    assert {r["name"]: r["place"] for r in got.collect()} == {"a": 1, "b": 7, "c": 3}
    got = upkeep.retire(control(spark), "name", ["b", "c"], "active", note="gone")
    assert {r["name"]: (r["active"], r["note"]) for r in got.collect()} == {
        "a": (True, "hand"), "b": (False, "gone"), "c": (False, "hand")}


def test_parents_by_name(spark):
    links = spark.createDataFrame([("b", "a"), ("c", "zz")], "child string, parent_name string")
    got = upkeep.resolve_parent(control(spark), links, "name", "place", "parent")
    assert {r["name"]: r["parent"] for r in got.collect()} == {"a": None, "b": 1, "c": None}


def test_evolve_adds_columns_last(spark):
    got = upkeep.evolve(control(spark), {"place": "int", "year": "bigint"})
    assert got.columns == ["name", "place", "note", "active", "parent", "year"]
    assert got.schema["year"].dataType.simpleString() == "bigint"

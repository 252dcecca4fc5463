from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wattledger.operators import groups
from wattledger.plans import extract, features, history
from wattledger.settings import DEFAULTS
from wattledger.sources import contracts

READING = dict(service=1, period=1, bill_period=10, period_start="2026-01-01", period_end="2026-01-30 00:00:00", days=29,
               kind_text="3-ACTIVE", kind=3, device="M-1", factor="1", digits=5, previous_reading=10.0,
               current_reading=20.0, computed_use=10.0, billed_use=10.0, low_limit=0.0, high_limit=50.0,
               note_1="0-NONE", note_2=None, note_3=None, loss_mark=None, bill_year=2026, bill_month=1, cycle=1)
USE = dict(service=1, period=1, bill_period=10, bill_year=2026, bill_month=1, cycle=1, route_cycle=1,
           recorded_on="2026-02-01", method="4-BILLED", kind_text="3-ACTIVE", amount=10.0, calc_function="P_USE",
           rating="1-NORMAL", period_start="2026-01-01", period_end="2026-01-30")
CHARGE = dict(service=1, bill=7, bill_period=10, period=1.0, concept="87-USE", cause="-1", sign="DB", period_label="2026-01",
              document="AA-311-K", created_at="2026-02-01 00:00:00", program="5-REGULAR", tariff=1.0, units=10.0,
              amount=100.0, period_start="2026-01-01", period_end="2026-01-30", bill_year=2026, bill_month=1)
BILL = dict(service=1, bill=7, bill_period=10, bill_year=2026, bill_month=1, paid_at=None, total=100.0, paid=0.0,
            claimed=0.0, pending=100.0, due_on="2026-03-01", own_amount=100.0, recovered_amount=0.0, period=1,
            period_start="2026-01-01", period_end="2026-01-30")
REQUEST = dict(service=1, request=1, customer="c", request_kind="300 - RECONNECTION", requested_at=None, request_state="s",
               attended_at=datetime(2026, 1, 10), comment=None, channel=None, analyst=None, area=None)


def frame(spark, table, base, *changes):
    rows = [{**base, **c} for c in (changes or ({},))]
    schema = ", ".join(f"{own} {kind}" for own, _, kind in contracts.fields(table))
    return spark.createDataFrame([tuple(r[own] for own, _, _ in contracts.fields(table)) for r in rows], schema)


def readings(spark, *c):
    return frame(spark, "readings", READING, *c)


def consumption(spark, *c):
    return frame(spark, "consumption", USE, *c)


def charges(spark, *c):
    return frame(spark, "charges", CHARGE, *c)


def bills(spark, *c):
    return frame(spark, "bills", BILL, *c)


def requests(spark, *c):
    return frame(spark, "requests", REQUEST, *c)


# --- consumption history -----------------------------------------------------------------


def test_equal_readings_are_one_fact(spark):
    got = history.consumption_history(readings(spark, {}, {}), consumption(spark)).collect()
    assert len(got) == 1 and got[0]["grain_rows"] == 1


def test_repeated_grain_is_counted_not_dropped(spark):
    rows = readings(spark, {}, {"current_reading": 21.0}, {"device": None}, {"period": 2})
    got = history.consumption_history(rows, consumption(spark)).collect()
    assert sorted((r["period"], r["device"], r["grain_rows"], r["n_devices"], r["device_use"]) for r in got) == [
        (1, "(sin medidor)", 1, 1, 30.0), (1, "M-1", 2, 1, 30.0), (1, "M-1", 2, 1, 30.0), (2, "M-1", 1, 1, 10.0)]


def test_incomplete_keys_are_left_out(spark):
    rows = readings(spark, {}, {"service": None}, {"period": None}, {"kind": None})
    assert history.consumption_history(rows, consumption(spark)).count() == 1


def test_dates_are_read_with_or_without_time(spark):
    row = history.consumption_history(readings(spark), consumption(spark)).first()
    assert (row["period_start"], row["period_end"]) == (date(2026, 1, 1), date(2026, 1, 30))


def test_ambiguous_attributes_are_null_beside_their_count(spark):
    use = consumption(spark, {}, {"rating": "5055-I"}, {"method": "17-LOSS", "rating": "9-X", "amount": 99.0})
    row = history.consumption_history(readings(spark), use).first()
    assert (row["rating"], row["n_ratings"], row["ratings"]) == (None, 2, ["1-NORMAL", "5055-I"])
    assert (row["calc_function"], row["n_calc_functions"]) == ("P_USE", 1)
    assert (row["period_use"], row["billed_rows"], row["use_reconciles"]) == (20.0, 2, False)


def test_cell_without_consumption_keeps_its_reading(spark):
    row = history.consumption_history(readings(spark), consumption(spark, {"period": 5})).first()
    assert (row["period_use"], row["n_ratings"], row["use_reconciles"]) == (None, None, False)


def test_period_view_adds_devices_up(spark):
    rows = readings(spark, {}, {"device": "M-2", "computed_use": -10.0, "current_reading": 1.0}, {"device": None})
    view = history.period_view(history.consumption_history(rows, consumption(spark))).first()
    assert (view["billed_use"], view["computed_use"], view["n_devices"], view["devices"]) == (30.0, 10.0, 2, ["M-1", "M-2"])
    assert (view["negative_use"], view["reading_fell"], view["some_device_unknown"]) == (True, True, True)


# --- charge history ----------------------------------------------------------------------


def test_charge_flags(spark):
    rows = charges(
        spark, {}, {"sign": "CR"}, {"document": "AA-PR-311-K", "period": 2.0},
        {"document": "AA-PR-311-K", "period": None}, {"cause": "74-LOSS", "program": "307-LOSS"},
        {"program": "-26-EXTERNAL"}, {"document": None, "period": 2.0}, {"bill": 99})
    got = [r.asDict() for r in history.charge_history(rows, bills(spark)).collect()]
    assert len(got) == 8
    by = {(r["sign"], r["document"], r["period"], r["cause_code"], r["program_code"], r["bill"]): r for r in got}
    assert by["CR", "AA-311-K", 1, -1, 5, 7]["signed_amount"] == -100.0
    assert by["DB", "AA-PR-311-K", 2, -1, 5, 7]["is_recovery"] is True
    assert by["DB", "AA-PR-311-K", None, -1, 5, 7]["is_recovery"] is False
    assert by["DB", "AA-311-K", 1, 74, 307, 7]["is_loss"] is True
    assert by["DB", "AA-311-K", 1, -1, -26, 7]["is_regular"] is False
    assert by["DB", None, 2, -1, 5, 7]["has_recovery_token"] is False
    assert by["DB", "AA-311-K", 1, -1, 5, 99]["period_differs"] is None


def test_candidate_key_of_charges_is_counted(spark):
    got = history.charge_history(charges(spark, {}, {"amount": 5.0}, {"tariff": 2.0}), bills(spark)).collect()
    assert sorted(r["grain_rows"] for r in got) == [1, 2, 2]


def test_left_joins_keep_rows(spark):
    rows = charges(spark, {}, {"bill": 99}, {"bill": 98})
    assert history.charge_history(rows, bills(spark)).count() == 3


def test_bill_history_multiplies_only_by_readings(spark):
    got = history.bill_history(bills(spark), charges(spark, {}, {"concept": "90-X"}),
                               consumption(spark, {}, {"method": "17-LOSS", "kind_text": "6-R"}),
                               readings(spark, {}, {"device": "M-2"}))
    rows = got.collect()
    assert len(rows) == 2
    assert {r["n_lines"] for r in rows} == {2} and {r["kind_use"] for r in rows} == {10.0}


@pytest.mark.parametrize("lines", [5, 50_000])
def test_a_bill_with_many_lines_stays_one_bill(spark, lines):
    many = charges(spark, {}).crossJoin(spark.range(lines).select(F.col("id").alias("n")))
    got = history.bill_history(bills(spark), many.withColumn("amount", F.lit(1.0)).drop("n"), consumption(spark, {}),
                               readings(spark, {}, {"device": "M-2"})).collect()
    assert len(got) == 2 and sum(r["kind_use"] for r in got) == 20.0
    assert {(r["n_lines"], r["line_amount"]) for r in got} == {(lines, float(lines))}


def test_detail_has_one_row_for_each_grain(spark):
    rows = charges(spark, {}, {"amount": 5.0}, {"concept": "90-X"}, {"period": 2.0}, {"cause": "74-LOSS"})
    got = history.charge_detail(rows).collect()
    assert sorted(len(r["charge_lines"]) for r in got) == [1, 1, 1, 2]


def test_review_history_counts_comments_and_detail_holds_them(spark):
    orders = spark.createDataFrame([(1,), (2,)], "order int")
    comments = spark.createDataFrame(
        [(1, datetime(2026, 1, 2, 9), "b", "y"), (1, datetime(2026, 1, 2, 8), "b", "z"), (1, datetime(2026, 1, 1), "a", "x")],
        "order int, recorded_at timestamp, comment_kind string, comment string")
    got = {r["order"]: (r["n_comments"], r["first_comment_at"]) for r in history.review_history(orders, comments).collect()}
    assert got == {1: (3, datetime(2026, 1, 1)), 2: (0, None)}
    detail = {(r["day"].day, r["comment_kind"]): [c["comment"] for c in r["comments"]] for r in history.comment_detail(comments).collect()}
    assert detail == {(1, "a"): ["x"], (2, "b"): ["z", "y"]}


def test_contract_roster(spark):
    rows = spark.createDataFrame(
        [(1, 10, "2020-01-01", None), (1, 11, "2020-01-01", "4732-12-31"), (1, 12, None, "2020-05-01"), (2, 13, None, None),
         (None, 14, None, None)], "contract int, service int, installed_on string, withdrawn_on string")
    got = {r["service"]: (r["active"], r["never_withdrawn"], r["contract_services"])
           for r in history.contract_roster(rows, date(2026, 1, 1)).collect()}
    assert got == {10: (True, None, 3), 11: (True, True, 3), 12: (False, False, 3), 13: (True, None, 1)}


def test_order_roster_by_activity(spark):
    orders = spark.createDataFrame([(1, 5, "993 - X"), (2, 5, "102010-X"), (3, 6, "993-X")],
                                   "order int, service int, activity string")
    master = spark.createDataFrame([(5, "A")], "service int, town string")
    got = {r["order"]: r["town"] for r in history.order_roster(orders, master, 993).collect()}
    assert got == {1: "A", 3: None}
    assert history.order_roster(orders, master).count() == 3


# --- features ----------------------------------------------------------------------------


def feature_rows(spark, reads, use=None, lines=None, asked=None, settings=DEFAULTS):
    h = history.consumption_history(readings(spark, *reads), consumption(spark, *(use or ({},))), settings)
    c = history.charge_history(charges(spark, *(lines or ({"service": 99},))), bills(spark), settings)
    got = features.features(features.collapse(h, settings), c, requests(spark, *(asked or ({"service": 99},))), settings)
    return {(r["service"], r["period"], r["kind"]): r for r in got.collect()}


def test_features_have_one_row_per_cell_in_contract_order(spark):
    h = history.consumption_history(readings(spark, {}, {"device": "M-2"}, {"period": 2}), consumption(spark))
    c = history.charge_history(charges(spark, {}, {}), bills(spark))
    out = contracts.publish(features.features(features.collapse(h), c, requests(spark, {}, {"request": 2})), "features", "run", datetime(2026, 1, 1))
    assert out.count() == 2
    assert contracts.type_differences(out, "features") == []
    assert out.columns == [stored for _, stored, _ in contracts.fields("features")]


def test_both_ways_to_the_cells_agree(spark):
    reads = readings(spark, {}, {}, {"device": "M-2", "digits": 4, "current_reading": 5.0, "computed_use": -5.0},
                     {"device": None, "note_2": "31-X"}, {"period": 2}, {"period": 2, "factor": "7", "days": 30})
    use = consumption(spark, {}, {"rating": "5055-I"}, {"period": 2, "calc_function": "[P_SOLICITUD_DE_INVESTIGACION]"})
    a = features.collapse(history.consumption_history(reads, use))
    b = features.cells(reads, use).select(*a.columns)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_false_lap(spark):
    read = {"digits": 4, "previous_reading": 8700.0, "current_reading": 120.0, "computed_use": -8580.0, "billed_use": 355.0}
    row = feature_rows(spark, [read])[1, 1, 3]
    assert round(row["lap_ratio"], 4) == 0.25 and row["false_lap"] is None
    low = DEFAULTS.with_values(false_lap_tolerance=0.2)
    assert feature_rows(spark, [read], settings=low)[1, 1, 3]["false_lap"] is True
    assert feature_rows(spark, [{}], settings=low)[1, 1, 3]["false_lap"] is False


def test_unconfirmed_request_codes_give_null(spark):
    off = DEFAULTS.with_values(reconnection=None)
    row = feature_rows(spark, [{}], asked=[{}], settings=off)[1, 1, 3]
    assert (row["reconnected_on"], row["reconnected_inside"], row["suspended_inside"]) == (None, None, False)


@pytest.mark.parametrize("at, inside, since", [
    (datetime(2025, 12, 31, 23), False, 30), (datetime(2026, 1, 1), True, 29), (datetime(2026, 1, 30, 23), True, 0),
    (datetime(2026, 1, 31), False, None), (None, False, None)])
def test_reconnection(spark, at, inside, since):
    row = feature_rows(spark, [{}], asked=[{"attended_at": at}])[1, 1, 3]
    assert (row["reconnected_inside"], row["days_since_reconnection"]) == (inside, since)


def test_charges_repeat_on_every_type(spark):
    got = feature_rows(spark, [{}, {"kind": 6, "kind_text": "6-R"}],
                       lines=[{}, {"concept": "899-U", "units": 3.0}, {"program": "-26-X", "sign": "CR"}])
    for kind in (3, 6):
        row = got[1, 1, kind]
        assert (row["charges"], row["other_charges"], row["measured_units"], row["unlegalised_units"]) == (100.0, -100.0, 20.0, 3.0)


def test_factor_differs_between_types(spark):
    got = feature_rows(spark, [{}, {"kind": 6, "kind_text": "6-R", "computed_use": 100.0}, {"period": 2},
                               {"period": 2, "kind": 6, "kind_text": "6-R"}])
    assert [got[1, p, k]["factor_differs"] for p in (1, 2) for k in (3, 6)] == [True, True, False, False]


def test_notes_in_any_slot(spark):
    got = feature_rows(spark, [{"note_2": "31-X"}, {"period": 2, "note_3": 34}])
    assert (got[1, 1, 3]["note_device_change"], got[1, 1, 3]["note_lower_reading"]) == (True, False)
    assert (got[1, 2, 3]["note_device_change"], got[1, 2, 3]["note_lower_reading"]) == (False, True)


def test_investigation_by_rating_or_function(spark):
    use = [{"rating": "5055-I"}, {}, {"period": 2, "calc_function": "[P_SOLICITUD_DE_INVESTIGACION]"}, {"period": 3}]
    got = feature_rows(spark, [{}, {"period": 2}, {"period": 3}], use)
    assert [got[1, p, 3]["investigated"] for p in (1, 2, 3)] == [True, True, False]


def test_features_with_a_hot_service(spark):
    reads = [{"period": p, "period_end": f"2026-01-{p:02d}", "device": f"M-{d}"} for p in range(1, 29) for d in range(3)]
    got = feature_rows(spark, reads, settings=DEFAULTS)
    assert len(got) == 28 and {r["n_devices"] for r in got.values()} == {3}


def test_reactive_check(spark):
    reads = [{"billed_use": 100.0}, {"kind": 6, "computed_use": 80.0, "billed_use": 35.0}, {"period": 2},
             {"period": 3, "billed_use": 100.0}, {"period": 3, "kind": 6, "computed_use": 10.0, "billed_use": 0.0}]
    got = {r["period"]: (r["expected"], r["difference"]) for r in
           features.reactive_check(readings(spark, *reads), 3, 6).collect()}
    assert got == {1: (30.0, 5.0), 3: (0.0, 0.0)}


# --- extracts ----------------------------------------------------------------------------


def test_billable_matrix_needs_both_keys(spark):
    matrix = spark.createDataFrame(
        [(c, f, p) for p in (101, 103, 501, 701) for c, f in ((1, "S"), (95, "N"), (110, "N"))] + [(96, "N", 701)],
        "cutoff_code int, billable string, product_code int")
    subs = spark.createDataFrame([(1, 1, 101), (2, 96, 701), (3, 96, 101), (4, 7, 501)],
                                 "service int, cutoff_code int, product_code int").withColumns({
        "contract": F.lit(1), "premises": F.lit(1), "customer_id": F.lit(1), "installed_at": F.lit(datetime(2020, 1, 1)),
        "withdrawn_at": F.lit(None).cast("timestamp"), "category_code": F.col("service"), "subcategory_code": F.lit(1),
        "cycle": F.lit(4), "plan_code": F.lit(5), "product_plan_code": F.lit(6)})
    one = spark.createDataFrame([(1, "t", "street 1", "p1")], "premises int, town string, address string, page string")
    who = spark.createDataFrame([(1, "Ana", None, "77")], "customer_id int, first_name string, last_name string, customer_document string")
    freq = spark.createDataFrame([(1, 1.0, 1, 1), (1, 2.0, 2, 2)], "service int, frequency double, recorded_at int, id int")
    owed = spark.createDataFrame([(1, 5.0, date(2020, 1, 1)), (1, 7.0, date(2030, 1, 1)), (1, 0.0, date(2020, 1, 1))],
                                 "service int, pending double, due_at date")
    def named(*rows):
        return spark.createDataFrame(list(rows), "code int, text string")

    names = {"product": named((101, "WATER")), "cutoff": named((1, "ON")), "category": named((1, "HOME"), (2, "TRADE")), "plan": named((5, "BASIC")),
             "subcategory": spark.createDataFrame([(1, 1, "LOW"), (9, 1, "X")], "category_code int, code int, text string")}
    rows = extract.services(subs, one, who, freq, owed, matrix, names, date(2026, 1, 1))
    assert contracts.publish(rows, "services").columns == [stored for _, stored, _ in contracts.fields("services")]
    got = {r["service"]: r for r in rows.collect()}
    assert {s: (r["category"], r["subcategory"]) for s, r in got.items()} == {
        1: ("1-HOME", "1-LOW"), 2: ("2-TRADE", None), 3: (None, None), 4: (None, None)}
    assert (got[1]["cutoff_state"], got[2]["cutoff_state"], got[1]["plan"], got[1]["product_plan"]) == ("1-ON", None, "5-BASIC", None)
    assert {s: r["billable"] for s, r in got.items()} == {1: "S", 2: "N", 3: None, 4: None}
    assert got[1]["billable_text"] == "S-FACTURABLE" and got[3]["billable_text"] is None
    assert (got[1]["pending_balance"], got[1]["overdue_bills"], got[1]["overdue_balance"]) == (12.0, 1, 5.0)
    assert (got[2]["pending_balance"], got[2]["overdue_bills"]) == (None, 0)
    assert got[1]["frequency"] == 2.0 and got[1]["customer"] == "Ana " and got[1]["product"] == "101-WATER"


def test_open_orders_fill_their_contract(spark):
    orders = spark.createDataFrame([(1, 5, None), (2, 12, None), (3, 5, datetime(2026, 1, 2))], "order int, state int, closed_at timestamp")
    acts = spark.createDataFrame([(1, 9, 993, 883, 4, "note"), (1, 8, 7, 883, 4, None), (2, 9, 993, 883, 4, "x"), (3, 9, 993, 883, 4, "x"),
                                  (1, 9, 993, 1, 4, "other task")],
                                 "order int, service int, activity int, task int, contract int, order_comment string")
    subs = spark.createDataFrame([(9, 70)], "service int, premises int")
    names = spark.createDataFrame([(993, "VARIATION"), (5, "OPEN")], "code int, text string")
    rows = extract.open_orders(orders.withColumn("created_at", F.lit(datetime(2026, 1, 1))), acts, subs, names, names)
    assert contracts.publish(rows, "open_orders").columns == [stored for _, stored, _ in contracts.fields("open_orders")]
    assert sorted((r["service"], r["premises"], r["activity"], r["order_state"], r["order_comment"]) for r in rows.collect()) == [
        (8, None, " - ", "5 - OPEN", None), (9, 70, "993 - VARIATION", "5 - OPEN", "note")]


def review_inputs(spark, acts):
    orders = spark.createDataFrame([(o, datetime(2026, 1, 10), None, 5) for o in (1, 2)],
                                   "order int, created_at timestamp, closed_at timestamp, state int")
    activities = spark.createDataFrame(acts, "order int, service int, activity int, task int, activity_ref int, request int")
    drivers = spark.createDataFrame([(9, k, 1, datetime(2026, 1, 1), datetime(2026, 1, 31)) for k in (3, 6)],
                                    "service int, kind bigint, period bigint, window_start timestamp, window_end timestamp")
    criticals = spark.createDataFrame([(9, 3, 1, 100), (9, 3, 2, 101)],
                                      "service int, kind bigint, period bigint, activity_ref int")
    cases = spark.createDataFrame([(9, 6, 1, 500, datetime(2026, 1, 5))],
                                  "service int, kind bigint, period bigint, request int, recorded_at timestamp")
    periods = spark.createDataFrame([(1, date(2026, 1, 1), date(2026, 1, 31))], "period bigint, starts date, ends date")
    closed = spark.createDataFrame([(1, "Eva")], "order int, closed_by string")
    text = spark.createDataFrame([(1, "TASK"), (102010, "REVIEW"), (3, "ACTIVE"), (5, "OPEN")], "code int, text string")
    return drivers, criticals, cases, orders, activities, closed, periods, dict.fromkeys(("task", "activity", "kind", "state"), text)


def test_a_decision_reached_from_two_types_is_one_row(spark):
    rows = extract.review_orders(*review_inputs(spark, [(1, 9, 7400027, 1, 7, 0)])).collect()
    assert [(r["order"], r["kind"], r["closed_by"]) for r in rows] == [(1, None, "Eva")]


def test_review_branches(spark):
    acts = [(1, 9, 102010, 1, 100, 0), (2, 9, 102010, 1, 101, 0), (2, 9, 0, 769, 8, 500), (1, 8, 7400027, 1, 9, 0)]
    df = extract.review_orders(*review_inputs(spark, acts))
    assert contracts.publish(df, "review_orders").columns == [stored for _, stored, _ in contracts.fields("review_orders")]
    rows = df.collect()
    assert {(r["kind"], r["kind_text"], r["task"], r["activity"], r["order_state"]) for r in rows} == {
        (3, "3-ACTIVE", "1-TASK", "102010-REVIEW", "5-OPEN"), (6, None, None, None, "5-OPEN")}
    assert sorted((r["order"], r["kind"], r["period"]) for r in rows) == [(1, 3, 1), (2, 6, 1)]


def test_a_driver_without_period_matches_every_period(spark):
    args = list(review_inputs(spark, [(1, 9, 102010, 1, 100, 0), (2, 9, 102010, 1, 101, 0)]))
    args[0] = args[0].withColumn("period", F.lit(None).cast("bigint"))
    rows = extract.review_orders(*args).collect()
    assert sorted((r["order"], r["period"]) for r in rows) == [(1, 1), (2, 2)]


def test_repeated_review_rows_multiply_nothing(spark):
    """Rows of every branch twice, and a driver that many rows repeat: no list of them is gathered anywhere."""
    acts = [(1, 9, 102010, 1, 100, 0), (2, 9, 102010, 1, 101, 0), (2, 9, 0, 769, 8, 500), (1, 9, 7400027, 1, 7, 0)]
    args = list(review_inputs(spark, acts))
    once = sorted(map(repr, extract.review_orders(*args).collect()))
    for i in (0, 1, 2, 3, 4):
        args[i] = args[i].unionByName(args[i])
    twice = extract.review_orders(*args)
    assert sorted(map(repr, twice.collect())) == once and len(once) > 2
    plan = twice._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan


def test_comments_are_cleaned_and_observations_need_an_open_order(spark):
    reviews = spark.createDataFrame([(1, 9, 3, 1, datetime(2026, 1, 1), None), (2, 9, None, 1, datetime(2026, 1, 1), None)],
                                    "order int, service int, kind int, period int, opened_at timestamp, ended_at timestamp")
    comments = spark.createDataFrame([(1, datetime(2026, 1, 2), 4, "a\n|b"), (5, datetime(2026, 1, 2), 4, "x")],
                                     "order int, recorded_at timestamp, kind_code int, comment string")
    activities = spark.createDataFrame([(1, 9), (5, 9)], "order int, service int")
    kinds = spark.createDataFrame([(4, "note")], "code int, text string")
    seen = spark.createDataFrame([(9, 3, 1, datetime(2026, 1, 5), "in"), (9, 3, 1, datetime(2026, 1, 5), "in"),
                                  (9, 3, 1, datetime(2026, 9, 5), "late"), (9, 3, 2, datetime(2026, 1, 5), "other")],
                                 "service int, kind int, period int, observed_at timestamp, comment string")
    got = extract.order_comments(reviews, comments, seen, activities, kinds, datetime(2026, 6, 1)).collect()
    assert sorted((r["order"], r["comment_kind"], r["comment"]) for r in got) == [
        (1, extract.ANALYST_REVIEW, "in"), (1, "note", "ab")]


def test_own_and_recovered_need_a_period_to_differ(spark):
    lines = spark.createDataFrame([(1, 7, 10, 1, "DB", 5.0), (1, 7, 10, None, "DB", 1.0), (1, 7, 10, 2, "CR", 2.0),
                                   (1, 7, 10, 2, "XX", 50.0)],
                                  "service int, bill int, bill_period int, period int, sign string, amount double")
    bill = spark.createDataFrame([(1, 7, 10, 1)], "service int, bill int, bill_period int, period int")
    row = extract.own_and_recovered(lines, bill).first()
    assert (row["own_amount"], row["recovered_amount"]) == (6.0, -2.0)


def test_loss_file_without_a_known_irregularity_shows_the_separator(spark):
    files = spark.createDataFrame([(1, 1, "F", 5, 2), (1, 2, "Z", None, 2)],
                                  "service int, loss_file int, state string, irregularity_code int, request int").withColumns({
        "recorded_at": F.lit(datetime(2026, 1, 1)), "fraud_from": F.lit(datetime(2026, 1, 1)),
        "fraud_to": F.lit(None).cast("timestamp"), "order": F.lit(1), "comment": F.lit("c")})
    kinds = spark.createDataFrame([(5, "X")], "code int, text string")
    got = {r["loss_file"]: (r["irregularity"], r["state_text"]) for r in extract.loss_files(files, kinds).collect()}
    assert got == {1: ("5-X", "F-FRAUDE CONFIRMADO"), 2: ("-", "Z-DESCONOCIDO")}


def test_one_closer_per_order(spark):
    changes = spark.createDataFrame([(1, 5, 8, "u", 1), (1, 5, 8, "v", 2), (1, 1, 8, "u", 3), (2, 5, 9, "u", 1)],
                                    "order int, from_state int, to_state int, user string, changed_at int")
    users = spark.createDataFrame([("u", 1), ("v", 2)], "user string, user_id int")
    people = spark.createDataFrame([(1, "Ana"), (2, "Eva")], "user_id int, name string")
    assert [tuple(r) for r in extract.closers(changes, people, users).collect()] == [(1, "Eva")]


def test_plans_hold_no_nested_loop(spark):
    plans = [extract.review_orders(*review_inputs(spark, [(1, 9, 7400027, 1, 7, 0)])),
             features.features(features.cells(readings(spark), consumption(spark)),
                               history.charge_history(charges(spark), bills(spark)), requests(spark))]
    for df in plans:
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text

"""Histories, the period view and the rosters."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from ..functions import amounts, codes, dates, flags
from ..operators import groups
from ..plans import history
from ..settings import DEFAULTS
from . import roles
from .registry import Tables, query

USE_BY_CELL = """use_by_cell AS (
  SELECT service, period, kind,
         sum(CASE WHEN method = '4-BILLED' THEN amount END) AS period_use,
         count(CASE WHEN method = '4-BILLED' THEN 1 END) AS billed_rows,
         CASE WHEN count(DISTINCT CASE WHEN method = '4-BILLED' THEN rating END) = 1
              THEN max(CASE WHEN method = '4-BILLED' THEN rating END) END AS rating,
         count(DISTINCT CASE WHEN method = '4-BILLED' THEN rating END) AS n_ratings,
         coalesce(array_to_string(list_sort(list(DISTINCT rating) FILTER (method = '4-BILLED')), ','), '') AS ratings,
         CASE WHEN count(DISTINCT CASE WHEN method = '4-BILLED' THEN calc_function END) = 1
              THEN max(CASE WHEN method = '4-BILLED' THEN calc_function END) END AS calc_function,
         count(DISTINCT CASE WHEN method = '4-BILLED' THEN calc_function END) AS n_calc_functions,
         max(recorded_on) AS last_recorded_on
  FROM consumption GROUP BY service, period, kind)"""

HISTORY = (roles.READINGS + ", " + roles.CONSUMPTION + ", " + USE_BY_CELL + """, device_totals AS (
  SELECT service, period, kind, count(DISTINCT device) AS n_devices, sum(billed_use) AS device_use
  FROM readings GROUP BY service, period, kind), history AS (
  SELECT r.service, r.period, r.kind, coalesce(r.device, '(sin medidor)') AS device,
         r.device IS NULL AS device_unknown, r.kind_text, r.bill_period, r.bill_year, r.bill_month,
         r.cycle, CAST(r.period_start AS DATE) AS period_start, CAST(r.period_end AS DATE) AS period_end,
         r.days, r.previous_reading, r.current_reading, r.computed_use, r.billed_use,
         CAST(r.factor AS DOUBLE) AS factor, r.digits, r.low_limit, r.high_limit, r.note_1, r.note_2,
         CAST(r.note_3 AS VARCHAR) AS note_3, r.loss_mark, u.period_use, u.billed_rows, u.rating,
         u.n_ratings, u.ratings, u.calc_function, u.n_calc_functions, u.last_recorded_on,
         d.n_devices, d.device_use,
         abs(coalesce(u.period_use, 0) - coalesce(d.device_use, 0)) <= 0.01 AS use_reconciles,
         count(*) OVER (PARTITION BY r.service, r.period, r.kind, r.device) AS grain_rows
  FROM readings r
  LEFT JOIN use_by_cell u ON u.service = r.service AND u.period = r.period AND u.kind = r.kind
  LEFT JOIN device_totals d ON d.service = r.service AND d.period = r.period AND d.kind = r.kind)""")


def rounded(*names: str, digits: int = 4):
    return [F.round(n, digits).alias(n) for n in names]


def rounded_sql(*names: str, digits: int = 4) -> str:
    return ", ".join(f"round({n}, {digits}) AS {n}" for n in names)


def built_history(t: Tables):
    return history.consumption_history(roles.readings(t), roles.consumption(t))


H_PLAIN = ["service", "period", "kind", "device", "device_unknown", "kind_text", "bill_period",
           "bill_year", "bill_month", "cycle", "period_start", "period_end", "days", "digits", "note_1",
           "note_2", "note_3", "loss_mark", "billed_rows", "rating", "n_ratings", "calc_function",
           "n_calc_functions", "last_recorded_on", "n_devices", "use_reconciles", "grain_rows"]
H_ROUND = ["previous_reading", "current_reading", "computed_use", "billed_use", "factor", "low_limit",
           "high_limit", "period_use", "device_use"]


@query("consumption_history", f"""WITH {HISTORY}
SELECT {', '.join(H_PLAIN)}, ratings, {rounded_sql(*H_ROUND)} FROM history""")
def consumption_history(t: Tables):
    return built_history(t).select(
        *H_PLAIN, F.array_join("ratings", ",").alias("ratings"), *rounded(*H_ROUND))


V_SQL = """period_view AS (
  SELECT service, period, kind, max(kind_text) AS kind_text, max(bill_period) AS bill_period,
         max(bill_year) AS bill_year, max(bill_month) AS bill_month, max(cycle) AS cycle,
         min(period_start) AS period_start, max(period_end) AS period_end, max(days) AS days,
         max(n_devices) AS n_devices,
         coalesce(array_to_string(list_sort(list(DISTINCT device) FILTER (NOT device_unknown)), ','), '') AS devices,
         bool_or(device_unknown) AS some_device_unknown, max(period_use) AS period_use,
         sum(billed_use) AS billed_use, sum(computed_use) AS computed_use,
         bool_or(use_reconciles) AS use_reconciles, bool_or(computed_use < 0) AS negative_use,
         bool_or(current_reading < previous_reading) AS reading_fell, max(rating) AS rating,
         max(n_ratings) AS n_ratings, max(calc_function) AS calc_function,
         array_to_string(list_sort(list(DISTINCT note_1)), ',') AS notes
  FROM history GROUP BY service, period, kind)"""
V_PLAIN = ["service", "period", "kind", "kind_text", "bill_period", "bill_year", "bill_month", "cycle",
           "period_start", "period_end", "days", "n_devices", "some_device_unknown", "use_reconciles",
           "negative_use", "reading_fell", "rating", "n_ratings", "calc_function"]
V_ROUND = ["period_use", "billed_use", "computed_use"]


@query("period_view", f"""WITH {HISTORY}, {V_SQL}
SELECT {', '.join(V_PLAIN)}, devices, notes, {rounded_sql(*V_ROUND)} FROM period_view""")
def period_view(t: Tables):
    return history.period_view(built_history(t)).select(
        *V_PLAIN, F.array_join("devices", ",").alias("devices"),
        F.array_join("notes", ",").alias("notes"), *rounded(*V_ROUND))


@query("collapse_device", f"""WITH {roles.READINGS}
SELECT service, period, kind, count(DISTINCT device) AS n_devices, max(days) AS days,
       round(sum(billed_use), 4) AS billed_use, round(sum(computed_use), 4) AS computed_use
FROM readings GROUP BY service, period, kind""")
def collapse_device(t: Tables):
    return (roles.readings(t).groupBy("service", "period", "kind").agg(
        F.size(F.collect_set("device")).cast("bigint").alias("n_devices"), F.max("days").alias("days"),
        F.round(F.sum("billed_use"), 4).alias("billed_use"),
        F.round(F.sum("computed_use"), 4).alias("computed_use")))


C_SQL = roles.BILLS + ", " + roles.LINES + """, charge_history AS (
  SELECT l.service, l.bill, l.bill_period, l.period, l.concept_code, l.cause_code, l.sign,
         l.program_code, l.document, l.tariff, CAST(l.created_at AS DATE) AS created_on, l.units, l.amount,
         CASE WHEN l.sign = 'CR' THEN -l.amount ELSE l.amount END AS signed_amount,
         b.period AS account_period, b.bill_year AS account_year, b.bill_month AS account_month,
         b.total AS account_total, b.pending AS account_pending, b.paid_on AS account_paid_on,
         l.program_code = 5 AS is_regular, l.cause_code = 74 AND l.program_code = 307 AS is_loss,
         coalesce(split_part(l.document, '-', 2) = 'PR', false) AS has_recovery_token,
         coalesce(l.period, b.period) <> b.period AS period_differs,
         coalesce(split_part(l.document, '-', 2) = 'PR', false)
           AND coalesce(l.period, b.period) <> b.period AS is_recovery,
         count(*) OVER (PARTITION BY l.bill, l.concept_code, l.cause_code, l.period, l.document,
                        l.tariff, l.sign) AS grain_rows
  FROM lines l LEFT JOIN bills b ON b.bill = l.bill)"""
C_COLS = ["service", "bill", "bill_period", "period", "concept_code", "cause_code", "sign", "program_code",
          "document", "created_on", "units", "amount", "signed_amount", "account_period", "account_year",
          "account_month", "account_total", "account_pending", "account_paid_on", "is_regular", "is_loss",
          "has_recovery_token", "period_differs", "is_recovery", "grain_rows"]


def built_charges(t: Tables):
    return history.charge_history(roles.charges(t), roles.bills(t))


@query("charge_history", f"WITH {C_SQL} SELECT {', '.join(C_COLS)}, CAST(tariff AS VARCHAR) AS tariff FROM charge_history")
def charge_history(t: Tables):
    return built_charges(t).select(*C_COLS, "tariff")


@query("signed_charges", f"""WITH {C_SQL}
SELECT service, bill, count(*) AS n_lines, round(sum(signed_amount), 2) AS signed_amount,
       round(sum(CASE sign WHEN 'DB' THEN amount WHEN 'CR' THEN -amount END), 2) AS strict_amount
FROM charge_history GROUP BY service, bill""")
def signed_charges(t: Tables):
    return (roles.charge_lines(t).groupBy("service", "bill").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.round(F.sum(amounts.credit_negative("sign", "amount")), 2).alias("signed_amount"),
        F.round(F.sum(amounts.debit_or_credit("sign", "amount")), 2).alias("strict_amount")))


@query("recovery_flag", f"""WITH {C_SQL}
SELECT has_recovery_token, period_differs, is_recovery, count(*) AS n_lines,
       round(sum(signed_amount), 1) AS signed_amount
FROM charge_history GROUP BY ALL""")
def recovery_flag(t: Tables):
    account = roles.bills(t).select("bill", F.col("period").alias("account_period"))
    token = codes.token_is("document", 1, DEFAULTS["recovery_token"])
    differs = history.period_differs("period", "account_period")
    return (roles.charge_lines(t).join(account, "bill").withColumns({
        "has_recovery_token": token, "period_differs": differs, "is_recovery": token & differs})
        .groupBy("has_recovery_token", "period_differs", "is_recovery").agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.round(F.sum(amounts.credit_negative("sign", "amount")), 1).alias("signed_amount")))


@query("loss_flag", """SELECT l_orderkey AS bill, count(*) AS n_lines,
       count(CASE WHEN l_linestatus = 'F' AND l_suppkey % 4 = 0 AND l_suppkey % 5 = 0 THEN 1 END) AS n_loss,
       bool_or(l_linestatus = 'F' AND l_suppkey % 4 = 0 AND l_suppkey % 5 = 0) AS has_loss
FROM lineitem GROUP BY l_orderkey""")
def loss_flag(t: Tables):
    lines = t.lineitem.withColumns(roles.line_columns())
    loss = history.loss_charge("cause_code", "program_code")
    return lines.groupBy(F.col("l_orderkey").alias("bill")).agg(
        F.count(F.lit(1)).alias("n_lines"), groups.count_where(loss).alias("n_loss"),
        groups.any_true(loss).alias("has_loss"))


@query("nested_charge_detail", f"""WITH {roles.LINES}
SELECT bill, concept_code || '-CONCEPT' AS concept, CASE cause_code WHEN 74 THEN '74-LOSS' ELSE '-1' END AS cause, period,
       count(*) AS n_entries, string_agg(sign || '/' || coalesce(document, '') || '/' || amount || '/' || units,
       ';' ORDER BY sign, document NULLS FIRST, amount, units) AS detail
FROM lines GROUP BY bill, concept_code, cause_code, period""")
def nested_charge_detail(t: Tables):
    text = F.transform("charge_lines", lambda e: F.concat_ws(
        "/", e["sign"], F.coalesce(e["document"], F.lit("")), e["amount"].cast("string"), e["units"].cast("string")))
    return history.charge_detail(roles.charges(t)).select(
        "bill", "concept", "cause", F.col("period").cast("bigint").alias("period"),
        F.size("charge_lines").cast("bigint").alias("n_entries"), F.array_join(text, ";").alias("detail"))


def turn_comments(t: Tables):
    """Turns as comments of an order, 12 hours apart."""
    hours = (F.col("turn") * 12).cast("int")
    return t.conversations.select(
        F.col("conv_id").alias("order"), F.timestamp_add("HOUR", hours, F.lit(datetime(2024, 1, 1))).alias("recorded_at"),
        F.col("role").alias("comment_kind"), F.col("text").alias("comment"))


TURN_COMMENTS = """turn_comments AS (
  SELECT conv_id AS "order", TIMESTAMP '2024-01-01' + turn * INTERVAL 12 HOUR AS recorded_at, role AS comment_kind, text AS comment
  FROM conversations)"""


@query("nested_comments", f"""WITH {TURN_COMMENTS}
SELECT "order", CAST(recorded_at AS DATE) AS day, comment_kind, count(*) AS n_comments,
       string_agg(hour(recorded_at) || ':' || length(comment), ';' ORDER BY recorded_at, comment) AS comments
FROM turn_comments GROUP BY ALL""")
def nested_comments(t: Tables):
    text = F.transform("comments", lambda e: F.concat_ws(
        ":", F.hour(e["recorded_at"]).cast("string"), F.length(e["comment"]).cast("string")))
    return history.comment_detail(turn_comments(t)).select(
        "order", "day", "comment_kind", F.size("comments").cast("bigint").alias("n_comments"),
        F.array_join(text, ";").alias("comments"))


@query("review_history", f"""WITH {roles.BILLS}, {TURN_COMMENTS}, seen AS (
  SELECT "order", count(*) AS n, min(recorded_at) AS first_comment_at, max(recorded_at) AS last_comment_at
  FROM turn_comments GROUP BY "order")
SELECT bill AS "order", service, state, coalesce(n, 0) AS n_comments, first_comment_at, last_comment_at
FROM bills LEFT JOIN seen ON "order" = bill""")
def review_history(t: Tables):
    orders = roles.bills(t).select(F.col("bill").alias("order"), "service", "state")
    return history.review_history(orders, turn_comments(t))


@query("bill_history", f"""WITH {roles.READINGS}, {roles.CONSUMPTION}, event_bills AS (
  SELECT service, service * 1000 + period // 2 AS bill, 100 + period // 2 AS bill_period,
         round(sum(value), 4) AS total FROM ev GROUP BY service, period // 2), detail AS (
  SELECT service * 1000 + period // 2 AS bill, count(*) AS n_lines, round(sum(value), 4) AS line_amount
  FROM ev GROUP BY service, period // 2), by_kind AS (
  SELECT service, bill_period, kind_text, min(period) AS period, round(sum(amount), 4) AS kind_use
  FROM consumption WHERE method = '4-BILLED' GROUP BY service, bill_period, kind_text)
SELECT b.service, b.bill, b.bill_period, b.total, n_lines, line_amount, u.kind_text, u.period, u.kind_use,
       r.period_start, r.period_end, r.days, round(r.previous_reading, 4) AS previous_reading,
       round(r.current_reading, 4) AS current_reading, round(r.computed_use, 4) AS computed_use,
       round(r.billed_use, 4) AS reading_use, r.high_limit, r.low_limit, r.note_1
FROM event_bills b LEFT JOIN detail d ON d.bill = b.bill
LEFT JOIN by_kind u ON u.service = b.service AND u.bill_period = b.bill_period
LEFT JOIN readings r ON r.service = b.service AND r.bill_period = b.bill_period AND r.kind_text = u.kind_text""")
def bill_history(t: Tables):
    bills = roles.event_bills(t).withColumn("bill_period", F.floor(F.col("period") / 2) + 100)
    bills = bills.withColumn("due_on", F.lit(None).cast("string"))
    rows = history.bill_history(bills, roles.event_charges(t), roles.consumption(t), roles.readings(t))
    return rows.select(
        "service", "bill", "bill_period", F.round("total", 4).alias("total"), "n_lines",
        F.round("line_amount", 4).alias("line_amount"),
        "kind_text", "period", F.round("kind_use", 4).alias("kind_use"), "period_start", "period_end",
        "days", *rounded("previous_reading", "current_reading", "computed_use", "reading_use"),
        "high_limit", "low_limit", "note_1")


@query("fanout_legacy", f"""WITH {roles.READINGS}, {roles.CONSUMPTION}, by_kind AS (
  SELECT service, bill_period, kind_text FROM consumption WHERE method = '4-BILLED' GROUP BY ALL), joined AS (
  SELECT u.service, u.bill_period, u.kind_text, r.device FROM by_kind u LEFT JOIN readings r
    ON r.service = u.service AND r.bill_period = u.bill_period AND r.kind_text = u.kind_text)
SELECT (SELECT count(*) FROM by_kind) AS rows_before, count(*) AS rows_after,
       count(*) > (SELECT count(*) FROM by_kind) AS multiplies FROM joined""")
def fanout_legacy(t: Tables):
    keys = ["service", "bill_period", "kind_text"]
    billed = roles.consumption(t).where(F.col("method") == "4-BILLED").select(*keys).distinct()
    counts = roles.readings(t).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    # Rows after the join follow from the match counts, without building the joined rows.
    return billed.join(counts, keys, "left").agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.sum(F.coalesce("n", F.lit(1))).alias("rows_after")).withColumn(
            "multiplies", F.col("rows_after") > F.col("rows_before"))


@query("contract_roster", """SELECT c_nationkey AS contract, c_custkey AS service, c_mktsegment AS product,
       CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN DATE '4732-12-31'
            ELSE DATE '2001-01-01' + CAST(c_custkey % 600 AS INTEGER) END AS withdrawn_on,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey % 5 = 1 END AS never_withdrawn,
       c_custkey % 5 <= 1 OR DATE '2001-01-01' + CAST(c_custkey % 600 AS INTEGER) > DATE '2001-09-01' AS active,
       count(*) OVER (PARTITION BY c_nationkey) AS contract_services
FROM customer""")
def contract_roster(t: Tables):
    key = F.col("c_custkey")
    leaving = dates.day_text(F.date_add(F.lit(date(2001, 1, 1)), (key % 600).cast("int")))
    services = t.customer.select(
        F.col("c_nationkey").alias("contract"), key.alias("service"), F.col("c_mktsegment").alias("product"),
        F.lit("1995-01-01 00:00:00").alias("installed_on"),
        F.when(key % 5 == 0, None).when(key % 5 == 1, "4732-12-31").otherwise(leaving).alias("withdrawn_on"))
    return history.contract_roster(services, roles.AS_OF_ORDERS).drop("installed_on")


@query("open_order_roster", f"""WITH {roles.BILLS}
SELECT bill AS "order", service, b.total, '993 - USE VARIATION' AS activity, 993 AS activity_code,
       c_name AS customer, c_mktsegment AS product
FROM bills b LEFT JOIN customer ON c_custkey = service
WHERE bill % 3 = 0 AND state = 'O'""")
def open_order_roster(t: Tables):
    activity = (F.when(F.col("bill") % 3 == 0, "993 - USE VARIATION").otherwise("102010-REVIEW"))
    orders = roles.bills(t).where(F.col("state") == "O").select(
        F.col("bill").alias("order"), "service", "total", activity.alias("activity"))
    master = t.customer.select(F.col("c_custkey").alias("service"), F.col("c_name").alias("customer"),
                               F.col("c_mktsegment").alias("product"))
    return history.order_roster(orders, master, DEFAULTS["use_variation_activity"])


@query("investigation_view", f"""WITH {roles.EV}
SELECT service, period, kind_text, CAST(kind AS INTEGER) AS kind, event_id AS request, k % 3 + 1 AS state,
       (k % 3 + 1) || '-STATE' AS state_text, day AS recorded_at,
       DATE '2024-01-01' + CAST(period * 3 AS INTEGER) AS period_start,
       DATE '2024-01-01' + CAST(period * 3 + 2 AS INTEGER) AS period_end
FROM ev""")
def investigation_view(t: Tables):
    state = F.col("k") % 3 + 1
    cases = roles.events(t).withColumns(
        roles.period_columns()).select(
        "service", "kind_text", "period", F.col("event_id").alias("request"), state.alias("state"),
        F.concat(state.cast("string"), F.lit("-STATE")).alias("state_text"),
        dates.time_text("ts").alias("recorded_at"), "period_start", "period_end")
    return history.investigation_view(cases)


@query("loss_file_view", """SELECT l_orderkey * 10 + l_linenumber AS loss_file, l_suppkey AS service,
       l_returnflag AS state, CASE WHEN l_partkey % 7 <> 0 THEN l_partkey % 7 END AS irregularity_code,
       CAST(l_shipdate AS DATE) AS fraud_start,
       CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) END AS fraud_end,
       CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS INTEGER) END AS fraud_days
FROM lineitem""")
def loss_file_view(t: Tables):
    code = F.col("l_partkey") % 7
    start = F.to_date("l_shipdate")
    ends = F.when(F.col("l_linenumber") != 7, F.date_add(start, F.col("l_quantity").cast("int")))
    files = t.lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("loss_file"),
        F.col("l_suppkey").alias("service"), F.col("l_returnflag").alias("state"),
        F.lit("R-EN INSPECCION").alias("state_text"),
        F.when(code == 0, "-").otherwise(F.concat(code.cast("string"), F.lit("-KIND"))).alias("irregularity"),
        F.lit(None).cast("bigint").alias("request"), F.lit(None).cast("bigint").alias("order"),
        dates.time_text("l_shipdate").alias("recorded_at"), dates.day_text(start).alias("fraud_start"),
        dates.day_text(ends).alias("fraud_end"), F.lit(None).cast("string").alias("comment"))
    return history.loss_file_view(files).select("loss_file", "service", "state", "irregularity_code",
                                                "fraud_start", "fraud_end", "fraud_days")

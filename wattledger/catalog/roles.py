"""Puts the given tables into the roles of readings, consumption, charges, bills and so on.

``events`` plays meter readings, consumption lines, charge lines and requests of a service
(the user); ``orders`` and ``lineitem`` play bills and charge lines of a service (the
customer). Codes are taken from the ``k`` property or from keys, so that every rule meets
cases on both sides.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import joins
from .registry import Tables

FIRST_DAY = date(2024, 1, 1)
PERIOD_DAYS = 3
WINDOW_DAYS = 7
AS_OF_EVENTS = date(2024, 1, 31)
AS_OF_ORDERS = date(2001, 9, 1)
# Fixed values of this mapping.
KINDS = {"click": 3, "view": 6, "purchase": 7, "signup": 8, "error": 9}
CONCEPTS = (87, 90, 545, 546, 899, 93, 1)


def pick(index: Column, *values) -> Column:
    """Value at a position of a short list."""
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def day_after(days: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY), days.cast("int"))


def events(t: Tables) -> DataFrame:
    # A flat object with one number: a pattern reads it several times faster than a JSON parser.
    k = F.regexp_extract("props", r'"k"\s*:\s*(\d+)', 1).try_cast("int")
    kind = F.lit(None).cast("int")
    for name, code in KINDS.items():
        kind = F.when(F.col("event_type") == name, code).otherwise(kind)
    day = F.to_date("ts")
    return t.events.select(
        "event_id", "ts", F.col("user_id").alias("service"), "event_type", "value", k.alias("k"),
        kind.cast("bigint").alias("kind"),
        F.concat(kind.cast("string"), F.lit("-"), F.upper("event_type")).alias("kind_text"),
        day.alias("day"),
        F.floor(F.datediff(day, F.lit(FIRST_DAY)) / PERIOD_DAYS).cast("bigint").alias("period"))


def kind_name() -> Column:
    text = F.lit(None).cast("string")
    for name, code in KINDS.items():
        text = F.when(F.col("kind") == code, f"{code}-{name.upper()}").otherwise(text)
    return text


EV = """ev AS (
  SELECT event_id, ts, user_id AS service, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(CASE event_type WHEN 'click' THEN 3 WHEN 'view' THEN 6 WHEN 'purchase' THEN 7
              WHEN 'signup' THEN 8 WHEN 'error' THEN 9 END AS BIGINT) AS kind,
         CASE event_type WHEN 'click' THEN '3' WHEN 'view' THEN '6' WHEN 'purchase' THEN '7'
              WHEN 'signup' THEN '8' WHEN 'error' THEN '9' END || '-' || upper(event_type) AS kind_text,
         CAST(ts AS DATE) AS day,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 3 AS BIGINT) AS period
  FROM events)"""


def period_columns() -> dict[str, Column]:
    start = day_after(F.col("period") * PERIOD_DAYS)
    end = day_after(F.col("period") * PERIOD_DAYS + PERIOD_DAYS - 1)
    return {"period_start": dates.day_text(start), "period_end": dates.day_text(end),
            "bill_period": F.floor(F.col("period") / 2).cast("bigint") + 100}


PERIOD_SQL = """strftime(DATE '2024-01-01' + CAST(period * 3 AS INTEGER), '%Y-%m-%d') AS period_start,
         strftime(DATE '2024-01-01' + CAST(period * 3 + 2 AS INTEGER), '%Y-%m-%d') AS period_end,
         100 + period // 2 AS bill_period"""


def readings(t: Tables) -> DataFrame:
    """One reading per service, period, type and device: the last event of the cell."""
    cells = (events(t).withColumn("slot", F.col("k") % 3)
             .groupBy("service", "period", "kind", "slot").agg(
                 F.sum(F.when(F.col("k") % 4 != 3, F.col("value"))).alias("billed_use"),
                 F.count(F.when(F.col("k") % 4 == 3, 1)).alias("losses"),
                 F.max_by("k", "event_id").alias("k"), F.max_by("value", "event_id").alias("value"))
             .withColumn("kind_text", kind_name()))
    k, previous = F.col("k"), F.col("k") * F.lit(10.0)
    current = F.when(k % 4 == 0, F.col("value")).otherwise(previous + F.col("value"))
    read_factor = F.when((F.col("kind") == 6) & (k % 5 == 0), 10.0).otherwise(1.0)
    note = F.when(k % 10 == 1, "31-DEVICE CHANGED").when(k % 10 == 2, "34-LOWER READING").otherwise("0-NONE")
    return cells.withColumns(period_columns()).select(
        "service", "period", "bill_period", "period_start", "period_end",
        F.lit(PERIOD_DAYS - 1).cast("bigint").alias("days"), "kind_text", "kind",
        F.when(F.col("slot") != 0, F.concat(F.lit("M-"), F.col("slot").cast("string"))).alias("device"),
        F.when(k % 9 != 0, (k % 2 + 1).cast("string")).alias("factor"),
        F.when(k % 7 != 0, F.when(k % 2 == 1, 3).otherwise(4)).cast("bigint").alias("digits"),
        previous.alias("previous_reading"), current.alias("current_reading"),
        ((current - previous) * read_factor).alias("computed_use"), "billed_use",
        F.lit(0.0).alias("low_limit"),
        F.when(k % 8 == 1, 0.0).when(k % 8 != 0, 20.0 + k).alias("high_limit"),
        note.alias("note_1"), F.when(k % 13 == 0, "31-DEVICE CHANGED").alias("note_2"),
        F.when(k % 17 == 0, 34).alias("note_3"),
        F.nullif(F.col("losses"), F.lit(0)).cast("string").alias("loss_mark"),
        F.lit(2024).cast("bigint").alias("bill_year"),
        F.month(F.col("period_start").cast("date")).cast("bigint").alias("bill_month"),
        (F.col("service") % 4).alias("cycle"))


READINGS = EV + """, reading_cells AS (
  SELECT service, period, kind, kind_text, k % 3 AS slot,
         sum(CASE WHEN k % 4 <> 3 THEN value END) AS billed_use,
         count(CASE WHEN k % 4 = 3 THEN 1 END) AS losses
  FROM ev GROUP BY ALL), reading_last AS (
  SELECT service, period, kind, k % 3 AS slot, k, value FROM ev
  QUALIFY row_number() OVER (PARTITION BY service, period, kind, k % 3 ORDER BY event_id DESC) = 1
), readings AS (
  SELECT service, period, """ + PERIOD_SQL + """, CAST(2 AS BIGINT) AS days, kind_text, kind,
         CASE WHEN slot <> 0 THEN 'M-' || slot END AS device,
         CASE WHEN k % 9 <> 0 THEN CAST(k % 2 + 1 AS VARCHAR) END AS factor,
         CAST(CASE WHEN k % 7 <> 0 THEN CASE WHEN k % 2 = 1 THEN 3 ELSE 4 END END AS BIGINT) AS digits,
         k * 10.0::DOUBLE AS previous_reading,
         CASE WHEN k % 4 = 0 THEN value ELSE k * 10.0::DOUBLE + value END AS current_reading,
         (CASE WHEN k % 4 = 0 THEN value ELSE k * 10.0::DOUBLE + value END - k * 10.0::DOUBLE)
           * CASE WHEN kind = 6 AND k % 5 = 0 THEN 10.0::DOUBLE ELSE 1.0::DOUBLE END AS computed_use,
         billed_use, 0.0::DOUBLE AS low_limit,
         CASE WHEN k % 8 = 1 THEN 0.0::DOUBLE WHEN k % 8 <> 0 THEN 20.0::DOUBLE + k END AS high_limit,
         CASE WHEN k % 10 = 1 THEN '31-DEVICE CHANGED' WHEN k % 10 = 2 THEN '34-LOWER READING'
              ELSE '0-NONE' END AS note_1,
         CASE WHEN k % 13 = 0 THEN '31-DEVICE CHANGED' END AS note_2,
         CASE WHEN k % 17 = 0 THEN 34 END AS note_3,
         CAST(nullif(losses, 0) AS VARCHAR) AS loss_mark,
         CAST(2024 AS BIGINT) AS bill_year,
         CAST(month(DATE '2024-01-01' + CAST(period * 3 AS INTEGER)) AS BIGINT) AS bill_month,
         service % 4 AS cycle
  FROM reading_cells JOIN reading_last USING (service, period, kind, slot))"""


def use_columns() -> dict[str, Column]:
    k = F.col("k")
    return {
        "method_code": F.when(k % 4 == 3, 17).otherwise(4),
        "method": F.when(k % 4 == 3, "17-LOSS").otherwise("4-BILLED"),
        "rating": F.when(k % 10 < 7, "1-NORMAL").when(k % 10 == 7, "5055-INVESTIGATION")
        .otherwise("5091-BAD DEVICE"),
        "calc_function": F.when(k % 25 == 0, "F[P_SOLICITUD_DE_INVESTIGACION]").otherwise("P_USE")}


def consumption(t: Tables) -> DataFrame:
    return events(t).withColumns(period_columns()).withColumns(use_columns()).select(
        "service", "period", "bill_period", dates.time_text("ts").alias("recorded_on"), "method",
        "kind_text", F.col("value").alias("amount"), "calc_function", "rating",
        "period_start", "period_end")


CONSUMPTION = """consumption AS (
  SELECT service, period, """ + PERIOD_SQL + """, kind, kind_text, value AS amount, day AS recorded_on,
         CASE WHEN k % 4 = 3 THEN '17-LOSS' ELSE '4-BILLED' END AS method,
         CASE WHEN k % 10 < 7 THEN '1-NORMAL' WHEN k % 10 = 7 THEN '5055-INVESTIGATION'
              ELSE '5091-BAD DEVICE' END AS rating,
         CASE WHEN k % 25 = 0 THEN 'F[P_SOLICITUD_DE_INVESTIGACION]' ELSE 'P_USE' END AS calc_function
  FROM ev)"""


def event_charges(t: Tables) -> DataFrame:
    """Charge lines of the services in ``events``; without a period where k divides by 11."""
    k = F.col("k")
    rows = events(t).withColumns(period_columns())
    return rows.select(
        "service", (F.col("service") * 1000 + F.floor(F.col("period") / 2)).alias("bill"),
        "bill_period", F.when(k % 11 != 0, F.col("period").cast("double")).alias("period"),
        F.concat(pick(k % 7, *CONCEPTS).cast("string"), F.lit("-CONCEPT")).alias("concept"),
        F.when(k % 5 == 0, "74-LOSS").otherwise("-1").alias("cause"),
        F.when(k % 6 == 0, "CR").otherwise("DB").alias("sign"),
        F.lit(None).cast("string").alias("period_label"),
        pick(k % 4, "AB-PR-250-M", "AB-250-M", "PLAIN", None).alias("document"),
        dates.time_text("ts").alias("created_at"),
        F.when(k % 3 == 0, "307-LOSS CONTROL").when(k % 6 == 2, "-26-EXTERNAL")
        .otherwise("5-REGULAR").alias("program"),
        (k % 3).cast("double").alias("tariff"), k.cast("double").alias("units"),
        F.col("value").alias("amount"), "period_start", "period_end",
        F.lit(2024).cast("bigint").alias("bill_year"), F.month("day").cast("bigint").alias("bill_month"))


def event_bills(t: Tables) -> DataFrame:
    """One bill per service and two periods; its own period is the first of the two."""
    half = F.floor(F.col("period") / 2)
    return (events(t).groupBy("service", half.alias("half")).agg(F.sum("value").alias("total"))
            .select("service", (F.col("service") * 1000 + F.col("half")).alias("bill"),
                    (F.col("half") * 2).alias("period"), F.lit(2024).alias("bill_year"),
                    F.lit(1).alias("bill_month"), "total", F.lit(0.0).alias("pending"),
                    F.lit(0.0).alias("own_amount"), F.lit(0.0).alias("recovered_amount"),
                    F.lit(None).cast("timestamp").alias("paid_at")))


EVENT_CHARGES = """event_charges AS (
  SELECT service, CASE WHEN k % 11 <> 0 THEN period END AS period, 2 * (period // 2) AS account_period,
         CASE k % 7 WHEN 0 THEN 87 WHEN 1 THEN 90 WHEN 2 THEN 545 WHEN 3 THEN 546 WHEN 4 THEN 899
              WHEN 5 THEN 93 ELSE 1 END AS concept_code,
         CASE WHEN k % 5 = 0 THEN 74 ELSE -1 END AS cause_code,
         CASE WHEN k % 3 = 0 THEN 307 WHEN k % 6 = 2 THEN -26 ELSE 5 END AS program_code,
         k % 4 = 0 AS has_recovery_token, CAST(k AS DOUBLE) AS units,
         CASE WHEN k % 6 = 0 THEN -value ELSE value END AS signed_amount
  FROM ev)"""


def event_requests(t: Tables) -> DataFrame:
    """Signups are reconnections, errors suspensions, purchases investigations."""
    name = (F.when(F.col("event_type") == "signup", "300 - RECONNECTION")
            .when(F.col("event_type") == "error", "56 - SUSPENSION")
            .when(F.col("event_type") == "purchase", "100207-INVESTIGATION"))
    return events(t).where(name.isNotNull()).select(
        "service", F.col("event_id").alias("request"), name.alias("request_kind"),
        F.col("ts").alias("requested_at"), F.when(F.col("k") % 9 != 0, F.col("ts")).alias("attended_at"))


REQUESTS = """requests AS (
  SELECT service, event_id AS request,
         CASE event_type WHEN 'signup' THEN 300 WHEN 'error' THEN 56 ELSE 100207 END AS request_code,
         ts AS requested_at, CASE WHEN k % 9 <> 0 THEN day END AS attended_on
  FROM ev WHERE event_type IN ('signup', 'error', 'purchase'))"""


def month_id(ts: str) -> Column:
    return (F.year(ts) * 100 + F.month(ts)).cast("bigint")


def bills(t: Tables) -> DataFrame:
    """Orders as bills of the customer."""
    total, state = F.col("o_totalprice"), F.col("o_orderstatus")
    return t.orders.select(
        F.col("o_custkey").alias("service"), F.col("o_orderkey").alias("bill"),
        month_id("o_orderdate").alias("bill_period"),
        F.year("o_orderdate").cast("bigint").alias("bill_year"),
        F.month("o_orderdate").cast("bigint").alias("bill_month"),
        F.when(state != "O", F.date_add(F.to_date("o_orderdate"), 20)).cast("timestamp").alias("paid_at"),
        total.alias("total"),
        F.when(state == "O", total).when(state == "P", F.floor(total / 2).cast("double"))
        .otherwise(0.0).alias("pending"),
        F.date_add(F.to_date("o_orderdate"), 30).alias("due_at"), state.alias("state"),
        month_id("o_orderdate").alias("period"),
        F.lit(None).cast("double").alias("own_amount"), F.lit(None).cast("double").alias("recovered_amount"))


BILLS = """bills AS (
  SELECT o_custkey AS service, o_orderkey AS bill,
         CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS bill_period,
         CAST(year(o_orderdate) AS BIGINT) AS bill_year, CAST(month(o_orderdate) AS BIGINT) AS bill_month,
         CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + 20 END AS paid_on,
         o_totalprice AS total,
         CASE o_orderstatus WHEN 'O' THEN o_totalprice WHEN 'P' THEN floor(o_totalprice / 2)
              ELSE 0.0 END AS pending,
         CAST(o_orderdate AS DATE) + 30 AS due_at, o_orderstatus AS state,
         CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS period
  FROM orders)"""


def line_columns() -> dict[str, Column]:
    return {
        "period": F.when(F.col("l_linenumber") != 7, month_id("l_shipdate")),
        "concept_code": pick(F.col("l_linenumber") - 1, *CONCEPTS),
        "cause_code": F.when((F.col("l_linestatus") == "F") & (F.col("l_suppkey") % 4 == 0), 74).otherwise(-1),
        "sign": F.when(F.col("l_returnflag") == "R", "CR").otherwise("DB"),
        "program_code": F.when(F.col("l_suppkey") % 5 == 0, 307)
        .when(F.col("l_suppkey") % 5 == 1, -26).otherwise(5),
        "document": pick((F.col("l_partkey") % 4).cast("int"), "AA-PR-311-K",
                         "AA-311-K", "PLAIN", None),
        "tariff": (F.col("l_partkey") % 10).cast("double")}


def as_charges(lines: DataFrame, *more: str) -> DataFrame:
    """Line items as charge lines of a bill."""
    return lines.withColumns(line_columns()).select(
        F.col("l_orderkey").alias("bill"), "period", "concept_code", "cause_code", "sign",
        "program_code", "document", "tariff", F.col("l_quantity").alias("units"),
        F.col("l_extendedprice").alias("amount"), F.col("l_shipdate").alias("created_at"), *more)


def charge_lines(t: Tables) -> DataFrame:
    """Line items as charge lines of a bill, with the customer as service."""
    lines = as_charges(t.lineitem)
    owner = t.orders.select(F.col("o_orderkey").alias("bill"), F.col("o_custkey").alias("service"),
                            month_id("o_orderdate").alias("bill_period"))
    return lines.join(joins.merged(owner), "bill")


LINES = """lines AS (
  SELECT o_custkey AS service, l_orderkey AS bill,
         CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS bill_period,
         CASE WHEN l_linenumber <> 7
              THEN CAST(year(l_shipdate) * 100 + month(l_shipdate) AS BIGINT) END AS period,
         CASE l_linenumber WHEN 1 THEN 87 WHEN 2 THEN 90 WHEN 3 THEN 545 WHEN 4 THEN 546
              WHEN 5 THEN 899 WHEN 6 THEN 93 ELSE 1 END AS concept_code,
         CASE WHEN l_linestatus = 'F' AND l_suppkey % 4 = 0 THEN 74 ELSE -1 END AS cause_code,
         CASE WHEN l_returnflag = 'R' THEN 'CR' ELSE 'DB' END AS sign,
         CASE l_suppkey % 5 WHEN 0 THEN 307 WHEN 1 THEN -26 ELSE 5 END AS program_code,
         CASE l_partkey % 4 WHEN 0 THEN 'AA-PR-311-K' WHEN 1 THEN 'AA-311-K'
              WHEN 2 THEN 'PLAIN' END AS document,
         CAST(l_partkey % 10 AS DOUBLE) AS tariff, l_quantity AS units, l_extendedprice AS amount,
         l_shipdate AS created_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

# Fixed values of this mapping: names of the charge codes.
CODE_NAMES = {"concept": {c: f"CONCEPT {c}" for c in CONCEPTS}, "cause": {-1: "NORMAL", 74: "LOSS"},
              "program": {5: "REGULAR", 307: "LOSS CONTROL", -26: "EXTERNAL"}}


def charges(t: Tables) -> DataFrame:
    """Charge lines in the landing layout, codes as texts."""
    lines = charge_lines(t)
    cause = F.when(F.col("cause_code") == 74, "74-LOSS").otherwise("-1")
    program = (F.when(F.col("program_code") == 307, "307-LOSS CONTROL")
               .when(F.col("program_code") == -26, "-26-EXTERNAL").otherwise("5-REGULAR"))
    return lines.select(
        "service", "bill", "bill_period", F.col("period").cast("double").alias("period"),
        F.concat(F.col("concept_code").cast("string"), F.lit("-CONCEPT")).alias("concept"),
        cause.alias("cause"), "sign", F.lit(None).cast("string").alias("period_label"), "document",
        dates.time_text("created_at").alias("created_at"), program.alias("program"), "tariff",
        "units", "amount", F.lit(None).cast("string").alias("period_start"),
        F.lit(None).cast("string").alias("period_end"),
        F.floor(F.col("bill_period") / 100).cast("bigint").alias("bill_year"),
        (F.col("bill_period") % 100).alias("bill_month"))


def months(days: DataFrame, ts: str) -> DataFrame:
    """Distinct calendar months that occur in a time column."""
    start = F.trunc(F.to_date(ts), "month")
    return days.select(start.alias("starts")).distinct().select(
        month_id("starts").alias("period"), F.year("starts").cast("bigint").alias("year"),
        F.month("starts").cast("bigint").alias("month"), "starts", F.last_day("starts").alias("ends"))


def run_log(t: Tables) -> DataFrame:
    """Events as load attempts: one object per event type, one run per day."""
    k = F.col("k")
    return events(t).select(
        F.col("event_id").alias("log_id"), F.col("event_type").alias("object"),
        F.date_format("day", "yyyyMMdd").alias("run"), F.col("ts").alias("started_at"),
        F.when(k % 10 != 9, F.timestamp_add("MINUTE", k, "ts")).alias("ended_at"),
        F.when(k % 10 == 9, "FAILED").otherwise("DONE").alias("status"),
        F.when(k % 10 != 9, F.when(k % 20 == 0, 0).otherwise(F.floor(F.col("value")).cast("bigint")))
        .cast("bigint").alias("written"),
        F.concat(F.lit("writer-"), (F.col("service") % 3).cast("string")).alias("writer"),
        F.when(k % 10 == 9, F.concat(F.lit("step "), k.cast("string"), F.lit(" failed"))).alias("message"))


LOG = EV + """, log AS (
  SELECT event_id AS log_id, event_type AS object, strftime(day, '%Y%m%d') AS run, ts AS started_at,
         CASE WHEN k % 10 <> 9 THEN ts + k * INTERVAL 1 MINUTE END AS ended_at,
         CASE WHEN k % 10 = 9 THEN 'FAILED' ELSE 'DONE' END AS status,
         CASE WHEN k % 10 <> 9 THEN CASE WHEN k % 20 = 0 THEN 0 ELSE CAST(floor(value) AS BIGINT) END
         END AS written,
         'writer-' || (service % 3) AS writer,
         CASE WHEN k % 10 = 9 THEN 'step ' || k || ' failed' END AS message
  FROM ev)"""

LOG_AS_OF = datetime(2024, 1, 31)

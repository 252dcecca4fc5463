"""Source tables to landing tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import joins
from ..plans import extract
from ..session import written
from ..settings import DEFAULTS
from . import roles
from .histories import rounded, rounded_sql
from .join_queries import PERIODS, bill_windows, use_periods
from .registry import Tables, query

# --- consumption and readings: events -------------------------------------------------


def codes_below(t: Tables, n: int):
    """Codes 0 to n - 1: the keys of the nations, of which there are 25. Lookups are cut on purpose,
    so that some codes have no name."""
    return t.nation.where(F.col("n_nationkey") < n).select(F.col("n_nationkey").cast("bigint").alias("code"))


def use_lines(t: Tables):
    week = F.floor(F.datediff("day", F.lit(roles.FIRST_DAY)) / roles.WINDOW_DAYS)
    cycle = F.col("service") % 4
    k = F.col("k")
    return roles.events(t).withColumns(roles.use_columns()).select(
        "service", (cycle * 100 + F.col("period")).alias("period"), (cycle * 1000 + week).alias("bill_period"),
        "kind", (k % 6).alias("device_id"), F.col("method_code").alias("method"), F.col("value").alias("amount"),
        "calc_function", F.when(k % 10 < 7, 1).when(k % 10 == 7, 5055).otherwise(77).alias("rating_code"),
        F.col("ts").alias("recorded_at"))


def reading_lines(t: Tables):
    """One reading per cell and device: its last event."""
    k = F.col("k")
    rows = roles.events(t).groupBy(
        "service", (F.col("service") % 4 * 100 + F.col("period")).alias("period"), "kind",
        (k % 9).alias("device_id")).agg(
            F.max_by("k", "event_id").alias("k"), F.max_by("value", "event_id").alias("value"))
    k = F.col("k")
    return rows.select(
        "service", "period", "kind", "device_id", F.when(k % 10 != 4, "F").otherwise("X").alias("status"),
        (k * 10.0 + F.col("value")).alias("current_reading"), (k * 10.0).alias("previous_reading"),
        F.lit(2.0).alias("read_factor"), F.lit(0.0).alias("low_limit"), (k + 20.0).alias("high_limit"),
        (k % 3).alias("note_code_1"), (k % 7).alias("note_code_2"), F.when(k % 5 == 0, k % 3).alias("note_code_3"))


SOURCES = PERIODS + """, use_lines AS (
  SELECT service, (service % 4) * 100 + period AS period,
         (service % 4) * 1000 + date_diff('day', DATE '2024-01-01', day) // 7 AS bill_period, kind,
         k % 6 AS device_id, CASE WHEN k % 4 = 3 THEN 17 ELSE 4 END AS method, value AS amount,
         CASE WHEN k % 25 = 0 THEN 'F[P_SOLICITUD_DE_INVESTIGACION]' ELSE 'P_USE' END AS calc_function,
         CASE WHEN k % 10 < 7 THEN 1 WHEN k % 10 = 7 THEN 5055 ELSE 77 END AS rating_code, ts AS recorded_at
  FROM ev), reading_lines AS (
  SELECT service, (service % 4) * 100 + period AS period, kind, k % 9 AS device_id,
         CASE WHEN k % 10 <> 4 THEN 'F' ELSE 'X' END AS status, k * 10.0::DOUBLE + value AS current_reading,
         k * 10.0::DOUBLE AS previous_reading, 0.0::DOUBLE AS low_limit, k + 20.0::DOUBLE AS high_limit,
         k % 3 AS note_code_1, k % 7 AS note_code_2, CASE WHEN k % 5 = 0 THEN k % 3 END AS note_code_3
  FROM (SELECT * FROM ev QUALIFY row_number() OVER (
    PARTITION BY service, period, kind, k % 9 ORDER BY event_id DESC) = 1)), periods AS (
  SELECT * FROM (
    SELECT s.service, s.kind, u.period, u.starts, u.ends, b.bill_period, b.year, b.month, u.cycle,
           dense_rank() OVER (PARTITION BY s.service ORDER BY u.ends DESC) AS place
    FROM (SELECT service, period, kind FROM use_lines WHERE method = 4
          UNION SELECT service, period, kind FROM reading_lines WHERE status = 'F') s
    JOIN use_periods u ON u.period = s.period
    JOIN bill_windows b ON b.cycle = u.cycle AND u.ends BETWEEN b.starts AND b.ends) WHERE place <= 8)"""


def cells(t: Tables):
    return extract.analysed_cells(use_lines(t), reading_lines(t), use_periods(t), bill_windows(t))


def kind_names(t: Tables):
    """All kinds but 8, so that one code has no name."""
    text = F.create_map(*[F.lit(x) for name, code in roles.KINDS.items() if code != 8 for x in (code, name.upper())])
    return codes_below(t, 25).withColumn("text", F.try_element_at(text, F.col("code").cast("int"))).where("text IS NOT NULL")


def note_names(t: Tables):
    return codes_below(t, 5).select("code", F.concat(F.lit("NOTE "), F.col("code").cast("string")).alias("text"))


def devices(t: Tables):
    return codes_below(t, 8).select(F.col("code").alias("id"), F.concat(F.lit("M-"), F.col("code").cast("string")).alias("device"),
                       (F.col("code") % 2 + 4).alias("digits"), (F.col("code") + 1.0).alias("factor"))


def code_text_sql(code: str, found: str, text: str) -> str:
    return f"CASE WHEN {found} THEN {code} || '-' || {text} END"


R_ROUND = ["previous_reading", "current_reading", "computed_use", "billed_use", "low_limit", "high_limit"]


@query("readings_extract", f"""WITH {SOURCES}, measured AS (
  SELECT service, period, kind, device_id AS dev, max(previous_reading) AS previous_reading, max(current_reading) AS current_reading,
         max(low_limit) AS low_limit, max(high_limit) AS high_limit, max(note_code_1) AS note_code_1,
         max(note_code_2) AS note_code_2, max(note_code_3) AS note_code_3, sum(amount) AS billed_use
  FROM (SELECT * EXCLUDE (status), CAST(NULL AS DOUBLE) AS amount FROM reading_lines WHERE status = 'F'
        UNION ALL BY NAME SELECT service, period, kind, device_id, amount FROM use_lines WHERE method = 4) GROUP BY ALL),
losses AS (SELECT service, kind, bill_period, CAST(count(*) AS VARCHAR) AS loss_mark FROM use_lines WHERE method = 17 GROUP BY ALL)
SELECT service, period, bill_period, strftime(starts, '%Y-%m-%d') AS period_start, strftime(ends, '%Y-%m-%d') AS period_end,
       CAST(2 AS BIGINT) AS days, kind, cycle, year AS bill_year, month AS bill_month,
       CASE kind WHEN 3 THEN '3-CLICK' WHEN 6 THEN '6-VIEW' WHEN 7 THEN '7-PURCHASE' WHEN 9 THEN '9-ERROR' END AS kind_text,
       {code_text_sql("'M'", 'dev < 8', 'dev')} AS device, CASE WHEN dev < 8 THEN dev % 2 + 4 END AS digits,
       CASE WHEN dev < 8 THEN CAST(dev + 1 AS DOUBLE) END AS factor,
       {rounded_sql(*[c for c in R_ROUND if c != 'computed_use'])},
       round((current_reading - previous_reading) * 2.0, 4) AS computed_use,
       {code_text_sql('note_code_1', 'note_code_1 < 5', "'NOTE ' || note_code_1")} AS note_1,
       {code_text_sql('note_code_2', 'note_code_2 < 5', "'NOTE ' || note_code_2")} AS note_2,
       {code_text_sql('note_code_3', 'note_code_3 < 5', "'NOTE ' || note_code_3")} AS note_3, loss_mark
FROM periods JOIN measured USING (service, period, kind) LEFT JOIN losses USING (service, kind, bill_period)""")
def readings_extract(t: Tables):
    rows = extract.readings(cells(t), use_lines(t), reading_lines(t), devices(t), kind_names(t), note_names(t))
    return rows.select(
        "service", "period", "bill_period", "period_start", "period_end", "days", "kind", "cycle", "bill_year",
        "bill_month", "kind_text", "device", "digits", "factor", *rounded(*R_ROUND), "note_1", "note_2", "note_3",
        "loss_mark")


USE_NAMES = """CASE method WHEN 4 THEN '4-BILLED' WHEN 17 THEN '17-LOSS' END AS method,
       CASE kind WHEN 3 THEN '3-CLICK' WHEN 6 THEN '6-VIEW' WHEN 7 THEN '7-PURCHASE' WHEN 9 THEN '9-ERROR' END AS kind_text,
       CASE rating_code WHEN 1 THEN '1-NORMAL' WHEN 5055 THEN '5055-INVESTIGATION' END AS rating"""


def method_names(t: Tables):
    return codes_below(t, 25).where(F.col("code").isin(4, 17)).select("code", F.when(F.col("code") == 4, "BILLED").otherwise("LOSS").alias("text"))


def rating_names(t: Tables):
    rows = codes_below(t, 2).select(F.when(F.col("code") == 0, 1).otherwise(5055).alias("code"))
    return rows.select("code", F.when(F.col("code") == 1, "NORMAL").otherwise("INVESTIGATION").alias("text"))


@query("consumption_extract", f"""WITH {SOURCES}
SELECT u.service, p.period, u.bill_period, b.year AS bill_year, b.month AS bill_month, b.cycle,
       CASE WHEN c_custkey % 5 > 0 THEN CAST(c_custkey % 5 AS INTEGER) END AS route_cycle, strftime(recorded_at, '%Y-%m-%d') AS recorded_on, {USE_NAMES}, amount, calc_function,
       strftime(p.starts, '%Y-%m-%d') AS period_start, strftime(p.ends, '%Y-%m-%d') AS period_end
FROM use_lines u LEFT JOIN bill_windows b ON b.bill_period = u.bill_period
LEFT JOIN use_periods p ON p.period = u.period LEFT JOIN customer ON c_custkey = u.service
WHERE (u.service, u.period) IN (SELECT (service, period) FROM periods)""")
def consumption_extract(t: Tables):
    routes = t.customer.where(F.col("c_custkey") % 5 > 0).select(
        F.col("c_custkey").alias("service"), (F.col("c_custkey") % 5).cast("int").alias("route_cycle"))
    return extract.consumption(use_lines(t), cells(t), routes, use_periods(t), bill_windows(t), method_names(t),
                               kind_names(t), rating_names(t))


@query("contract_consumption_extract", f"""WITH {SOURCES}, drivers AS (
  SELECT service FROM ev GROUP BY service HAVING max(value) > 200)
SELECT u.service, p.period, u.bill_period, b.year AS bill_year, b.month AS bill_month,
       strftime(recorded_at, '%Y-%m-%d') AS recorded_on, {USE_NAMES}, amount,
       strftime(p.starts, '%Y-%m-%d') AS period_start, strftime(p.ends, '%Y-%m-%d') AS period_end
FROM use_lines u LEFT JOIN bill_windows b ON b.bill_period = u.bill_period
LEFT JOIN use_periods p ON p.period = u.period
WHERE CAST(recorded_at AS DATE) >= DATE '2024-01-15'
  AND u.service // 5 IN (SELECT service // 5 FROM drivers)""")
def contract_consumption_extract(t: Tables):
    master = roles.events(t).select("service").distinct().withColumn("contract", F.floor(F.col("service") / 5))
    drivers = roles.events(t).groupBy("service").agg(F.max("value").alias("m")).where(F.col("m") > 200)
    as_of = datetime(2024, 7, 15).date()
    return extract.contract_consumption(use_lines(t), master, drivers.select("service"), as_of, use_periods(t),
                                        bill_windows(t), method_names(t), kind_names(t), rating_names(t))


@query("investigation_extract", f"""WITH {PERIODS}
SELECT service, CASE kind WHEN 3 THEN '3-CLICK' WHEN 6 THEN '6-VIEW' WHEN 7 THEN '7-PURCHASE' WHEN 9 THEN '9-ERROR' END AS kind_text,
       (service % 4) * 100 + e.period AS period, event_id AS request, k % 4 AS state,
       CASE k % 4 WHEN 1 THEN '1-OPEN' WHEN 2 THEN '2-CUSTOMER' WHEN 3 THEN '3-COMPANY' END AS state_text,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS recorded_at, strftime(u.starts, '%Y-%m-%d') AS period_start,
       strftime(u.ends, '%Y-%m-%d') AS period_end
FROM ev e LEFT JOIN use_periods u ON u.period = (service % 4) * 100 + e.period
WHERE day >= DATE '2024-01-15'""")
def investigation_extract(t: Tables):
    cases = roles.events(t).select(
        "service", "kind", (F.col("service") % 4 * 100 + F.col("period")).alias("period"),
        F.col("event_id").alias("request"), (F.col("k") % 4).alias("state"), F.col("ts").alias("recorded_at"))
    return extract.investigations(cases, kind_names(t), case_states(t), use_periods(t), datetime(2024, 7, 15).date())


def case_states(t: Tables):
    return codes_below(t, 4).where("code > 0").select(
        "code", roles.pick((F.col("code") - 1).cast("int"), "OPEN", "CUSTOMER", "COMPANY").alias("text"))


# --- bills, charges, master and orders: orders and lineitem ----------------------------


def month_windows(t: Tables):
    months = roles.months(t.orders, "o_orderdate")
    return months.select(F.col("period").alias("bill_period"), F.lit(1).alias("cycle"), "year", "month",
                         "starts", "ends", "period")


def month_periods(t: Tables, windows=None):
    """Months in which something was ordered or shipped; ``windows`` are the former, where they are at hand."""
    months = "period", F.lit(1).alias("cycle"), "starts", "ends"
    ordered = roles.months(t.orders, "o_orderdate") if windows is None else windows
    return ordered.select(*months).unionByName(roles.months(t.lineitem, "l_shipdate").select(*months)).distinct()


MONTHS = """month_windows AS (
  SELECT DISTINCT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS period,
         CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS starts, last_day(CAST(o_orderdate AS DATE)) AS ends
  FROM orders), month_periods AS (
  SELECT period, starts, ends FROM month_windows UNION
  SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS BIGINT),
         CAST(date_trunc('month', l_shipdate) AS DATE), last_day(CAST(l_shipdate AS DATE)) FROM lineitem)"""


def accounts(t: Tables):
    return roles.bills(t).withColumns({
        "invoice": F.col("bill") + 5_000_000, "paid": F.col("total") - F.col("pending"),
        "claimed": (F.col("bill") % 7).cast("double")}).select("service", "bill", "invoice", "state", "total", "paid", "claimed",
                                       "pending", "paid_at", "due_at")


def invoices(t: Tables):
    rank = F.split("o_orderpriority", "-")[0].cast("int")
    return t.orders.select(
        (F.col("o_orderkey") + 5_000_000).alias("invoice"),
        F.when(rank == 1, extract.INVOICE_KIND).otherwise(1).alias("invoice_kind"),
        F.when(rank == 2, 5).when(rank == 3, 97).otherwise(1).alias("program"),
        roles.month_id("o_orderdate").alias("bill_period"))


WANTED_BILLS = roles.BILLS + """, wanted AS (
  SELECT b.*, o_orderpriority FROM bills b JOIN orders ON o_orderkey = bill
  WHERE o_orderpriority = '1-URGENT' OR (o_orderpriority IN ('2-HIGH', '3-MEDIUM') AND state = 'P'))"""


@query("bill_extract", f"""WITH {WANTED_BILLS}, {roles.LINES}, {MONTHS}, last_ AS (
  SELECT w.*, m.starts, m.ends, m.period AS m_period FROM wanted w JOIN month_windows m ON m.period = w.bill_period
  QUALIFY row_number() OVER (PARTITION BY service ORDER BY m.ends DESC, bill DESC) <= 8)
SELECT service, bill, bill_period, bill_year, bill_month, CAST(paid_on AS TIMESTAMP) AS paid_at, total, round(total - pending, 2) AS paid,
       CAST(bill % 7 AS DOUBLE) AS claimed, pending,
       strftime(due_at, '%Y-%m-%d') AS due_on,
       (SELECT round(sum(CASE sign WHEN 'DB' THEN amount WHEN 'CR' THEN -amount END), 2) FROM lines l
        WHERE l.service = last_.service AND l.bill_period = last_.bill_period AND l.bill = last_.bill
          AND coalesce(l.period, m_period) = m_period) AS own_amount,
       (SELECT round(sum(CASE sign WHEN 'DB' THEN amount WHEN 'CR' THEN -amount END), 2) FROM lines l
        WHERE l.service = last_.service AND l.bill_period = last_.bill_period AND l.bill = last_.bill
          AND coalesce(l.period, m_period) <> m_period) AS recovered_amount,
       m_period AS period, strftime(starts, '%Y-%m-%d') AS period_start, strftime(ends, '%Y-%m-%d') AS period_end
FROM last_""")
def bill_extract(t: Tables):
    rows = extract.bills(accounts(t), invoices(t), month_windows(t), month_periods(t), roles.charge_lines(t))
    return rows.select(
        "service", "bill", "bill_period", "bill_year", "bill_month", "paid_at", "total",
        F.round("paid", 2).alias("paid"), "claimed", "pending", "due_on", F.round("own_amount", 2).alias("own_amount"),
        F.round("recovered_amount", 2).alias("recovered_amount"), "period", "period_start", "period_end")


@query("own_vs_recovered", f"""WITH {roles.BILLS}, {roles.LINES}
SELECT b.bill, round(sum(CASE WHEN coalesce(l.period, b.period) = b.period
         THEN CASE sign WHEN 'DB' THEN amount ELSE -amount END END), 2) AS own_amount,
       round(sum(CASE WHEN coalesce(l.period, b.period) <> b.period
         THEN CASE sign WHEN 'DB' THEN amount ELSE -amount END END), 2) AS recovered_amount
FROM lines l JOIN bills b ON b.bill = l.bill GROUP BY b.bill""")
def own_vs_recovered(t: Tables):
    bills = roles.bills(t).select("service", "bill", "bill_period", "period")
    return extract.own_and_recovered(roles.charge_lines(t), bills).select(
        "bill", F.round("own_amount", 2).alias("own_amount"), F.round("recovered_amount", 2).alias("recovered_amount"))


@query("open_balances", f"""WITH {roles.BILLS}
SELECT service, round(sum(CASE WHEN pending > 0 THEN pending END), 2) AS pending_balance,
       count(CASE WHEN pending > 0 AND due_at < DATE '2001-09-01' THEN 1 END) AS overdue_bills,
       round(sum(CASE WHEN pending > 0 AND due_at < DATE '2001-09-01' THEN pending END), 2) AS overdue_balance
FROM bills GROUP BY service""")
def open_balances(t: Tables):
    rows = extract.balances(roles.bills(t), roles.AS_OF_ORDERS)
    return rows.select("service", F.round("pending_balance", 2).alias("pending_balance"), "overdue_bills",
                       F.round("overdue_balance", 2).alias("overdue_balance"))


def code_names(t: Tables, known: dict):
    """A lookup table of the given names."""
    at = F.col("code").cast("int")
    return codes_below(t, len(known)).select(roles.pick(at, *known).alias("code"), roles.pick(at, *known.values()).alias("text"))


@query("charges_extract", f"""WITH {roles.LINES}, {MONTHS}
SELECT service, bill, bill_period, l.period, concept_code || '-CONCEPT ' || concept_code AS concept,
       CASE cause_code WHEN -1 THEN '-1' ELSE '74-LOSS' END AS cause, sign,
       strftime(w.starts, '%Y-%m') AS period_label, document,
       strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
       CASE program_code WHEN 5 THEN '5-REGULAR' WHEN 307 THEN '307-LOSS CONTROL' END AS program, tariff, units, amount,
       strftime(p.starts, '%Y-%m-%d') AS period_start, strftime(p.ends, '%Y-%m-%d') AS period_end,
       bill_period // 100 AS bill_year, bill_period % 100 AS bill_month
FROM lines l LEFT JOIN month_windows w ON w.period = l.period LEFT JOIN month_periods p ON p.period = l.period""")
def charges_extract(t: Tables):
    programs = {k: v for k, v in roles.CODE_NAMES["program"].items() if k > 0}
    windows = written(month_windows(t), "month_windows")
    return extract.charges(
        roles.charge_lines(t).drop("bill_period"), accounts(t), invoices(t), windows, month_periods(t, windows),
        code_names(t, roles.CODE_NAMES["concept"]),
        code_names(t, roles.CODE_NAMES["cause"]), code_names(t, programs))


@query("master_extract", f"""WITH {roles.BILLS}, balance AS (
  SELECT service, sum(CASE WHEN pending > 0 THEN pending END) AS p,
         count(CASE WHEN pending > 0 AND due_at < DATE '2001-09-01' THEN 1 END) AS n,
         sum(CASE WHEN pending > 0 AND due_at < DATE '2001-09-01' THEN pending END) AS o FROM bills GROUP BY service),
latest AS (SELECT o_custkey AS service, arg_max(CAST(o_orderkey % 3 AS DOUBLE), (o_orderdate, o_orderkey)) AS frequency
  FROM orders GROUP BY 1)
SELECT c_custkey AS service, c_nationkey AS contract, n_nationkey AS premises,
       CASE WHEN c_custkey % 3 < 2 THEN c_custkey % 3 || '-PRODUCT ' || c_custkey % 3 END AS product,
       '1995-01-01' AS installed_on, CASE WHEN c_custkey % 5 = 1 THEN '4732-12-31' WHEN c_custkey % 5 > 1 THEN '2001-08-20' END AS withdrawn_on,
       frequency, CASE WHEN c_custkey % 4 < 3 THEN c_custkey % 4 || '-CUTOFF ' || c_custkey % 4 END AS cutoff_state,
       c_custkey % 6 || '-CATEGORY ' || c_custkey % 6 AS category,
       CASE WHEN c_custkey % 6 < 5 AND c_custkey % 7 < 5 THEN c_custkey % 7 || '-' || c_custkey % 6 || '/' || c_custkey % 7 END AS subcategory,
       c_custkey % 4 AS cycle, CASE WHEN c_custkey % 9 < 8 THEN c_custkey % 9 || '-PLAN ' || c_custkey % 9 END AS plan,
       CASE WHEN c_custkey % 11 < 8 THEN c_custkey % 11 || '-PLAN ' || c_custkey % 11 END AS product_plan,
       c_name || ' ' || c_mktsegment AS customer, 'D' || c_custkey AS customer_document, n_name AS address, 'P' || n_nationkey AS page,
       r_name AS town, CASE WHEN c_custkey % 4 < 2 AND c_custkey % 3 < 2 THEN CASE c_custkey % 4 WHEN 0 THEN 'N' ELSE 'S' END END AS billable,
       CASE WHEN c_custkey % 4 < 2 AND c_custkey % 3 < 2
            THEN CASE c_custkey % 4 WHEN 0 THEN 'N-NO FACTURABLE' ELSE 'S-FACTURABLE' END END AS billable_text,
       round(p, 2) AS pending_balance, coalesce(n, 0) AS overdue_bills, round(o, 2) AS overdue_balance
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
LEFT JOIN balance b ON b.service = c_custkey LEFT JOIN latest l ON l.service = c_custkey""")
def master_extract(t: Tables):
    rows = extract.services(*master_parts(t), roles.AS_OF_ORDERS)
    return rows.withColumns({"pending_balance": F.round("pending_balance", 2),
                             "overdue_balance": F.round("overdue_balance", 2)})


def master_parts(t: Tables):
    """Subscriptions, premises, customers, frequencies, bills, the billable matrix and the names of codes."""
    key = F.col("c_custkey")
    subscriptions = t.customer.select(
        key.alias("service"), F.col("c_nationkey").alias("contract"), F.col("c_nationkey").alias("premises"),
        key.alias("customer_id"), (key % 3).alias("product_code"), (key % 4).alias("cutoff_code"),
        (key % 6).alias("category_code"), (key % 7).alias("subcategory_code"), (key % 4).alias("cycle"),
        (key % 9).alias("plan_code"), (key % 11).alias("product_plan_code"),
        F.lit("1995-01-01").cast("timestamp").alias("installed_at"),
        F.when(key % 5 == 1, "4732-12-31").when(key % 5 > 1, "2001-08-20").cast("timestamp").alias("withdrawn_at"))
    premises = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("premises"), F.col("r_name").alias("town"), F.col("n_name").alias("address"),
        F.concat(F.lit("P"), F.col("n_nationkey").cast("string")).alias("page"))
    customers = t.customer.select(key.alias("customer_id"), F.col("c_name").alias("first_name"),
                                  F.col("c_mktsegment").alias("last_name"),
                                  F.concat(F.lit("D"), key.cast("string")).alias("customer_document"))
    frequencies = t.orders.select(
        F.col("o_custkey").alias("service"), (F.col("o_orderkey") % 3).cast("double").alias("frequency"),
        F.col("o_orderdate").alias("recorded_at"), F.col("o_orderkey").alias("id"))
    matrix = codes_below(t, 4).select((F.col("code") % 2).alias("cutoff_code"), F.floor(F.col("code") / 2).alias("product_code")).withColumn(
        "billable", F.when(F.col("cutoff_code") == 0, "N").otherwise("S"))

    def named(word: str, n: int):
        return codes_below(t, n).withColumn("text", F.concat(F.lit(word + " "), F.col("code").cast("string")))

    pair = codes_below(t, 25).select(F.floor(F.col("code") / 5).alias("category_code"), (F.col("code") % 5).alias("code"))
    names = {"product": named("PRODUCT", 2), "cutoff": named("CUTOFF", 3), "category": named("CATEGORY", 6), "plan": named("PLAN", 8),
             "subcategory": pair.withColumn("text", F.concat_ws("/", F.col("category_code").cast("string"), F.col("code").cast("string")))}
    return subscriptions, premises, customers, frequencies, roles.bills(t), matrix, names


def order_states(t: Tables):
    """Orders with numbered states: open 5, part shipped 12 (cancelled), finished 8."""
    state = F.col("o_orderstatus")
    return t.orders.select(
        F.col("o_orderkey").alias("order"), F.col("o_custkey").alias("o_service"),
        F.when(state == "O", 5).when(state == "P", 12).otherwise(8).alias("state"),
        F.col("o_orderdate").alias("created_at"),
        F.when(state == "F", F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("closed_at"))


def order_activities(t: Tables):
    """Line items as activities of their order."""
    owner = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("service"))
    return activities_of(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus").join(joins.merged(owner), "l_orderkey"))


def activities_of(lines):
    """Activities of line items that carry the service of their order."""
    line = F.col("l_linenumber")
    activity = roles.pick(line - 1, DEFAULTS["review_activity"], DEFAULTS["decision_activity"], 993, 1019, 993, 0, 0)
    return lines.select(
        F.col("l_orderkey").alias("order"), activity.alias("activity"),
        F.when(line <= 4, 883).otherwise(roles.pick(line - 5, 769, 803, 1)).alias("task"),
        (F.col("l_orderkey") * 10 + line).alias("activity_ref"), F.col("l_orderkey").alias("request"),
        F.concat("l_returnflag", F.lit("/"), "l_linestatus").alias("order_comment"), "service", (F.col("service") % 25).alias("contract"))


def activity_names(t: Tables):
    return code_names(t, {993: "VARIATION", 102010: "REVIEW"})


def state_names(t: Tables):
    return code_names(t, {5: "OPEN", 8: "OTHER", 12: "OTHER"})


@query("open_order_extract", """SELECT l_orderkey AS "order", o_custkey AS service, o_orderdate AS created_at,
       CASE l_linenumber WHEN 1 THEN '102010 - REVIEW' WHEN 3 THEN '993 - VARIATION' WHEN 2 THEN ' - ' ELSE ' - ' END AS activity,
       '5 - OPEN' AS order_state, c_nationkey AS premises, o_custkey % 25 AS contract, l_returnflag || '/' || l_linestatus AS order_comment
FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey
WHERE l_linenumber <= 4 AND o_orderstatus = 'O'""")
def open_order_extract(t: Tables):
    subscriptions = t.customer.select(F.col("c_custkey").alias("service"), F.col("c_nationkey").alias("premises"))
    return extract.open_orders(order_states(t), order_activities(t), subscriptions, activity_names(t), state_names(t))


@query("requests_extract", f"""WITH {roles.EV}
SELECT service, event_id AS request, coalesce(c_name, '') || ' ' || coalesce(c_mktsegment, '') AS customer,
       kind || ' - ' || upper(event_type) AS request_kind, ts AS requested_at, k % 5 || ' - STATE' AS request_state,
       CASE WHEN k % 9 <> 0 THEN ts END AS attended_at, 'remark ' || k AS comment,
       CASE WHEN k % 7 < 4 THEN k % 7 || ' - CHANNEL' ELSE k % 7 || ' - ' END AS channel,
       CASE WHEN s_name IS NULL THEN service % 200 || ' - ' ELSE service % 200 || ' - ' || s_name END AS analyst,
       service % 30 || ' - ' || coalesce(n_name, '') AS area
FROM ev LEFT JOIN customer ON c_custkey = service * 20 LEFT JOIN supplier ON s_suppkey = service % 200
LEFT JOIN nation ON n_nationkey = service % 30
WHERE kind <> 8 AND k % 5 <> 4""")
def requests_extract(t: Tables):
    return extract.requests(*request_parts(t))


def request_parts(t: Tables):
    """Packages, motives, and the names of kinds, states, channels, people, areas and customers."""
    rows = roles.events(t)
    motives = rows.select("service", F.col("event_id").alias("request"))
    packages = rows.select(
        F.col("event_id").alias("request"), F.col("kind").alias("kind_code"), (F.col("k") % 5).alias("state_code"),
        F.col("ts").alias("requested_at"), F.when(F.col("k") % 9 != 0, F.col("ts")).alias("attended_at"),
        F.concat(F.lit("remark "), F.col("k").cast("string")).alias("comment"), (F.col("k") % 7).alias("channel_code"),
        (F.col("service") % 200).alias("person_code"), (F.col("service") % 30).alias("area_code"),
        (F.col("service") * 20).alias("customer_id"))
    states = codes_below(t, 4).withColumn("text", F.lit("STATE"))
    channels = codes_below(t, 4).withColumn("text", F.lit("CHANNEL"))
    people = t.supplier.select(F.col("s_suppkey").alias("code"), F.col("s_name").alias("text"))
    areas = t.nation.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("text"))
    customers = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("first_name"),
                                  F.col("c_mktsegment").alias("last_name"))
    return packages, motives, kind_names(t), states, channels, people, areas, customers


@query("loss_file_extract", """SELECT o_custkey AS service, o_orderkey AS loss_file, o_orderstatus AS state,
       CASE WHEN o_custkey % 7 < 5 THEN o_custkey % 7 || '-KIND' ELSE '-' END AS irregularity,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS recorded_at, strftime(o_orderdate, '%Y-%m-%d') AS fraud_start,
       strftime(o_orderdate + INTERVAL 10 DAY, '%Y-%m-%d') AS fraud_end,
       o_orderstatus || '-' || CASE o_orderstatus WHEN 'F' THEN 'FRAUDE CONFIRMADO' WHEN 'P' THEN 'PENDIENTE'
         ELSE 'DESCONOCIDO' END AS state_text, o_orderkey * 3 AS request, o_orderkey AS "order", o_orderpriority AS comment
FROM orders""")
def loss_file_extract(t: Tables):
    return extract.loss_files(loss_sources(t), irregularities(t))


def irregularities(t: Tables):
    return codes_below(t, 5).withColumn("text", F.lit("KIND"))


def loss_sources(t: Tables):
    key = F.col("o_custkey") % 7
    return t.orders.select(
        F.col("o_custkey").alias("service"), F.col("o_orderkey").alias("loss_file"), F.col("o_orderstatus").alias("state"),
        key.alias("irregularity_code"), (F.col("o_orderkey") * 3).alias("request"),
        F.col("o_orderdate").alias("recorded_at"), F.col("o_orderdate").alias("fraud_from"),
        (F.col("o_orderdate") + F.expr("INTERVAL 10 DAYS")).alias("fraud_to"), F.col("o_orderkey").alias("order"),
        F.col("o_orderpriority").alias("comment"))


# --- review orders and their comments --------------------------------------------------

REVIEW_DRIVERS = """drivers AS (
  SELECT DISTINCT o_custkey AS service, CASE WHEN l_suppkey % 2 = 0 THEN 3 ELSE 6 END AS kind,
         CASE WHEN month(o_orderdate) <> 12 THEN CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) END AS period,
         CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS window_start,
         CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) + INTERVAL 1 MONTH AS window_end
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderpriority = '1-URGENT')"""
REVIEW_FOUND = """act AS (
  SELECT l_orderkey AS "order", o_custkey AS service, l_orderkey AS request, l_orderkey * 10 + l_linenumber AS activity_ref,
         CASE l_linenumber WHEN 1 THEN 102010 WHEN 2 THEN 7400027 WHEN 4 THEN 1019 WHEN 6 THEN 0 WHEN 7 THEN 0 ELSE 993 END AS activity,
         CASE l_linenumber WHEN 5 THEN 769 WHEN 6 THEN 803 WHEN 7 THEN 1 ELSE 883 END AS task
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey), criticals AS (
  SELECT o_custkey AS service, CASE WHEN l_suppkey % 2 = 0 THEN 3 ELSE 6 END AS kind,
         CAST(year(l_shipdate) * 100 + month(l_shipdate) AS BIGINT) AS period, l_orderkey * 10 + l_linenumber AS activity_ref
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey), cases AS (
  SELECT o_custkey AS service, CASE WHEN l_suppkey % 2 = 0 THEN 3 ELSE 6 END AS kind,
         CAST(year(l_shipdate) * 100 + month(l_shipdate) AS BIGINT) AS period, l_orderkey AS request, l_shipdate AS recorded_at
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'A'), closed AS (
  SELECT l_orderkey AS "order", arg_max(s_name, (l_shipdate, s_name)) AS closed_by
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY 1), found AS (
  SELECT a."order", c.service, c.kind, c.period, a.task, a.activity FROM criticals c
  JOIN drivers d ON d.service = c.service AND d.kind = c.kind AND c.period = coalesce(d.period, c.period)
  JOIN act a ON a.activity_ref = c.activity_ref AND a.service = c.service AND a.activity = 102010
  UNION SELECT a."order", p.service, p.kind, p.period, a.task, a.activity FROM cases p
  JOIN drivers d ON d.service = p.service AND d.kind = p.kind AND p.period = coalesce(d.period, p.period)
  JOIN act a ON a.request = p.request AND a.service = p.service AND a.task IN (769, 803)
  UNION SELECT a."order", p.service, p.kind, p.period, a.task, a.activity FROM cases p
  JOIN drivers d ON d.service = p.service AND d.kind = p.kind AND p.recorded_at BETWEEN d.window_start AND d.window_end
  JOIN act a ON a.request = p.request AND a.service = p.service AND a.task IN (769, 803)
  UNION SELECT a."order", a.service, NULL, d.period, a.task, a.activity FROM act a JOIN orders ON o_orderkey = a."order"
  JOIN drivers d ON d.service = a.service AND o_orderdate BETWEEN d.window_start AND d.window_end
  WHERE a.activity = 7400027)"""
REVIEW = f"{REVIEW_DRIVERS}, {REVIEW_FOUND}"


def line_owner(t: Tables):
    return t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("service"),
                           "o_orderdate", "o_orderpriority")


def review_lines(t: Tables):
    """Line items with what their order tells, written once for all the roles they play in a review."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus").join(
        line_owner(t), "l_orderkey").withColumns({
            "kind": F.when(F.col("l_suppkey") % 2 == 0, 3).otherwise(6).cast("bigint"), "period": roles.month_id("l_shipdate")})
    return written(lines, "review_lines")


def review_parts(lines):
    month = F.date_trunc("month", "o_orderdate")
    drivers = lines.where(F.col("o_orderpriority") == "1-URGENT").select(
        "service", "kind", F.when(F.month("o_orderdate") != 12, roles.month_id("o_orderdate")).alias("period"),
        month.alias("window_start"), (month + F.expr("INTERVAL 1 MONTH")).alias("window_end"))
    criticals = lines.select("service", "kind", "period",
                             (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("activity_ref"))
    cases = lines.where(F.col("l_returnflag") == "A").select(
        "service", "kind", "period", F.col("l_orderkey").alias("request"), F.col("l_shipdate").alias("recorded_at"))
    return drivers, criticals, cases


def changes(lines):
    """State changes of orders: line items by their return flag and status."""
    return lines.select(
        F.col("l_orderkey").alias("order"), F.col("l_suppkey").alias("user"), F.col("l_shipdate").alias("changed_at"),
        F.when(F.col("l_returnflag") == "R", 5).alias("from_state"), F.when(F.col("l_linestatus") == "F", 8).alias("to_state"))


def users(t: Tables):
    return t.supplier.select(F.col("s_suppkey").alias("user"), F.col("s_suppkey").alias("user_id"))


def people(t: Tables):
    return t.supplier.select(F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("name"))


def closed_by(t: Tables, lines=None):
    return extract.closers(changes(t.lineitem if lines is None else lines), people(t), users(t))


def built_reviews(t: Tables, lines):
    drivers, criticals, cases = review_parts(lines)
    names = {"task": code_names(t, {883: "QUALITY", 769: "INSPECT"}), "activity": activity_names(t),
             "kind": kind_names(t), "state": state_names(t)}
    return extract.review_orders(drivers, criticals, cases, order_states(t), activities_of(lines), closed_by(t, lines),
                                 month_periods(t), names)


@query("review_union", f"""WITH {REVIEW}, {MONTHS}
SELECT f."order", f.service, f.kind, CASE kind WHEN 3 THEN '3-CLICK' WHEN 6 THEN '6-VIEW' END AS kind_text, f.period,
       CASE task WHEN 883 THEN '883-QUALITY' WHEN 769 THEN '769-INSPECT' END AS task,
       CASE activity WHEN 993 THEN '993-VARIATION' WHEN 102010 THEN '102010-REVIEW' END AS activity, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created_at,
       CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d %H:%M:%S') END AS closed_at,
       CASE o_orderstatus WHEN 'O' THEN '5-OPEN' WHEN 'P' THEN '12-OTHER' ELSE '8-OTHER' END AS order_state, closed_by,
       strftime(p.starts, '%Y-%m-%d') AS period_start, strftime(p.ends, '%Y-%m-%d') AS period_end
FROM found f JOIN orders ON o_orderkey = f."order" LEFT JOIN closed c ON c."order" = f."order"
LEFT JOIN month_periods p ON p.period = f.period""")
def review_union(t: Tables):
    return built_reviews(t, review_lines(t))


def comments(t: Tables):
    """Turns of the conversations as comments of the order with their number."""
    dated = t.orders.select(F.col("o_orderkey").alias("order"), "o_orderdate")
    return t.conversations.select(
        F.col("conv_id").alias("order"), "turn", F.when(F.col("role") == "user", 1).when(F.col("role") == "assistant", 2).otherwise(3).alias("kind_code"),
        F.col("text").alias("comment")).join(joins.merged(dated), "order").withColumn(
        "recorded_at", F.timestamp_add("DAY", F.col("turn").cast("int"), "o_orderdate"))


def comment_kinds(t: Tables):
    """Names of two kinds; a third has none."""
    return code_names(t, {1: "CUSTOMER", 2: "ANALYST"})


@query("comment_extract", f"""WITH {REVIEW}, spans AS (
  SELECT DISTINCT f."order", f.service, f.kind, f.period, o_orderdate AS opened_at,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY END AS ended_at
  FROM found f JOIN orders ON o_orderkey = f."order"), both_ AS (
  SELECT conv_id AS "order", (SELECT min(service) FROM act WHERE act."order" = conv_id) AS service, o_orderdate + turn * INTERVAL 1 DAY AS recorded_at,
         CASE role WHEN 'user' THEN 'CUSTOMER' WHEN 'assistant' THEN 'ANALYST' END AS comment_kind,
         regexp_replace(text, '[\\n\\r\\t|]', '', 'g') AS comment
  FROM conversations JOIN orders ON o_orderkey = conv_id WHERE conv_id IN (SELECT "order" FROM spans)
  UNION ALL SELECT DISTINCT s."order", s.service, l_shipdate, 'REVISION ANALISTA', l_returnflag || l_linestatus
  FROM spans s JOIN lineitem ON TRUE JOIN orders ON o_orderkey = l_orderkey AND o_custkey = s.service
  WHERE CASE WHEN l_suppkey % 2 = 0 THEN 3 ELSE 6 END = s.kind
    AND year(l_shipdate) * 100 + month(l_shipdate) = s.period
    AND l_shipdate BETWEEN s.opened_at AND coalesce(s.ended_at, TIMESTAMP '2001-09-01'))
SELECT "order", service, recorded_at, comment_kind, md5(comment) AS comment FROM both_""")
def comment_extract(t: Tables):
    lines = review_lines(t)
    reviews = built_reviews(t, lines).select("order", "service", "kind", "period").join(
        order_states(t).select("order", F.col("created_at").alias("opened_at"), F.col("closed_at").alias("ended_at")),
        "order")
    observations = lines.select(
        "service", "kind", "period", F.col("l_shipdate").alias("observed_at"),
        F.concat("l_returnflag", "l_linestatus").alias("comment"))
    rows = extract.order_comments(reviews, comments(t), observations, activities_of(lines), comment_kinds(t), datetime(2001, 9, 1))
    return rows.withColumn("comment", F.md5(F.col("comment").cast("binary")))


@query("population_periods", f"""WITH {SOURCES} SELECT service, kind, period, bill_period FROM periods""")
def population_periods(t: Tables):
    return cells(t).select("service", "kind", "period", "bill_period")


@query("period_dates", f"""WITH {MONTHS} SELECT period, strftime(starts, '%Y-%m-%d') AS starts,
       date_diff('day', starts, ends) AS days FROM month_periods""")
def period_dates(t: Tables):
    return month_periods(t).select("period", dates.day_text("starts").alias("starts"),
                                   dates.window_days("starts", "ends").alias("days"))

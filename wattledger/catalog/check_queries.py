"""Quality checks and the run log."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import functions as F

from ..checks import ledger, quality
from ..functions import codes, dates
from ..operators import joins, series
from ..plans import features as plan
from ..plans import history
from . import roles
from .feature_queries import CELLS, ENRICHED, built_features
from .histories import C_SQL, HISTORY, built_history
from .registry import Tables, query


def row_sql(check: str, obj: str, passed: str, expected: str, obtained: str, otherwise: str = "FALLA") -> str:
    return (f"SELECT '{check}' AS \"check\", '{obj}' AS object, CASE WHEN ({passed}) IS NULL THEN 'N/A' "
            f"WHEN {passed} THEN 'OK' ELSE '{otherwise}' END AS status, '{expected}' AS expected, "
            f"CAST({obtained} AS VARCHAR) AS obtained FROM m")


def both_sql(*parts: str) -> str:
    return " UNION ALL ".join(parts)


GRAIN_SQL = both_sql(
    row_sql("unique grain", "lineitem", "n = d", "repeated rows: 0", "n - d"),
    row_sql("key without NULL", "lineitem", "nulls = 0", "0", "nulls"))


@query("grain_check", f"""WITH m AS (SELECT count(*) AS n, count(DISTINCT (l_orderkey, l_linenumber)) AS d,
  count(CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 1 END) AS nulls FROM lineitem) {GRAIN_SQL}""")
def grain_check(t: Tables):
    return quality.grain(t.lineitem, "lineitem", ["l_orderkey", "l_linenumber"])


@query("history_grain_check", f"""WITH {HISTORY}, m AS (SELECT count(*) AS n,
  count(DISTINCT (service, period, kind, device)) AS d,
  count(CASE WHEN service IS NULL OR period IS NULL OR kind IS NULL OR device IS NULL THEN 1 END) AS nulls FROM history)
  {GRAIN_SQL.replace("'lineitem'", "'consumption_history'")}""")
def history_grain_check(t: Tables):
    return quality.grain(built_history(t), "consumption_history", ["service", "period", "kind", "device"])


@query("rows_per_value", "WITH m AS (SELECT count(*) AS n, count(DISTINCT l_suppkey) AS d FROM lineitem) "
       + row_sql("rows per value", "lineitem", "true", "for information", "round(n::DOUBLE / d, 2)"))
def rows_per_value(t: Tables):
    return quality.rows_per_value(t.lineitem, "lineitem", ["l_suppkey"])


def coverage_sql(column: str, floor: float) -> str:
    return (f"SELECT 'coverage of {column}' AS \"check\", 'readings' AS object, CASE WHEN n = 0 THEN 'N/A' "
            f"WHEN round(100.0 * {column} / n, 2) > {floor} THEN 'OK' WHEN {column} = 0 THEN 'FALLA' ELSE 'REVISAR' "
            f"END AS status, '> {floor}' AS expected, CAST(round(100.0 * {column} / n, 2) AS VARCHAR) AS obtained FROM m")


@query("coverage_check", f"""WITH {roles.READINGS}, m AS (SELECT count(*) AS n, count(device) AS device,
  count(factor) AS factor, count(high_limit) AS high_limit, count(note_1) AS note_1 FROM readings)
  {both_sql(*[coverage_sql(c, f) for c, f in (('device', 95), ('factor', 70), ('high_limit', 95), ('note_1', 95))])}""")
def coverage_check(t: Tables):
    return quality.coverage(roles.readings(t), "readings", {"device": 95, "factor": 70, "high_limit": 95, "note_1": 95})


@query("gap_cause_check", f"""WITH {roles.LINES}, dated AS (SELECT period, CASE WHEN period IS NOT NULL
  THEN created_at END AS starts FROM lines), m AS (SELECT count(CASE WHEN starts IS NULL THEN 1 END) AS v,
  count(CASE WHEN period IS NULL THEN 1 END) AS c,
  count(CASE WHEN starts IS NULL AND period IS NOT NULL THEN 1 END) AS u FROM dated)
  {both_sql(row_sql('starts missing', 'charges', 'true', 'for information', 'v'),
            row_sql('period missing', 'charges', 'true', 'for information', 'c'),
            row_sql('gaps explained', 'charges', 'u = 0', '0', 'u', 'REVISAR'))}""")
def gap_cause_check(t: Tables):
    lines = t.lineitem.withColumns(roles.line_columns())
    dated = lines.select("period", F.when(F.col("period").isNotNull(), F.col("l_shipdate")).alias("starts"))
    return quality.gap_cause(dated, "charges", "starts", "period")


@query("date_order_check", """WITH m AS (SELECT count(CASE WHEN o_orderdate > l_shipdate THEN 1 END) AS bad
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey) """
       + row_sql("o_orderdate <= l_shipdate", "lineitem", "bad = 0", "0", "bad", "REVISAR"))
def date_order_check(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_shipdate").join(
        t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    return quality.date_order(rows, "lineitem", "o_orderdate", "l_shipdate")


@query("domain_check", """WITH m AS (SELECT count(*) AS n, min(o_orderpriority) AS first FROM (
  SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))) """
       + row_sql("domain of o_orderpriority", "orders", "n = 0", "no other value", "n || '' '' || first", "REVISAR")
       .replace("'' ''", "' '"))
def domain_check(t: Tables):
    allowed = t.orders.where(F.split("o_orderpriority", "-")[0].cast("int") <= 3).select("o_orderpriority").distinct()
    return quality.domain(t.orders, "orders", "o_orderpriority", allowed)


@query("prefix_check", """WITH m AS (SELECT count(CASE WHEN NOT starts_with(
  o_orderpriority, CAST(CAST(regexp_extract(o_orderpriority, '^[0-9]+') AS INTEGER) AS VARCHAR)) THEN 1 END) AS bad
  FROM orders) """
       + row_sql("text starts with code", "orders", "bad = 0", "0", "bad"))
def prefix_check(t: Tables):
    rows = t.orders.select(codes.leading_code("o_orderpriority").alias("code"), F.col("o_orderpriority").alias("text"))
    return quality.code_prefix(rows, "orders", "code", "text")


@query("orphan_check", """WITH m AS (SELECT count(DISTINCT l_partkey) AS n FROM lineitem
  WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)) """
       + row_sql("l_partkey known", "lineitem", "n = 0", "0", "n"))
def orphan_check(t: Tables):
    master = t.part.where(F.col("p_size") > 10).select(F.col("p_partkey").alias("l_partkey"))
    return quality.orphans(t.lineitem, "lineitem", master, "l_partkey")


@query("fanout_check", """WITH m AS (SELECT (SELECT count(*) FROM orders) AS b, (SELECT count(*) FROM orders
  LEFT JOIN lineitem ON l_orderkey = o_orderkey) AS a) """
       + row_sql("join keeps rows", "orders", "a = b", "same count", "b || '' to '' || a").replace("'' to ''", "' to '"))
def fanout_check(t: Tables):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return quality.row_preservation(t.orders.select("o_orderkey"), lines, ["o_orderkey"], "orders")


@query("ambiguity_check", f"""WITH {HISTORY}, m AS (SELECT count(CASE WHEN n_ratings > 1 THEN 1 END) AS s,
  count(CASE WHEN n_ratings > 1 AND rating IS NOT NULL THEN 1 END) AS bad FROM history)
  {both_sql(row_sql('ambiguous rating is NULL', 'consumption_history', 'bad = 0', '0', 'bad'),
            row_sql('ambiguous rating', 'consumption_history', 'true', 'for information', 's'))}""")
def ambiguity_check(t: Tables):
    return quality.ambiguity(built_history(t), "consumption_history", "rating", "n_ratings")


@query("reconcile_rate", f"""WITH {HISTORY}, m AS (SELECT round(100.0 * count(CASE WHEN use_reconciles THEN 1 END) / count(*), 2) AS pct
  FROM history) {row_sql('use reconciles', 'consumption_history', 'pct >= 95', '>= 95', 'pct', 'REVISAR')}""")
def reconcile_rate(t: Tables):
    return quality.rate(built_history(t), "use reconciles", "consumption_history", "use_reconciles", 95)


CHARGE_FLAGS = ["is_loss", "is_recovery", "is_regular", "has_recovery_token", "period_differs"]


@query("flag_profile", f"""WITH {C_SQL}, m AS (SELECT count(*) AS n,
  {', '.join(f'count(CASE WHEN {f} THEN 1 END) AS t_{f}, count(CASE WHEN {f} IS NULL THEN 1 END) AS n_{f}' for f in CHARGE_FLAGS)}
  FROM charge_history)
  {both_sql(*[row_sql(f'flag {f}', 'charge_history', f'n_{f} = 0', 'no NULL', f"t_{f} || ' of ' || n", 'REVISAR') for f in CHARGE_FLAGS])}""")
def flag_profile(t: Tables):
    return quality.flag_profile(history.flagged_charges(roles.charges(t), roles.bills(t)), "charge_history", CHARGE_FLAGS)


@query("flag_parts_check", f"""WITH {C_SQL}, m AS (SELECT count(CASE WHEN is_recovery <> (has_recovery_token AND period_differs)
  THEN 1 END) AS bad FROM charge_history)
  {row_sql('is_recovery is the AND of its parts', 'charge_history', 'bad = 0', '0', 'bad')}""")
def flag_parts_check(t: Tables):
    return quality.composed(history.flagged_charges(roles.charges(t), roles.bills(t)), "charge_history", "is_recovery", ["has_recovery_token", "period_differs"])


SIGNALS = ["n_devices", "factor_min", "falling_streak", "mean_before", "reconnected_on"]


@query("signal_check", f"""WITH {ENRICHED}, m AS (SELECT {', '.join(f'count({c}) AS c_{c}' for c in SIGNALS)},
  count(CASE WHEN reconnected_inside THEN 1 END) AS t_r, 0 AS c_false_lap FROM rows_)
  {both_sql(row_sql('false_lap all NULL', 'features', 'c_false_lap = 0', '0', 'c_false_lap'),
            *[row_sql(f'{c} has values', 'features', f'c_{c} > 0', '> 0', f'c_{c}', 'REVISAR') for c in SIGNALS],
            row_sql('reconnected_inside is true somewhere', 'features', 't_r > 0', '> 0 or switched off', 't_r', 'REVISAR'))}""")
def signal_check(t: Tables):
    return quality.signals(built_features(t), "features", ["false_lap"], SIGNALS, ["reconnected_inside"])


@query("reconcile_measure", f"""WITH {roles.EV}, {roles.EVENT_CHARGES}, fresh AS (
  SELECT service, period, sum(units) AS f FROM event_charges WHERE concept_code IN (87, 90, 545, 546)
    AND period IS NOT NULL GROUP BY ALL), shown AS (
  SELECT e.service, e.period, max(c.s) AS s FROM ev e LEFT JOIN (SELECT service, period,
    sum(CASE WHEN concept_code IN (87, 90, 545, 546) THEN units END) AS s FROM event_charges GROUP BY ALL) c
    ON c.service = e.service AND c.period = e.period GROUP BY ALL), m AS (
  SELECT count(CASE WHEN abs(coalesce(f, 0) - coalesce(s, 0)) > 0.001 THEN 1 END) AS bad
  FROM fresh FULL JOIN shown USING (service, period))
  {row_sql('measured_units matches its source', 'features', 'bad = 0', '0', 'bad')}""")
def reconcile_measure(t: Tables):
    charges = history.flagged_charges(roles.event_charges(t), roles.event_bills(t))
    cells = roles.events(t).select("service", "period", "kind").distinct()
    shown = cells.join(plan.charges_by_period(charges), ["service", "period"], "left")
    source = charges.where(F.col("concept_code").isin(87, 90, 545, 546) & F.col("period").isNotNull()).select(
        "service", "period", F.col("units").alias("measured_units"))
    return quality.recompute(shown, source, ["service", "period"], "measured_units", "features")


@query("definition_moved", f"""WITH {roles.LINES}, m AS (SELECT sum(CASE WHEN cause_code = -1 THEN units END) AS o,
  sum(CASE WHEN concept_code IN (87, 90, 545, 546) THEN units END) AS n FROM lines)
  {row_sql('definition moved the total', 'charges', 'abs(o - n) > 0.001', 'totals differ',
           "CAST(round(o, 0) AS BIGINT) || ' to ' || CAST(round(n, 0) AS BIGINT)")}""")
def definition_moved(t: Tables):
    lines = t.lineitem.withColumns(roles.line_columns())
    return quality.definition_moved(lines, "charges", F.col("cause_code") == -1,
                                    F.col("concept_code").isin(87, 90, 545, 546), "l_quantity")


@query("iteration_duplicates", """WITH m AS (SELECT count(*) AS bad FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)) """
       + row_sql("repeated l_orderkey+l_linenumber", "decisions", "bad = 0", "0", "bad"))
def iteration_duplicates(t: Tables):
    return quality.repeated(t.lineitem, "decisions", ["l_orderkey", "l_linenumber"])


@query("expectation_mismatch", """SELECT code, billable, count(*) AS n_rows, expected FROM (
  SELECT c_custkey % 6 AS code, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 < 3 THEN 'S' ELSE 'N' END AS billable,
         CASE c_custkey % 6 WHEN 0 THEN 'S' WHEN 1 THEN 'S' WHEN 2 THEN 'N' WHEN 3 THEN 'N' END AS expected FROM customer)
WHERE billable <> expected GROUP BY ALL""")
def expectation_mismatch(t: Tables):
    key = F.col("c_custkey")
    found = t.customer.select((key % 6).alias("code"), F.when(key % 5 == 0, None).when(key % 5 < 3, "S").otherwise("N")
                              .alias("billable"))
    expected = found.select("code").distinct().where(F.col("code") < 4).withColumn(
        "billable", F.when(F.col("code") < 2, "S").otherwise("N"))
    return quality.expectation_mismatch(found, expected, "code", "billable")


@query("check_summary", f"""WITH part_checks AS (
  SELECT CASE WHEN count(*) = count(DISTINCT (l_orderkey, l_linenumber)) THEN 'OK' ELSE 'FALLA' END AS status FROM lineitem
  UNION ALL SELECT CASE WHEN count(CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 1 END) = 0
    THEN 'OK' ELSE 'FALLA' END FROM lineitem
  UNION ALL SELECT CASE WHEN count(*) = count(DISTINCT o_orderkey) THEN 'OK' ELSE 'FALLA' END FROM orders
  UNION ALL SELECT CASE WHEN count(CASE WHEN o_orderkey IS NULL THEN 1 END) = 0 THEN 'OK' ELSE 'FALLA' END FROM orders
  UNION ALL SELECT CASE WHEN count(CASE WHEN l_partkey NOT IN (SELECT p_partkey FROM part) THEN 1 END) = 0
    THEN 'OK' ELSE 'FALLA' END FROM lineitem)
SELECT status, count(*) AS n_checks FROM part_checks GROUP BY status""")
def check_summary(t: Tables):
    rows = [quality.grain(t.lineitem, "lineitem", ["l_orderkey", "l_linenumber"]),
            quality.grain(t.orders, "orders", ["o_orderkey"]),
            quality.orphans(t.lineitem, "lineitem", t.part.select(F.col("p_partkey").alias("l_partkey")), "l_partkey")]
    return quality.summary(reduce(lambda a, b: a.unionByName(b), rows))


# --- run log ----------------------------------------------------------------------------


@query("latest_status", f"""WITH {roles.LOG}
SELECT object, arg_max(status, (started_at, log_id)) AS status, max(started_at) AS started_at FROM log GROUP BY object""")
def latest_status(t: Tables):
    return ledger.latest_status(roles.run_log(t))


@query("last_run_status", f"""WITH {roles.LOG}, last_ AS (
  SELECT arg_max(run, (ended_at, log_id)) AS run FROM log WHERE ended_at IS NOT NULL)
SELECT status, count(*) AS n_rows FROM log WHERE run = (SELECT run FROM last_) GROUP BY status""")
def last_run_status(t: Tables):
    return ledger.status_counts(roles.run_log(t))


TOTALS = roles.LOG + """, totals AS (
  SELECT object, run, CAST(sum(written) AS BIGINT) AS written, max(ended_at) AS ended_at FROM log
  WHERE status = 'DONE' AND written IS NOT NULL GROUP BY object, run)"""


@query("volume_delta", f"""WITH {TOTALS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY object ORDER BY ended_at DESC, run DESC) AS rn FROM totals)
SELECT a.object, b.written AS before, a.written AS now, a.written - b.written AS delta,
       round((a.written - b.written) * 100.0 / nullif(abs(b.written), 0), 4) AS delta_pct,
       coalesce(abs((a.written - b.written) * 100.0 / nullif(abs(b.written), 0)) > 10, false) AS large
FROM ranked a JOIN ranked b ON a.object = b.object AND a.rn = 1 AND b.rn = 2""")
def volume_delta(t: Tables):
    return ledger.volume_delta(roles.run_log(t), done="DONE").withColumn("delta_pct", F.round("delta_pct", 4))


@query("run_over_run", f"""WITH {TOTALS}
SELECT object, run, written, written - lag(written) OVER (PARTITION BY object ORDER BY run) AS step FROM totals""")
def run_over_run(t: Tables):
    totals = ledger.run_totals(roles.run_log(t), done="DONE").select("object", "run", "written")
    return series.with_step(totals, "object", "run", "written")


@query("run_pivot", f"""WITH {TOTALS}
SELECT object, max(CASE WHEN run = '20240130' THEN written END) AS "20240130",
       max(CASE WHEN run = '20240129' THEN written END) AS "20240129",
       max(CASE WHEN run = '20240130' THEN written END) IS NOT DISTINCT FROM
       max(CASE WHEN run = '20240129' THEN written END) AS same FROM totals GROUP BY object""")
def run_pivot(t: Tables):
    return ledger.counts_by_run(roles.run_log(t), ["20240130", "20240129"], done="DONE")


@query("zero_row_success", f"""WITH {roles.LOG}
SELECT log_id, object, run, written FROM log WHERE status = 'DONE' AND written = 0""")
def zero_row_success(t: Tables):
    return ledger.zero_row_success(roles.run_log(t), done="DONE").select("log_id", "object", "run", "written")


@query("recent_failures", f"""WITH {roles.LOG}
SELECT log_id, object, started_at, message FROM log WHERE status = 'FAILED' AND started_at >= TIMESTAMP '2024-01-24'""")
def recent_failures(t: Tables):
    return ledger.recent_failures(roles.run_log(t), roles.LOG_AS_OF, failed="FAILED").select(
        "log_id", "object", "started_at", "message")


@query("laggards", f"""WITH {roles.LOG}, last_ AS (SELECT object, max(ended_at) AS last_write FROM log GROUP BY object)
SELECT object, last_write, date_diff('second', last_write, (SELECT max(last_write) FROM last_)) / 3600.0 > 6 AS late FROM last_""")
def laggards(t: Tables):
    return ledger.laggards(roles.run_log(t))


@query("writers", f"""WITH {roles.LOG}
SELECT object, count(DISTINCT writer) AS n_writers, CASE WHEN count(DISTINCT writer) = 1 THEN max(writer) END AS only_writer
FROM log GROUP BY object""")
def writers(t: Tables):
    return ledger.writers(roles.run_log(t))


@query("written_after", f"""WITH {roles.LOG}
SELECT object, max(ended_at) AS last_write FROM log WHERE object IN ('view', 'click') GROUP BY object
HAVING max(ended_at) >= TIMESTAMP '2024-01-15'""")
def written_after(t: Tables):
    return ledger.written_after(roles.run_log(t), datetime(2024, 1, 15), ["view", "click"])


@query("job_profile", f"""WITH {roles.LOG}
SELECT writer, count(*) AS n_rows, count(DISTINCT object) AS n_objects, min(started_at) AS first_start,
       max(ended_at) AS last_end FROM log GROUP BY writer""")
def job_profile(t: Tables):
    return ledger.job_profile(roles.run_log(t), "writer")


@query("missing_from_log", f"""WITH {roles.LOG}
SELECT object FROM (SELECT p_type AS object FROM part UNION SELECT event_type FROM events)
WHERE object NOT IN (SELECT object FROM log)""")
def missing_from_log(t: Tables):
    planned = t.part.select(F.col("p_type").alias("object")).union(t.events.select("event_type")).distinct()
    return ledger.missing_from_log(planned, roles.run_log(t))


@query("log_with_plan", f"""WITH {roles.LOG}, plan AS (
  SELECT object, min(log_id) AS load_id, object <> 'error' AS active FROM log GROUP BY object)
SELECT log_id, l.object, active FROM log l JOIN plan p ON p.object = l.object WHERE active""")
def log_with_plan(t: Tables):
    log = roles.run_log(t)
    plan_rows = log.groupBy("object").agg(F.min("log_id").alias("load_id")).withColumn("active", F.col("object") != "error")
    numbered = joins.lookup(log, plan_rows, {"object": "object"}, {"load_id": "load_id"})
    return (ledger.log_with_plan(numbered, plan_rows.select("load_id", "active")).where("active")
            .select("log_id", "object", "active"))


@query("plan_matches", f"""WITH {roles.LOG}, m AS (SELECT count(DISTINCT CASE WHEN object <> 'error' THEN object END) AS l,
  count(DISTINCT object) AS r FROM log)
  {row_sql('active loads', 'log', 'l = r', 'as planned', "l || '/' || r || '/' || l", 'REVISAR')}""")
def plan_matches(t: Tables):
    objects = roles.run_log(t).select("object").distinct()
    return ledger.plan_matches(objects.withColumn("active", F.col("object") != "error"), "active", objects, "log")


@query("run_freshness", f"""WITH {roles.LOG}
SELECT object, max(ended_at) AS last_write, CASE WHEN max(ended_at) >= TIMESTAMP '2024-01-31' - INTERVAL 36 HOUR
  THEN 'OK' ELSE 'REVISAR' END AS status FROM log GROUP BY object""")
def run_freshness(t: Tables):
    hours = F.timestamp_diff("SECOND", F.max("ended_at"), F.lit(roles.LOG_AS_OF)) / 3600
    return roles.run_log(t).groupBy("object").agg(
        F.max("ended_at").alias("last_write"),
        F.when(hours <= 36, quality.OK).otherwise(quality.LOOK).alias("status"))

"""Joins, last-N and set operations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators import groups, joins, series, sets
from ..plans import extract
from ..settings import DEFAULTS
from . import roles
from .registry import Tables, query

N = DEFAULTS["analysed_periods"]


@query("keyed_chain", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN (
  SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal < 0))""")
def keyed_chain(t: Tables):
    drivers = t.customer.where((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") < 0))
    orders = joins.keep_keys(t.orders, drivers.select(F.col("c_custkey").alias("o_custkey")), ["o_custkey"])
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return joins.keep_keys(lines, orders.select(F.col("o_orderkey").alias("l_orderkey")), ["l_orderkey"])


@query("sibling_entities", """SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (
  SELECT c_nationkey FROM customer WHERE c_custkey IN (
    SELECT o_custkey FROM orders WHERE o_totalprice > 499000))""")
def sibling_entities(t: Tables):
    drivers = t.orders.where(F.col("o_totalprice") > 499000).select(F.col("o_custkey").alias("c_custkey"))
    return joins.siblings(t.customer.select("c_custkey", "c_nationkey"), drivers, "c_custkey", "c_nationkey")


@query("status_closer", """SELECT l_orderkey AS "order", arg_max(s_name, (l_shipdate, s_name)) AS closed_by
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY l_orderkey""")
def status_closer(t: Tables):
    changes = t.lineitem.select(
        F.col("l_orderkey").alias("order"), F.col("l_suppkey").alias("user"), F.col("l_shipdate").alias("changed_at"),
        F.when(F.col("l_returnflag") == "R", extract.STATE_BEFORE_CLOSE).alias("from_state"),
        F.when(F.col("l_linestatus") == "F", extract.STATE_CLOSED).alias("to_state"))
    users = t.supplier.select(F.col("s_suppkey").alias("user"), (F.col("s_suppkey") + 1).alias("user_id"))
    people = t.supplier.select((F.col("s_suppkey") + 1).alias("user_id"), F.col("s_name").alias("name"))
    return extract.closers(changes, people, users)


@query("last_n_periods", f"""WITH {roles.EV}, ends AS (
  SELECT DISTINCT service, kind, period FROM ev)
SELECT service, kind, period FROM ends
QUALIFY dense_rank() OVER (PARTITION BY service ORDER BY period DESC) <= 8""")
def last_n_periods(t: Tables):
    rows = roles.events(t).select("service", "kind", "period").distinct()
    return series.last_distinct(rows, "service", "period", N).select("service", "kind", "period")


@query("last_n_bills", """SELECT o_custkey, o_orderkey, rank FROM (
  SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey
         ORDER BY o_orderdate DESC, o_orderkey DESC) AS INTEGER) AS rank FROM orders) WHERE rank <= 8""")
def last_n_bills(t: Tables):
    newest = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return series.last_rows(rows, ["o_custkey"], newest, N).drop("o_orderdate")


@query("latest_value", """SELECT user_id, arg_max(value, (ts, event_id)) AS value, max(ts) AS ts
FROM events GROUP BY user_id""")
def latest_value(t: Tables):
    return series.latest(t.events, ["user_id"], ["ts", "event_id"], ["value", "ts"])


WEEK = """DATE '2024-01-01' + CAST(7 * w AS INTEGER) AS starts, DATE '2024-01-01' + CAST(7 * w + 6 AS INTEGER) AS ends"""

# Periods of three days and billing windows of seven days, each in four cycles.
PERIODS = roles.EV + f""", use_periods AS (
  SELECT DISTINCT (service % 4) * 100 + period AS period, service % 4 AS cycle,
         DATE '2024-01-01' + CAST(period * 3 AS INTEGER) AS starts,
         DATE '2024-01-01' + CAST(period * 3 + 2 AS INTEGER) AS ends FROM ev), bill_windows AS (
  SELECT cycle * 1000 + w AS bill_period, cycle, CAST(2024 AS BIGINT) AS year, CAST(1 AS BIGINT) AS month,
         {WEEK} FROM (SELECT DISTINCT service % 4 AS cycle, date_diff('day', DATE '2024-01-01', day) // 7 AS w FROM ev))"""


def use_periods(t: Tables):
    return roles.events(t).select(
        (F.col("service") % 4).alias("cycle"), F.col("period").alias("p")).distinct().select(
        (F.col("cycle") * 100 + F.col("p")).alias("period"), "cycle",
        roles.day_after(F.col("p") * 3).alias("starts"), roles.day_after(F.col("p") * 3 + 2).alias("ends"))


def bill_windows(t: Tables):
    week = F.floor(F.datediff("day", F.lit(roles.FIRST_DAY)) / roles.WINDOW_DAYS)
    return roles.events(t).select((F.col("service") % 4).alias("cycle"), week.alias("w")).distinct().select(
        (F.col("cycle") * 1000 + F.col("w")).alias("bill_period"), "cycle",
        F.lit(2024).cast("bigint").alias("year"), F.lit(1).cast("bigint").alias("month"),
        roles.day_after(F.col("w") * 7).alias("starts"), roles.day_after(F.col("w") * 7 + 6).alias("ends"))


@query("period_range_join", f"""WITH {PERIODS}
SELECT p.period, p.cycle, b.bill_period, p.ends FROM use_periods p
JOIN bill_windows b ON b.cycle = p.cycle AND p.ends BETWEEN b.starts AND b.ends""")
def period_range_join(t: Tables):
    return extract.period_lookup(use_periods(t), bill_windows(t)).select("period", "cycle", "bill_period", "ends")


@query("event_in_window", f"""WITH {roles.EV}, {roles.REQUESTS}, cells AS (
  SELECT DISTINCT service, period, DATE '2024-01-01' + CAST(period * 3 AS INTEGER) AS starts,
         DATE '2024-01-01' + CAST(period * 3 + 2 AS INTEGER) AS ends FROM ev)
SELECT r.request, r.service, c.period FROM requests r
JOIN cells c ON c.service = r.service AND r.attended_on BETWEEN c.starts AND c.ends""")
def event_in_window(t: Tables):
    windows = roles.events(t).select(
        F.col("service").alias("owner"), "period").distinct().withColumns({
            "starts": roles.day_after(F.col("period") * 3), "ends": roles.day_after(F.col("period") * 3 + 2)})
    dated = roles.event_requests(t).withColumn("attended_on", F.to_date("attended_at"))
    return joins.inside(dated, windows, {"service": "owner"}, "attended_on", "starts", "ends").select(
        "request", "service", "period")


@query("open_range_join", """SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
JOIN orders ON o_orderkey = l_orderkey AND l_shipdate BETWEEN o_orderdate AND coalesce(
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY END, TIMESTAMP '2001-09-01')""")
def open_range_join(t: Tables):
    closed = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"))
    spans = t.orders.select("o_orderkey", F.col("o_orderdate").alias("opened_at"), closed.alias("closed_at"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    rows = joins.inside(lines, spans, {"l_orderkey": "o_orderkey"}, "l_shipdate", "opened_at", "closed_at",
                        open_end=F.lit(datetime(2001, 9, 1)))
    return rows.select("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("full_outer_keys", f"""WITH {roles.EV}, l AS (
  SELECT service, period, kind, sum(value) AS used FROM ev WHERE k % 4 <> 3 GROUP BY ALL), r AS (
  SELECT service, period, kind, count(*) AS losses FROM ev WHERE k % 4 = 3 GROUP BY ALL)
SELECT coalesce(l.service, r.service) AS service, coalesce(l.period, r.period) AS period,
       coalesce(l.kind, r.kind) AS kind, round(used, 4) AS used, losses
FROM l FULL JOIN r ON l.service = r.service AND l.period = r.period AND l.kind = r.kind""")
def full_outer_keys(t: Tables):
    keys = ["service", "period", "kind"]
    rows = roles.events(t)
    used = rows.where(F.col("k") % 4 != 3).groupBy(*keys).agg(F.round(F.sum("value"), 4).alias("used"))
    losses = rows.where(F.col("k") % 4 == 3).groupBy(*keys).agg(F.count(F.lit(1)).alias("losses"))
    return joins.both_sides(used, losses, keys)


@query("semi_exists", """SELECT c_custkey FROM customer WHERE EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O' AND o_totalprice > 450000)""")
def semi_exists(t: Tables):
    wanted = t.orders.where((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 450000))
    return joins.keep_keys(t.customer.select("c_custkey"),
                           wanted.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("orphans", """SELECT DISTINCT l_orderkey FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def orphans(t: Tables):
    known = t.orders.where(F.col("o_orderstatus") != "P").select(F.col("o_orderkey").alias("l_orderkey"))
    return joins.drop_keys(t.lineitem.select("l_orderkey").distinct(), known, ["l_orderkey"])


@query("left_lookup", """SELECT s_suppkey, n_name, r_name, customers FROM supplier
LEFT JOIN nation ON n_nationkey = s_nationkey AND n_regionkey <> 2
LEFT JOIN region ON r_regionkey = n_regionkey
LEFT JOIN (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1) c ON c.c_nationkey = s_nationkey""")
def left_lookup(t: Tables):
    nation = t.nation.where(F.col("n_regionkey") != 2)
    rows = joins.lookup(t.supplier, nation, {"s_nationkey": "n_nationkey"},
                        {"n_name": "n_name", "n_regionkey": "n_regionkey"})
    rows = joins.lookup(rows, t.region, {"n_regionkey": "r_regionkey"}, {"r_name": "r_name"})
    counts = t.customer.groupBy(F.col("c_nationkey").alias("s_nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    return rows.join(counts, "s_nationkey", "left").select("s_suppkey", "n_name", "r_name", "customers")


@query("large_lookup", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name FROM lineitem
LEFT JOIN part ON p_partkey = l_partkey AND p_size > 25""")
def large_lookup(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return joins.lookup(lines, t.part.where(F.col("p_size") > 25), {"l_partkey": "p_partkey"},
                        {"p_name": "p_name"})


@query("type_self_join", f"""WITH {roles.EV}, cells AS (
  SELECT service, period, kind, sum(value) AS used FROM ev WHERE kind IN (3, 6) GROUP BY ALL)
SELECT a.service, a.period, round(a.used, 4) AS active, round(b.used, 4) AS reactive FROM cells a
JOIN cells b ON b.service = a.service AND b.period = a.period AND a.kind = 3 AND b.kind = 6""")
def type_self_join(t: Tables):
    active, reactive = F.col("kind") == 3, F.col("kind") == 6
    rows = roles.events(t).groupBy("service", "period").agg(
        F.round(groups.sum_where(active, "value"), 4).alias("active"),
        F.round(groups.sum_where(reactive, "value"), 4).alias("reactive"))
    return rows.where(F.col("active").isNotNull() & F.col("reactive").isNotNull())


@query("key_overlap", """SELECT (SELECT count(DISTINCT user_id) FROM events WHERE value > 200) AS n_left,
  (SELECT count(DISTINCT user_id) FROM events WHERE event_type = 'signup' AND value < 2) AS n_right,
  (SELECT count(DISTINCT user_id) FROM events WHERE value > 200 AND user_id IN (
    SELECT user_id FROM events WHERE event_type = 'signup' AND value < 2)) AS n_both""")
def key_overlap(t: Tables):
    right = t.events.where((F.col("event_type") == "signup") & (F.col("value") < 2))
    return joins.overlap(t.events.where(F.col("value") > 200), right, "user_id")


@query("value_intersect", """SELECT CAST(o_custkey AS VARCHAR) AS value FROM orders
INTERSECT SELECT CAST(l_suppkey AS VARCHAR) FROM lineitem""")
def value_intersect(t: Tables):
    return sets.shared_values(t.orders, "o_custkey", t.lineitem, "l_suppkey")


@query("preferred_pick", """WITH candidate AS (
  SELECT user_id, 1 AS preference FROM events WHERE value > 100000 UNION ALL
  SELECT user_id, 2 FROM events WHERE value > 300 UNION ALL SELECT user_id, 3 FROM events)
SELECT min(user_id) AS user_id, preference FROM candidate
WHERE preference = (SELECT min(preference) FROM candidate) GROUP BY preference""")
def preferred_pick(t: Tables):
    return sets.first_available("user_id", t.events.where(F.col("value") > 100000),
                                t.events.where(F.col("value") > 300), t.events)


@query("union_distinct", f"""WITH {roles.EV}
SELECT service, period, kind FROM ev WHERE k % 4 <> 3 UNION SELECT service, period, kind FROM ev WHERE k > 50""")
def union_distinct(t: Tables):
    rows = roles.events(t)
    keys = ["service", "period", "kind"]
    return sets.union_distinct(rows.where(F.col("k") % 4 != 3).select(*keys),
                               rows.where(F.col("k") > 50).select(*keys))


@query("union_all_tagged", """SELECT branch, count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS chars FROM (
  SELECT 'turns' AS branch, text FROM conversations UNION ALL
  SELECT 'pages', html FROM pages UNION ALL SELECT 'items', text FROM benchmark) GROUP BY branch""")
def union_all_tagged(t: Tables):
    rows = sets.union_tagged("branch", turns=t.conversations.select("text"),
                             pages=t.pages.select(F.col("html").alias("text")),
                             items=t.benchmark.select("text"))
    return rows.groupBy("branch").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("text")).alias("chars"))


@query("dedupe_iterations", """SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem""")
def dedupe_iterations(t: Tables):
    return groups.distinct_rows(t.lineitem.select("l_orderkey", "l_returnflag", "l_linestatus"))


@query("distinct_facts", f"""WITH {roles.EV} SELECT DISTINCT service, kind, day, k % 3 AS device FROM ev""")
def distinct_facts(t: Tables):
    return groups.distinct_rows(roles.events(t).select("service", "kind", "day", (F.col("k") % 3).alias("device")))


@query("distinct_keys_partial_null", """SELECT 'all' AS needed, count(*) AS n_keys FROM (
  SELECT DISTINCT l_suppkey, CASE WHEN l_linenumber < 7 THEN l_linenumber END AS line FROM lineitem) WHERE line IS NOT NULL
UNION ALL SELECT 'first', count(*) FROM (
  SELECT DISTINCT l_suppkey, CASE WHEN l_linenumber < 7 THEN l_linenumber END AS line FROM lineitem)""")
def distinct_keys_partial_null(t: Tables):
    rows = t.lineitem.withColumn("line", F.when(F.col("l_linenumber") < 7, F.col("l_linenumber")))
    keys = ["l_suppkey", "line"]
    every = sets.union_tagged("needed", all=sets.distinct_keys(rows, keys),
                              first=sets.distinct_keys(rows, keys, ["l_suppkey"]))
    return every.groupBy("needed").agg(F.count(F.lit(1)).alias("n_keys"))


@query("array_difference", f"""WITH {roles.EV}, kinds AS (
  SELECT service, list(DISTINCT kind) AS all_kinds, coalesce(list(DISTINCT kind) FILTER (k < 50), []) AS low FROM ev
  GROUP BY service)
SELECT service, array_to_string(list_sort(list_filter(all_kinds, lambda x: NOT list_contains(low, x))), ',') AS only_high
FROM kinds""")
def array_difference(t: Tables):
    rows = roles.events(t).groupBy("service").agg(
        groups.sorted_set("kind").alias("all_kinds"),
        groups.sorted_set(F.when(F.col("k") < 50, F.col("kind"))).alias("low"))
    rest = F.sort_array(F.array_except("all_kinds", "low")).cast("array<string>")
    return rows.select("service", F.array_join(rest, ",").alias("only_high"))


@query("population_profile", """SELECT count(*) AS n_events, count(DISTINCT user_id) AS n_users,
       min(ts) AS first_at, max(ts) AS last_at FROM events WHERE event_type = 'error' AND user_id IN (
  SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 150)""")
def population_profile(t: Tables):
    population = t.events.where((F.col("event_type") == "purchase") & (F.col("value") > 150))
    mine = joins.keep_keys(t.events.where(F.col("event_type") == "error"), population, ["user_id"])
    return mine.agg(F.count(F.lit(1)).alias("n_events"), F.countDistinct("user_id").alias("n_users"),
                    F.min("ts").alias("first_at"), F.max("ts").alias("last_at"))


@query("window_split", f"""WITH {roles.EV}, windows AS (
  SELECT DISTINCT period FROM ev ORDER BY period DESC LIMIT 8)
SELECT count(*) AS n_events, count(CASE WHEN period IN (SELECT period FROM windows) THEN 1 END) AS n_inside,
       count(CASE WHEN period NOT IN (SELECT period FROM windows) THEN 1 END) AS n_outside,
       round(100.0 * count(CASE WHEN period NOT IN (SELECT period FROM windows) THEN 1 END) / count(*), 4) AS pct_outside
FROM ev WHERE kind = 9""")
def window_split(t: Tables):
    rows = roles.events(t)
    windows = (rows.select("period").distinct().orderBy(F.col("period").desc()).limit(N)
               .select("period", F.lit(True).alias("inside")))
    marked = rows.where(F.col("kind") == 9).join(windows, "period", "left")
    n = F.count(F.lit(1))
    inside = groups.count_where(F.col("inside"))
    return marked.agg(n.alias("n_events"), inside.alias("n_inside"), (n - inside).alias("n_outside"),
                      F.round((n - inside) * 100.0 / n, 4).alias("pct_outside"))

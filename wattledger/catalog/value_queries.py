"""Column helpers, filters and aggregates over whole tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions import amounts, codes, dates, flags, texts
from ..operators import groups, joins
from ..plans import extract
from ..settings import DEFAULTS
from . import roles
from .registry import Tables, query


@query("code_decorate", """SELECT c_custkey, n_nationkey || '-' || n_name AS nation,
       n_nationkey || ' - ' || n_name AS nation_spaced
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey % 5 <> 0""")
def code_decorate(t: Tables):
    names = t.nation.where(F.col("n_nationkey") % 5 != 0)
    rows = joins.lookup(t.customer, names, {"c_nationkey": "n_nationkey"}, {"n_name": "name"})
    known = F.when(F.col("name").isNotNull(), F.col("c_nationkey"))
    return rows.select("c_custkey", codes.code_text(known, "name").alias("nation"),
                       codes.code_text(known, "name", " - ").alias("nation_spaced"))


@query("oracle_concat", """SELECT doc_id, coalesce(CAST(quality AS VARCHAR), '') || '-' || lang AS tag
FROM documents LEFT JOIN labels USING (doc_id)""")
def oracle_concat(t: Tables):
    rows = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return rows.select("doc_id", codes.glue("quality", F.lit("-"), "lang").alias("tag"))


@query("code_parse", """SELECT o_orderkey, CAST(regexp_extract(o_orderpriority, '^\\s*(-?[0-9]+)', 1) AS INTEGER) AS priority,
       -CAST(regexp_extract(o_orderpriority, '^\\s*(-?[0-9]+)', 1) AS INTEGER) AS negative,
       TRY_CAST(nullif(regexp_extract(o_orderstatus, '^\\s*(-?[0-9]+)', 1), '') AS INTEGER) AS none,
       split_part(o_orderpriority, '-', 1) AS first, nullif(split_part(o_orderpriority, '-', 3), '') AS third,
       split_part(o_orderpriority, '-', 2) = 'URGENT' AS is_urgent
FROM orders""")
def code_parse(t: Tables):
    text = F.col("o_orderpriority")
    return t.orders.select(
        "o_orderkey", codes.leading_code(text).alias("priority"),
        codes.leading_code(F.concat(F.lit(" -"), text)).alias("negative"),
        codes.leading_code("o_orderstatus").alias("none"), codes.token(text, 0).alias("first"),
        codes.token(text, 2).alias("third"), codes.token_is(text, 1, "URGENT").alias("is_urgent"))


@query("bare_code", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_linenumber = 7 THEN '-1' ELSE l_linenumber || '-' || l_returnflag END AS cause,
       coalesce(CASE WHEN l_linenumber < 7 THEN l_tax END, 1.0) AS units
FROM lineitem""")
def bare_code(t: Tables):
    code = F.when(F.col("l_linenumber") == 7, -1).otherwise(F.col("l_linenumber"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             codes.bare_code(code, "l_returnflag").alias("cause"),
                             amounts.default(F.when(F.col("l_linenumber") < 7, F.col("l_tax")), 1.0)
                             .alias("units"))


@query("status_catalogue", """SELECT o_orderkey, o_orderstatus || '-' || CASE o_orderstatus
       WHEN 'F' THEN 'FRAUDE CONFIRMADO' WHEN 'P' THEN 'PENDIENTE' ELSE 'DESCONOCIDO' END AS state
FROM orders""")
def status_catalogue(t: Tables):
    text = codes.status_text("o_orderstatus", extract.LOSS_STATES, extract.LOSS_STATE_OTHER)
    return t.orders.select("o_orderkey", codes.glue("o_orderstatus", F.lit("-"), text).alias("state"))


@query("clean_text", """SELECT doc_id, md5(translate(text, chr(10) || chr(13) || chr(9) || '|', '')) AS digest,
       length(text) - length(translate(text, chr(10) || chr(13) || chr(9) || '|', '')) AS dropped FROM documents""")
def clean_text(t: Tables):
    clean = texts.clean("text")
    return t.documents.select("doc_id", F.md5(clean.cast("binary")).alias("digest"),
                              (F.length("text") - F.length(clean)).cast("bigint").alias("dropped"))


@query("date_parse", """SELECT event_id, CAST(ts AS DATE) AS from_time, CAST(ts AS DATE) AS from_day,
       CAST(NULL AS DATE) AS unreadable FROM events""")
def date_parse(t: Tables):
    return t.events.select("event_id", dates.text_to_date(dates.time_text("ts")).alias("from_time"),
                           dates.text_to_date(dates.day_text("ts")).alias("from_day"),
                           dates.text_to_date("event_type").alias("unreadable"))


@query("year_month", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS label,
       CASE WHEN month(o_orderdate) <> 2 THEN strftime(o_orderdate, '%Y-%m') END AS label_or_null
FROM orders""")
def year_month(t: Tables):
    month = F.month("o_orderdate")
    return t.orders.select("o_orderkey", dates.year_month(F.year("o_orderdate"), month).alias("label"),
                           dates.year_month(F.year("o_orderdate"), F.when(month != 2, month))
                           .alias("label_or_null"))


@query("days_between", """SELECT event_id, CAST(round((epoch_us(ts) // 1000000 - epoch_us(TIMESTAMP '2024-01-01')
       // 1000000) / 86400.0) AS BIGINT) AS days,
       CASE WHEN event_id % 3 <> 0 THEN date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) END AS whole_days
FROM events""")
def days_between(t: Tables):
    start = F.lit(date(2024, 1, 1))
    return t.events.select(
        "event_id", dates.days_rounded(start.cast("timestamp"), "ts").alias("days"),
        dates.window_days(start, F.when(F.col("event_id") % 3 != 0, F.to_date("ts"))).alias("whole_days"))


@query("zero_as_null", f"""WITH {roles.EV}
SELECT service, kind, nullif(CAST(count(CASE WHEN k % 4 = 3 THEN 1 END) AS VARCHAR), '0') AS losses
FROM ev GROUP BY service, kind""")
def zero_as_null(t: Tables):
    rows = roles.events(t).groupBy("service", "kind").agg(groups.count_where(F.col("k") % 4 == 3).alias("n"))
    return rows.select("service", "kind", amounts.zero_as_null("n").alias("losses"))


@query("optional_filter", """SELECT 'given' AS parameter, count(*) AS n_rows FROM lineitem
WHERE l_returnflag = 'R' UNION ALL SELECT 'missing', count(*) FROM lineitem WHERE l_returnflag IS NOT NULL""")
def optional_filter(t: Tables):
    both = t.lineitem.agg(
        groups.count_where(flags.matches("l_returnflag", "R")).alias("given"),
        groups.count_where(flags.matches("l_returnflag")).alias("missing"))
    return both.unpivot([], ["given", "missing"], "parameter", "n_rows")


@query("rolling_months", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ordered_on FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '2001-03-01'""")
def rolling_months(t: Tables):
    recent = dates.since_months("o_orderdate", roles.AS_OF_ORDERS, DEFAULTS["history_months"])
    return t.orders.where(recent).select("o_orderkey", F.to_date("o_orderdate").alias("ordered_on"))


@query("open_items", """SELECT o_orderkey FROM orders WHERE split_part(o_orderpriority, '-', 1) = '1'
AND o_orderstatus <> 'F' AND o_orderstatus <> 'P'""")
def open_items(t: Tables):
    closed_at = F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate"))
    return t.orders.where((codes.leading_code("o_orderpriority") == 1) & (F.col("o_orderstatus") != "F")
                          & closed_at.isNull()).select("o_orderkey")


@query("safe_ratio", """SELECT c_custkey, round(c_acctbal / nullif(abs(CAST(c_custkey % 4 - 1 AS DOUBLE)), 0), 4) AS ratio
FROM customer""")
def safe_ratio(t: Tables):
    bottom = (F.col("c_custkey") % 4 - 1).cast("double")
    return t.customer.select("c_custkey", F.round(amounts.ratio("c_acctbal", bottom), 4).alias("ratio"))


@query("prefix_filters", """SELECT p_partkey, p_name FROM part
WHERE starts_with(p_type, 'S') AND contains(p_name, 'red') AND regexp_matches(p_brand, '#1[0-9]$')""")
def prefix_filters(t: Tables):
    return t.part.where(texts.drawn_from("p_type", prefix="S") & texts.drawn_from("p_name", part="red")
                        & texts.drawn_from("p_brand", pattern="#1[0-9]$")).select("p_partkey", "p_name")


@query("extreme_values", """SELECT event_id, user_id, value FROM events WHERE value >= 300""")
def extreme_values(t: Tables):
    return t.events.where(F.col("value") >= 300).select("event_id", "user_id", "value")


@query("parameter_list", """SELECT l_linenumber AS line, count(*) AS n_rows, sum(l_quantity) AS units
FROM lineitem WHERE l_linenumber IN (1, 2, 3, 4) GROUP BY 1""")
def parameter_list(t: Tables):
    concept = roles.line_columns()["concept_code"]
    return (t.lineitem.where(concept.isin(DEFAULTS["measured_concepts"]))
            .groupBy(F.col("l_linenumber").alias("line"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("units")))


@query("null_sentinel", f"""WITH {roles.READINGS}
SELECT coalesce(device, '(sin medidor)') AS device, device IS NULL AS unknown, count(*) AS n_rows
FROM readings GROUP BY 1, 2""")
def null_sentinel(t: Tables):
    device, unknown = flags.or_unknown("device", "(sin medidor)")
    return (roles.readings(t).select(device.alias("device"), unknown.alias("unknown"))
            .groupBy("device", "unknown").agg(F.count(F.lit(1)).alias("n_rows")))


@query("unique_or_null", f"""WITH {roles.EV}, {roles.CONSUMPTION}
SELECT service, period, CASE WHEN count(DISTINCT rating) = 1 THEN max(rating) END AS rating,
       count(DISTINCT rating) AS n_ratings FROM consumption GROUP BY service, period""")
def unique_or_null(t: Tables):
    return roles.consumption(t).groupBy("service", "period").agg(
        groups.only_value("rating").alias("rating"), F.countDistinct("rating").alias("n_ratings"))


@query("sorted_sets", """SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kinds,
       count(DISTINCT event_type) AS n_kinds FROM events GROUP BY user_id""")
def sorted_sets(t: Tables):
    rows = t.events.groupBy("user_id").agg(groups.sorted_set("event_type").alias("kinds"))
    return rows.select("user_id", F.array_join("kinds", ",").alias("kinds"),
                       F.size("kinds").cast("bigint").alias("n_kinds"))


@query("bool_any", """SELECT l_orderkey, bool_or(l_returnflag = 'R') AS any_returned,
       bool_or(l_discount > 0.09) AS any_discount FROM lineitem GROUP BY l_orderkey""")
def bool_any(t: Tables):
    return t.lineitem.groupBy("l_orderkey").agg(
        groups.any_true(F.col("l_returnflag") == "R").alias("any_returned"),
        groups.any_true(F.col("l_discount") > 0.09).alias("any_discount"))


@query("conditional_sums", """SELECT l_suppkey, round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END), 2) AS returned,
       count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n_returned,
       round(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END), 2) AS open_units
FROM lineitem GROUP BY l_suppkey""")
def conditional_sums(t: Tables):
    returned = F.col("l_returnflag") == "R"
    rows = t.lineitem.groupBy("l_suppkey").agg(
        groups.sum_where(returned, "l_extendedprice").alias("returned"),
        groups.count_where(returned).alias("n_returned"),
        groups.sum_where(F.col("l_linestatus") == "O", "l_quantity").alias("open_units"))
    return rows.select("l_suppkey", F.round("returned", 2).alias("returned"), "n_returned",
                       F.round("open_units", 2).alias("open_units"))


@query("meter_period_sums", f"""WITH {roles.EV}
SELECT period, k % 3 AS device, kind, round(sum(value), 4) AS used FROM ev GROUP BY ALL""")
def meter_period_sums(t: Tables):
    return (roles.events(t).groupBy("period", (F.col("k") % 3).alias("device"), "kind")
            .agg(F.round(F.sum("value"), 4).alias("used")))


@query("period_lookup", """WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS starts FROM orders)
SELECT CAST(year(starts) AS BIGINT) AS year, min(CAST(year(starts) * 100 + month(starts) AS BIGINT)) AS period,
       min(starts) AS starts, min(last_day(starts)) AS ends FROM m GROUP BY ALL""")
def period_lookup(t: Tables):
    return extract.first_periods(roles.months(t.orders, "o_orderdate"), ["year"])


@query("group_size", """SELECT c_custkey, c_nationkey, count(*) OVER (PARTITION BY c_nationkey) AS group_size
FROM customer""")
def group_size(t: Tables):
    return groups.with_group_size(t.customer.select("c_custkey", "c_nationkey"), ["c_nationkey"], "group_size")


@query("grain_rows", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS grain_rows FROM lineitem""")
def grain_rows(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return groups.with_grain_rows(lines, ["l_orderkey", "l_linenumber"], "grain_rows")


@query("partition_totals", f"""WITH {roles.READINGS}
SELECT service, period, kind, device, round(billed_use, 4) AS billed_use,
       len(list_distinct(list(device) OVER w)) AS n_devices, round(sum(billed_use) OVER w, 4) AS cell_use,
       abs(coalesce(billed_use, 0) - coalesce(sum(billed_use) OVER w, 0)) <= 0.01 AS alone
FROM readings WINDOW w AS (PARTITION BY service, period, kind)""")
def partition_totals(t: Tables):
    keys = ["service", "period", "kind"]
    rows = roles.readings(t).select(*keys, "device", "billed_use")
    totals = rows.groupBy(*keys).agg(F.countDistinct("device").alias("n_devices"), F.sum("billed_use").alias("cell_use"))
    out = groups.attach_totals(rows, totals, keys)
    return out.select(*keys, "device", F.round("billed_use", 4).alias("billed_use"), "n_devices",
                      F.round("cell_use", 4).alias("cell_use"),
                      amounts.reconciles("billed_use", "cell_use", 0.01).alias("alone"))


@query("frequency_topk", """SELECT p_brand, count(*) AS n_rows FROM part GROUP BY p_brand
ORDER BY n_rows DESC, p_brand LIMIT 10""")
def frequency_topk(t: Tables):
    return groups.frequency_top(t.part, "p_brand", 10)


@query("topk_by_measure", """SELECT o_orderkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 20""")
def topk_by_measure(t: Tables):
    return groups.top_by(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", ["o_orderkey"], 20)


@query("having_distinct", """SELECT o_custkey, count(DISTINCT o_orderpriority) AS n_priorities FROM orders
GROUP BY o_custkey HAVING count(DISTINCT o_orderpriority) > 1""")
def having_distinct(t: Tables):
    return groups.several_values(t.orders, ["o_custkey"], "o_orderpriority", "n_priorities")


@query("group_size_avg", """SELECT count(*) AS n_groups, max(n) AS largest, round(avg(n), 4) AS average
FROM (SELECT count(*) AS n FROM customer GROUP BY c_nationkey)""")
def group_size_avg(t: Tables):
    return groups.average_group_size(t.customer, "c_nationkey").withColumn("average", F.round("average", 4))


@query("concept_inventory", f"""WITH {roles.LINES}
SELECT concept_code, count(*) AS n_lines, sum(units) AS units, round(sum(amount), 0) AS amount,
       concept_code IN (87, 90, 545, 546) AS measured, concept_code = 899 AS unlegalised
FROM lines GROUP BY concept_code""")
def concept_inventory(t: Tables):
    rows = t.lineitem.withColumns(roles.line_columns()).groupBy("concept_code").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("units"),
        F.round(F.sum("l_extendedprice"), 0).alias("amount"))
    return rows.withColumns({
        "measured": F.col("concept_code").isin(DEFAULTS["measured_concepts"]),
        "unlegalised": F.col("concept_code") == DEFAULTS["unlegalised_concept"]})


@query("external_charges", f"""WITH {roles.LINES}
SELECT program_code, concept_code, count(*) AS n_lines, round(sum(amount), 0) AS amount
FROM lines WHERE program_code < 0 GROUP BY ALL""")
def external_charges(t: Tables):
    program = F.concat(roles.line_columns()["program_code"].cast("string"), F.lit("-PROGRAM"))
    return (t.lineitem.withColumns(roles.line_columns()).where(texts.drawn_from(program, pattern="^-"))
            .groupBy("program_code", "concept_code").agg(
                F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_extendedprice"), 0).alias("amount")))


@query("cross_tab", """SELECT o_orderpriority, o_orderstatus, count(*) AS n_rows FROM orders GROUP BY ALL""")
def cross_tab(t: Tables):
    return groups.cross_tab(t.orders, ["o_orderpriority", "o_orderstatus"])


@query("schema_cast", """SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CAST(l_shipdate AS DATE) AS l_shipdate, CAST(l_quantity AS BIGINT) AS l_quantity,
       CAST(NULL AS DOUBLE) AS l_returnflag FROM lineitem""")
def schema_cast(t: Tables):
    from pyspark.sql.types import StructType

    from ..sources.contracts import cast_to
    wanted = StructType.fromDDL("l_orderkey string, l_linenumber bigint, l_shipdate date, "
                                "l_quantity bigint, l_returnflag double")
    return cast_to(t.lineitem, wanted)

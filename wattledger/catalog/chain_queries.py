"""The chain of extracts over customers: orders, line items and conversations in all source roles."""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checks import schemas
from ..operators import joins
from ..plans import chain, extract
from ..session import shared_folder, written
from ..sources import contracts, files
from . import extract_queries as ex
from . import roles
from .registry import Tables, query

AS_OF = datetime(2001, 9, 1)
TABLES = ("open_orders", "services", "readings", "consumption", "review_orders", "order_comments", "bills", "charges", "requests",
          "contract_consumption", "investigations", "loss_files")


def sold_lines(t: Tables) -> DataFrame:
    """Line items with the customer and the month of their order: all that the lines need in any of their roles."""
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag",
                              "l_linestatus", "l_shipdate")
    owner = ex.line_owner(t).select("l_orderkey", "service", roles.month_id("o_orderdate").alias("bill_period"))
    return lines.join(joins.merged(owner), "l_orderkey").withColumns({
        "kind": F.when(F.col("l_suppkey") % 2 == 0, 3).otherwise(6).cast("bigint"), "period": roles.month_id("l_shipdate")})


def sources(t: Tables) -> dict[str, DataFrame]:
    """The given tables in the roles of the source tables. Three customers with neighbouring numbers share a premises.

    Lines that know their order, and the few months there are, are written once for all their roles and steps.
    """
    lines, part = written(sold_lines(t), "sold_lines"), F.col("l_partkey")
    windows = written(ex.month_windows(t), "month_windows")
    periods = written(ex.month_periods(t, windows), "month_periods")
    premises = F.floor(F.col("c_custkey") / 3).cast("bigint")
    subscriptions, places, customers, frequencies, balances, billable, names = ex.master_parts(t)
    homes = t.customer.where(F.col("c_custkey") % 3 == 0).select(premises.alias("premises"), F.col("c_nationkey").alias("nation"))
    packages, motives, *_ = ex.request_parts(t)
    used = lines.select(
        "service", "period", F.col("period").alias("bill_period"), "kind", (part % 6).alias("device_id"),
        F.when(F.col("l_returnflag") == "R", extract.LOSS_METHOD).otherwise(4).alias("method"), F.col("l_quantity").alias("amount"),
        F.lit("P_USE").alias("calc_function"), F.when(part % 3 == 0, 5055).otherwise(1).alias("rating_code"), F.col("l_shipdate").alias("recorded_at"))
    read = lines.where(F.col("l_linestatus") == "F").groupBy("service", "period", "kind", (part % 9).alias("device_id")).agg(
        F.max("l_quantity").alias("current_reading"), F.min("l_quantity").alias("previous_reading"))
    read = read.select("*", F.lit("F").alias("status"), F.lit(1.0).alias("read_factor"), F.lit(0.0).alias("low_limit"), F.lit(40.0).alias("high_limit"),
                       (F.col("device_id") % 3).alias("note_code_1"), F.lit(None).cast("bigint").alias("note_code_2"),
                       F.lit(None).cast("bigint").alias("note_code_3"))
    cases = lines.where(F.col("l_returnflag") == "A")
    ref = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("activity_ref")
    return {
        "orders": ex.order_states(t), "activities": ex.activities_of(lines),
        "subscriptions": subscriptions.drop("premises").withColumn("premises", F.floor(F.col("service") / 3).cast("bigint")),
        "premises": homes.join(places.withColumnRenamed("premises", "nation"), "nation").drop("nation"), "customers": customers, "frequencies": frequencies,
        "balances": balances, "billable": billable, "use_lines": used, "reading_lines": read, "use_periods": periods,
        "bill_windows": windows, "devices": ex.devices(t),
        "routes": t.customer.select(F.col("c_custkey").alias("service"), (F.col("c_custkey") % 5).cast("int").alias("route_cycle")),
        "criticals": lines.select("service", "kind", "period", ref),
        "cases": cases.select("service", "kind", "period", F.col("l_orderkey").alias("request"), F.col("l_shipdate").alias("recorded_at")),
        "changes": ex.changes(t.lineitem), "people": ex.people(t), "users": ex.users(t), "comments": ex.comments(t),
        "observations": lines.select("service", "kind", "period", F.col("l_shipdate").alias("observed_at"),
                                     F.concat("l_returnflag", "l_linestatus").alias("comment")),
        "accounts": ex.accounts(t), "invoices": ex.invoices(t), "charge_lines": roles.as_charges(lines, "service", "bill_period"), "packages": packages, "motives": motives,
        "investigations": cases.select("service", "kind", "period", F.col("l_orderkey").alias("request"), (part % 4).alias("state"),
                                       F.col("l_shipdate").alias("recorded_at")),
        "loss_files": ex.loss_sources(t)}


def names(t: Tables) -> dict[str, DataFrame]:
    _, _, kinds, states, channels, people, areas, _ = ex.request_parts(t)
    programs = {k: v for k, v in roles.CODE_NAMES["program"].items() if k > 0}
    return ex.master_parts(t)[-1] | {
        "activity": ex.activity_names(t), "order_state": ex.state_names(t), "kind": ex.kind_names(t), "note": ex.note_names(t), "method": ex.method_names(t),
        "rating": ex.rating_names(t), "task": ex.code_names(t, {883: "QUALITY", 769: "INSPECT"}), "comment": ex.comment_kinds(t),
        "concept": ex.code_names(t, roles.CODE_NAMES["concept"]), "cause": ex.code_names(t, roles.CODE_NAMES["cause"]), "program": ex.code_names(t, programs),
        "request_kind": kinds, "request_state": states, "channel": channels, "person": people, "area": areas,
        "case_state": ex.case_states(t), "irregularity": ex.irregularities(t)}


def built_chain(t: Tables) -> chain.Landing:
    landing = chain.Landing(t.spark, f"{shared_folder(t.spark).rstrip('/')}/landing-{uuid.uuid4().hex[:12]}")
    chain.landing_chain(landing, sources(t), names(t), AS_OF)
    return landing


CHAIN = f"""{ex.MONTHS}, lines AS (
  SELECT l.*, o_custkey AS service, o_orderdate, CASE WHEN l_suppkey % 2 = 0 THEN 3 ELSE 6 END AS kind,
         CAST(year(l_shipdate) * 100 + month(l_shipdate) AS BIGINT) AS period FROM lineitem l JOIN orders ON o_orderkey = l_orderkey),
opened AS (SELECT o_custkey AS service, c_custkey // 3 AS premises FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey WHERE l_linenumber <= 4 AND o_orderstatus = 'O'),
master AS (SELECT c_custkey AS service, c_nationkey AS contract FROM customer WHERE c_custkey // 3 IN (SELECT premises FROM opened)
  AND c_custkey // 3 IN (SELECT c_custkey // 3 FROM customer WHERE c_custkey % 3 = 0)),
mine AS (SELECT * FROM lines WHERE service IN (SELECT service FROM master)),
billed AS (SELECT DISTINCT service, period, kind, l_partkey % 6 AS dev FROM mine WHERE l_returnflag <> 'R'),
measured AS (SELECT DISTINCT service, period, kind, l_partkey % 9 AS dev FROM mine WHERE l_linestatus = 'F'),
cells AS (SELECT service, period, kind FROM (
  SELECT *, dense_rank() OVER (PARTITION BY service ORDER BY period DESC) AS place
  FROM (SELECT service, period, kind FROM billed UNION SELECT service, period, kind FROM measured) JOIN (SELECT period FROM month_windows) USING (period))
  WHERE place <= 8),
drivers AS (SELECT service, kind, period, CAST(starts AS TIMESTAMP) AS window_start, CAST(ends AS TIMESTAMP) AS window_end
  FROM cells JOIN month_windows USING (period)),
{ex.REVIEW_FOUND},
spans AS (SELECT DISTINCT f."order", f.service, f.kind, f.period, o_orderdate AS opened_at,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY END AS ended_at FROM found f JOIN orders ON o_orderkey = f."order"),
noted AS (SELECT DISTINCT s."order", s.service, l_shipdate, l_returnflag || l_linestatus AS comment FROM spans s
  JOIN mine m ON m.service = s.service AND m.kind = s.kind AND m.period = s.period
  AND l_shipdate BETWEEN s.opened_at AND coalesce(s.ended_at, TIMESTAMP '2001-09-01')),
last_bills AS (SELECT bill FROM wanted w JOIN month_windows m ON m.period = w.bill_period WHERE service IN (SELECT service FROM master)
  QUALIFY row_number() OVER (PARTITION BY service ORDER BY m.ends DESC, bill DESC) <= 8),
counted AS (
  SELECT 'open_orders' AS object, count(*) AS n_rows FROM opened
  UNION ALL SELECT 'services', count(*) FROM master
  UNION ALL SELECT 'readings', count(*) FROM (SELECT * FROM billed UNION SELECT * FROM measured) JOIN cells USING (service, period, kind)
  UNION ALL SELECT 'consumption', count(*) FROM mine WHERE (service, period) IN (SELECT (service, period) FROM cells)
  UNION ALL SELECT 'review_orders', count(*) FROM found
  UNION ALL SELECT 'order_comments', (SELECT count(*) FROM conversations WHERE conv_id IN (SELECT "order" FROM found)) + (SELECT count(*) FROM noted)
  UNION ALL SELECT 'bills', count(*) FROM last_bills
  UNION ALL SELECT 'charges', count(*) FROM lineitem WHERE l_orderkey IN (SELECT bill FROM last_bills)
  UNION ALL SELECT 'requests', count(*) FROM ev WHERE kind <> 8 AND k % 5 <> 4 AND service IN (SELECT service FROM master)
  UNION ALL SELECT 'contract_consumption', count(*) FROM lines WHERE l_shipdate >= DATE '2001-03-01' AND service IN (
    SELECT service FROM master WHERE contract IN (SELECT contract FROM master WHERE service IN (SELECT service FROM opened)))
  UNION ALL SELECT 'investigations', count(*) FROM mine WHERE l_returnflag = 'A' AND l_shipdate >= DATE '2001-03-01'
  UNION ALL SELECT 'loss_files', count(*) FROM orders WHERE o_custkey IN (SELECT service FROM master))"""
CHAIN = f"{roles.EV}, {ex.WANTED_BILLS}, {CHAIN}"


@query("landing_chain", f"WITH {CHAIN} SELECT * FROM counted")
def landing_chain(t: Tables):
    """Rows of every landing table after one run of the chain from the open orders to charges and comments."""
    landing = built_chain(t)
    counts = [landing.get(n).agg(F.lit(n).alias("object"), F.count(F.lit(1)).alias("n_rows")) for n in TABLES]
    return reduce(DataFrame.unionByName, counts)


_COLUMNS = ", ".join(f"('{n}', {len(contracts.fields(n))})" for n in TABLES)


@query("comment_coverage", f"""WITH {CHAIN}, declared(object, n_columns) AS (VALUES {_COLUMNS})
SELECT object, CAST(n_columns AS BIGINT) AS n_columns, CAST(n_columns AS BIGINT) AS n_commented, 'OK' AS status, n_rows FROM declared JOIN counted USING (object)""")
def comment_coverage(t: Tables):
    """All landing tables of a run as tables of the catalog, their comments read back from it, and their rows."""
    landing, mark = built_chain(t), uuid.uuid4().hex[:12]
    counts = []
    for n in TABLES:
        files.register_table(t.spark, f"{n}_{mark}", landing.path(n), contracts.stored_schema(n, commented=True), n.replace("_", " "))
        counts.append(t.spark.table(f"{n}_{mark}").agg(F.lit(n).alias("object"), F.count(F.lit(1)).alias("n_rows")))
    found = schemas.catalog_columns(t.spark, [f"{n}_{mark}" for n in TABLES]).withColumn("object", F.replace("object", F.lit(f"_{mark}"), F.lit("")))
    return schemas.comment_coverage(found).join(reduce(DataFrame.unionByName, counts), "object")

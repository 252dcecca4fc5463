"""Changes to managed tables, snapshots, files and published tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import upkeep
from ..session import shared_folder
from ..sources import contracts, files
from . import roles
from .feature_queries import ENRICHED, built_features
from .histories import HISTORY, built_history
from .registry import Tables, query

# The control table of these queries: one row per part, the seed holds the large parts.
CONTROL = """control AS (
  SELECT p_partkey AS key, p_name AS name, p_type AS load_type, p_size AS position, p_brand AS note
  FROM part WHERE p_partkey % 3 <> 0), seed AS (
  SELECT p_partkey AS key, upper(p_name) AS name, 'SEEDED' AS load_type, p_size + 100 AS position,
         'from seed' AS note FROM part WHERE p_size > 40)"""


def control(t: Tables):
    return t.part.where(F.col("p_partkey") % 3 != 0).select(
        F.col("p_partkey").alias("key"), F.col("p_name").alias("name"), F.col("p_type").alias("load_type"),
        F.col("p_size").alias("position"), F.col("p_brand").alias("note"))


def seed(t: Tables):
    return t.part.where(F.col("p_size") > 40).select(
        F.col("p_partkey").alias("key"), F.upper("p_name").alias("name"), F.lit("SEEDED").alias("load_type"),
        (F.col("p_size") + 100).alias("position"), F.lit("from seed").alias("note"))


@query("upsert_managed", f"""WITH {CONTROL}
SELECT coalesce(c.key, s.key) AS key, CASE WHEN s.key IS NOT NULL THEN s.name ELSE c.name END AS name,
       CASE WHEN s.key IS NOT NULL THEN s.load_type ELSE c.load_type END AS load_type,
       CASE WHEN s.key IS NOT NULL THEN s.position ELSE c.position END AS position,
       CASE WHEN c.key IS NULL THEN s.note ELSE c.note END AS note
FROM control c FULL JOIN seed s ON s.key = c.key""")
def upsert_managed(t: Tables):
    return upkeep.upsert(control(t), seed(t), ["key"], ["name", "load_type", "position"])


@query("insert_if_missing", f"""WITH {CONTROL}
SELECT * FROM control UNION ALL SELECT * FROM seed WHERE key NOT IN (SELECT key FROM control)""")
def insert_if_missing(t: Tables):
    return upkeep.add_missing(control(t), seed(t), ["key"])


@query("guarded_update", f"""WITH {CONTROL}
SELECT key, name, CASE WHEN load_type = 'SMALL' AND key % 2 = 0 THEN 'TINY' ELSE load_type END AS load_type FROM control""")
def guarded_update(t: Tables):
    rows = control(t).select("key", "name", "load_type")
    return upkeep.replace_value(rows, F.col("key") % 2 == 0, "load_type", "SMALL", "TINY")


@query("retire_rows", f"""WITH {CONTROL}
SELECT key, CASE WHEN load_type IN ('SMALL', 'LARGE') AND position > 10 THEN false ELSE position > 10 END AS active,
       CASE WHEN load_type IN ('SMALL', 'LARGE') AND position > 10 THEN 'retired' ELSE note END AS note FROM control""")
def retire_rows(t: Tables):
    rows = control(t).withColumn("active", F.col("position") > 10)
    return upkeep.retire(rows, "load_type", ["SMALL", "LARGE"], "active", note="retired").select("key", "active", "note")


@query("resolve_parent", """SELECT p_partkey AS key, 'load ' || p_partkey AS name,
       CASE WHEN p_partkey % 4 = 1 THEN CASE WHEN p_partkey % 8 = 1 THEN p_partkey - 1 END ELSE -1 END AS parent FROM part""")
def resolve_parent(t: Tables):
    key = F.col("p_partkey")
    table = t.part.select(key.alias("key"), F.concat(F.lit("load "), key.cast("string")).alias("name"),
                          F.lit(-1).cast("bigint").alias("parent"))
    linked = t.part.where(key % 4 == 1)
    wanted = F.when(key % 8 == 1, F.concat(F.lit("load "), (key - 1).cast("string"))).otherwise("unknown")
    links = linked.select(F.concat(F.lit("load "), key.cast("string")).alias("child"), wanted.alias("parent_name"))
    return upkeep.resolve_parent(table, links, "name", "key", "parent")


@query("evolve_columns", f"""WITH {CONTROL}
SELECT key, name, CAST(NULL AS BIGINT) AS bill_year, CAST(NULL AS VARCHAR) AS remark FROM control""")
def evolve_columns(t: Tables):
    rows = control(t).select("key", "name")
    return upkeep.evolve(rows, {"name": "string", "bill_year": "bigint", "remark": "string"})


@query("snapshot_compare", f"""WITH {roles.EV}
SELECT day AS run, round(sum(value), 4) AS total, count(*) AS n_rows FROM ev GROUP BY day""")
def snapshot_compare(t: Tables):
    runs = roles.events(t).select(F.col("day").alias("run"), "value")
    return upkeep.snapshot_totals(runs, "run", "value").withColumn("total", F.round("total", 4))


@query("pass_through", """SELECT doc_id, quality, toxic FROM labels""")
def pass_through(t: Tables):
    return t.labels.select("doc_id", "quality", "toxic")


@query("landing_roundtrip", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""")
def landing_roundtrip(t: Tables):
    """Writes a landing file with mixed-case names and a helper column, and reads it back."""
    path = f"{shared_folder(t.spark)}/landing_roundtrip-{t.spark.sparkContext.applicationId}"
    out = t.orders.select(F.col("o_orderkey").alias("O_ORDERKEY"), F.col("o_custkey").alias("O_CUSTKEY"),
                          "o_orderstatus", "o_totalprice", F.lit(1).alias("ITERATION"))
    files.write_landing(out, path)
    return files.read_landing(t.spark, path)


#: Hours a table may lie behind the newest data of all tables.
LAG_HOURS = 24 * 90


@query("freshness_guard", f"""WITH n AS (
  SELECT 'orders' AS object, max(CAST(o_orderdate AS TIMESTAMP)) AS newest FROM orders UNION ALL
  SELECT 'lineitem', max(CAST(l_shipdate AS TIMESTAMP)) FROM lineitem UNION ALL SELECT 'events', max(CAST(ts AS TIMESTAMP)) FROM events)
SELECT object, newest, round(date_diff('microsecond', newest, (SELECT max(newest) FROM n)) / 3.6e9, 4) AS hours,
       coalesce(date_diff('microsecond', newest, (SELECT max(newest) FROM n)) / 3.6e9 > {LAG_HOURS}, true) AS stale,
       newest <= CAST(now() AS TIMESTAMP) AS written_after FROM n""")
def freshness_guard(t: Tables):
    """Each table against the newest data of all: the older ones lag years behind; and its files against its own data."""
    tables = {"orders": (t.orders, "o_orderdate"), "lineitem": (t.lineitem, "l_shipdate"), "events": (t.events, "ts")}
    newest = reduce(DataFrame.unionByName, [df.agg(F.max(at).cast("timestamp").alias("newest")) for df, at in tables.values()])
    rows = files.freshness(tables, newest.agg(F.max("newest")).scalar(), LAG_HOURS)
    return rows.select("object", "newest", F.round("hours", 4).alias("hours"), "stale", "written_after")


def shown(table: str) -> list[tuple[str, str, bool]]:
    """(own name, stored name, is a double) of the columns compared: no arrays, no load mark."""
    return [(own, stored, kind == "double") for own, stored, kind in contracts.fields(table)
            if not kind.startswith("array") and own not in ("run_id", "loaded_at")]


def shown_columns(table: str):
    return [F.round(stored, 4).alias(stored) if real else F.col(stored) for _, stored, real in shown(table)]


def shown_sql(table: str) -> str:
    return ", ".join(f"round({own}, 4) AS {stored}" if real else f"{own} AS {stored}"
                     for own, stored, real in shown(table))


@query("published_history", f"""WITH {HISTORY} SELECT {shown_sql('consumption_history')} FROM history""")
def published_history(t: Tables):
    stored = contracts.publish(built_history(t), "consumption_history", "run-1", roles.LOG_AS_OF)
    return stored.select(shown_columns("consumption_history"))


@query("published_features", f"""WITH {ENRICHED}, shown AS (
  SELECT *, date_diff('day', reconnected_on, period_end) AS days_since_reconnection,
         (period_use - mean_before) / nullif(abs(mean_before), 0) AS mean_deviation,
         period_use >= high_limit AND high_limit > 0 AS exceeds_now, CAST(NULL AS BOOLEAN) AS false_lap FROM rows_)
SELECT {shown_sql('features')} FROM shown""")
def published_features(t: Tables):
    stored = contracts.publish(built_features(t), "features", "run-1", roles.LOG_AS_OF)
    return stored.select(shown_columns("features"))

"""Stored tables: managed versions, overwrites of partitions, the log of a load, comments, contracts and snapshots.

Tables and folders get a name of their own in each call, below the shared folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..checks import ledger, quality, schemas
from ..operators import upkeep
from ..session import shared_folder
from ..sources import files, managed
from . import roles
from .registry import Tables, query
from .upkeep_queries import CONTROL, control, seed


def fresh_name(t: Tables, name: str) -> tuple[str, str]:
    """(table name, folder) nobody uses yet."""
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    return table, f"{shared_folder(t.spark).rstrip('/')}/{table}"


# --- managed tables ----------------------------------------------------------------------


def managed_control(t: Tables, *more) -> str:
    table, folder = fresh_name(t, "control")
    managed.create(control(t).withColumns(dict(more)), table, folder)
    return table


@query("upsert_stored", f"""WITH {CONTROL}
SELECT coalesce(c.key, s.key) AS key, CASE WHEN s.key IS NOT NULL THEN s.name ELSE c.name END AS name,
       CASE WHEN s.key IS NOT NULL THEN s.load_type ELSE c.load_type END AS load_type,
       CASE WHEN s.key IS NOT NULL THEN s.position ELSE c.position END AS position,
       CASE WHEN c.key IS NULL THEN s.note ELSE c.note END AS note
FROM control c FULL JOIN seed s ON s.key = c.key""")
def upsert_stored(t: Tables):
    """The seed goes in twice; the table is read after the second switch."""
    table = managed_control(t)
    for _ in range(2):
        managed.upsert(t.spark, table, seed(t), ["key"], ["name", "load_type", "position"])
    return t.spark.table(table)


@query("insert_stored", f"""WITH {CONTROL}
SELECT * FROM control UNION ALL SELECT * FROM seed WHERE key NOT IN (SELECT key FROM control)""")
def insert_stored(t: Tables):
    table = managed_control(t)
    for _ in range(2):
        managed.add_missing(t.spark, table, seed(t), ["key"])
    return t.spark.table(table)


@query("guarded_update_stored", f"""WITH {CONTROL}
SELECT * REPLACE (CASE WHEN load_type LIKE 'SMALL%' AND load_type = (SELECT min(load_type) FROM control WHERE load_type LIKE 'SMALL%')
                       AND key % 2 = 0 THEN 'TINY' ELSE load_type END AS load_type) FROM control""")
def guarded_update_stored(t: Tables):
    """Only rows that still hold the old value change, so a second time finds none."""
    table = managed_control(t)
    old = control(t).where(F.col("load_type").startswith("SMALL")).agg(F.min("load_type")).first()[0]
    for _ in range(2):
        managed.replace_value(t.spark, table, ["key"], F.col("key") % 2 == 0, "load_type", old, "TINY")
    return t.spark.table(table)


@query("retire_stored", f"""WITH {CONTROL}, old AS (SELECT min(load_type) AS load_type FROM control)
SELECT key, control.load_type, position > 10 AS was_active, position > 10 AND control.load_type <> old.load_type AS active,
       CASE WHEN position > 10 AND control.load_type = old.load_type THEN 'retired' ELSE note END AS note FROM control, old""")
def retire_stored(t: Tables):
    """Rows switched off, beside what the version before says of them."""
    table = managed_control(t, ("active", F.col("position") > 10))
    old = t.spark.table(table).agg(F.min("load_type")).first()[0]
    managed.retire(t.spark, table, ["key"], "load_type", [old], "active", note="retired")
    before = managed.read(t.spark, table, 1).select("key", F.col("active").alias("was_active"))
    return t.spark.table(table).join(before, "key").select("key", "load_type", "was_active", "active", "note")


# --- overwrites --------------------------------------------------------------------------


def yearly(t: Tables) -> str:
    """A stored table of bills, a partition for each year."""
    table, folder = fresh_name(t, "bills")
    files.replace_table(roles.bills(t).select("bill", "service", "total", "bill_year"), table, path=folder, partitions=("bill_year",))
    return table


def new_run(t: Tables):
    """What a later run delivers: the bills of the newest year only, with corrected totals."""
    rows = roles.bills(t).select("bill", "service", (-F.col("total")).alias("total"), "bill_year")
    return rows.where(F.col("bill_year") == rows.agg(F.max("bill_year")).scalar())


OVERWRITTEN = f"""WITH {roles.BILLS}
SELECT bill, service, CASE WHEN bill_year = (SELECT max(bill_year) FROM bills) THEN -total ELSE total END AS total, bill_year FROM bills"""


@query("overwrite_by_position", OVERWRITTEN)
def overwrite_by_position(t: Tables):
    """A run replaces its own partition of a stored table."""
    table = yearly(t)
    files.overwrite_by_position(new_run(t), table)
    return t.spark.table(table)


@query("overwrite_by_name", OVERWRITTEN)
def overwrite_by_name(t: Tables):
    """The same with columns in another order."""
    table = yearly(t)
    files.overwrite_by_name(new_run(t).select("bill_year", "total", "service", "bill"), table)
    return t.spark.table(table)


# --- loads and their log -----------------------------------------------------------------


@query("run_log_append", """SELECT 'orders' AS object, 'a-1' AS attempt, 'EXITOSO' AS status, count(*) AS read,
       count(*) FILTER (WHERE o_orderstatus = 'O') AS written FROM orders
UNION ALL SELECT 'lineitem', 'a-2', 'EXITOSO', count(*), count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
UNION ALL SELECT 'part', 'a-3', 'FALLIDO', NULL, NULL""")
def run_log_append(t: Tables):
    """Three loads with their counts from the write itself; the first was reported before under the same attempt."""
    _, log = fresh_name(t, "log")

    def load(name: str, attempt: str, make):
        source = getattr(t, name)
        ledger.logged_load(source, make, lambda rows: files.write_landing(rows, fresh_name(t, name)[1]), log, attempt, object=name, run="r-1")

    load("orders", "a-1", lambda rows: rows.where("o_orderstatus = 'F'"))
    load("orders", "a-1", lambda rows: rows.where("o_orderstatus = 'O'"))
    load("lineitem", "a-2", lambda rows: rows.select("l_orderkey", "l_linenumber").distinct())
    try:
        load("part", "a-3", lambda rows: rows.select())
    except ValueError:
        pass
    return ledger.read_log(t.spark, log).select("object", "attempt", "status", "read", "written")


@query("empty_load_guard", """WITH n AS (SELECT count(*) AS all_, count(*) FILTER (WHERE o_orderstatus = 'F') AS f,
       count(*) FILTER (WHERE o_orderstatus = '?') AS none FROM orders)
SELECT 'filled' AS object, 'EXITOSO' AS status, f AS written, f AS n_rows FROM n
UNION ALL SELECT 'empty', 'FALLIDO', none, all_ FROM n UNION ALL SELECT 'allowed', 'EXITOSO', none, none FROM n""")
def empty_load_guard(t: Tables):
    """An empty load is refused by the counts of its own write, and readers keep the rows they had."""
    _, log = fresh_name(t, "log")
    source = t.orders.select("o_orderkey", "o_orderstatus")
    rows = None
    for name, state, allowed in (("filled", "F", False), ("empty", "?", False), ("allowed", "?", True)):
        table, folder = fresh_name(t, name)
        managed.create(source, table, folder)
        try:
            ledger.logged_load(source, lambda df: df.where(F.col("o_orderstatus") == state),
                               lambda df: managed.replace_all(df, table, ["o_orderkey"], allowed), log, name, object=name, run="r-1")
        except managed.Refused:
            pass
        n = t.spark.table(table).agg(F.lit(name).alias("object"), F.count(F.lit(1)).alias("n_rows"))
        rows = n if rows is None else rows.unionByName(n)
    return ledger.read_log(t.spark, log).select("object", "status", "written").join(rows, "object")


# --- views, comments and contracts -------------------------------------------------------

VIEW_COLUMNS = {"order_id": "Order, as the source numbers it", "service": "Customer the order belongs to", "state": "Open, finished or part shipped",
                "days_open": "Days from the order to the newest order; it's NULL once finished"}


@query("commented_view", """WITH newest AS (SELECT max(o_orderdate) AS top FROM orders),
rows_ AS (SELECT o_orderkey AS order_id, o_custkey AS service, o_orderstatus AS state,
                 CASE WHEN o_orderstatus <> 'F' THEN date_diff('day', o_orderdate, top) END AS days_open FROM orders, newest),
n AS (SELECT count(*) AS n_rows, count(days_open) AS n_open, CAST(sum(days_open) AS BIGINT) AS days FROM rows_)
SELECT c.column, c.comment, n.* FROM n, (VALUES ('order_id', 'Order, as the source numbers it'), ('service', 'Customer the order belongs to'),
  ('state', 'Open, finished or part shipped'), ('days_open', 'Days from the order to the newest order; it''s NULL once finished')) AS c("column", comment)""")
def commented_view(t: Tables):
    """A view of the catalog over a stored table: its comments as the catalog gives them, and its rows in figures."""
    table, folder = fresh_name(t, "orders")
    files.replace_table(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"), table, comment="Orders as landed", path=folder)
    view = f"{table}_open"
    files.replace_stored_view(t.spark, view, f"""SELECT o_orderkey, o_custkey, o_orderstatus,
        CASE WHEN o_orderstatus <> 'F' THEN datediff((SELECT max(o_orderdate) FROM {table}), o_orderdate) END AS days_open FROM {table}""",
                              VIEW_COLUMNS, "Orders with the days they have been open")
    noted = schemas.catalog_columns(t.spark, [view]).select("column", "comment")
    n = t.spark.table(view).agg(F.struct(F.count(F.lit(1)).alias("n_rows"), F.count("days_open").alias("n_open"), F.sum("days_open").alias("days")))
    return noted.withColumn("n", n.scalar()).select("column", "comment", "n.*")


# What a reader expects of three given tables, with faults on purpose.
EXPECTED = {
    "orders": (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_totalprice", "double"), ("o_orderstatus", "string"),
               ("o_orderdate", "date"), ("o_remark", "string")),
    "part": (("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"), ("p_size", "bigint"),
             ("p_container", "string")),
    "labels": (("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")),
}
FORBIDDEN = ("price", "toxic")

_WANTED = ", ".join(f"('{o}', {i}, '{c}', '{k}')" for o, columns in EXPECTED.items() for i, (c, k) in enumerate(columns, 1))
_FORBIDDEN = " OR ".join(f"contains(column_, '{w}')" for w in FORBIDDEN)


@query("schema_contract", f"""WITH want(object, w_at, column_, want) AS (VALUES {_WANTED}),
found AS (SELECT table_name AS object, CAST(ordinal_position AS INTEGER) AS f_at, lower(column_name) AS column_,
                 CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
                      WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS have
          FROM information_schema.columns WHERE table_name IN ({', '.join(f"'{o}'" for o in EXPECTED)})),
both_ AS (SELECT coalesce(w.object, f.object) AS object, coalesce(w.column_, f.column_) AS column_, w_at, f_at, want, have
          FROM want w FULL JOIN found f ON f.object = w.object AND f.column_ = w.column_),
shared AS (SELECT object, column_, row_number() OVER (PARTITION BY object ORDER BY w_at) <> row_number() OVER (PARTITION BY object ORDER BY f_at) AS moved
           FROM both_ WHERE w_at IS NOT NULL AND f_at IS NOT NULL),
judged AS (SELECT b.*, concat_ws(', ', CASE WHEN have IS NULL THEN 'missing' END, CASE WHEN want IS NULL THEN 'surplus' END,
             CASE WHEN want <> have THEN 'type ' || have END, CASE WHEN moved THEN 'place ' || f_at END,
             CASE WHEN have IS NOT NULL AND ({_FORBIDDEN.replace('column_', 'b.column_')}) THEN 'name' END) AS fault
           FROM both_ b LEFT JOIN shared s ON s.object = b.object AND s.column_ = b.column_)
SELECT object, column_ AS "column", CASE WHEN fault = '' THEN 'OK' ELSE 'FALLA' END AS status, coalesce(want, 'no column') AS expected,
       CASE WHEN fault = '' THEN have ELSE fault END AS obtained FROM judged""")
def schema_contract(t: Tables):
    """Declared columns of three tables against the tables: order, type, missing, surplus and forbidden names."""
    found = schemas.columns_of({name: getattr(t, name) for name in EXPECTED})
    return schemas.schema_contract(found, schemas.declared(t.spark, EXPECTED), FORBIDDEN)


@query("settings_check", f"""WITH {CONTROL}, pair AS (
  SELECT s.key, c.key AS c_key, CAST(s.position AS VARCHAR) AS value, s.load_type = 'SEEDED' AS active, CAST(c.position AS VARCHAR) AS found,
         c.position > 10 AS found_active FROM seed s LEFT JOIN control c ON c.key = s.key)
SELECT 'setting' AS "check", 'part.' || key AS object,
       CASE WHEN coalesce(found = value AND found_active = active, false) THEN 'OK' ELSE 'FALLA' END AS status,
       value || ' active=' || active AS expected, CASE WHEN found IS NULL THEN 'missing' ELSE found || ' active=' || found_active END AS obtained
FROM pair""")
def settings_check(t: Tables):
    """Stored settings beside what they should be: some missing, some with another value."""
    def shaped(rows, active):
        return rows.select(F.lit("part").alias("domain"), F.col("key").cast("string").alias("key"), F.col("position").cast("string").alias("value"),
                           active.alias("active"))

    return quality.settings_as_expected(shaped(control(t), F.col("position") > 10), shaped(seed(t), F.col("load_type") == "SEEDED"), ["domain", "key"])


@query("source_types", """SELECT o_orderkey AS id, CAST(round(o_totalprice, 2) AS DOUBLE) AS amount, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS ordered_at,
       o_orderpriority AS remark FROM orders""")
def source_types(t: Tables):
    """Orders with the types a relational source has, made those of the landing tables."""
    source = t.orders.select(F.col("o_orderkey").cast("decimal(18,0)").alias("id"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
                             F.to_date("o_orderdate").alias("ordered_at"), F.col("o_orderpriority").alias("remark"))
    return files.normalise_source(source)


# --- versions and snapshots --------------------------------------------------------------


@query("evolved_read", """SELECT p_partkey AS key, CAST(p_size AS BIGINT) AS size, p_retailprice AS price, CASE WHEN p_size > 25 THEN p_brand END AS brand
FROM part""")
def evolved_read(t: Tables):
    """Files from before and after a change of a table, read as one: a column was added, one grew from int to bigint, one from float to double."""
    _, folder = fresh_name(t, "parts")
    key, size, price = F.col("p_partkey").alias("key"), F.col("p_size"), F.col("p_retailprice")
    t.part.where(size <= 25).select(key, size.cast("int").alias("size"), price.alias("price")).write.parquet(f"{folder}/v1")
    t.part.where(size > 25).select(key, price.alias("price"), size.cast("bigint").alias("SIZE"), F.col("p_brand").alias("brand")).write.parquet(f"{folder}/v2")
    return files.read_evolved(t.spark, [f"{folder}/v1", f"{folder}/v2"])


RUNS = ("2024-01-10", "2024-01-11")


@query("snapshot_diff", f"""WITH {roles.EV}, cells AS (
  SELECT day, service, kind, count(*) AS n, max(k) AS top, sum(value) AS total FROM ev GROUP BY ALL),
a AS (SELECT * FROM cells WHERE day = DATE '{RUNS[0]}'), b AS (SELECT * FROM cells WHERE day = DATE '{RUNS[1]}')
SELECT CASE WHEN a.n IS NULL THEN 'added' WHEN b.n IS NULL THEN 'removed' WHEN a.n = b.n AND a.top = b.top THEN 'same' ELSE 'changed' END AS outcome,
       count(*) AS n_rows, round(sum(a.total), 4) AS total_before, round(sum(b.total), 4) AS total_after
FROM a FULL JOIN b ON b.service = a.service AND b.kind = a.kind GROUP BY 1""")
def snapshot_diff(t: Tables):
    """Two of the stored daily snapshots, compared by service and kind."""
    rows = stored_snapshots(t)
    found = upkeep.snapshot_diff(rows, "run", *RUNS, ["service", "kind"], ["n", "top"], "total")
    return found.select("outcome", "n_rows", F.round("total_before", 4).alias("total_before"), F.round("total_after", 4).alias("total_after"))


def stored_snapshots(t: Tables):
    _, folder = fresh_name(t, "snapshots")
    cells = roles.events(t).groupBy(F.col("day").cast("string").alias("run"), "service", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.max("k").alias("top"), F.sum("value").alias("total"))
    cells.repartition("run").write.partitionBy("run").parquet(folder)
    return t.spark.read.schema(cells.schema).parquet(folder)

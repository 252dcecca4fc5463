"""The extracts as one chain: each landing table is written once, and its keys decide what the next ones read.

Keys are handed on as stored rows, one step's beside another's, and never pass through the driver. A later
source is reduced to the keys of an earlier landing table by a semi join before anything else is done
with it. The reader of a step names the step, a condition on stored data, so Spark may also build
a bloom filter of the keys (while they are few) and drop the other rows of a large source before they are
shuffled. All keys of a step are used, whatever their number: there is no loop over them.

Within a step rows are dealt by service (or bill, or order) once: a join or sum by more columns than that uses the
exchange there is. What a step needs twice is stored, and a step's shuffle files go as it ends, so the
disk holds the stored rows and one step's exchanges.
"""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..operators import joins
from ..session import conf_set, shuffles_dropped
from ..settings import DEFAULTS, Settings
from ..sources import contracts, files
from . import extract

KEYS = "step string, premises bigint, service bigint, kind bigint, period bigint, bill bigint, `order` bigint"


@dataclass
class Landing:
    """Landing tables and handed keys below one folder all executors share."""

    spark: SparkSession
    folder: str

    def path(self, table: str) -> str:
        return f"{self.folder.rstrip('/')}/{table}"

    @contextmanager
    def step(self):
        """Inside, joins use an exchange by some of their keys, and the shuffle files of a query go as it ends."""
        with shuffles_dropped(self.spark), conf_set(self.spark, {"spark.sql.requireAllClusterKeysForCoPartition": "false"}):
            yield

    def put(self, table: str, rows: DataFrame) -> DataFrame:
        """Writes a landing table in its stored layout and reads it back under the library's names."""
        with self.step():
            files.write_landing(contracts.publish(rows, table), self.path(table))
        return self.get(table)

    def store(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows that several steps, or several parts of one, read: written once beside the landing tables."""
        path = self.path(f"stored/{name}")
        with self.step():
            rows.write.mode("overwrite").parquet(path, compression="zstd")
        return self.spark.read.schema(rows.schema).parquet(path)

    def get(self, table: str) -> DataFrame:
        return contracts.from_landing(files.read_landing(self.spark, self.path(table)), table)

    def hand(self, step: str, keys: DataFrame) -> None:
        """Stores the distinct keys of a step; keys with a missing part drive nothing."""
        with self.step():
            keys.dropna().distinct().write.mode("overwrite").parquet(f"{self.path('keys')}/step={step}")

    def handed(self, step: str, *columns: str) -> DataFrame:
        return self.spark.read.schema(KEYS).parquet(self.path("keys")).where(F.col("step") == step).select(*columns)

    def keep(self, rows: DataFrame, step: str, *columns: str) -> DataFrame:
        """The rows whose key a step has handed on."""
        return joins.keep_known(rows, self.handed(step, *columns), list(columns))


def landing_chain(landing: Landing, s: Mapping[str, DataFrame], names: Mapping[str, DataFrame], as_of,
                  settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """All landing tables, driven by the open orders.

    ``s`` holds the source tables and ``names`` the lookup tables (code, text), by the names of the arguments
    of :mod:`extract`. From the open orders' premises come the services; from the services their readings,
    bills, requests, investigations and loss files; from the readings' periods the consumption and the
    review orders; from these the comments; from the bills the charges. Empty steps give empty
    tables, and those after them too.
    """
    out: dict[str, DataFrame] = {}

    def put(table: str, rows: DataFrame) -> DataFrame:
        out[table] = landing.put(table, rows)
        return out[table]

    day = as_of.date() if hasattr(as_of, "date") else as_of
    periods, windows = s["use_periods"], s["bill_windows"]
    open_orders = put("open_orders", extract.open_orders(s["orders"], s["activities"], s["subscriptions"], names["activity"], names["order_state"], settings))
    landing.hand("open_orders", open_orders.select("premises"))
    services = put("services", extract.services(
        landing.keep(s["subscriptions"], "open_orders", "premises"), s["premises"], s["customers"], s["frequencies"], s["balances"], s["billable"],
        {n: names[n] for n in ("product", "cutoff", "category", "plan", "subcategory")}, day))
    landing.hand("services", services.select("service"))
    use_lines, reading_lines = (landing.keep(s[n], "services", "service") for n in ("use_lines", "reading_lines"))

    dated = landing.store("dated_periods", extract.period_lookup(periods, windows))
    cells = landing.store("cells", extract.analysed_cells(use_lines, reading_lines, periods, windows, settings, dated))
    landing.hand("cells", cells.select("service", "kind", "period"))
    in_cells = [landing.keep(s[n], "cells", "service", "kind", "period") for n in ("use_lines", "reading_lines")]
    readings = put("readings", extract.readings(cells, *in_cells, s["devices"], names["kind"], names["note"], settings, use_lines))
    landing.hand("readings", readings.select("service", "period"))

    spans = windows.select("bill_period", F.col("starts").alias("window_start"), F.col("ends").alias("window_end"))
    drivers = landing.store("drivers", readings.select("service", "kind", "period", "bill_period").distinct().join(spans, "bill_period").drop("bill_period"))
    closed = extract.closers(s["changes"], s["people"], s["users"])
    reviews = put("review_orders", extract.review_orders(
        drivers, *(landing.keep(s[n], "services", "service") for n in ("criticals", "cases")), s["orders"],
        landing.keep(s["activities"], "services", "service"), closed, periods,
        {"task": names["task"], "activity": names["activity"], "kind": names["kind"], "state": names["order_state"]}, settings))
    landing.hand("review_orders", reviews.select("order"))
    reviewed = reviews.select("order", "service", codes.leading_code("kind_text").cast("bigint").alias("kind"), "period",
                              F.to_timestamp("created_at").alias("opened_at"), F.to_timestamp("closed_at").alias("ended_at"))
    landing.hand("reviewed", reviewed.select("service", "kind", "period"))
    observed = landing.store("observations", landing.keep(s["observations"], "reviewed", "service", "kind", "period"))
    put("order_comments", extract.order_comments(
        reviewed, landing.keep(s["comments"], "review_orders", "order"), observed,
        landing.keep(s["activities"], "review_orders", "order"), names["comment"], as_of))

    last = landing.store("last_bills", extract.last_bills(landing.keep(s["accounts"], "services", "service"), s["invoices"], windows, periods, settings))
    landing.hand("bills", last.select("bill"))
    lines = landing.store("charge_lines", landing.keep(s["charge_lines"], "bills", "bill"))
    put("bills", extract.with_amounts(last, lines))
    put("charges", extract.charges(lines.drop("bill_period"), s["accounts"], s["invoices"], windows, periods, names["concept"], names["cause"],
                                   names["program"]))

    # after the steps with large exchanges, as landing tables fill the disk one after another
    put("consumption", extract.consumption(landing.keep(s["use_lines"], "readings", "service", "period"), None, s["routes"], periods, windows,
                                           names["method"], names["kind"], names["rating"]))
    put("requests", extract.requests(s["packages"], landing.keep(s["motives"], "services", "service"), names["request_kind"], names["request_state"],
                                     names["channel"], names["person"], names["area"], s["customers"]))
    landing.hand("members", joins.siblings(services.select("service", "contract"), open_orders, "service", "contract").select("service"))
    put("contract_consumption", extract.recent_consumption(landing.keep(s["use_lines"], "members", "service"), day, periods, windows, names["method"],
                                                           names["kind"], names["rating"], settings=settings))
    put("investigations", extract.investigations(landing.keep(s["investigations"], "services", "service"), names["kind"], names["case_state"], periods,
                                                 day, settings))
    put("loss_files", extract.loss_files(landing.keep(s["loss_files"], "services", "service"), names["irregularity"]))
    return out

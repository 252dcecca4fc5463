"""Consumption, charge, bill and review histories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import amounts, codes, dates, flags
from ..operators import groups, joins
from ..settings import DEFAULTS, Settings

# Fixed value: stands in the key where the source knows no device.
NO_DEVICE = "(sin medidor)"

CELL = ["service", "period", "kind"]


def clean_readings(readings: DataFrame) -> DataFrame:
    """Typed readings with a complete key; rows equal in every column become one."""
    return groups.distinct_rows(typed_readings(readings))


def typed_readings(readings: DataFrame) -> DataFrame:
    """Readings with a complete key and declared types."""
    device, unknown = flags.or_unknown("device", NO_DEVICE)
    longs = ["service", "period", "kind", "bill_period", "bill_year", "bill_month", "cycle",
             "days", "digits"]
    doubles = ["previous_reading", "current_reading", "computed_use", "billed_use", "factor",
               "low_limit", "high_limit"]
    texts = ["kind_text", "note_1", "note_2", "note_3", "loss_mark"]
    return readings.dropna(subset=CELL).select(
        *[F.col(c).try_cast("bigint").alias(c) for c in longs],
        device.alias("device"), unknown.alias("device_unknown"),
        *[F.col(c).cast("string").alias(c) for c in texts],
        *[F.col(c).try_cast("double").alias(c) for c in doubles],
        dates.text_to_date("period_start").alias("period_start"),
        dates.text_to_date("period_end").alias("period_end"))


def use_by_cell(consumption: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Billed use per service, period and type, with the rating and function used.

    An attribute with several values is NULL, beside the number of values.
    """
    billed = codes.token("method", 0) == F.lit(str(settings["billed_method"]))
    keyed = consumption.dropna(subset=["service", "period", "kind_text"])
    lines = keyed.select(
        F.col("service").cast("bigint").alias("service"),
        F.col("period").cast("bigint").alias("period"),
        codes.token("kind_text", 0).try_cast("bigint").alias("kind"),
        billed.alias("billed"),
        F.when(billed, F.col("amount").cast("double")).alias("amount"),
        F.when(billed, F.col("rating")).alias("rating"),
        F.when(billed, F.col("calc_function")).alias("calc_function"),
        dates.text_to_date("recorded_on").alias("recorded_on"))
    # Summed first per rating and function, by hash and with map-side sums, so that the sets
    # of catalogue texts are collected from a few rows per cell.
    parts = lines.groupBy(*CELL, "rating", "calc_function").agg(
        F.sum("amount").alias("amount"),
        groups.count_where(F.col("billed")).alias("billed_rows"),
        F.max("recorded_on").alias("recorded_on"))
    cells = parts.groupBy(*CELL).agg(
        F.sum("amount").alias("period_use"),
        F.sum("billed_rows").alias("billed_rows"),
        groups.sorted_set("rating").alias("ratings"),
        groups.sorted_set("calc_function").alias("calc_functions"),
        F.max("recorded_on").alias("last_recorded_on"))
    n_ratings, n_functions = F.size("ratings"), F.size("calc_functions")
    return cells.select(
        *CELL, "period_use", "billed_rows",
        F.when(n_ratings == 1, F.get("ratings", F.lit(0))).alias("rating"),
        n_ratings.cast("bigint").alias("n_ratings"), "ratings",
        F.when(n_functions == 1, F.get("calc_functions", F.lit(0))).alias("calc_function"),
        n_functions.cast("bigint").alias("n_calc_functions"),
        "last_recorded_on")


def consumption_history(readings: DataFrame, consumption: DataFrame,
                        settings: Settings = DEFAULTS) -> DataFrame:
    """Readings per device with the billed use of their cell and a check of the two.

    A cell holds the few devices of a service, type and period. Readings are dealt by cell once; that
    serves dropping equal rows, both counts and the join.
    """
    device, cell = W.partitionBy(*CELL, "device"), W.partitionBy(*CELL)
    known = F.when(~F.col("device_unknown"), F.col("device"))
    rows = typed_readings(readings).repartition(*CELL).distinct().withColumns({
        "grain_rows": F.count(F.lit(1)).over(device),
        "n_devices": F.size(F.collect_set(known).over(cell)).cast("bigint"),
        "device_use": F.sum("billed_use").over(cell)})
    check = amounts.reconciles("period_use", "device_use", settings["reconcile_tolerance"])
    return rows.join(use_by_cell(consumption, settings), CELL, "left").withColumn("use_reconciles", check)


def period_view(history: DataFrame) -> DataFrame:
    """The consumption history with devices collapsed into their cell."""
    constant = ["kind_text", "bill_period", "bill_year", "bill_month", "cycle", "period_end",
                "days", "n_devices", "period_use", "use_reconciles", "rating", "n_ratings",
                "calc_function"]
    known = F.when(~F.col("device_unknown"), F.col("device"))
    return history.groupBy(*CELL).agg(
        *[F.max(c).alias(c) for c in constant],
        F.min("period_start").alias("period_start"),
        groups.sorted_set(known).alias("devices"),
        groups.any_true("device_unknown").alias("some_device_unknown"),
        F.sum("billed_use").alias("billed_use"),
        F.sum("computed_use").alias("computed_use"),
        groups.any_true(F.col("computed_use") < 0).alias("negative_use"),
        groups.any_true(F.col("current_reading") < F.col("previous_reading")).alias("reading_fell"),
        groups.sorted_set("note_1").alias("notes"))


CHARGE_GRAIN = ["bill", "concept_code", "cause_code", "period", "document", "tariff", "sign"]


def charge_history(charges: DataFrame, bills: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Flagged charge lines, and how many lines share the best candidate for a key.

    Lines are dealt by their bill once, which serves the count and the join with the bills.
    """
    lines = typed_charges(charges).repartition("bill")
    return flag_charges(groups.with_grain_rows(lines, CHARGE_GRAIN, "grain_rows"), bills, settings)


def flagged_charges(charges: DataFrame, bills: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Charge lines with codes, sign, their bill's columns and five flags."""
    return flag_charges(typed_charges(charges), bills, settings)


def typed_charges(charges: DataFrame) -> DataFrame:
    """Charge lines with declared types and the codes read from their texts."""
    return charges.dropna(subset=["service", "bill"]).select(
        *[F.col(c).cast("bigint").alias(c)
          for c in ("service", "bill", "bill_period", "period", "bill_year", "bill_month")],
        *[F.col(c).cast("string").alias(c)
          for c in ("concept", "cause", "sign", "program", "document", "tariff", "period_label")],
        codes.leading_code("concept").alias("concept_code"),
        codes.leading_code("cause").alias("cause_code"),
        codes.leading_code("program").alias("program_code"),
        dates.text_to_date("created_at").alias("created_on"),
        dates.text_to_date("period_start").alias("period_start"),
        dates.text_to_date("period_end").alias("period_end"),
        F.col("units").cast("double").alias("units"),
        F.col("amount").cast("double").alias("amount"))


def flag_charges(lines: DataFrame, bills: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Adds the columns of the bill, which is unique, and the flags."""
    account = bills.select(
        F.col("bill").cast("bigint").alias("bill"),
        F.col("period").cast("bigint").alias("account_period"),
        F.col("bill_year").cast("bigint").alias("account_year"),
        F.col("bill_month").cast("bigint").alias("account_month"),
        F.col("total").cast("double").alias("account_total"),
        F.col("pending").cast("double").alias("account_pending"),
        F.col("own_amount").cast("double").alias("account_own"),
        F.col("recovered_amount").cast("double").alias("account_recovered"),
        dates.text_to_date("paid_at").alias("account_paid_on"))
    return lines.join(account, "bill", "left").withColumns({
        "signed_amount": amounts.credit_negative("sign", "amount", settings["credit_sign"]),
        "is_regular": F.col("program_code") == settings["regular_program"],
        "is_loss": loss_charge("cause_code", "program_code", settings),
        "has_recovery_token": codes.token_is("document", 1, settings["recovery_token"]),
        "period_differs": period_differs("period", "account_period"),
        "is_recovery": (codes.token_is("document", 1, settings["recovery_token"])
                        & period_differs("period", "account_period")),
    })


def loss_charge(cause_code: str, program_code: str, settings: Settings = DEFAULTS):
    return ((F.col(cause_code) == settings["loss_cause"])
            & (F.col(program_code) == settings["loss_program"]))


def period_differs(own: str, account: str):
    """Charge period against that of the bill; a charge without one counts as the bill's."""
    return F.coalesce(F.col(own), F.col(account)) != F.col(account)


DETAIL_GRAIN = ["bill", "concept", "cause", "period"]
DETAIL = ["sign", "document", "amount", "units"]


def charge_detail(charges: DataFrame) -> DataFrame:
    """The lines of a bill for each concept, cause and period, as a sorted list."""
    return groups.nest(charges, DETAIL_GRAIN, DETAIL, "charge_lines")


def bill_history(bills: DataFrame, charges: DataFrame, consumption: DataFrame,
                 readings: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Bills with the number and amount of their charge lines, billed use per type and its readings.

    The lines themselves are in :func:`charge_detail`, however many a bill has. The reading join keeps
    the older definition: several devices of a type give several rows.
    """
    detail = charges.groupBy("bill").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("amount").alias("line_amount"), F.sum("units").alias("line_units"))
    billed = consumption.where(
        codes.token("method", 0) == F.lit(str(settings["billed_method"])))
    by_kind = billed.groupBy("service", "bill_period", "kind_text").agg(
        F.min("period").alias("period"), F.sum("amount").alias("kind_use"))
    read = readings.select(
        "service", "bill_period", "kind_text", "period_start", "period_end", "days",
        "previous_reading", "current_reading", "computed_use",
        F.col("billed_use").alias("reading_use"), "high_limit", "low_limit", "note_1")
    own = bills.select("service", "bill_period", "bill", "bill_year", "bill_month", "paid_at",
                       "total", "pending", "due_on")
    return (own.join(detail, "bill", "left")
            .join(by_kind, ["service", "bill_period"], "left")
            .join(read, ["service", "bill_period", "kind_text"], "left"))


def comment_detail(comments: DataFrame) -> DataFrame:
    """An order's comments of a day and kind, as a sorted list."""
    dated = comments.withColumn("day", F.to_date("recorded_at"))
    return groups.nest(dated, ["order", "day", "comment_kind"], ["recorded_at", "comment"], "comments")


def review_history(orders: DataFrame, comments: DataFrame) -> DataFrame:
    """Review orders with the number and the times of their comments; the texts are in :func:`comment_detail`."""
    seen = comments.groupBy("order").agg(F.count(F.lit(1)).alias("n_comments"), F.min("recorded_at").alias("first_comment_at"),
                                         F.max("recorded_at").alias("last_comment_at"))
    return orders.join(seen, "order", "left").withColumn("n_comments", F.coalesce("n_comments", F.lit(0)))


def contract_roster(services: DataFrame, as_of, settings: Settings = DEFAULTS) -> DataFrame:
    """Services of each contract, active on a date or not, with the size of the contract."""
    from datetime import date
    never = date.fromisoformat(settings["never_withdrawn"])
    rows = services.where(F.col("contract").isNotNull()).withColumns({
        "installed_on": dates.text_to_date("installed_on"),
        "never_withdrawn": dates.is_never("withdrawn_on", never),
        "active": dates.active_on("withdrawn_on", as_of),
        "withdrawn_on": dates.text_to_date("withdrawn_on")})
    return groups.with_group_size(rows, ["contract"], "contract_services")


def order_roster(orders: DataFrame, services: DataFrame, activity: int | None = None) -> DataFrame:
    """Open orders with the master data of their service; one activity, or all."""
    known = [c for c in services.columns if c not in orders.columns or c == "service"]
    rows = orders.withColumn("activity_code", codes.leading_code("activity"))
    if activity is not None:
        rows = rows.where(F.col("activity_code") == activity)
    return rows.join(services.select(*known), "service", "left")


def investigation_view(investigations: DataFrame) -> DataFrame:
    return investigations.select(
        "service", "period", "kind_text", codes.leading_code("kind_text").alias("kind"),
        "request", "state", "state_text",
        *[dates.text_to_date(c).alias(c) for c in ("recorded_at", "period_start", "period_end")])


def loss_file_view(files: DataFrame) -> DataFrame:
    days = dates.window_days("fraud_start", "fraud_end")
    return files.select(
        "loss_file", "service", "state", "state_text", "irregularity",
        codes.leading_code("irregularity").alias("irregularity_code"), "request", "order",
        *[dates.text_to_date(c).alias(c) for c in ("recorded_at", "fraud_start", "fraud_end")],
        "comment").withColumn("fraud_days", days)


def request_history(requests: DataFrame) -> DataFrame:
    """Copy with explicit columns and no filter."""
    return requests.select("service", "request", "customer", "request_kind", "requested_at",
                           "request_state", "attended_at", "comment", "channel", "analyst", "area")

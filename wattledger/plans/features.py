"""Features per service, period and type.

Three exchanges of cell-sized data follow the first aggregation, whatever the number of
features: the charges join on (service, period), whose partitioning also serves the
comparison between types; the request dates by service; and the series windows, which reuse
the partitioning by service.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import amounts, codes, dates, flags
from ..operators import groups, joins, series
from ..settings import DEFAULTS, Settings
from .history import CELL, clean_readings, use_by_cell

SERIES = series.Series(keys=("service", "kind"), end="period_end", period="period")


# Constant within a cell, so the maximum only collapses them.
DEVICE_CONSTANT = ["kind_text", "bill_period", "bill_year", "bill_month", "period_end", "days",
                   "high_limit", "digits", "factor"]
USE_COLUMNS = ["period_use", "ratings", "calc_function"]


def device_measures(settings: Settings) -> list[Column]:
    """Aggregates over the devices of a cell."""
    known = F.when(~F.col("device_unknown"), F.col("device"))
    steep = groups.steepness("computed_use", "previous_reading", "current_reading")
    lap = groups.full_lap("digits", "previous_reading", "current_reading")
    notes = [codes.leading_code(f"note_{i}") for i in (1, 2, 3)]
    return [
        *[F.max(c).alias(c) for c in DEVICE_CONSTANT],
        F.min("period_start").alias("period_start"),
        F.sum("computed_use").alias("computed_use"),
        groups.sorted_set(known).alias("devices"),
        F.min(steep).alias("factor_min"), F.max(steep).alias("factor_max"),
        groups.any_true(F.col("computed_use") < 0).alias("negative_use"),
        groups.any_true(F.col("current_reading") < F.col("previous_reading")).alias("reading_fell"),
        F.max(F.col("billed_use") / lap).alias("lap_ratio"),
        groups.any_true(codes.in_any(settings["device_change_note"], *notes)).alias("note_device_change"),
        groups.any_true(codes.in_any(settings["lower_reading_note"], *notes)).alias("note_lower_reading")]


def under_investigation(settings: Settings) -> Column:
    """By any rating of the cell, or by the marker in its only calculation function."""
    rated = codes.any_element(
        "ratings", lambda x: codes.leading_code(x) == settings["investigation_rating"])
    marked = F.col("calc_function").contains(settings["investigation_marker"])
    return rated | flags.is_true(marked)


def collapse(history: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per service, period and type from a stored consumption history."""
    return history.groupBy(*CELL).agg(
        *device_measures(settings), F.max("n_devices").alias("n_devices"),
        F.max("period_use").alias("period_use"),
        groups.any_true(under_investigation(settings)).alias("investigated"))


def cells(readings: DataFrame, consumption: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The same rows straight from readings and consumption, without the rows per device.

    Both sides are aggregated to the cell before they meet.
    """
    collapsed = clean_readings(readings).groupBy(*CELL).agg(*device_measures(settings))
    use = use_by_cell(consumption, settings).select(*CELL, *USE_COLUMNS)
    return collapsed.join(use, CELL, "left").select(
        *collapsed.columns, "period_use", F.size("devices").cast("bigint").alias("n_devices"),
        under_investigation(settings).alias("investigated"))


def charges_by_period(charges: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Charges have no type: their sums repeat on every type of the period."""
    measured = F.col("concept_code").isin(settings["measured_concepts"])
    apart = F.col("concept_code") == settings["unlegalised_concept"]
    return (charges.where(F.col("period").isNotNull() & F.col("service").isNotNull())
            .groupBy("service", "period").agg(
                F.sum("signed_amount").alias("charges"),
                groups.sum_where(~F.col("is_regular"), "signed_amount").alias("other_charges"),
                groups.sum_where(measured, "units").alias("measured_units"),
                groups.sum_where(apart, "units").alias("unlegalised_units"),
                groups.any_true("is_loss").alias("has_loss_charge"),
                groups.any_true("is_recovery").alias("has_recovery_charge")))


def request_dates(requests: DataFrame) -> DataFrame:
    return requests.where(F.col("attended_at").isNotNull()).select(
        "service", codes.leading_code("request_kind").alias("request_code"),
        F.col("attended_at").cast("date").alias("attended_on"))


def with_requests(cells: DataFrame, requests: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Latest reconnection before the period end, and both kinds inside the period.

    A request lies inside the period exactly when the latest one at or before its end does
    not lie before its start, so one pass gives all three.
    """
    wanted = {"reconnected_on": settings["reconnection"], "__suspended_on": settings["suspension"]}
    seen = joins.with_latest_before(cells, request_dates(requests), "service", "period_end",
                                    "request_code", "attended_on", wanted)
    inside = {name: flags.unless_unset(settings[key], flags.is_true(F.col(at) >= F.col("period_start")))
              for name, key, at in (("reconnected_inside", "reconnection", "reconnected_on"),
                                    ("suspended_inside", "suspension", "__suspended_on"))}
    return seen.withColumns({
        **inside, "days_since_reconnection": F.datediff("period_end", "reconnected_on")
    }).drop("__suspended_on")


def factor_differs(cells: DataFrame) -> DataFrame:
    """Do the types of one period show different effective factors."""
    same_period = W.partitionBy("service", "period")
    rounded = F.round("factor_max", 4)
    differs = F.min(rounded).over(same_period) != F.max(rounded).over(same_period)
    return cells.withColumn("factor_differs", flags.is_true(differs))


def series_features(cells: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    one_device = F.col("n_devices") <= 1
    mean, used = series.trailing("period_use", ~(F.col("n_devices") > 1) | F.col("n_devices").isNull(),
                                 SERIES, settings["mean_lookback"])
    has_limit = F.col("high_limit") > 0
    reached, n_limits = series.precedent(F.col("period_use") >= F.col("high_limit"), has_limit, SERIES)
    rows = series.with_streak(cells, F.col("reading_fell") & one_device, SERIES, "falling_streak")
    rows = rows.withColumns({
        "device_set_changed": series.set_changed("devices", SERIES),
        "charges_delta": series.relative_delta("charges", SERIES),
        "units_delta": series.relative_delta("measured_units", SERIES),
        "mean_before": mean,
        "n_in_mean": used,
        "exceeded_before": reached,
        "n_with_limit_before": n_limits})
    tolerance = settings["false_lap_tolerance"]
    return rows.withColumns({
        "mean_deviation": amounts.ratio(F.col("period_use") - F.col("mean_before"), "mean_before"),
        "exceeds_now": amounts.exceeds("period_use", "high_limit"),
        "false_lap": flags.unless_unset(
            tolerance, F.col("negative_use") & (F.col("lap_ratio") > F.lit(tolerance)))})


def features(cells: DataFrame, charges: DataFrame, requests: DataFrame,
             settings: Settings = DEFAULTS) -> DataFrame:
    """The feature table from the rows per cell, the flagged charge lines and requests."""
    charged = cells.join(charges_by_period(charges, settings), ["service", "period"], "left")
    compared = factor_differs(charged)
    rows = series_features(with_requests(compared, requests, settings), settings)
    return rows.withColumns({
        "has_loss_charge": flags.is_true(F.col("has_loss_charge")),
        "has_recovery_charge": flags.is_true(F.col("has_recovery_charge"))})


def reactive_check(history: DataFrame, active: int, reactive: int,
                   settings: Settings = DEFAULTS) -> DataFrame:
    """Billed reactive use against what exceeds its share of the active use.

    Both types of a period are picked in one aggregation instead of a self join.
    """
    both = (history.where(F.col("kind").isin(active, reactive))
            .groupBy("service", "period").agg(
                groups.sum_where(F.col("kind") == active, "billed_use").alias("active_use"),
                groups.sum_where(F.col("kind") == reactive, "computed_use").alias("reactive_computed"),
                groups.sum_where(F.col("kind") == reactive, "billed_use").alias("reactive_billed"),
                groups.any_true(F.col("kind") == active).alias("__a"),
                groups.any_true(F.col("kind") == reactive).alias("__r"))
            .where(F.col("__a") & F.col("__r")).drop("__a", "__r"))
    excess = F.col("reactive_computed") - settings["reactive_factor"] * F.col("active_use")
    return both.withColumn("expected", F.greatest(F.lit(0.0), excess)).withColumn(
        "difference", F.abs(F.col("reactive_billed") - F.col("expected")))


def lap_screen(history: DataFrame, share: float = 0.9) -> DataFrame:
    """Older screen: negative computed use and a bill near the dial's whole range."""
    near = F.pow(F.lit(10.0), F.col("digits")) * share
    return history.where((F.col("computed_use") < 0) & (F.col("billed_use") > near))

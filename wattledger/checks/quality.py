"""Quality checks. Each is one aggregation that gives rows (check, object, status, expected,
obtained); several measures of a table share one pass over it."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import amounts
from ..functions.codes import col
from ..operators import groups, joins

# States of a check.
OK, LOOK, FAIL, NONE = "OK", "REVISAR", "FALLA", "N/A"
REPORT = ("check", "object", "status", "expected", "obtained")


def entry(check: str, obj: str, passed: Column, expected: str, obtained: Column,
          otherwise: str = FAIL) -> Column:
    """One report row from aggregated measures; an unknown outcome is N/A."""
    status = F.when(passed.isNull(), NONE).when(passed, OK).otherwise(otherwise)
    return F.struct(F.lit(check).alias("check"), F.lit(obj).alias("object"), status.alias("status"),
                    F.lit(expected).alias("expected"), obtained.cast("string").alias("obtained"))


def report(measures: DataFrame, entries: list[Column]) -> DataFrame:
    """One-row measures to report rows."""
    return measures.select(F.inline(F.array(*entries)))


def share(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage, NULL for an empty whole."""
    return F.round(F.try_divide(part * 100.0, whole), digits)


def any_null(columns: list[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def grain(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Is the key unique, and never NULL."""
    n = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.struct(*keys)).alias("d"),
               groups.count_where(any_null(keys)).alias("nulls"))
    return report(n, [
        entry("unique grain", name, F.col("n") == F.col("d"), "repeated rows: 0", F.col("n") - F.col("d")),
        entry("key without NULL", name, F.col("nulls") == 0, "0", F.col("nulls"))])


def rows_per_value(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """How far a key that is not unique is from being so; for information."""
    n = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.struct(*keys)).alias("d"))
    return report(n, [entry("rows per value", name, F.lit(True), "for information",
                            F.round(F.col("n") / F.col("d"), 2))])


def coverage(df: DataFrame, name: str, floors: dict[str, float]) -> DataFrame:
    """Share of non-NULL values per column against its floor; none at all is a failure."""
    n = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(c) for c in floors])
    rows = []
    for c, floor in floors.items():
        pct = share(F.col(c), F.col("n"))
        status = F.when(pct.isNull(), NONE).when(pct > floor, OK).when(pct == 0, FAIL).otherwise(LOOK)
        rows.append(F.struct(F.lit(f"coverage of {c}").alias("check"), F.lit(name).alias("object"),
                             status.alias("status"), F.lit(f"> {floor}").alias("expected"),
                             pct.cast("string").alias("obtained")))
    return report(n, rows)


def gap_cause(df: DataFrame, name: str, value: str, cause: str) -> DataFrame:
    """Values may only be missing where their cause is missing too."""
    n = df.agg(groups.count_where(F.col(value).isNull()).alias("without_value"),
               groups.count_where(F.col(cause).isNull()).alias("without_cause"),
               groups.count_where(F.col(value).isNull() & F.col(cause).isNotNull()).alias("unexplained"))
    return report(n, [
        entry(f"{value} missing", name, F.lit(True), "for information", F.col("without_value")),
        entry(f"{cause} missing", name, F.lit(True), "for information", F.col("without_cause")),
        entry("gaps explained", name, F.col("unexplained") == 0, "0", F.col("unexplained"), LOOK)])


def count_check(df: DataFrame, check: str, name: str, bad: Column, otherwise: str = LOOK) -> DataFrame:
    """No row may satisfy ``bad``."""
    n = df.agg(groups.count_where(bad).alias("bad"))
    return report(n, [entry(check, name, F.col("bad") == 0, "0", F.col("bad"), otherwise)])


def date_order(df: DataFrame, name: str, start: str, end: str) -> DataFrame:
    return count_check(df, f"{start} <= {end}", name, F.col(start) > F.col(end))


def domain(df: DataFrame, name: str, column: str, allowed: DataFrame) -> DataFrame:
    """Distinct values outside the allowed ones; ``allowed`` has the same column."""
    odd = joins.drop_keys(df.select(column).where(F.col(column).isNotNull()).distinct(), allowed, [column])
    n = odd.agg(F.count(F.lit(1)).alias("n"), F.min(col(column).cast("string")).alias("first"))
    return report(n, [entry(f"domain of {column}", name, F.col("n") == 0, "no other value",
                            F.concat_ws(" ", F.col("n").cast("string"), F.col("first")), LOOK)])


def code_prefix(df: DataFrame, name: str, code: str, text: str) -> DataFrame:
    """A text starts with the code it describes."""
    bad = F.col(code).isNotNull() & ~F.col(text).startswith(F.col(code).cast("string"))
    return count_check(df, f"{text} starts with {code}", name, bad, FAIL)


def orphans(df: DataFrame, name: str, master: DataFrame, key: str) -> DataFrame:
    lost = joins.drop_keys(df.select(key).where(F.col(key).isNotNull()).distinct(), master, [key])
    n = lost.agg(F.count(F.lit(1)).alias("n"))
    return report(n, [entry(f"{key} known", name, F.col("n") == 0, "0", F.col("n"))])


def row_preservation(rows: DataFrame, other: DataFrame, keys: list[str], name: str) -> DataFrame:
    """A left join of ``rows`` to ``other`` keeps the number of rows; counted per key, not joined out."""
    matches = other.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    n = (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).join(matches, keys, "left")
         .agg(F.coalesce(F.sum("__rows"), F.lit(0)).alias("before"),
              F.coalesce(F.sum(F.col("__rows") * F.coalesce("__n", F.lit(1))), F.lit(0)).alias("after")))
    return report(n, [entry("join keeps rows", name, F.col("before") == F.col("after"), "same count",
                            F.concat_ws(" to ", F.col("before").cast("string"), F.col("after").cast("string")))])


def ambiguity(df: DataFrame, name: str, value: str, count: str) -> DataFrame:
    """An attribute with several values must be NULL."""
    n = df.agg(groups.count_where(F.col(count) > 1).alias("several"),
               groups.count_where((F.col(count) > 1) & F.col(value).isNotNull()).alias("bad"))
    return report(n, [entry(f"ambiguous {value} is NULL", name, F.col("bad") == 0, "0", F.col("bad")),
                      entry(f"ambiguous {value}", name, F.lit(True), "for information", F.col("several"))])


def rate(df: DataFrame, check: str, name: str, condition: str | Column, floor: float) -> DataFrame:
    n = df.agg(groups.count_where(col(condition)).alias("yes"), F.count(F.lit(1)).alias("n"))
    pct = share(F.col("yes"), F.col("n"))
    return report(n, [entry(check, name, pct >= floor, f">= {floor}", pct, LOOK)])


def flag_profile(df: DataFrame, name: str, flags: list[str]) -> DataFrame:
    """True and NULL counts per flag; a NULL asks for a look."""
    n = df.agg(F.count(F.lit(1)).alias("n"),
               *[groups.count_where(F.col(f)).alias(f"t_{f}") for f in flags],
               *[groups.count_where(F.col(f).isNull()).alias(f"n_{f}") for f in flags])
    return report(n, [entry(f"flag {f}", name, F.col(f"n_{f}") == 0, "no NULL",
                            F.concat_ws(" of ", f"t_{f}", "n"), LOOK) for f in flags])


def signals(df: DataFrame, name: str, empty: list[str], filled: list[str],
            positive: list[str] = ()) -> DataFrame:
    """Columns that must be all NULL, must hold something, and flags that must be true once."""
    n = df.agg(*[F.count(c).alias(f"c_{c}") for c in {*empty, *filled, *positive}],
               *[groups.count_where(F.col(c)).alias(f"t_{c}") for c in positive])
    rows = [entry(f"{c} all NULL", name, F.col(f"c_{c}") == 0, "0", F.col(f"c_{c}")) for c in empty]
    rows += [entry(f"{c} has values", name, F.col(f"c_{c}") > 0, "> 0", F.col(f"c_{c}"), LOOK) for c in filled]
    rows += [entry(f"{c} is true somewhere", name, (F.col(f"c_{c}") == 0) | (F.col(f"t_{c}") > 0),
                   "> 0 or switched off", F.col(f"t_{c}"), LOOK) for c in positive]
    return report(n, rows)


def recompute(published: DataFrame, source: DataFrame, keys: list[str], measure: str, name: str,
              tolerance: float = 0.001) -> DataFrame:
    """A published measure against the same measure summed from its source.

    A key that only one side holds counts as a difference, unless its measure is 0 or missing there.
    """
    fresh = source.groupBy(*keys).agg(F.sum(measure).alias("__fresh"))
    shown = published.groupBy(*keys).agg(F.max(measure).alias("__shown"))
    met = fresh.join(shown, keys, "full")
    n = met.agg(groups.count_where(~amounts.reconciles("__fresh", "__shown", tolerance)).alias("bad"))
    return report(n, [entry(f"{measure} matches its source", name, F.col("bad") == 0, "0", F.col("bad"))])


def definition_moved(df: DataFrame, name: str, old: Column, new: Column, measure: str) -> DataFrame:
    """A changed definition must change the total."""
    n = df.agg(groups.sum_where(old, measure).alias("old"), groups.sum_where(new, measure).alias("new"))
    moved = ~amounts.reconciles("old", "new", 0.001)
    return report(n, [entry("definition moved the total", name, moved, "totals differ",
                            F.concat_ws(" to ", F.round("old", 0).cast("bigint").cast("string"),
                                        F.round("new", 0).cast("bigint").cast("string")))])


def composed(df: DataFrame, name: str, whole: str, parts: list[str]) -> DataFrame:
    """A combined flag is the AND of its parts."""
    return count_check(df, f"{whole} is the AND of its parts", name,
                       F.col(whole) != reduce(and_, [F.col(p) for p in parts]), FAIL)


def repeated(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    again = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    n = again.agg(F.count(F.lit(1)).alias("bad"))
    return report(n, [entry("repeated " + "+".join(keys), name, F.col("bad") == 0, "0", F.col("bad"))])


def expectation_mismatch(found: DataFrame, expected: DataFrame, key: str, value: str) -> DataFrame:
    """Rows of ``found`` whose value is not the expected one; keys without one are left out."""
    want = expected.select(F.col(key), F.col(value).alias("expected"))
    return (found.where(F.col(key).isNotNull() & F.col(value).isNotNull())
            .groupBy(key, value).agg(F.count(F.lit(1)).alias("n_rows")).join(want, key)
            .where(F.col(value) != F.col("expected")))


def settings_as_expected(settings: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Each expected setting with OK or what is wrong."""
    shown = settings.select(*keys, F.col("value").alias("found"), F.col("active").alias("found_active"))
    rows = expected.join(shown, keys, "left")
    right = ((F.regexp_replace("found", " ", "") == F.regexp_replace("value", " ", ""))
             & (F.col("found_active") == F.col("active")))
    obtained = F.when(F.col("found").isNull(), "missing").otherwise(
        F.concat_ws(" active=", "found", F.col("found_active").cast("string")))
    return rows.select(
        F.lit("setting").alias("check"), F.concat_ws(".", *keys).alias("object"),
        F.when(F.coalesce(right, F.lit(False)), OK).otherwise(FAIL).alias("status"),
        F.concat_ws(" active=", "value", F.col("active").cast("string")).alias("expected"),
        obtained.alias("obtained"))


def summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n_checks"))

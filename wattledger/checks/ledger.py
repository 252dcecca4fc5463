"""The run log: one row per attempt, states derived from the latest rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import groups, joins, series
from ..sources.managed import Refused, observed
from .quality import LOOK, entry, report

STARTED, DONE, FAILED = "INICIADO", "EXITOSO", "FALLIDO"
SCHEMA = ("object string, run string, started_at timestamp, ended_at timestamp, status string, "
          "read bigint, written bigint, path string, message string, writer string")


def append_attempt(spark: SparkSession, path: str, **attempt) -> None:
    """Add one attempt to the log, with its whole message."""
    row = [tuple(attempt.get(f.split()[0]) for f in SCHEMA.split(", "))]
    df = spark.createDataFrame(row, SCHEMA).withColumn("message", F.nullif("message", F.lit("")))
    seconds = F.unix_timestamp("ended_at") - F.unix_timestamp("started_at")
    df.withColumn("seconds", seconds.cast("double")).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The stored log with its attempt ids."""
    return spark.read.schema(f"{SCHEMA}, seconds double, attempt string").parquet(path)


def record_attempt(spark: SparkSession, path: str, attempt: str, **values) -> None:
    """Store one attempt under its id. The same id once more replaces its row: a repeated report stays one row."""
    row = [tuple(values.get(f.split()[0]) for f in SCHEMA.split(", "))]
    seconds = F.unix_timestamp("ended_at") - F.unix_timestamp("started_at")
    (spark.createDataFrame(row, SCHEMA).withColumn("message", F.nullif("message", F.lit(""))).withColumn("seconds", seconds.cast("double"))
     .coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/attempt={attempt}"))


def logged_load(source: DataFrame, make: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], object], log: str, attempt: str,
                now: Callable[[], datetime] = datetime.now, **values) -> dict:
    """One load with its row in the log: started, then done or failed, with the rows read and written.

    ``make`` turns the source into what ``write`` stores. Both counts are observed while the load writes, so
    nothing is read a second time. A load that ``write`` refuses afterwards (an empty one) is logged as
    failed with its counts; any other error without. The error is raised again. Where a lost executor
    makes Spark repeat a stage before a shuffle, its rows may count twice in ``read``; ``written`` is exact.
    """
    spark = source.sparkSession
    row = {**values, "started_at": now(), "status": STARTED}
    record_attempt(spark, log, attempt, **row)
    read, written = Observation(), Observation()
    n = F.count(F.lit(1)).alias("rows")
    try:
        write(make(source.observe(read, n)).observe(written, n))
        row |= {"status": DONE}
    except Refused as e:
        row |= {"status": FAILED, "message": str(e)}
        raise
    except Exception as e:
        row |= {"status": FAILED, "message": str(e)}
        read = written = None
        raise
    finally:
        row |= {"ended_at": now()}
        if written is not None:
            row |= {"read": observed(read, "rows"), "written": observed(written, "rows")}
        record_attempt(spark, log, attempt, **row)
    return row


def latest_status(log: DataFrame) -> DataFrame:
    """State of each object: that of its latest attempt."""
    return series.latest(log, ["object"], ["started_at", "log_id"], ["status", "started_at"])


def last_run(log: DataFrame) -> DataFrame:
    """All rows of the run that ended last; run names have no order of their own."""
    newest = (log.where(F.col("ended_at").isNotNull())
              .agg(series.latest_value("run", "ended_at", "log_id").alias("run")))
    return log.where(F.col("run") == newest.scalar())


def run_totals(log: DataFrame, done: str = DONE) -> DataFrame:
    """Rows written per object and run, from the successful attempts."""
    return (log.where((F.col("status") == done) & F.col("written").isNotNull())
            .groupBy("object", "run").agg(F.sum("written").alias("written"),
                                          F.max("ended_at").alias("ended_at")))


def volume_delta(log: DataFrame, done: str = DONE, limit_pct: float = 10.0) -> DataFrame:
    """Rows written by the latest run against the one before; large steps are marked."""
    rows = series.run_over_run(run_totals(log, done), "object", ["ended_at", "run"], "written")
    return rows.withColumn("large", F.coalesce(F.abs("delta_pct") > limit_pct, F.lit(False)))


def counts_by_run(log: DataFrame, runs: list[str], done: str = DONE) -> DataFrame:
    """Rows written per object with one column per named run, and whether they are equal."""
    wide = groups.runs_as_columns(run_totals(log, done), "object", "run", runs, "written")
    first = F.col(f"`{runs[0]}`")
    same = F.lit(True)
    for r in runs[1:]:
        same = same & first.eqNullSafe(F.col(f"`{r}`"))
    return wide.withColumn("same", same)


def status_counts(log: DataFrame) -> DataFrame:
    return last_run(log).groupBy("status").agg(F.count(F.lit(1)).alias("n_rows"))


def zero_row_success(log: DataFrame, done: str = DONE) -> DataFrame:
    """Attempts that claim success and wrote nothing: the mark of a silent failure."""
    return log.where((F.col("status") == done) & (F.col("written") == 0))


def missing_from_log(plan: DataFrame, log: DataFrame) -> DataFrame:
    return joins.drop_keys(plan, log, ["object"])


def log_with_plan(log: DataFrame, plan: DataFrame) -> DataFrame:
    return log.join(plan, "load_id")


def recent_failures(log: DataFrame, as_of: datetime, days: int = 7, failed: str = FAILED) -> DataFrame:
    return log.where((F.col("status") == failed) & (F.col("started_at") >= F.lit(as_of - timedelta(days=days))))


def laggards(log: DataFrame, hours: int = 6) -> DataFrame:
    """Objects whose last write lies more than ``hours`` before the newest write of all."""
    last = log.groupBy("object").agg(F.max("ended_at").alias("last_write"))
    newest = log.agg(F.max("ended_at")).scalar()
    behind = (F.unix_timestamp(newest) - F.unix_timestamp("last_write")) / 3600
    return last.withColumn("late", behind > hours)


def writers(log: DataFrame) -> DataFrame:
    """Who writes each object; more than one is a conflict."""
    return log.groupBy("object").agg(F.countDistinct("writer").alias("n_writers"),
                                     groups.only_value("writer").alias("only_writer"))


def written_after(log: DataFrame, cutoff: datetime, objects: list[str]) -> DataFrame:
    """Retired objects that something still writes."""
    return (log.where(F.col("object").isin(objects)).groupBy("object")
            .agg(F.max("ended_at").alias("last_write")).where(F.col("last_write") >= F.lit(cutoff)))


def job_profile(log: DataFrame, job: str) -> DataFrame:
    return log.groupBy(job).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("object").alias("n_objects"),
                                F.min("started_at").alias("first_start"), F.max("ended_at").alias("last_end"))


def plan_matches(plan: DataFrame, active: str, wanted: DataFrame, name: str) -> DataFrame:
    """The active loads are exactly the wanted ones."""
    live = plan.where(F.col(active)).select("object")
    sides = joins.overlap(live, wanted, "object")
    good = (F.col("n_left") == F.col("n_right")) & (F.col("n_left") == F.col("n_both"))
    return report(sides, [entry("active loads", name, good, "as planned",
                                F.concat_ws("/", "n_left", "n_right", "n_both"), LOOK)])

"""Session and shared-folder settings."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "wattledger", cores: str | None = None) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own session."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores != "*" else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors see, as the cluster names it in spark.checkpoint.dir.

    Only where that is unset (tests on one machine) a new local folder is made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    made = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


@contextmanager
def conf_set(spark: SparkSession, settings: dict[str, str]):
    """Inside, the session has these settings; after it, those it had before."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shuffles_dropped(spark: SparkSession):
    """Inside, the shuffle files of a query go as it ends, not when the driver happens to collect its garbage.

    Only for queries that nobody runs a second time, such as those that write what later steps read.
    """
    return conf_set(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once into the shared folder and read from there.

    Its lineage ends, it outlives an executor, and a later step reads only the columns it uses.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)

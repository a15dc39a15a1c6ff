"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# For local masters that name no shared folder.
LOCAL_DIR = os.environ.get("SERIESLOOM_SHARED_DIR", "/tmp/seriesloom-shared")


def local_session(cpus: int | str = "*", app: str = "seriesloom", **conf: str) -> SparkSession:
    """A single-machine session for tests, the benchmark and small runs."""
    partitions = "8" if cpus == "*" else str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _named(spark: SparkSession) -> str | None:
    return spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Where it names none, a local master, whose driver and executors are one
    process, uses ``LOCAL_DIR``; on a cluster that is an error.
    """
    named = _named(spark)
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors can reach")
        spark.sparkContext.setCheckpointDir(LOCAL_DIR)
        named = _named(spark)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage at a columnar table, so later readers prune columns and a
    lost executor costs a re-read rather than the work before it.
    """
    return written_at(df, name)[0]


def written_at(df: DataFrame, name: str = "table") -> tuple[DataFrame, str]:
    """``df`` written and read back, and the path for :func:`remove_table`."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _written_by(spark).append(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete one table that :func:`written_at` made and nothing will read again."""
    _delete(spark, path)
    _written_by(spark).remove(path)


# Paths of the tables written for each application.
_PATHS: dict[str, list[str]] = {}


def _written_by(spark: SparkSession) -> list[str]:
    return _PATHS.setdefault(spark.sparkContext.applicationId, [])


def remove_written(spark: SparkSession) -> None:
    """Delete the tables that :func:`written` made for this application.

    To be called when all results are stored: tables returned before read them.
    """
    paths = _written_by(spark)
    while paths:
        _delete(spark, paths.pop())


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)

"""Session settings the results depend on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .errors import SharedFolderMissing


def prepare(spark: SparkSession) -> SparkSession:
    """Pin UTC: date parts, day boundaries and zone-less timestamps all rely on it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession, purpose: str, base: str | None = None) -> str:
    """A new folder for intermediate tables, under ``base`` or ``spark.checkpoint.dir``.

    Both must name storage that every executor can reach. There is no other choice: a
    folder of one machine would lose what executors elsewhere write.
    """
    base = base or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise SharedFolderMissing(
            "Set spark.checkpoint.dir to a folder that the driver and all executors share"
        )
    return f"{_own(spark, base)}/{purpose}-{uuid.uuid4().hex}"


# For tables that are written to be read again by the same run.
COMPACT = {"compression": "zstd"}
# Compressed feed rows are a few bytes each; a task reads several files of this many.
ROWS_PER_FILE = 250_000


def staged(rows: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, for plans that use it twice."""
    path = shared_folder(rows.sparkSession, purpose)
    rows.write.options(**COMPACT, maxRecordsPerFile=ROWS_PER_FILE).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@contextmanager
def open_writers(spark: SparkSession, most: int) -> Iterator[None]:
    """Let a task keep a file open for each of up to ``most`` partition values of a write.

    Rows then need not be sorted by them first; a task that meets more values sorts the rest.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(most, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def release(spark: SparkSession, base: str | None = None) -> None:
    """Remove every intermediate table of this application; frames over them end with it."""
    base = base or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        path = spark._jvm.org.apache.hadoop.fs.Path(_own(spark, base))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def folder_exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _own(spark: SparkSession, base: str) -> str:
    return f"{base.rstrip('/')}/pricetide-{spark.sparkContext.applicationId}"

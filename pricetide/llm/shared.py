"""Reading the tables, intermediate tables in the shared folder, and text helpers."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.session import shared_folder

#: Words of every contract: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers of this machine import the package from where the driver has it.

    Workers on other machines need it installed, in PYTHONPATH, or passed by --py-files.
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [environment.get("PYTHONPATH"), root]))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A new path under ``spark.checkpoint.dir``, which all executors share.

    Only a local master, whose executors are this process, may do without the setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and spark.sparkContext.master.startswith("local["):
        base = tempfile.gettempdir()
    return shared_folder(spark, purpose, base)


def stage(rows: DataFrame, purpose: str) -> DataFrame:
    """Write rows once to the shared folder and go on from the files.

    Cuts lineage, survives lost executors, and keeps later plans from repeating the work.
    """
    path = shared_path(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts: one scan of that column, to choose numbers of parts."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0

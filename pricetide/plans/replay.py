"""A way back for rejected rows: repair by rule, load again, mark what was loaded."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import accepted, observe
from ..schema import RAW_COLUMNS, RAW_TO_CLEAN
from ..session import folder_exists
from ..sources.raw import MALFORMED, with_lineage
from .pipeline import PipelineRun, run_batch

# For each reason of rejection the feed columns to replace, from the feed columns as they came.
Repairs = Mapping[str, Mapping[str, Column]]
KEPT_TEXT = {"price_min": "price_min_text", "price_max": "price_max_text", "date_seen": "date_text"}
MARKS = "batch string, reject_id string, run_id bigint"


def rejects(spark: SparkSession, root: str) -> DataFrame:
    """Rejects of cleaning as feed rows again, with batch, reason and an id.

    The id is a digest of the row and its reason, so it is the same whenever it is computed.
    """
    kept = spark.read.parquet(f"{root.rstrip('/')}/failed").where("reject_stage = 'clean'")
    feed = [F.col(KEPT_TEXT.get(clean, clean)).cast("string").alias(raw) for raw, clean in RAW_TO_CLEAN.items()]
    rows = kept.select(*feed, F.col("batch").cast("string").alias("batch"), "reject_reason")
    cells = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`")), F.lit("-")) for c in RAW_COLUMNS]
    identity = F.sha2(F.to_json(F.array("reject_reason", *cells)), 256)
    return rows.withColumn("reject_id", identity)


def replayed(spark: SparkSession, root: str) -> DataFrame:
    """(batch, reject_id, run_id) of the rejects that were repaired and loaded."""
    path = f"{root.rstrip('/')}/replayed"
    return spark.read.schema(MARKS).parquet(path) if folder_exists(spark, path) else spark.createDataFrame([], MARKS)


def reject_states(spark: SparkSession, root: str) -> DataFrame:
    """Every reject with ``run_id``, the run that loaded it after repair, or NULL."""
    marks = replayed(spark, root).groupBy("batch", "reject_id").agg(F.min("run_id").alias("run_id"))
    return rejects(spark, root).join(marks, ["batch", "reject_id"], "left")


def repaired(rows: DataFrame, repairs: Repairs) -> DataFrame:
    """Rejects whose reason has a rule, with the rule applied."""
    known = rows.where(F.col("reject_reason").isin(*repairs))

    def cell(name: str) -> Column:
        old = F.col(f"`{name}`")
        rules = [(reason, changes[name]) for reason, changes in repairs.items() if name in changes]
        return reduce(lambda c, r: F.when(F.col("reject_reason") == r[0], r[1]).otherwise(c), rules, old).alias(name)

    return known.select(*map(cell, RAW_COLUMNS), "batch", "reject_id")


def replay_rejects(spark: SparkSession, root: str, repairs: Repairs) -> PipelineRun | None:
    """Take repaired rejects through the pipeline as a run of their own; None without any.

    Only rows that pass cleaning once repaired go, the others stay as they are. What was loaded
    is marked after the run, and never goes again. If the run ends before the marks are written,
    the next replay takes the same rows, and their load keys are found stored.
    """
    root = root.rstrip("/")
    waiting = reject_states(spark, root).where("run_id is null").drop("run_id")
    candidates = repaired(waiting, repairs)
    path = f"{root}/staged/repaired"
    carry = ["batch", "reject_id"]
    passed = accepted(observe(candidates, carry), carry).select(*carry).distinct()
    candidates.join(passed, carry, "left_semi").write.mode("overwrite").parquet(path)
    ready = spark.read.parquet(path)
    if ready.isEmpty():
        return None

    def scan(name: str) -> DataFrame:
        source = F.concat(F.lit(f"{root}/failed/batch="), F.col("batch")).alias("_source_file")
        text = F.lit(None).cast("string").alias(MALFORMED)
        feed = [F.col(f"`{c}`") for c in RAW_COLUMNS]
        return with_lineage(ready.select(*feed, text, source), name)

    run = run_batch(spark, root, scan, policy="quarantine")
    marks = ready.select(*carry, F.lit(run.run_id).cast("bigint").alias("run_id"))
    marks.write.mode("append").parquet(f"{root}/replayed")
    return run

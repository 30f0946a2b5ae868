"""The staged pipeline: land, validate, clean, load, with a ledger entry either way."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import (
    accepted,
    observe_parsed,
    parse_prices,
    rejected,
    select_business_columns,
)
from ..operators.quality import (
    count_stored_copies,
    require_columns,
    require_valid,
    tally,
    validation_report,
    watch_report,
)
from ..errors import FeedRejected
from ..schema import RAW_COLUMNS
from ..session import COMPACT, ROWS_PER_FILE, open_writers, prepare
from ..sources.raw import MALFORMED, landed, scan_for_landing, write_landed
from ..sources.warehouse import LoadResult, Warehouse
from .ledger import RunLedger


class PipelineRun(NamedTuple):
    run_id: int
    load: LoadResult


def write_processed(observed: DataFrame, path: str) -> None:
    """Replace the processed table: good rows and rejects from one pass, side by side."""
    good = F.col("reject_reason").isNull()
    labelled = observed.withColumn("outcome", F.when(good, "clean").otherwise("rejected"))
    writer = labelled.write.mode("overwrite").partitionBy("outcome")
    with open_writers(observed.sparkSession, 2):
        writer.options(**COMPACT, maxRecordsPerFile=ROWS_PER_FILE).parquet(path)


def read_processed(spark: SparkSession, path: str, schema: DataFrame) -> DataFrame:
    """The processed table, also when one of the outcomes has no rows."""
    fields = schema.schema.add("outcome", "string")
    return spark.read.schema(fields).parquet(path)


def malformed(landed: DataFrame) -> DataFrame:
    """Rows that do not fit their header, as rejects that keep the text."""
    return landed.where(F.col(MALFORMED).isNotNull()).select(
        F.lit("scan").alias("reject_stage"),
        F.lit("row_malformed").alias("reject_reason"),
        F.col(MALFORMED).alias("row_text"),
    )


def run_pipeline(
    spark: SparkSession,
    source: str | list[str],
    root: str,
    *,
    policy: str = "strict",
    multiline: bool = False,
    **checks: object,
) -> PipelineRun:
    """Take one feed into the warehouse under ``root``.

    ``strict`` fails the batch at the first failed check. ``quarantine`` keeps bad rows
    aside with a reason and loads the rest. ``checks`` are options of the validation
    report. Any error closes the run as FAILED and is raised again.
    """
    root = root.rstrip("/")

    def scan(batch: str) -> DataFrame:
        return scan_for_landing(spark, source, f"{root}/raw", batch, multiline)

    return run_batch(spark, root, scan, policy=policy, **checks)


def run_batch(
    spark: SparkSession,
    root: str,
    scan: Callable[[str], DataFrame],
    *,
    policy: str,
    batch: str | None = None,
    dead_after: float = 0,
    **checks: object,
) -> PipelineRun:
    """One run over what ``scan`` returns for the name of the batch.

    Runs without a batch name of their own are named by their number. A named batch that
    was loaded before adds nothing. Runs that died are closed first; as a warehouse has one
    writer, that is every run still open after ``dead_after`` seconds.

    The counts of the ledger are observed while the tables are written.
    """
    if policy not in ("strict", "quarantine"):
        raise ValueError("policy is 'strict' or 'quarantine'")
    prepare(spark)
    ledger = RunLedger(spark, root)
    run_id = ledger.open(dead_after)
    counts: dict[str, int] = {}
    try:
        name = str(run_id) if batch is None else batch
        seen = Observation()
        scanned = scan(name).observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count(MALFORMED).alias("broken")
        )
        write_landed(scanned, f"{root}/raw", name)
        counts["records_received"], broken = seen.get["rows"], seen.get["broken"]
        if broken and policy == "strict":
            raise FeedRejected(f"row_malformed: {broken} rows do not fit their header")
        batch_rows = landed(spark, f"{root}/raw", name)
        raw = batch_rows.where(F.col(MALFORMED).isNull()).drop(MALFORMED)

        # Only rows that may be copies are shuffled as a whole. A strict run reads the landed rows
        # once more for its report, before anything is cleaned; else the report is watched while
        # the cleaned rows are written, and the counted rows need no table of their own.
        require_columns(raw, RAW_COLUMNS)
        require_columns(raw, checks.get("required", RAW_COLUMNS))
        counted = count_stored_copies(raw)

        def keep_report(report: DataFrame) -> DataFrame:
            numbered = report.withColumn("run_id", F.lit(run_id).cast("bigint"))
            numbered.write.mode("overwrite").json(f"{root}/reports/batch={name}")
            return spark.read.json(f"{root}/reports/batch={name}")

        if policy == "strict":
            require_valid(keep_report(validation_report(counted, **checks)))

        parsed = parse_prices(select_business_columns(counted, ["_copies"]))
        watched, report = watch_report(parsed, len(counted.columns) - 1, **checks)
        usable, seen = Observation(), Observation()
        priced = watched.observe(usable, tally(F.col("reject_reason").isNull(), F.col("_copies")).alias("rows"))
        observed = observe_parsed(priced)
        clean_count = F.count(F.when(F.col("reject_reason").isNull(), 1))
        write_processed(observed.observe(seen, clean_count.alias("clean")), f"{root}/processed")
        if policy != "strict":
            keep_report(report())
        counts["records_validated"] = usable.get["rows"]
        counts["records_transformed"] = seen.get["clean"]
        processed = read_processed(spark, f"{root}/processed", observed)
        refused = rejected(processed.where("outcome = 'rejected'")).drop("outcome")
        if broken:
            refused = refused.unionByName(malformed(batch_rows), allowMissingColumns=True)
        refused.write.mode("overwrite").parquet(f"{root}/failed/batch={name}")
        clean_rows = accepted(processed.where("outcome = 'clean'"))

        result = Warehouse(spark, root).load(clean_rows, policy=policy, batch=batch)
        counts["records_loaded"] = result.inserted
    except Exception as error:
        ledger.close(run_id, "FAILED", {"records_received": counts.get("records_received", 0)}, str(error))
        raise
    ledger.close(run_id, "SUCCESS", counts)
    return PipelineRun(run_id, result)

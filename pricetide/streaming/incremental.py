"""Incremental loading of newly arrived feed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from ..plans.pipeline import run_batch
from ..session import prepare
from ..sources.raw import scan_for_landing, stream_arrivals
from ..sources.warehouse import Warehouse


def load_arrivals(
    spark: SparkSession,
    source: str,
    root: str,
    *,
    max_files: int | None = None,
    once: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Start a stream that takes every file not seen before through the pipeline.

    Each micro-batch is landed, reported on, cleaned and loaded as a run of its own in the
    ledger, with its rejects kept. Every file is read by its own header, as in a batch load.
    With ``once`` it works through what has arrived and ends; otherwise it keeps looking. The
    load key makes it safe to repeat a micro-batch and to receive an observation late or twice:
    what is stored is skipped, so no watermark or state is needed and lateness is unlimited.
    """
    prepare(spark)
    store = root.rstrip("/")
    options = {"recursiveFileLookup": True}
    if max_files:
        options["maxFilesPerTrigger"] = max_files
    arrivals = stream_arrivals(spark, source, **options)

    def load(rows: DataFrame, batch_id: int) -> None:
        session, batch = rows.sparkSession, f"stream-{batch_id}"
        if Warehouse(session, root).has(batch):
            return  # a repeat of a micro-batch that was committed

        # The stream's own log lists the files of a micro-batch on the driver, too.
        files = [row.file for row in rows.distinct().collect()]

        def scan(name: str) -> DataFrame:
            return scan_for_landing(session, sorted(files), f"{store}/raw", name)

        run_batch(session, store, scan, policy="quarantine", batch=batch)

    writer = arrivals.writeStream.foreachBatch(load).option(
        "checkpointLocation", f"{store}/stream_checkpoint"
    )
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()

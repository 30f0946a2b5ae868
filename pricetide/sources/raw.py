"""Reading raw feeds and landing them unchanged."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import LoadRejected
from ..functions import missing_as_null
from ..session import COMPACT, ROWS_PER_FILE, shared_folder

# Header, doubled quotes inside quoted cells, and text kept exactly as written.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


# The first line of each file of a feed.
HEADERS = T.StructType([T.StructField("file", T.StringType()), T.StructField("header", T.StringType())])
# A file is one split for a scan that stops after its first line; so many files share one plan.
ONE_LINE = {
    "spark.sql.files.maxPartitionBytes": str(1 << 50),
    "spark.sql.files.minPartitionNum": "1",
    "spark.sql.adaptive.enabled": "false",
}
FILES_PER_LOOK = 100
ROWS_PER_RAW_FILE = 2_000_000
ARRIVAL = "path string, modificationTime timestamp, length bigint, content binary"

# Text of a row whose cells do not fit its header, NULL for other rows.
MALFORMED = "_malformed"


def missing_cells(rows: DataFrame) -> DataFrame:
    """Turn missing-value tokens into NULL in every text column."""
    return rows.select(
        *[
            missing_as_null(f.name).alias(f.name)
            if isinstance(f.dataType, T.StringType) and f.name != MALFORMED
            else F.col(f"`{f.name}`")
            for f in rows.schema.fields
        ]
    )


def scan_raw_prices(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """CSV feed as text columns, extra columns included, missing-value tokens as NULL.

    Nothing is inferred, so ids keep their zeros. Columns are taken by the header of each
    file. A row that does not have as many cells as its header keeps its text in
    ``MALFORMED``; that includes both halves of a row with a line break inside a cell. Set
    ``multiline`` for feeds with such cells: their files cannot be split between tasks.
    """
    return missing_cells(_scan_text(spark, path, multiline))


def stream_arrivals(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """Names of files as they arrive, as a stream; the files themselves are not opened.

    What a file holds is settled by its own header when its micro-batch is landed, so files of
    one stream may have different columns in different orders.
    """
    # Only the path is asked for, so no content is read.
    reader = spark.readStream.format("binaryFile").schema(ARRIVAL).options(**options)
    return reader.load(path).select(F.col("_metadata.file_path").alias("file"))


def with_lineage(rows: DataFrame, batch_id: str) -> DataFrame:
    """Add batch and arrival time to rows that know their source file."""
    return rows.withColumns({"_ingested_at": F.current_timestamp(), "_batch_id": F.lit(batch_id)})


def land_raw(
    spark: SparkSession, source: str | list[str], table: str, batch_id: str, multiline: bool = False
) -> DataFrame:
    """Append a feed file, untouched, to the raw table and return the landed batch.

    Each batch owns one partition, which a retry of the same batch replaces. The headers of
    its files are kept beside the table, see ``landed_headers``.
    """
    write_landed(scan_for_landing(spark, source, table, batch_id, multiline), table, batch_id)
    return landed(spark, table, batch_id)


def scan_for_landing(
    spark: SparkSession, source: str | list[str], table: str, batch_id: str, multiline: bool = False
) -> DataFrame:
    """The rows that ``write_landed`` stores, for callers that watch them on the way."""
    folder = f"{_headers(table)}/_batch_id={batch_id}"
    return with_lineage(_scan_text(spark, source, multiline, folder, traced=True), batch_id)


def write_landed(rows: DataFrame, table: str, batch_id: str) -> None:
    folder = f"{table.rstrip('/')}/_batch_id={batch_id}"
    writer = rows.drop("_batch_id").write.mode("overwrite")
    writer.options(**COMPACT, maxRecordsPerFile=ROWS_PER_FILE).parquet(folder)


def _headers(table: str) -> str:
    return f"{table.rstrip('/')}_headers"


def landed_headers(spark: SparkSession, table: str) -> DataFrame:
    """(file, header, _batch_id) of every file landed in the raw table."""
    schema = T.StructType([*HEADERS.fields, T.StructField("_batch_id", T.StringType())])
    return spark.read.schema(schema).parquet(_headers(table))


def landed(spark: SparkSession, table: str, batch_id: str) -> DataFrame:
    """One landed batch with missing-value tokens as NULL."""
    rows = spark.read.parquet(f"{table.rstrip('/')}/_batch_id={batch_id}")
    return missing_cells(rows).withColumn("_batch_id", F.lit(batch_id))


def _scan_text(
    spark: SparkSession,
    source: str | list[str],
    multiline: bool,
    keep_headers: str | None = None,
    traced: bool = False,
) -> DataFrame:
    try:
        files = spark.read.text(source).inputFiles()
        if len(files) == 1 and not keep_headers:
            return _scan_alike(spark, files, multiline, traced)
        headers = file_headers(spark, files, keep_headers)
        # Rows of kinds of headers. Spark's reader takes its files by name, so the driver has to
        # list them, as Spark itself does.
        kinds = headers.groupBy("header").agg(F.collect_list("file").alias("files")).collect()
        parts = [_scan_alike(spark, sorted(k.files), multiline, traced) for k in sorted(kinds)]
    except AnalysisException as error:
        raise LoadRejected(f"Feed cannot be read: {source}") from error
    if not parts:  # nothing but empty files
        names = [MALFORMED, *(["_source_file"] if traced else [])]
        return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def file_headers(spark: SparkSession, files: list[str], folder: str | None = None) -> DataFrame:
    """(file, header): the first line of every file that has one, stored in ``folder``.

    A task opens each file, takes one line and stops: a limit of one row on a scan that reads
    the file as one split. Nothing else of the feed is read, however large its files are.
    """
    folder = folder or shared_folder(spark, "headers")
    look = spark.newSession()
    for name, value in ONE_LINE.items():
        look.conf.set(name, value)
    mode = "overwrite"
    for at in range(0, len(files), FILES_PER_LOOK):
        firsts = [
            look.read.text(file).limit(1).select(F.lit(file).alias("file"), F.col("value").alias("header"))
            for file in files[at : at + FILES_PER_LOOK]
        ]
        reduce(DataFrame.unionByName, firsts).coalesce(1).write.mode(mode).parquet(folder)
        mode = "append"
    return spark.read.schema(HEADERS).parquet(folder) if files else spark.createDataFrame([], HEADERS)


def _scan_alike(spark: SparkSession, files: list[str], multiline: bool, traced: bool) -> DataFrame:
    """Files that have one header in common; ``traced`` adds the file of each row."""
    names = spark.read.options(**CSV_OPTIONS).csv(files[0]).columns  # reads that one line
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*names, MALFORMED)])
    reader = spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=multiline)
    rows = reader.option("columnNameOfCorruptRecord", MALFORMED).csv(files)
    return rows.select("*", F.col("_metadata.file_path").alias("_source_file")) if traced else rows


def write_raw_files(rows: DataFrame, path: str) -> None:
    """Write a feed in the file format ``scan_raw_prices`` reads, compressed.

    A compressed file is read by one task, so no file gets more than ``ROWS_PER_RAW_FILE`` rows.
    """
    options = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": ROWS_PER_RAW_FILE, **CSV_OPTIONS}
    rows.write.mode("overwrite").options(**options).csv(path)

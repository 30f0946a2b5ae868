"""One query per operator, over the whole order and event feeds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import FeedRejected
from ..operators import cleaning, dimensions, facts, history, market, quality
from ..schema import RAW_COLUMNS, RAW_TO_CLEAN
from ..session import prepare, shared_folder, staged
from ..sources import raw as raw_source
from ..sources.feeds import as_file_feed, event_feed, order_feed
from ..sources.warehouse import Warehouse
from ..streaming.incremental import load_arrivals
from . import ledger, replay
from .pipeline import run_batch, run_pipeline

Query = Callable[[SparkSession, str], DataFrame]

# The day an earlier load of the order feed ended, for queries about a second load.
EARLIER_LOAD = "1998-07-01"
# The same for the event feed.
EARLIER_ARRIVAL = "2024-01-15"


def presented(rows: DataFrame) -> DataFrame:
    """Plain types for comparison: decimals as double, integers as bigint, dates as text."""

    def plain(field: T.StructField) -> object:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            return column.cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        return column

    return rows.select(*[plain(f) for f in rows.schema.fields])


# --- inputs -------------------------------------------------------------------


def order_raw(spark: SparkSession, folder: str, batch: bool = False) -> DataFrame:
    return raw_source.missing_cells(order_feed(spark, folder, batch))


def order_clean(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_stored(staged(order_raw(spark, folder), "raw"))


def order_facts(spark: SparkSession, folder: str) -> DataFrame:
    return facts.named_facts(order_clean(spark, folder), stored=True)


def event_facts(spark: SparkSession, folder: str) -> DataFrame:
    return facts.named_facts(cleaning.clean(raw_source.missing_cells(event_feed(spark, folder))))


def all_sellers(spark: SparkSession, folder: str) -> DataFrame:
    """Merchants with known ids, from the supplier table."""
    return spark.read.parquet(f"{folder}/supplier.parquet").selectExpr(
        "cast(s_suppkey + 1 as int) AS merchant_id",
        "lower(s_name) AS merchant_name",
        "cast(null as timestamp) AS created_at",
        "s_acctbal",
    )


def known_sellers(spark: SparkSession, folder: str) -> DataFrame:
    """A directory that lacks the sellers without credit."""
    return all_sellers(spark, folder).where("s_acctbal > 0").drop("s_acctbal")


def id_facts(spark: SparkSession, folder: str, clean_rows: DataFrame | None = None) -> DataFrame:
    rows = order_clean(spark, folder) if clean_rows is None else clean_rows
    prepared = facts.prepare_facts(rows, all_sellers(spark, folder))
    return facts.distinct_facts(facts.loadable(prepared), stored=True)


def earlier(rows: DataFrame, column: str = "observed_at") -> DataFrame:
    return rows.where(F.col(column) < F.lit(EARLIER_LOAD).cast("timestamp"))


def renamed(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed(RAW_TO_CLEAN)


# --- scans, landing, pipeline ---------------------------------------------------


def scan_raw_prices(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "scan")
    raw_source.write_raw_files(order_feed(spark, folder), path)
    return renamed(raw_source.scan_raw_prices(spark, path).select([f"`{c}`" for c in RAW_COLUMNS]))


def scan_mixed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files that order their columns differently, and rows broken by line breaks in cells."""
    path = shared_folder(spark, "mixed")
    rows = as_file_feed(order_feed(spark, folder))
    turned, broken = F.col("id").like("%3"), F.col("id").like("%7")
    backwards = [F.col(f"`{c}`") for c in reversed(RAW_COLUMNS)]
    raw_source.write_raw_files(rows.where(~turned & ~broken), f"{path}/a")
    raw_source.write_raw_files(rows.where(turned).select(*backwards), f"{path}/b")
    two_lines = rows.where(broken).withColumn("name", F.concat("name", F.lit("\nmore")))
    raw_source.write_raw_files(two_lines, f"{path}/c")
    scanned = raw_source.scan_raw_prices(spark, [f"{path}/{name}" for name in "abc"])
    is_broken = F.col(raw_source.MALFORMED).isNotNull()
    cells = [F.when(~is_broken, F.col(f"`{c}`")).alias(c) for c in RAW_COLUMNS]
    return renamed(scanned.select(*cells, is_broken.alias("malformed")))


def land_raw(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "land")
    raw_source.write_raw_files(order_feed(spark, folder), f"{path}/feed")
    rows = raw_source.land_raw(spark, f"{path}/feed", f"{path}/raw", "day1")
    return rows.groupBy("_batch_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("_ingested_at").alias("stamped_rows"),
        F.count("_source_file").alias("traced_rows"),
        F.count("id").alias("id_rows"),
        F.count("`prices.amountMin`").alias("price_rows"),
        F.count("`prices.merchant`").alias("merchant_rows"),
    )


def pipeline_load(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "pipeline")
    raw_source.write_raw_files(order_feed(spark, folder), f"{path}/feed")
    run_pipeline(spark, f"{path}/feed", f"{path}/store", policy="quarantine")
    stored = Warehouse(spark, f"{path}/store").facts()
    return stored.select(
        "product_id",
        "product_name",
        F.col("merchant_name").alias("merchant"),
        "observed_at",
        "price",
        "price_min",
        "price_max",
        "currency",
        "condition",
        "observed_year",
        "observed_month",
    )


def pipeline_runs(spark: SparkSession, folder: str) -> DataFrame:
    """A strict run, which the feed's bad prices fail, and two that set bad rows aside: the
    second of those has nothing to add."""
    path = shared_folder(spark, "runs")
    raw_source.write_raw_files(order_feed(spark, folder), f"{path}/feed")
    try:
        run_pipeline(spark, f"{path}/feed", f"{path}/store", policy="strict")
    except FeedRejected:
        pass  # the ledger has it
    for _ in range(2):
        run_pipeline(spark, f"{path}/feed", f"{path}/store", policy="quarantine")
    runs = ledger.RunLedger(spark, f"{path}/store").runs()
    return runs.select("run_id", "status", *ledger.COUNTS)


# --- cleaning ---------------------------------------------------------------------


def select_business_columns(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.select_business_columns(order_raw(spark, folder, batch=True))


def dedup_exact(spark: SparkSession, folder: str) -> DataFrame:
    return renamed(cleaning.dedup_exact(order_raw(spark, folder)))


def filter_invalid_prices(spark: SparkSession, folder: str) -> DataFrame:
    rows = cleaning.select_business_columns(cleaning.dedup_exact(order_raw(spark, folder)))
    parsed = cleaning.parse_prices(rows).where("reject_reason is null")
    return parsed.select("product_id", "price_min", "price_max", "currency", "date_seen")


def filter_invalid_dates(spark: SparkSession, folder: str) -> DataFrame:
    return order_clean(spark, folder).select(
        "product_id",
        "merchant",
        "date_seen",
        "price",
        "observed_date",
        "observed_year",
        "observed_month",
    )


def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    rows = cleaning.rejected(cleaning.observe(order_raw(spark, folder)))
    return rows.select(
        "product_id",
        "merchant",
        *cleaning.TEXT_KEPT,
        "reject_stage",
        "reject_reason",
    )


def transform_accounting(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.transform_accounting(order_raw(spark, folder))


def sorted_observations(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.sorted_observations(staged(order_clean(spark, folder), "clean"))


# --- quality ------------------------------------------------------------------------


def missing_columns(spark: SparkSession, folder: str) -> DataFrame:
    return quality.column_presence(order_raw(spark, folder).drop("prices.condition"))


def missing_by_column(spark: SparkSession, folder: str) -> DataFrame:
    return quality.missing_by_column(order_raw(spark, folder))


def type_conformance(spark: SparkSession, folder: str) -> DataFrame:
    return quality.type_conformance(order_raw(spark, folder))


def duplicate_count(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_count(order_raw(spark, folder))


def validation_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.validation_report(order_raw(spark, folder), allow_duplicates=False)


def quality_by_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The reports that real runs stored, batch by batch."""
    return _reports(spark, folder).drop("batch")


def quality_trend(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_trend(_reports(spark, folder), over=2)


def _reports(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.json(f"{_real_runs(spark, folder)}/reports")


def _unchecked(spark: SparkSession, folder: str) -> DataFrame:
    """Parsed observations before any filter, as facts would look without cleaning."""
    rows = cleaning.select_business_columns(cleaning.dedup_exact(order_raw(spark, folder)))
    parsed = cleaning.explode_dates(cleaning.parse_prices(rows)).withColumns(
        {
            "currency": F.upper("currency"),
            "merchant": F.lower("merchant"),
            "price": (F.col("price_min") + F.col("price_max")) / 2,
            "observed_at": F.col("date_seen"),
        }
    )
    return dimensions.map_merchant_ids(parsed, known_sellers(spark, folder))


def load_gate(spark: SparkSession, folder: str) -> DataFrame:
    return quality.load_gate(_unchecked(spark, folder))


# Changes that break every declared constraint somewhere, in SQL that both engines know.
BROKEN_PRODUCT = """CASE WHEN product_id LIKE '%99' THEN repeat(product_id, 100)
    WHEN product_id LIKE '%98' THEN NULL ELSE product_id END AS product_id"""
BROKEN_NAMES = """CASE WHEN product_id LIKE '%5' THEN NULL ELSE product_name END AS product_name,
    CASE WHEN product_id LIKE '%7' THEN repeat(brand, 40) ELSE brand END AS brand"""
BROKEN_MERCHANT = """CASE WHEN product_id LIKE '%3' THEN repeat(merchant, 40) ELSE merchant END AS merchant_name,
    merchant_id"""
BROKEN_FACT = """CASE WHEN product_id LIKE '%6' THEN NULL ELSE CAST(substr(product_id, 2) AS BIGINT) % 1000 END AS price_id,
    CASE WHEN product_id LIKE '%1' THEN repeat(currency, 4) ELSE currency END AS currency,
    CASE WHEN product_id LIKE '%2' THEN repeat(condition, 40) ELSE condition END AS condition,
    CASE WHEN product_id LIKE '%4' THEN -price_max ELSE price_max END AS price_max,
    merchant_id, price_min, price, observed_at"""
BROKEN_RUN = """nullif(user_id % 700, 13) AS run_id,
    CASE WHEN user_id % 5 = 0 THEN NULL ELSE CAST(ts AS TIMESTAMP) END AS started_at,
    CASE WHEN user_id % 7 = 0 THEN NULL ELSE CAST(ts AS TIMESTAMP) + (user_id % 3 - 1) * INTERVAL '1' HOUR END AS completed_at,
    CASE user_id % 6 WHEN 0 THEN NULL WHEN 1 THEN repeat(event_type, 20) WHEN 2 THEN 'RUNNING' WHEN 3 THEN 'FAILED'
      ELSE 'SUCCESS' END AS status,
    CAST(floor(value) AS BIGINT) - 10 AS records_received, CAST(floor(value) AS BIGINT) - 20 AS records_validated,
    CAST(floor(value) AS BIGINT) - 30 AS records_transformed, CAST(floor(value) AS BIGINT) - 40 AS records_loaded"""


def _exprs(rows: DataFrame, *parts: str) -> DataFrame:
    rows.createOrReplaceTempView("broken_rows")
    return rows.sparkSession.sql(f"SELECT {', '.join(parts)} FROM broken_rows")


def constraint_violations(spark: SparkSession, folder: str) -> DataFrame:
    rows = staged(_unchecked(spark, folder), "constraints")
    products = _exprs(rows.where("reject_reason is null"), BROKEN_PRODUCT, BROKEN_NAMES).distinct()
    merchants = _exprs(rows, BROKEN_MERCHANT)
    prices = _exprs(rows, BROKEN_PRODUCT, BROKEN_FACT)
    runs = _exprs(spark.read.parquet(f"{folder}/events.parquet"), BROKEN_RUN)
    return quality.constraint_violations(prices, products, merchants, runs)


def fk_orphans(spark: SparkSession, folder: str) -> DataFrame:
    clean_rows = staged(order_clean(spark, folder), "orphans")
    rows = id_facts(spark, folder, clean_rows)
    # The product table lacks every tenth part.
    products = clean_rows.where("product_id not like '%7'").select("product_id").distinct()
    return quality.fk_orphans(rows, products, known_sellers(spark, folder))


# --- dimensions -----------------------------------------------------------------------


def dim_products(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.dim_products(order_clean(spark, folder))


def dim_merchants(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.dim_merchants(order_clean(spark, folder))


def products_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Small parts are stored already, under their type as name; the whole feed updates them."""
    stored = spark.read.parquet(f"{folder}/part.parquet").where("p_size <= 25").selectExpr(
        "concat('P', cast(p_partkey as string)) AS product_id",
        "p_type AS product_name",
        "p_brand AS brand",
        "'unsorted' AS category",
        "timestamp '1995-01-01' AS created_at",
        "timestamp '1995-01-01' AS updated_at",
    )
    now = F.lit("2002-01-01").cast("timestamp")
    products = dimensions.dim_products(order_clean(spark, folder))
    return dimensions.upsert_products(stored, products, now)


def merchants_merge(spark: SparkSession, folder: str) -> DataFrame:
    stored = known_sellers(spark, folder)
    names = staged(dimensions.dim_merchants(order_clean(spark, folder)), "merchants")
    merged = dimensions.merge_merchants(stored, names)
    highest = stored.agg(F.max("merchant_id")).scalar()
    flagged = merged.withColumn("is_new", F.col("merchant_id") > highest)
    # New ids are generated, so only stored ones are shown.
    return flagged.select(
        "merchant_name",
        "is_new",
        F.when(F.col("is_new"), F.lit(-1)).otherwise(F.col("merchant_id")).alias("stored_id"),
    )


def merchants_new_ids(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of generated ids: they follow the highest stored one without a gap."""
    stored = known_sellers(spark, folder)
    names = dimensions.dim_merchants(order_clean(spark, folder))
    return dimensions.new_merchants(stored, names).agg(
        F.count("merchant_name").alias("new_merchants"),
        F.countDistinct("merchant_id").alias("new_ids"),
        F.min("merchant_id").alias("first_id"),
        F.max("merchant_id").alias("last_id"),
    )


def map_merchant_id(spark: SparkSession, folder: str) -> DataFrame:
    rows = dimensions.map_merchant_ids(order_clean(spark, folder), known_sellers(spark, folder))
    return rows.select(
        "product_id",
        F.coalesce("merchant", F.lit("")).alias("merchant"),
        "date_seen",
        "price",
        F.coalesce("merchant_id", F.lit(-1)).alias("merchant_id"),
    )


def reject_unmapped_merchant(spark: SparkSession, folder: str) -> DataFrame:
    rows = facts.prepare_facts(order_clean(spark, folder), known_sellers(spark, folder))
    return rows.where("reject_reason = 'merchant_unmapped'").select(
        "product_id",
        F.coalesce("merchant", F.lit("")).alias("merchant"),
        "observed_at",
        "price",
        "reject_stage",
        "reject_reason",
    )


def reject_overlong_text(spark: SparkSession, folder: str) -> DataFrame:
    """Currency and condition are lengthened with the year and month they were seen."""
    rows = order_clean(spark, folder).withColumns(
        {
            "currency": F.expr("repeat(currency, if(observed_year >= 1999, 4, 1))"),
            "condition": F.expr("repeat(condition, observed_month * 3)"),
        }
    )
    prepared = facts.prepare_facts(rows, all_sellers(spark, folder))
    kept = F.coalesce("reject_reason", F.lit("kept")).alias("outcome")
    return prepared.groupBy(kept).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.max(F.length("currency")).alias("longest_currency"),
        F.max(F.length("condition")).alias("longest_condition"),
    )


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.dim_date(order_facts(spark, folder))


def product_search(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.product_search(dim_products(spark, folder), "RING")


# --- facts ------------------------------------------------------------------------------


def price_history_load(spark: SparkSession, folder: str) -> DataFrame:
    return id_facts(spark, folder)


def price_history_reload(spark: SparkSession, folder: str) -> DataFrame:
    """The whole feed again after an earlier load: only later observations are new."""
    rows = staged(id_facts(spark, folder), "reload")
    return facts.new_facts(rows, earlier(rows))


def load_accounting(spark: SparkSession, folder: str) -> DataFrame:
    prepared = facts.prepare_facts(order_clean(spark, folder), all_sellers(spark, folder))
    incoming = staged(facts.loadable(prepared), "accounting")
    rows = facts.distinct_facts(incoming)
    return facts.load_accounting(incoming, rows, earlier(rows))


def price_facts_star(spark: SparkSession, folder: str) -> DataFrame:
    clean_rows = staged(order_clean(spark, folder), "star")
    rows = staged(id_facts(spark, folder, clean_rows), "star")
    products = dimensions.dim_products(clean_rows)
    joined = facts.star(rows, products, all_sellers(spark, folder), dimensions.dim_date(rows))
    return joined.groupBy("brand", "merchant_name", "observed_year", "quarter", "is_weekend").agg(
        F.count(F.lit(1)).alias("observations"),
        F.sum("price").alias("total_price"),
    )


# --- price questions -----------------------------------------------------------------------


def sliced(operator: Callable[..., DataFrame], rows_per_task: int) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: operator(rows, rows_per_task=rows_per_task)


def _of_orders(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(order_facts(spark, folder))


def _of_events(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(event_facts(spark, folder))


def _of_order_groups(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(staged(order_facts(spark, folder), "facts"))


def _of_event_groups(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(staged(event_facts(spark, folder), "facts"))


# --- runs -----------------------------------------------------------------------------------


# Stores that several queries look at, made once per application and folder.
_STORES: dict[tuple[str, str, str], str] = {}


def _store(make: Callable[[SparkSession, str, str], None]) -> Callable[[SparkSession, str], str]:
    def stored(spark: SparkSession, folder: str) -> str:
        key = (make.__name__, spark.sparkContext.applicationId, folder)
        root = _STORES.get(key)
        if root is None or Warehouse(spark, root).commits().isEmpty():
            path = shared_folder(spark, "store")
            make(spark, folder, path)
            root = _STORES[key] = f"{path}/store"
        return root

    return stored


@_store
def _real_runs(spark: SparkSession, folder: str, path: str) -> None:
    """The order feed in four files of two ship years each, every other one under strict checks."""
    rows = order_feed(spark, folder, batch=True)
    part = F.expr("greatest(0, least(3, floor((year(cast(_batch_id as date)) - 1994) / 2)))")
    for k in range(4):
        raw_source.write_raw_files(as_file_feed(rows.where(part == k)), f"{path}/feed{k}")
        try:
            run_pipeline(spark, f"{path}/feed{k}", f"{path}/store", policy="quarantine" if k % 2 else "strict")
        except FeedRejected:
            pass  # the ledger has it


def run_ledger(spark: SparkSession, folder: str) -> DataFrame:
    runs = ledger.RunLedger(spark, _real_runs(spark, folder)).runs()
    failure = F.split_part("error_message", F.lit(":"), F.lit(1)).alias("failure")
    ended = (F.col("completed_at") >= F.col("started_at")).alias("ended")
    return runs.select("run_id", "status", *ledger.COUNTS, failure, ended)


def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.run_summary(ledger.RunLedger(spark, _real_runs(spark, folder)).runs())


def runs_recovered(spark: SparkSession, folder: str) -> DataFrame:
    """A run that is killed after it landed its feed, and the next one, which finds it open."""
    path = shared_folder(spark, "killed")
    raw_source.write_raw_files(order_feed(spark, folder), f"{path}/feed")

    def scan(name: str) -> DataFrame:
        raw_source.land_raw(spark, f"{path}/feed", f"{path}/store/raw", name)
        raise SystemExit

    try:
        run_batch(spark, f"{path}/store", scan, policy="quarantine")
    except SystemExit:
        pass  # nothing could be written any more
    run_pipeline(spark, f"{path}/feed", f"{path}/store", policy="quarantine")
    runs = ledger.RunLedger(spark, f"{path}/store").runs()
    return runs.select("run_id", "status", *ledger.COUNTS, "error_message")


# The second load brings products under new names.
@_store
def _two_loads(spark: SparkSession, folder: str, path: str) -> None:
    clean_rows = staged(order_clean(spark, folder), "clean")
    first = F.col("date_seen") < F.lit(EARLIER_LOAD).cast("timestamp")
    store = Warehouse(spark, f"{path}/store")
    store.load(clean_rows.where(first))
    store.load(clean_rows.where(~first).withColumn("product_name", F.upper("product_name")))
    store.compact_products()


def products_appended(spark: SparkSession, folder: str) -> DataFrame:
    """Products after two loads and a compaction; those of both loads were updated."""
    products = Warehouse(spark, _two_loads(spark, folder)).products()
    updated = (F.col("updated_at") > F.col("created_at")).alias("updated")
    return products.select("product_id", "product_name", "brand", "category", updated)


def price_ids(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of generated ids: from 1 on, without gaps, across loads."""
    return Warehouse(spark, _two_loads(spark, folder)).price_history().groupBy("load").agg(
        F.count(F.lit(1)).alias("facts"),
        F.countDistinct("price_id").alias("ids"),
        F.min("price_id").alias("first_id"),
        F.max("price_id").alias("last_id"),
    )


def rejects_replayed(spark: SparkSession, folder: str) -> DataFrame:
    """Swapped prices are turned, negative ones take the other price; a second replay adds nothing."""
    path = shared_folder(spark, "replay")
    root = f"{path}/store"
    raw_source.write_raw_files(order_feed(spark, folder), f"{path}/feed")
    run_pipeline(spark, f"{path}/feed", root, policy="quarantine")
    low, high = F.col("`prices.amountMin`"), F.col("`prices.amountMax`")
    repairs = {
        "price_range": {"prices.amountMin": high, "prices.amountMax": low},
        "price_negative": {"prices.amountMin": high},
    }
    for _ in range(2):
        replay.replay_rejects(spark, root, repairs)
    states = replay.reject_states(spark, root).groupBy("reject_reason")
    counted = states.agg(F.count(F.lit(1)).alias("rejects"), F.count("run_id").alias("loaded"))
    stored = Warehouse(spark, root).price_history().agg(F.count(F.lit(1))).scalar()
    return counted.withColumn("stored_facts", stored)


# --- streaming -----------------------------------------------------------------------------------


def _arrive(rows: DataFrame, path: str, name: str) -> None:
    raw_source.write_raw_files(as_file_feed(rows), f"{path}/feed/{name}")


def _stored(spark: SparkSession, root: str) -> DataFrame:
    return Warehouse(spark, root).facts().select(
        "product_id",
        F.col("merchant_name").alias("merchant"),
        "observed_at",
        "price",
        "currency",
        "condition",
    )


def incremental_load(spark: SparkSession, folder: str) -> DataFrame:
    """Files arrive in two parts; the second start of the stream takes only the new ones."""
    path = shared_folder(spark, "incremental")
    rows = event_feed(spark, folder)
    first = F.col("`prices.dateSeen`") < EARLIER_ARRIVAL
    for name, part in {"a": rows.where(first), "b": rows.where(~first)}.items():
        _arrive(part, path, name)
        load_arrivals(spark, f"{path}/feed", f"{path}/store").awaitTermination()
    return _stored(spark, f"{path}/store")


def incremental_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Everything arrives, then the earlier part again in new files: nothing is added."""
    path = shared_folder(spark, "replay")
    rows = event_feed(spark, folder)
    first = F.col("`prices.dateSeen`") < EARLIER_ARRIVAL
    for name, part in {"a": rows, "b": rows.where(first)}.items():
        _arrive(part, path, name)
        load_arrivals(spark, f"{path}/feed", f"{path}/store").awaitTermination()
    return _stored(spark, f"{path}/store")


def incremental_mixed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of one stream that order their columns differently, some in one micro-batch."""
    path = shared_folder(spark, "turning")
    rows = as_file_feed(event_feed(spark, folder))
    first, odd = F.col("`prices.dateSeen`") < EARLIER_ARRIVAL, F.col("id").rlike("[13579]$")
    backwards = [F.col(f"`{c}`") for c in reversed(RAW_COLUMNS)]
    for name, part in {"a": rows.where(first), "b": rows.where(~first)}.items():
        raw_source.write_raw_files(part.where(odd), f"{path}/feed/{name}1")
        raw_source.write_raw_files(part.where(~odd).select(*backwards), f"{path}/feed/{name}2")
        load_arrivals(spark, f"{path}/feed", f"{path}/store").awaitTermination()
    return _stored(spark, f"{path}/store")


def _order_arrivals(spark: SparkSession, folder: str) -> str:
    """The store after the order feed arrived in two parts, products apart."""
    path = shared_folder(spark, "arrivals")
    rows = order_feed(spark, folder)
    first = F.col("id").rlike("[0-4]$")
    for name, part in {"a": rows.where(first), "b": rows.where(~first)}.items():
        _arrive(part, path, name)
        load_arrivals(spark, f"{path}/feed", f"{path}/store").awaitTermination()
    return f"{path}/store"


def incremental_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Rejects of all micro-batches."""
    rows = spark.read.parquet(f"{_order_arrivals(spark, folder)}/failed")
    names = ["product_id", "merchant", *cleaning.TEXT_KEPT, "reject_stage", "reject_reason"]
    return rows.select(*names)


def incremental_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Each micro-batch is a run of its own."""
    runs = ledger.RunLedger(spark, _order_arrivals(spark, folder)).runs()
    return runs.select("run_id", "status", *ledger.COUNTS)


QUERIES: dict[str, Query] = {
    "scan_raw_prices": scan_raw_prices,
    "scan_mixed_files": scan_mixed_files,
    "land_raw": land_raw,
    "select_business_columns": select_business_columns,
    "dedup_exact": dedup_exact,
    "filter_invalid_prices": filter_invalid_prices,
    "filter_invalid_dates": filter_invalid_dates,
    "quarantine": quarantine,
    "transform_accounting": transform_accounting,
    "sorted_observations": sorted_observations,
    "missing_columns": missing_columns,
    "missing_by_column": missing_by_column,
    "type_conformance": type_conformance,
    "duplicate_count": duplicate_count,
    "validation_report": validation_report,
    "quality_by_batch": quality_by_batch,
    "quality_trend": quality_trend,
    "load_gate": load_gate,
    "constraint_violations": constraint_violations,
    "fk_orphans": fk_orphans,
    "dim_products": dim_products,
    "dim_merchants": dim_merchants,
    "products_upsert": products_upsert,
    "merchants_merge": merchants_merge,
    "merchants_new_ids": merchants_new_ids,
    "map_merchant_id": map_merchant_id,
    "reject_unmapped_merchant": reject_unmapped_merchant,
    "reject_overlong_text": reject_overlong_text,
    "dim_date": dim_date,
    "product_search": product_search,
    "price_history_load": price_history_load,
    "price_history_reload": price_history_reload,
    "load_accounting": load_accounting,
    "price_facts_star": price_facts_star,
    "current_price": _of_orders(history.current_price),
    "cheapest_merchant": _of_orders(market.cheapest_merchant),
    "competitor_comparison": _of_orders(market.competitor_comparison),
    "avg_competitor_price": _of_orders(market.avg_competitor_price),
    "avg_price_across_competitors": _of_orders(market.avg_price_across_competitors),
    "price_trend_monthly": _of_orders(lambda rows: history.price_trend(rows, "month")),
    "price_trend_daily": _of_orders(lambda rows: history.price_trend(rows, "day")),
    "lowest_recorded_price": _of_orders(history.lowest_recorded_price),
    "highest_recorded_price": _of_orders(history.highest_recorded_price),
    "price_history_view": _of_order_groups(history.price_history_view),
    "price_change_feed": _of_order_groups(history.price_change),
    "previous_price": _of_event_groups(history.previous_price),
    "price_change": _of_event_groups(history.price_change),
    "price_change_points": _of_event_groups(history.price_change_points),
    "price_change_frequency": _of_event_groups(history.change_frequency),
    "price_fluctuation": _of_event_groups(history.price_fluctuation),
    # The same questions with groups cut into slices, as on a table with very busy groups.
    "cheapest_merchant_sliced": _of_orders(market.cheapest_merchant),  # has no groups to cut
    "competitor_comparison_sliced": _of_orders(sliced(market.competitor_comparison, 2)),
    "price_change_feed_sliced": _of_order_groups(sliced(history.price_change, 2)),
    "previous_price_sliced": _of_event_groups(sliced(history.previous_price, 20)),
    "price_fluctuation_sliced": _of_event_groups(sliced(history.price_fluctuation, 20)),
    "top_price_increases": _of_orders(history.top_price_increases),
    "top_price_decreases": _of_orders(history.top_price_decreases),
    "top_price_increases_since_first": _of_events(
        lambda rows: history.top_price_increases(rows, basis="first")
    ),
    "run_ledger": run_ledger,
    "run_summary": run_summary,
    "pipeline_load": pipeline_load,
    "pipeline_runs": pipeline_runs,
    "runs_recovered": runs_recovered,
    "products_appended": products_appended,
    "price_ids": price_ids,
    "rejects_replayed": rejects_replayed,
    "incremental_load": incremental_load,
    "incremental_replay": incremental_replay,
    "incremental_mixed_files": incremental_mixed_files,
    "incremental_rejects": incremental_rejects,
    "incremental_runs": incremental_runs,
}


def registered() -> dict[str, Query]:
    """The queries with session settings applied and results in plain types."""

    def bound(query: Query) -> Query:
        return lambda spark, folder: presented(query(prepare(spark), folder))

    return {name: bound(query) for name, query in QUERIES.items()}

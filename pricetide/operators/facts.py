"""Clean observations to warehouse facts, loaded once however often they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fill_blank, to_money
from ..schema import CONDITION_WIDTH, CURRENCY_WIDTH, LOAD_KEY
from ..session import staged
from .dimensions import map_merchant_ids
from .quality import require_columns
from .rows import HASHES_SENT, settle, with_copies

REQUIRED = [
    "product_id",
    "merchant",
    "price_min",
    "price_max",
    "price",
    "currency",
    "condition",
    "date_seen",
]


def load_problem(merchant: Column) -> Column:
    """Why a prepared row cannot become a fact, NULL when it can."""
    no_price = F.col("price_min").isNull() | F.col("price_max").isNull() | F.col("price").isNull()
    return (
        F.when(F.col("product_id") == "", "product_missing")
        .when(merchant.isNull(), "merchant_unmapped")
        .when(F.col("observed_at").isNull(), "date_invalid")
        .when(F.length("currency") > CURRENCY_WIDTH, "currency_too_long")
        .when(F.length("condition") > CONDITION_WIDTH, "condition_too_long")
        .when(no_price, "price_invalid")
    )


def _typed(rows: DataFrame) -> DataFrame:
    return rows.withColumnRenamed("date_seen", "observed_at").withColumns(
        {
            "product_id": fill_blank(F.col("product_id")),
            "currency": fill_blank(F.col("currency")),
            "condition": fill_blank(F.col("condition")),
            "price_min": to_money(F.col("price_min")),
            "price_max": to_money(F.col("price_max")),
            "price": to_money(F.col("price")),
        }
    )


def prepare_facts(clean_rows: DataFrame, merchants: DataFrame) -> DataFrame:
    """Every clean row typed for the warehouse, with the reason when it must be rejected."""
    require_columns(clean_rows, REQUIRED)
    typed = _typed(map_merchant_ids(clean_rows.select(*REQUIRED), merchants))
    judged = typed.withColumn("reject_reason", load_problem(F.col("merchant_id")))
    return settle(judged, "reject_reason").withColumn(
        "reject_stage", F.when(F.col("reject_reason").isNotNull(), F.lit("load"))
    )


def loadable(prepared: DataFrame) -> DataFrame:
    return prepared.where(F.col("reject_reason").isNull()).drop("reject_reason", "reject_stage")


def distinct_facts(
    rows: DataFrame, merchant: str = "merchant_id", carry: Sequence[str] = (), stored: bool = False
) -> DataFrame:
    """One row per load key. Every other fact column follows from the key.

    ``stored`` rows are cheap to read twice: only those whose key may recur are shuffled.
    """
    return dated(distinct_keys(rows, merchant, carry, stored))


def distinct_keys(
    rows: DataFrame, merchant: str = "merchant_id", carry: Sequence[str] = (), stored: bool = False
) -> DataFrame:
    """``distinct_facts`` without the columns that follow from the key, which need not be shuffled."""
    key = [merchant if c == "merchant_id" else c for c in LOAD_KEY]
    keys = rows.select(*key, *carry)
    return with_copies(keys, keys.columns).drop("_copies") if stored else keys.distinct()


def dated(keys: DataFrame) -> DataFrame:
    """Load keys with the columns that follow from them."""
    at = F.col("observed_at")
    return keys.withColumns(
        {
            "observed_date": F.to_date(at),
            "observed_year": F.year(at),
            "observed_month": F.month(at),
        }
    )


def named_facts(clean_rows: DataFrame, carry: Sequence[str] = (), stored: bool = False) -> DataFrame:
    """Facts under merchant names instead of ids, for analysis without a warehouse."""
    typed = _typed(clean_rows.select(*REQUIRED, *carry)).withColumn(
        "merchant", F.nullif(fill_blank(F.col("merchant")), F.lit(""))
    )
    judged = settle(typed.withColumn("reject_reason", load_problem(F.col("merchant"))), "reject_reason")
    return distinct_facts(judged.where(F.col("reject_reason").isNull()), "merchant", carry, stored)


def new_facts(facts: DataFrame, stored: DataFrame) -> DataFrame:
    """Facts whose load key is not stored yet.

    Hashes of the keys are compared first. That join may broadcast the batch where Catalyst
    finds it small, and the store is then read but not shuffled. Facts whose hash is not stored
    are new; only the others and the stored keys of those hashes are compared as a whole. Where
    more hashes are in both than tasks should be sent, all keys are compared. Give ``stored`` cut
    down to the months of the batch, and ``facts`` as a stored table, as both are read twice.
    """
    key_hash = F.xxhash64(*LOAD_KEY).alias("_hash")
    known = stored.select(*LOAD_KEY)
    both = known.select(key_hash).join(facts.select(key_hash), "_hash", "left_semi").distinct()
    hashes = staged(both, "both")
    found = hashes.count()
    if not found:
        return facts
    if found > HASHES_SENT:
        return facts.join(known, LOAD_KEY, "left_anti")
    sent = F.broadcast(hashes)
    hashed = facts.select("*", key_hash)
    unseen = hashed.join(sent, "_hash", "left_anti").drop("_hash")
    hits = known.select("*", key_hash).join(sent, "_hash", "left_semi").drop("_hash")
    seen = hashed.join(sent, "_hash", "left_semi").drop("_hash")
    return unseen.unionByName(seen.join(hits, LOAD_KEY, "left_anti").select(*facts.columns))


def load_accounting(facts_in: DataFrame, facts: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows received, inserted and skipped when ``facts`` are loaded onto ``stored``."""
    inserted = new_facts(facts, stored).agg(F.count(F.lit(1)))
    received = facts_in.agg(F.count(F.lit(1)).alias("received"))
    return received.withColumn("inserted", inserted.scalar()).withColumn(
        "skipped", F.col("received") - F.col("inserted")
    )


def star(
    facts: DataFrame, products: DataFrame, merchants: DataFrame, dates: DataFrame | None = None
) -> DataFrame:
    """Facts with their product, merchant and (optionally) calendar attributes.

    Inner joins without hints: Catalyst broadcasts each dimension that is small enough.
    """
    joined = facts.join(
        products.select("product_id", "product_name", "brand", "category"), "product_id"
    ).join(merchants.select("merchant_id", "merchant_name"), "merchant_id")
    if dates is not None:
        joined = joined.join(
            dates.select(
                F.col("calendar_date").alias("observed_date"), "quarter", "day_of_week", "is_weekend"
            ),
            "observed_date",
        )
    return joined

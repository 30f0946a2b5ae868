"""Product, merchant and date dimensions, and how a batch changes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fill_blank
from .quality import require_columns

# New names are numbered inside this many hash buckets.
ID_BUCKETS = 1024


def _missing_last(name: str) -> list[Column]:
    return [F.col(name).isNull().alias(f"{name}_missing"), F.col(name)]


def dim_products(clean_rows: DataFrame) -> DataFrame:
    """One row per product: the first in (product, merchant, time) order, missing last.

    Name, brand and category break ties. A minimum over a struct combines map-side, so
    a product seen very often costs one row per task.
    """
    require_columns(clean_rows, ["product_id", "product_name", "brand", "category"])
    order = [
        part
        for name in ["merchant", "date_seen", "product_name", "brand", "category"]
        for part in _missing_last(name)
    ]
    first = clean_rows.groupBy(fill_blank(F.col("product_id")).alias("product_id")).agg(
        F.min(F.struct(*order)).alias("first")
    )
    return first.where(F.col("product_id") != "").select(
        "product_id",
        *[fill_blank(F.col(f"first.{c}")).alias(c) for c in ["product_name", "brand", "category"]],
    )


def dim_merchants(clean_rows: DataFrame) -> DataFrame:
    """Distinct merchant names without blanks."""
    require_columns(clean_rows, ["merchant"])
    names = clean_rows.select(fill_blank(F.col("merchant")).alias("merchant_name"))
    return names.where(F.col("merchant_name") != "").distinct()


def upsert_products(stored: DataFrame, batch: DataFrame, now: Column | None = None) -> DataFrame:
    """Stored products with a batch applied: every match overwritten, history not kept.

    ``change`` tells inserted, updated and untouched rows apart.
    """
    now = F.current_timestamp() if now is None else now
    new = batch.select(
        "product_id",
        *[F.col(c).alias(f"new_{c}") for c in ["product_name", "brand", "category"]],
        F.lit(True).alias("in_batch"),
    )
    old = stored.withColumn("in_stored", F.lit(True))
    joined = old.join(new, "product_id", "full_outer")
    fresh = F.col("in_batch").isNotNull()
    return joined.select(
        "product_id",
        *[
            F.when(fresh, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c)
            for c in ["product_name", "brand", "category"]
        ],
        F.coalesce("created_at", now).alias("created_at"),
        F.when(fresh, now).otherwise(F.col("updated_at")).alias("updated_at"),
        F.when(F.col("in_stored").isNull(), "inserted")
        .when(fresh, "updated")
        .otherwise("untouched")
        .alias("change"),
    )


def new_merchants(
    stored: DataFrame, names: DataFrame, now: Column | None = None, first_id: int | None = None
) -> DataFrame:
    """Merchants of a batch that are not stored yet, with the next free ids.

    Ids run on from the highest stored id without gaps. Names are numbered inside hash
    buckets and each bucket starts where the one before ends; only the bucket totals,
    at most ID_BUCKETS rows, meet in one task. The ids depend on the names alone, so a
    recomputed partition gives the same ones. Pass ``first_id`` when it is known.
    """
    now = F.current_timestamp() if now is None else now
    absent = names.select("merchant_name").join(
        stored.select("merchant_name"), "merchant_name", "left_anti"
    )
    bucketed = absent.withColumn("_b", F.pmod(F.xxhash64("merchant_name"), F.lit(ID_BUCKETS)))
    in_bucket = F.row_number().over(Window.partitionBy("_b").orderBy("merchant_name"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        bucketed.groupBy("_b")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    numbered = bucketed.withColumn("_i", in_bucket).join(F.broadcast(starts), "_b")
    if first_id is None:
        base = stored.agg(F.coalesce(F.max("merchant_id"), F.lit(0))).scalar()
    else:
        base = F.lit(first_id - 1)
    return numbered.select(
        (base + F.col("_start") + F.col("_i")).cast("int").alias("merchant_id"),
        "merchant_name",
        now.alias("created_at"),
    )


def merge_merchants(stored: DataFrame, names: DataFrame, now: Column | None = None) -> DataFrame:
    """Stored merchants plus the new ones of a batch; stored ids never change."""
    return stored.select("merchant_id", "merchant_name", "created_at").unionByName(
        new_merchants(stored, names, now)
    )


def map_merchant_ids(clean_rows: DataFrame, merchants: DataFrame) -> DataFrame:
    """Add ``merchant_id``, NULL where the merchant is blank or not known.

    Catalyst broadcasts the merchants while they are below its broadcast threshold and
    otherwise shuffles both sides, where the adaptive skew join splits a busy merchant.
    Blank merchants can match nothing; the second key spreads them over all tasks.
    """
    named = F.nullif(fill_blank(F.col("merchant")), F.lit(""))
    rows = clean_rows.withColumns(
        {
            "_name": named,
            "_spread": F.when(named.isNull(), F.xxhash64("product_id", "date_seen")).otherwise(
                F.lit(0).cast("bigint")
            ),
        }
    )
    lookup = merchants.select(
        F.col("merchant_name").alias("_name"),
        F.lit(0).cast("bigint").alias("_spread"),
        "merchant_id",
    )
    return rows.join(lookup, ["_name", "_spread"], "left").drop("_name", "_spread")


def dim_date(facts: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last observation, with its parts.

    The parser bounds observation times, so there are at most 213,504 days.
    """
    span = facts.agg(
        F.min(F.to_date("observed_at")).alias("first"),
        F.max(F.to_date("observed_at")).alias("last"),
    ).where(F.col("first").isNotNull())
    days = span.select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("calendar_date")
    )
    day = F.col("calendar_date")
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.day(day).alias("day"),
        (F.weekday(day) + 1).alias("day_of_week"),
        F.weekday(day).isin(5, 6).alias("is_weekend"),
    )


def product_search(products: DataFrame, text: str) -> DataFrame:
    """Products whose name, brand or category contains a text, in any case."""
    needle = F.lower(F.lit(text))
    return products.where(
        F.lower("product_name").contains(needle)
        | F.lower("brand").contains(needle)
        | F.lower("category").contains(needle)
    )

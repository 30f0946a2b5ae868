"""Comparison of merchants that offer the same product now."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .history import MARKET, current_price, mean, offer, percent
from .skew import flagged, heavy_groups, with_total_before


def current_offers(facts: DataFrame, merchant: str) -> DataFrame:
    """Current price of every offer, stored: the history is read once, and what follows counts
    and compares one row per offer."""
    return staged(current_price(facts, merchant), "offers")


def cheapest_merchant(facts: DataFrame, merchant: str = "merchant") -> DataFrame:
    """Merchants with the lowest current price of each product; all ties are kept.

    The minimum of a product combines before the shuffle and is joined back, so no task ever
    holds a product with all its merchants.
    """
    now = current_offers(facts, merchant)
    lowest = now.groupBy(*MARKET).agg(F.min("price").alias("price"))
    return now.join(lowest, [*MARKET, "price"]).select(*offer(merchant), "price", "observed_at")


def market_position(facts: DataFrame, merchant: str = "merchant", **limits: int) -> DataFrame:
    """Each current offer with the size, sum and minimum of its market and its price rank."""
    whole = Window.partitionBy(*MARKET)

    def windowed(rows: DataFrame) -> DataFrame:
        return rows.withColumns(
            {
                "offers": F.count(F.lit(1)).over(whole),
                "total": F.sum("price").over(whole),
                "lowest": F.min("price").over(whole),
                "price_rank": F.rank().over(whole.orderBy("price")).cast("bigint"),
            }
        )

    # A market has no more offers than observations, so where these fit, nothing is to be cut.
    if heavy_groups(facts, MARKET, **limits) is None:
        return windowed(current_price(facts, merchant))
    now = current_offers(facts, merchant)
    heavy = heavy_groups(now, MARKET, **limits)
    if heavy is None:
        return windowed(now)
    # Products with very many merchants: the rank is one plus the number of offers at lower price
    # levels, and the totals are taken over the levels too, so that offers move once, for the join
    # with their level; the adaptive skew join splits it where it is not broadcast. Where most
    # offers are in such markets, the others go with them instead of being told apart.
    # Rows without a key are not joined either.
    busy = heavy.agg(F.sum("_rows")).first()[0]
    keyed = reduce(and_, [F.col(key).isNotNull() for key in MARKET])
    if 2 * busy < now.count():
        rows = staged(flagged(now, MARKET, heavy), "current")
        crowded, others = rows.where(F.col("_busy") & keyed), rows.where(~F.col("_busy") | ~keyed)
    else:
        crowded, others = now.where(keyed), now.where(~keyed)
    levels = crowded.groupBy(*MARKET, "price").agg(
        F.count(F.lit(1)).alias("offers"), F.sum("price").alias("total"), F.min("price").alias("lowest")
    )
    levels = staged(levels, "levels")  # counted, cut and summed from there
    wholes = {"offers": F.sum("offers"), "total": F.sum("total"), "lowest": F.min("lowest")}
    cheaper = with_total_before(levels, MARKET, ["price"], "offers", "_cheaper", wholes, **limits)
    at_level = F.col("price").eqNullSafe(F.col("_at_price"))
    same_level = reduce(and_, [F.col(key) == F.col(f"_at_{key}") for key in MARKET], at_level)
    ranked = crowded.join(
        cheaper.withColumnsRenamed({name: f"_at_{name}" for name in [*MARKET, "price"]}), same_level
    ).select(
        *now.columns,
        "offers",
        F.col("total").cast(levels.schema["total"].dataType).alias("total"),
        "lowest",
        (F.col("_cheaper") + 1).alias("price_rank"),
    )
    return windowed(others.select(*now.columns)).unionByName(ranked)


def competitor_comparison(facts: DataFrame, merchant: str = "merchant", **limits: int) -> DataFrame:
    """Rank of each merchant's current price and its gap to the cheapest."""
    gap = F.col("price") - F.col("lowest")
    return market_position(facts, merchant, **limits).select(
        *offer(merchant),
        "price",
        "offers",
        "price_rank",
        F.col("lowest").alias("lowest_price"),
        gap.alias("gap_to_lowest"),
        percent(gap, F.col("lowest")).alias("gap_pct"),
    )


def avg_competitor_price(facts: DataFrame, merchant: str = "merchant", **limits: int) -> DataFrame:
    """Average current price of the other merchants of a product, NULL when there are none."""
    others = F.col("offers") - 1
    average = F.when(others > 0, mean(F.col("total") - F.col("price"), F.nullif(others, F.lit(0))))
    return market_position(facts, merchant, **limits).select(
        *offer(merchant),
        "price",
        others.alias("competitors"),
        average.alias("competitor_avg"),
        (F.col("price").cast("double") - average).alias("gap_to_competitors"),
    )


def avg_price_across_competitors(facts: DataFrame, merchant: str = "merchant") -> DataFrame:
    """Average current price of each product over all its merchants."""
    totals = current_price(facts, merchant).groupBy(*MARKET).agg(
        F.count(F.lit(1)).alias("offers"),
        F.min("price").alias("lowest_price"),
        F.max("price").alias("highest_price"),
        F.sum("price").alias("total"),
    )
    return totals.withColumn("avg_price", mean(F.col("total"), F.col("offers"))).drop("total")

"""Price history of offers: current, previous, change, trend, extremes.

An offer is one product at one merchant in one currency and condition; prices are only
comparable inside an offer's currency and condition. These functions take facts with
``product_id``, ``currency``, ``condition``, ``observed_at``, ``price``, ``price_min``,
``price_max`` and a merchant column, whose name is the ``merchant`` argument.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import with_previous

MARKET = ["product_id", "currency", "condition"]
# Total order inside an offer once facts are distinct on the load key.
ORDER = ["observed_at", "price", "price_min", "price_max"]


def offer(merchant: str) -> list[str]:
    return ["product_id", merchant, "currency", "condition"]


def mean(total: Column, n: Column) -> Column:
    """Average from an exact decimal sum, so that it does not depend on row order."""
    return total.cast("double") / n


def percent(change: Column, base: Column) -> Column:
    """100 * change / base in double, NULL when the base is NULL or 0."""
    return F.when(
        base != 0, F.lit(100.0) * change.cast("double") / F.nullif(base, F.lit(0)).cast("double")
    )


def current_price(facts: DataFrame, merchant: str = "merchant") -> DataFrame:
    """Latest price of each offer. An aggregate, so a busy offer combines map-side."""
    latest = facts.groupBy(*offer(merchant)).agg(F.max(F.struct(*ORDER)).alias("last"))
    return latest.select(
        *offer(merchant),
        F.col("last.observed_at").alias("observed_at"),
        F.col("last.price").alias("price"),
    )


def previous_price(facts: DataFrame, merchant: str = "merchant", **limits: int) -> DataFrame:
    """Every observation with the price and time of the one before it in its offer."""
    return with_previous(
        facts.select(*offer(merchant), *ORDER),
        offer(merchant),
        ORDER,
        {"previous_price": "price", "previous_at": "observed_at"},
        **limits,
    )


def price_change(facts: DataFrame, merchant: str = "merchant", **limits: int) -> DataFrame:
    """Every observation with its difference and percentage change from the one before."""
    change = F.col("price") - F.col("previous_price")
    return previous_price(facts, merchant, **limits).withColumns(
        {"price_diff": change, "price_pct": percent(change, F.col("previous_price"))}
    )


def price_change_points(facts: DataFrame, merchant: str = "merchant", **limits: int) -> DataFrame:
    """History with repeats removed: the first observation and every changed one."""
    rows = previous_price(facts, merchant, **limits)
    return rows.where(
        F.col("previous_price").isNull() | (F.col("price") != F.col("previous_price"))
    )


def price_history_view(
    facts: DataFrame,
    product_id: str | None = None,
    merchant: str = "merchant",
    **limits: int,
) -> DataFrame:
    """Ordered history with changes, of one product or of all."""
    if product_id is not None:
        facts = facts.where(F.col("product_id") == product_id)
    keys = offer(merchant)
    return price_change(facts, merchant, **limits).orderBy(*keys, *ORDER)


def change_frequency(facts: DataFrame, merchant: str = "merchant", **limits: int) -> DataFrame:
    """How often each merchant changes a price between neighbouring observations."""
    rows = previous_price(facts, merchant, **limits)
    counts = rows.groupBy(merchant).agg(
        F.count(F.lit(1)).alias("observations"),
        F.count("previous_price").alias("pairs"),
        F.count(F.when(F.col("price") != F.col("previous_price"), 1)).alias("changes"),
    )
    return counts.withColumn(
        "change_rate", F.col("changes") / F.nullif(F.col("pairs"), F.lit(0))
    )


def latest_change(facts: DataFrame, merchant: str = "merchant", basis: str = "previous") -> DataFrame:
    """Current price of each offer against its previous (or its first) observation.

    Offers with a single observation have nothing to compare and are left out.
    """
    keys = offer(merchant)
    if basis == "first":
        ends = facts.groupBy(*keys).agg(
            F.min(F.struct(*ORDER)).alias("old"),
            F.max(F.struct(*ORDER)).alias("new"),
            F.count(F.lit(1)).alias("n"),
        )
        pairs = ends.where("n > 1")
    elif basis == "previous":
        # The rank filter is applied before the shuffle too (at most two rows per offer
        # leave each task), so a busy offer stays small.
        newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in ORDER])
        two = facts.withColumn("_n", F.row_number().over(newest)).where("_n <= 2")
        ends = two.groupBy(*keys).agg(
            F.min(F.struct(*ORDER)).alias("old"),
            F.max(F.struct(*ORDER)).alias("new"),
            F.count(F.lit(1)).alias("n"),
        )
        pairs = ends.where("n = 2")
    else:
        raise ValueError("basis is 'previous' or 'first'")
    change = F.col("price") - F.col("previous_price")
    return pairs.select(
        *keys,
        F.col("old.price").alias("previous_price"),
        F.col("new.price").alias("price"),
        F.col("new.observed_at").alias("observed_at"),
    ).withColumns({"price_diff": change, "price_pct": percent(change, F.col("previous_price"))})


def top_price_increases(
    facts: DataFrame, n: int = 20, merchant: str = "merchant", basis: str = "previous"
) -> DataFrame:
    rises = latest_change(facts, merchant, basis).where("price_pct > 0")
    return rises.orderBy(F.desc("price_pct"), *offer(merchant)).limit(n)


def top_price_decreases(
    facts: DataFrame, n: int = 20, merchant: str = "merchant", basis: str = "previous"
) -> DataFrame:
    falls = latest_change(facts, merchant, basis).where("price_pct < 0")
    return falls.orderBy(F.asc("price_pct"), *offer(merchant)).limit(n)


def price_trend(facts: DataFrame, period: str = "month") -> DataFrame:
    """Observations, lowest, highest and average price per product and period."""
    rows = facts.withColumn("period", F.date_trunc(period, "observed_at"))
    totals = rows.groupBy(*MARKET, "period").agg(
        F.count(F.lit(1)).alias("observations"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.sum("price").alias("total"),
    )
    return totals.withColumn("avg_price", mean(F.col("total"), F.col("observations"))).drop("total")


def price_fluctuation(facts: DataFrame, merchant: str = "merchant", **limits: int) -> DataFrame:
    """Range, spread and number of changes of each product's price."""
    stats = previous_price(facts, merchant, **limits).groupBy(*MARKET).agg(
        F.count(F.lit(1)).alias("observations"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.count(F.when(F.col("price") != F.col("previous_price"), 1)).alias("changes"),
        F.round(F.stddev_samp(F.col("price").cast("double")), 6).alias("price_stddev"),
    )
    spread = F.col("max_price") - F.col("min_price")
    return stats.withColumns(
        {"price_range": spread, "range_pct": percent(spread, F.col("min_price"))}
    )


def lowest_recorded_price(facts: DataFrame, merchant: str = "merchant") -> DataFrame:
    """Lowest price of each product, when and where first seen."""
    return _extreme(facts, merchant, F.col("price"))


def highest_recorded_price(facts: DataFrame, merchant: str = "merchant") -> DataFrame:
    """Highest price of each product, when and where first seen."""
    return _extreme(facts, merchant, -F.col("price"))


def _extreme(facts: DataFrame, merchant: str, rank: Column) -> DataFrame:
    # The smallest struct wins: best price, then earliest time, then merchant.
    first = F.min(F.struct(rank.alias("rank"), "observed_at", merchant)).alias("first")
    best = facts.groupBy(*MARKET).agg(first)
    return best.select(
        *MARKET,
        F.abs("first.rank").alias("price"),
        F.col("first.observed_at").alias("observed_at"),
        F.col(f"first.{merchant}").alias(merchant),
    )

"""Raw feed rows to price observations, with every rejected row kept and explained."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import iso_instant, midpoint, number, strip
from ..schema import CLEAN_COLUMNS, LINEAGE_COLUMNS, RAW_COLUMNS, RAW_TO_CLEAN
from .quality import count_copies, require_columns, tally
from .rows import settle, with_copies

TEXT_COLUMNS = [
    "product_id",
    "product_name",
    "brand",
    "category",
    "currency",
    "merchant",
    "condition",
]

# Identical rows that may share one row of a sort.
COPIES_PER_BLOCK = 100_000

# Raw text of the parsed cells, kept so that a rejected row can be traced and repaired.
TEXT_KEPT = ["price_min_text", "price_max_text", "date_text"]


def dedup_exact(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Drop rows equal in every feed column; landing columns count only when carried.

    A plain distinct: copies collapse on the map side, so a row repeated across a
    third of the feed shuffles once per task.
    """
    return raw.drop(*[c for c in LINEAGE_COLUMNS if c not in carry]).distinct()


def dedup_stored(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``dedup_exact`` of rows that are cheap to read twice: only possible copies are shuffled."""
    columns = [c for c in raw.columns if c in carry or c not in LINEAGE_COLUMNS]
    return with_copies(raw, columns).drop("_copies")


def select_business_columns(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The ten feed columns under their clean names; extra columns are dropped."""
    require_columns(raw, RAW_COLUMNS)
    return raw.select(
        *[F.col(f"`{name}`").alias(clean) for name, clean in RAW_TO_CLEAN.items()], *carry
    )


def price_problem(low: Column, high: Column) -> Column:
    """Why a price range is unusable, NULL when it is fine."""
    return (
        F.when(low.isNull() | high.isNull(), "price_missing")
        .when((low < 0) | (high < 0), "price_negative")
        .when(low > high, "price_range")
    )


def parse_prices(rows: DataFrame) -> DataFrame:
    """Strip text, parse both prices and name the price problem, one row per raw row."""
    stripped = rows.withColumns({name: strip(F.col(name)) for name in TEXT_COLUMNS})
    parsed = stripped.withColumns(
        {
            "price_min_text": F.col("price_min"),
            "price_max_text": F.col("price_max"),
            "price_min": number(F.col("price_min")),
            "price_max": number(F.col("price_max")),
        }
    )
    judged = parsed.withColumn(
        "reject_reason", price_problem(F.col("price_min"), F.col("price_max"))
    )
    return settle(judged, "price_min", "price_max", "reject_reason")


def explode_dates(parsed: DataFrame) -> DataFrame:
    """One row per comma-separated date; a row with a price problem stays one row.

    An empty or NULL date list still gives one row, which then counts as a bad date.
    """
    pieces = F.when(F.col("reject_reason").isNull(), F.split("date_seen", ",", -1))
    exploded = parsed.withColumn("date_piece", F.explode_outer(pieces))
    dated = exploded.withColumn("date_piece", strip(F.col("date_piece"))).withColumns(
        {
            "date_text": F.coalesce("date_piece", "date_seen"),
            "date_seen": iso_instant(F.col("date_piece")),
        }
    )
    judged = dated.drop("date_piece").withColumn(
        "reject_reason",
        F.coalesce(
            "reject_reason", F.when(F.col("date_seen").isNull(), F.lit("date_invalid"))
        ),
    )
    return settle(judged, "date_seen", "reject_reason")


def observe(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Every outcome of cleaning in one plan: good observations and explained rejects.

    Good rows have a NULL ``reject_reason``. One scan and one shuffle (the distinct)
    feed both sides; write it once, partitioned by outcome, to use both. ``carry`` names
    landing columns to keep, such as the batch when several are cleaned together.
    """
    return observe_distinct(dedup_exact(raw, carry), carry)


def observe_distinct(distinct_rows: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``observe`` for rows that are distinct already; it shuffles nothing."""
    return observe_parsed(parse_prices(select_business_columns(distinct_rows, carry)), carry)


def observe_parsed(parsed: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``observe_distinct`` from rows that ``parse_prices`` gave."""
    exploded = explode_dates(parsed)
    seen = F.col("date_seen")
    return exploded.withColumns(
        {
            "currency": F.upper("currency"),
            "merchant": F.lower("merchant"),
            "condition": F.lower("condition"),
            "price": midpoint(F.col("price_min"), F.col("price_max")),
            "observed_date": F.to_date(seen),
            "observed_year": F.year(seen),
            "observed_month": F.month(seen),
            "reject_stage": F.when(F.col("reject_reason").isNotNull(), F.lit("clean")),
        }
    ).select(*CLEAN_COLUMNS, *TEXT_KEPT, *carry, "reject_stage", "reject_reason")


def accepted(observed: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return observed.where(F.col("reject_reason").isNull()).select(*CLEAN_COLUMNS, *carry)


def rejected(observed: DataFrame) -> DataFrame:
    return observed.where(F.col("reject_reason").isNotNull())


def clean(raw: DataFrame) -> DataFrame:
    """Raw feed to clean price observations."""
    return accepted(observe(raw))


def clean_stored(raw: DataFrame) -> DataFrame:
    """``clean`` of rows that are cheap to read twice; it shuffles hashes and possible copies."""
    return accepted(observe_distinct(dedup_stored(raw)))


def transform_accounting(raw: DataFrame) -> DataFrame:
    """Rows in and out of each cleaning step, as one row.

    Rows are first counted per distinct raw row, so one scan and one shuffle serve
    every figure, and date lists are exploded only once per distinct row.
    """
    copies = count_copies(raw)
    business = copies.select(
        *[F.col(f"`{name}`").alias(new) for name, new in RAW_TO_CLEAN.items()],
        F.col("_copies").alias("copies"),
    )
    parsed = parse_prices(business).withColumn("price_problem", F.col("reject_reason"))
    # The copies of a raw row are counted on its first date only.
    numbered = parsed.withColumn(
        "dates", F.when(F.col("price_problem").isNull(), F.split("date_seen", ",", -1))
    ).select("price_problem", "copies", F.posexplode_outer("dates").alias("n", "piece"))
    first = F.coalesce(F.col("n"), F.lit(0)) == 0
    priced = F.col("price_problem").isNull()
    valid = priced & iso_instant(strip(F.col("piece"))).isNotNull()

    return numbered.agg(
        tally(first, F.col("copies")).alias("rows_in"),
        tally(first, F.col("copies") - 1).alias("rows_duplicate"),
        tally(~priced).alias("rows_bad_price"),
        tally(priced).alias("rows_exploded"),
        tally(priced & ~valid).alias("rows_bad_date"),
        tally(valid).alias("rows_out"),
    ).withColumn("rows_removed", F.col("rows_in") - F.col("rows_out"))


def sorted_observations(clean_rows: DataFrame) -> DataFrame:
    """Total order by product, merchant and time, missing values last.

    The remaining columns break ties so that the range partitioner can cut inside one
    product and merchant. Identical rows are counted first, and a large count is spread
    over several sort rows, so that copies do not pile up in one task either. The rows are read
    several times and should be a stored table; only those that may be copies are shuffled twice.
    """
    keys = ["product_id", "merchant", "date_seen"]
    others = [c for c in clean_rows.columns if c not in keys]
    counted = with_copies(clean_rows, [*keys, *others]).withColumnRenamed("_copies", "_n")
    block = F.lit(COPIES_PER_BLOCK)
    blocks = counted.select(
        "*", F.explode(F.sequence(F.lit(0), F.ceil(F.col("_n") / block) - 1)).alias("_block")
    )
    ordered = blocks.orderBy(
        *[F.asc_nulls_last(c) for c in [*keys, *others]], "_block"
    )
    size = F.least(block, F.col("_n") - F.col("_block") * block)
    return ordered.select(
        *clean_rows.columns, F.explode(F.sequence(F.lit(1), size)).alias("_copy")
    ).drop("_copy")

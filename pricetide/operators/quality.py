"""Validation reports, constraint checks and gates."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..errors import FeedRejected, LoadRejected
from ..functions import iso_instant, number, strip
from ..schema import (
    BRAND_WIDTH,
    CONDITION_WIDTH,
    CURRENCY_WIDTH,
    LINEAGE_COLUMNS,
    MERCHANT_WIDTH,
    PRODUCT_ID_WIDTH,
    RAW_COLUMNS,
    STATUS_WIDTH,
)
from .rows import with_copies


def quoted(name: str) -> Column:
    """Column whose name may contain dots."""
    return F.col(f"`{name}`")


def tally(condition: Column, weight: Column | None = None) -> Column:
    """Rows (or their weights) meeting a condition; NULL counts as not met."""
    amount = F.lit(1) if weight is None else weight
    total = F.sum(F.when(condition, amount).otherwise(F.lit(0)))
    return F.coalesce(total, F.lit(0)).cast("bigint")


# --- columns ---------------------------------------------------------------


def missing_columns(rows: DataFrame, required: Sequence[str] = RAW_COLUMNS) -> list[str]:
    """Required columns the frame lacks, sorted; extra columns are allowed."""
    return sorted(set(required) - set(rows.columns))


def require_columns(rows: DataFrame, required: Sequence[str]) -> None:
    missing = missing_columns(rows, required)
    if missing:
        raise FeedRejected(f"Missing required columns: {missing}")


def column_presence(rows: DataFrame, required: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """Per required column: is it there, and how many rows have a value in it."""
    present = set(rows.columns)
    filled = rows.agg(
        *[
            (F.count(quoted(name)) if name in present else F.lit(0).cast("bigint")).alias(f"c{i}")
            for i, name in enumerate(required)
        ]
    )
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(name in present).alias("present"),
            F.col(f"c{i}").alias("filled_rows"),
        )
        for i, name in enumerate(required)
    ]
    return filled.select(F.inline(F.array(*entries)))


def missing_by_column(rows: DataFrame, columns: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """Rows and missing values per column, from one pass."""
    counts = rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(quoted(name)).alias(f"c{i}") for i, name in enumerate(columns)],
    )
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("n").alias("total_rows"),
            (F.col("n") - F.col(f"c{i}")).alias("missing_rows"),
        )
        for i, name in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*entries)))


def type_conformance(rows: DataFrame) -> DataFrame:
    """Per typed feed column: values present and values that parse as the expected type.

    A date cell conforms when every comma-separated piece of it parses.
    """
    pieces = F.split(quoted("prices.dateSeen"), ",", -1)
    all_dates = F.forall(pieces, lambda piece: iso_instant(strip(piece)).isNotNull())
    checks = {
        "prices.amountMin": ("number", number(quoted("prices.amountMin")).isNotNull()),
        "prices.amountMax": ("number", number(quoted("prices.amountMax")).isNotNull()),
        "prices.dateSeen": ("timestamp list", all_dates),
        "prices.currency": (
            "text(10)",
            F.length(strip(quoted("prices.currency"))) <= CURRENCY_WIDTH,
        ),
        "prices.condition": (
            "text(100)",
            F.length(strip(quoted("prices.condition"))) <= CONDITION_WIDTH,
        ),
        "id": ("text(255)", F.length(strip(quoted("id"))).between(1, PRODUCT_ID_WIDTH)),
    }
    counts = rows.agg(
        *[F.count(quoted(name)).alias(f"v{i}") for i, name in enumerate(checks)],
        *[tally(ok).alias(f"k{i}") for i, (_, ok) in enumerate(checks.values())],
    )
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(expected).alias("expected_type"),
            F.col(f"v{i}").alias("value_rows"),
            F.col(f"k{i}").alias("conforming_rows"),
        )
        for i, (name, (expected, _)) in enumerate(checks.items())
    ]
    return counts.select(F.inline(F.array(*entries)))


# --- batch report and gate --------------------------------------------------


def count_copies(rows: DataFrame, batch: str | None = None) -> DataFrame:
    """Each distinct row once, with how often it occurs as ``_copies``.

    The only shuffle on whole rows that validation and cleaning need. Its map-side
    combine absorbs a row that is repeated very often. For rows in a stored table
    ``count_stored_copies`` does the same and shuffles less.
    """
    columns = [c for c in rows.columns if c == batch or c not in LINEAGE_COLUMNS]
    return rows.groupBy(*map(quoted, columns)).agg(F.count(F.lit(1)).alias("_copies"))


def count_stored_copies(rows: DataFrame) -> DataFrame:
    """``count_copies`` of rows that are cheap to read twice: only possible copies are shuffled."""
    return with_copies(rows, [c for c in rows.columns if c not in LINEAGE_COLUMNS])


def duplicate_count(rows: DataFrame) -> DataFrame:
    """Rows beyond the first copy of each row, over all feed columns."""
    totals = count_copies(rows).agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    )
    return totals.withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_rows"))


def validation_report(
    raw: DataFrame,
    batch: str | None = None,
    *,
    allow_duplicates: bool = True,
    allow_null_prices: bool = False,
    minimum_price: float = 0,
    required: Sequence[str] = RAW_COLUMNS,
) -> DataFrame:
    """One row of metrics per batch, with its status and first failing check.

    Takes raw rows, or rows already counted with ``count_copies``. Every figure is a sum
    over copy counts, so one plan with one shuffle on whole rows gives them all.
    """
    require_columns(raw, required)
    copies = raw if "_copies" in raw.columns else count_copies(raw, batch)
    keys = [batch] if batch else []
    low = number(quoted("prices.amountMin"))
    high = number(quoted("prices.amountMax"))
    weighted = copies.select(*keys, "_copies", *_flags(low, high, quoted("id"), minimum_price))
    report = weighted.groupBy(*keys).agg(*[figure.alias(name) for name, figure in _figures().items()])
    feed_columns = F.lit(len(copies.columns) - 1 - len(keys)).cast("bigint").alias("column_count")
    return _judged(report.select(*keys, "row_count", feed_columns, *REPORTED), allow_duplicates, allow_null_prices)


def watch_report(
    parsed: DataFrame,
    feed_columns: int,
    *,
    allow_duplicates: bool = True,
    allow_null_prices: bool = False,
    minimum_price: float = 0,
    required: Sequence[str] = RAW_COLUMNS,
) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``validation_report`` of counted rows that another job parses and writes anyway.

    Takes counted rows under their clean names with parsed prices. Returns the rows to write in
    their place, and what gives the report once they were written; it costs no pass of its own.
    ``required`` columns are the caller's to check, on the rows as they came.
    """
    seen = Observation()
    flags = _flags(F.col("price_min"), F.col("price_max"), F.col("product_id"), minimum_price)
    watched = parsed.select("*", *flags).observe(
        seen, *[figure.alias(name) for name, figure in _figures().items()]
    )

    def report() -> DataFrame:
        figures = [F.lit(seen.get[name]).cast("bigint").alias(name) for name in ("row_count", *REPORTED)]
        row = parsed.sparkSession.range(1).select(*figures)
        columns = F.lit(feed_columns).cast("bigint").alias("column_count")
        return _judged(row.select("row_count", columns, *REPORTED), allow_duplicates, allow_null_prices)

    return watched.drop(*FLAGS), report


# Figures of a report in their order, after the numbers of rows and columns.
REPORTED = ["duplicates", "null_price_rows", "invalid_price_rows", "null_product_ids"]
FLAGS = ["_null_price", "_low_price", "_no_id"]


def _flags(low: Column, high: Column, product_id: Column, minimum_price: float) -> list[Column]:
    return [
        (low.isNull() | high.isNull()).alias("_null_price"),
        ((low < minimum_price) | (high < minimum_price)).alias("_low_price"),
        (F.coalesce(strip(product_id), F.lit("")) == "").alias("_no_id"),
    ]


def _figures() -> dict[str, Column]:
    n = F.col("_copies")
    return {
        "row_count": F.coalesce(F.sum(n), F.lit(0)),
        "duplicates": F.coalesce(F.sum(n - 1), F.lit(0)),
        "null_price_rows": tally(F.col("_null_price"), n),
        "invalid_price_rows": tally(F.col("_low_price"), n),
        "null_product_ids": tally(F.col("_no_id"), n),
    }


def _judged(report: DataFrame, allow_duplicates: bool, allow_null_prices: bool) -> DataFrame:
    failures = [
        (not allow_duplicates, "duplicates", "duplicates"),
        (not allow_null_prices, "null_price_rows", "null_prices"),
        (True, "invalid_price_rows", "invalid_prices"),
        (True, "null_product_ids", "null_product_ids"),
    ]
    first = F.coalesce(
        *[F.when(F.col(c) > 0, F.lit(label)) for on, c, label in failures if on],
    )
    return report.withColumn("first_failure", F.coalesce(first, F.lit(""))).withColumn(
        "status", F.when(F.col("first_failure") == "", "PASSED").otherwise("FAILED")
    )


def require_valid(report: DataFrame) -> None:
    """Stop at a report that has a failed batch (the report has one row per batch)."""
    failed = report.where(F.col("status") == "FAILED").limit(1).collect()
    if failed:
        row = failed[0]
        raise FeedRejected(
            f"{row.first_failure}: {row.row_count} rows, {row.duplicates} duplicates, "
            f"{row.null_price_rows} null prices, {row.invalid_price_rows} invalid prices, "
            f"{row.null_product_ids} missing product ids"
        )


def quality_trend(reports: DataFrame, over: int = 3) -> DataFrame:
    """Each metric from batch to batch, from stored reports: one row per report and metric.

    ``share`` is the metric's part of the batch's rows, ``usual_share`` that of the ``over``
    batches before it taken together, ``change`` their difference; the first batch has neither.
    ``first_failing`` names the first run in which the metric was not 0.
    """
    metrics = ["duplicates", "null_price_rows", "invalid_price_rows", "null_product_ids"]
    pairs = F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics))
    rows = reports.select("run_id", "status", "row_count", F.inline(pairs))
    by_metric = Window.partitionBy("metric")
    before = by_metric.orderBy("run_id").rowsBetween(-over, -1)
    share = F.try_divide(F.col("value").cast("double"), F.col("row_count").cast("double"))
    usual = F.try_divide(F.sum("value").over(before).cast("double"), F.sum("row_count").over(before).cast("double"))
    return rows.select(
        "run_id",
        "metric",
        "status",
        "row_count",
        "value",
        share.alias("share"),
        usual.alias("usual_share"),
        (share - usual).alias("change"),
        F.min(F.when(F.col("value") > 0, F.col("run_id"))).over(by_metric).alias("first_failing"),
    )


# --- rejects ----------------------------------------------------------------


def reject_summary(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reject_stage", "reject_reason").agg(
        F.count(F.lit(1)).alias("rejected_rows")
    )


# --- load gate --------------------------------------------------------------


def load_gate(facts: DataFrame) -> DataFrame:
    """Counts of facts that break a requirement of the warehouse, one row per check."""
    required = ["merchant_id", "price_min", "price_max", "price", "observed_at"]
    checks = {
        "product_id_blank": F.coalesce(F.col("product_id"), F.lit("")) == "",
        **{f"{name}_null": F.col(name).isNull() for name in required},
        "currency_too_long": F.length("currency") > CURRENCY_WIDTH,
        "condition_too_long": F.length("condition") > CONDITION_WIDTH,
    }
    return _checks(facts, checks)


def require_loadable(facts: DataFrame) -> None:
    """Fail the load when any gate check counts a row."""
    broken = load_gate(facts).where("violations > 0").collect()
    if broken:
        counts = ", ".join(f"{r.check_name}={r.violations}" for r in broken)
        raise LoadRejected(f"Facts cannot be loaded: {counts}")


def _checks(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    counts = rows.agg(*[tally(broken).alias(name) for name, broken in checks.items()])
    entries = [
        F.struct(F.lit(name).alias("check_name"), quoted(name).alias("violations"))
        for name in checks
    ]
    return counts.select(F.inline(F.array(*entries)))


# --- declared constraints ----------------------------------------------------


class Rules(NamedTuple):
    """Declared constraints of a table: unique keys, and conditions that break it by name."""

    table: str
    unique: Sequence[str]
    broken: dict[str, Column]


def _required(*names: str) -> dict[str, Column]:
    return {f"{name} not null": F.col(name).isNull() for name in names}


def _bounded(**widths: int) -> dict[str, Column]:
    return {f"{name} length": F.length(name) > width for name, width in widths.items()}


def _not_negative(*names: str) -> dict[str, Column]:
    return {f"{name} >= 0": F.col(name) < 0 for name in names}


def product_rules() -> Rules:
    widths = _bounded(product_id=PRODUCT_ID_WIDTH, brand=BRAND_WIDTH)
    return Rules("products", ["product_id"], _required("product_id", "product_name") | widths)


def merchant_rules() -> Rules:
    widths = _bounded(merchant_name=MERCHANT_WIDTH)
    return Rules("merchants", ["merchant_id", "merchant_name"], _required("merchant_id", "merchant_name") | widths)


def price_rules() -> Rules:
    money = ["price_min", "price_max", "price"]
    return Rules(
        "price_history",
        ["price_id"],
        _required("price_id", "product_id", "merchant_id", *money, "observed_at")
        | _bounded(product_id=PRODUCT_ID_WIDTH, currency=CURRENCY_WIDTH, condition=CONDITION_WIDTH)
        | _not_negative(*money)
        | {"price_min <= price_max": F.col("price_min") > F.col("price_max")},
    )


def run_rules() -> Rules:
    """The ledger's rules: those declared, and that a run ends after it began, with an outcome."""
    running = F.col("status") == "RUNNING"
    counts = ["records_received", "records_validated", "records_transformed", "records_loaded"]
    return Rules(
        "pipeline_runs",
        ["run_id"],
        _required("run_id", "started_at", "status")
        | _bounded(status=STATUS_WIDTH)
        | _not_negative(*counts)
        | {
            "status known": ~F.col("status").isin("RUNNING", "SUCCESS", "FAILED"),
            "completed_at >= started_at": F.col("completed_at") < F.col("started_at"),
            "completed_at of ended runs": F.col("status").isNotNull() & ~running & F.col("completed_at").isNull(),
        },
    )


def violations(rows: DataFrame, rules: Rules) -> DataFrame:
    """(check_name, violations) for every rule of a table, also those that hold; one scan.

    Each row expands into its unique keys and the conditions it breaks. Counting those per rule
    and key, combined before the shuffle, serves uniqueness and conditions alike: a key beyond
    its first row is a violation, and so is every broken condition.
    """
    keys = [
        F.when(F.col(key).isNotNull(), F.struct(F.lit(f"{rules.table}.{key} unique").alias("check_name"), F.col(key).cast("string").alias("key")))
        for key in rules.unique
    ]
    breaks = [
        F.when(broken, F.struct(F.lit(f"{rules.table}.{name}").alias("check_name"), F.lit(None).cast("string").alias("key")))
        for name, broken in rules.broken.items()
    ]
    found = rows.select(F.inline(F.array_compact(F.array(*keys, *breaks))))
    counted = found.groupBy("check_name", "key").agg(F.count(F.lit(1)).alias("n"))
    spare = F.col("n") - F.col("key").isNotNull().cast("int")
    totals = counted.groupBy("check_name").agg(F.sum(spare).alias("n"))
    names = [f"{rules.table}.{key} unique" for key in rules.unique] + [f"{rules.table}.{name}" for name in rules.broken]
    every = rows.sparkSession.createDataFrame([(name,) for name in names], "check_name string")
    return every.join(totals, "check_name", "left").select(
        "check_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("violations")
    )


def constraint_violations(
    facts: DataFrame, products: DataFrame, merchants: DataFrame, runs: DataFrame
) -> DataFrame:
    """Violations of every declared constraint of the four tables, as (check, count)."""
    tables = {product_rules: products, merchant_rules: merchants, price_rules: facts, run_rules: runs}
    return reduce(DataFrame.unionByName, [violations(rows, rules()) for rules, rows in tables.items()])


def fk_orphans(facts: DataFrame, products: DataFrame, merchants: DataFrame) -> DataFrame:
    """Keys of facts without a dimension row, with the number of facts of each.

    Facts are counted per key before the anti join, so the join sees each key once.
    """

    def orphans(key: str, dimension: DataFrame) -> DataFrame:
        used = facts.groupBy(key).agg(F.count(F.lit(1)).alias("fact_rows"))
        return used.join(dimension.select(key), key, "left_anti").select(
            F.lit(key).alias("foreign_key"),
            F.col(key).cast("string").alias("key_value"),
            "fact_rows",
        )

    return orphans("product_id", products).unionByName(orphans("merchant_id", merchants))

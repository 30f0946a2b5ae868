"""Finding groups too large for one task and cutting them into ordered slices.

A window needs all rows of a group in one task. Groups of more than ``rows_per_task`` rows
are cut along the window's own order into slices of about that many. The slices are
windowed separately and a small table carries values from one slice to the next, so
the result is exact whatever the cuts are. Groups are counted exactly, on every input
alike; where none is too large, the plain one-shuffle window is all there is to do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged

# Rows of one group that a task may sort.
ROWS_PER_TASK = 5_000_000
# Sampled rows per slice when cuts are chosen, and the fan-out of the two-level search.
SAMPLES_PER_SLICE = 32
FAN_OUT = 64


def group_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def heavy_groups(
    rows: DataFrame, keys: Sequence[str], *, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame | None:
    """(_hash, _rows) of the groups that are too large for a task, None if there are none.

    One count per group, combined map-side, over the key columns alone. A hash shared by
    two groups only means that both are cut.
    """
    counts = rows.groupBy(group_hash(keys).alias("_hash")).agg(F.count(F.lit(1)).alias("_rows"))
    heavy = staged(counts.where(F.col("_rows") > rows_per_task), "heavy")
    return None if heavy.isEmpty() else heavy


def flagged(rows: DataFrame, keys: Sequence[str], heavy: DataFrame) -> DataFrame:
    """Rows with ``_busy``: whether their group is one of ``heavy``."""
    marks = heavy.select("_hash", F.lit(True).alias("_busy"))
    joined = rows.withColumn("_hash", group_hash(keys)).join(marks, "_hash", "left")
    return joined.withColumn("_busy", F.coalesce("_busy", F.lit(False))).drop("_hash")


def choose_cuts(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    heavy: DataFrame,
    *,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Cut points of each heavy group: one row per group, (_hash, _coarse, _fine).

    A thin sample of the heavy rows only decides where to cut, as Spark's own range
    partitioner does. The table is written once, so every task and retry sees the same.
    """
    fraction = min(1.0, SAMPLES_PER_SLICE / rows_per_task)
    step = max(1, min(SAMPLES_PER_SLICE, int(rows_per_task * fraction)))
    sample = (
        rows.select(group_hash(keys).alias("_hash"), F.struct(*order).alias("_at"))
        .join(heavy.select("_hash"), "_hash")
        .sample(fraction, seed=7)
    )
    ranked = sample.withColumn(
        "_n", F.row_number().over(Window.partitionBy("_hash").orderBy("_at"))
    )
    cuts = (
        ranked.where(F.col("_n") % step == 0)
        .groupBy("_hash")
        .agg(F.sort_array(F.collect_set("_at")).alias("_cuts"))
    )
    blocks = F.sequence(F.lit(0), F.ceil(F.size("_cuts") / FAN_OUT).cast("int") - 1)
    fine = F.transform(blocks, lambda i: F.slice("_cuts", i * FAN_OUT + 1, FAN_OUT))
    table = heavy.select("_hash").join(cuts, "_hash", "left").select("_hash", fine.alias("_fine"))
    coarse = F.transform("_fine", lambda part: part[0])
    empty = F.array().cast(table.schema["_fine"].dataType)
    table = table.withColumn("_fine", F.coalesce("_fine", empty))
    return staged(table.select("_hash", coarse.alias("_coarse"), "_fine"), "cuts")


def assign_slices(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], cuts: DataFrame
) -> DataFrame:
    """Add ``_slice`` (rising along the order within a group) and ``_heavy``."""
    at = F.struct(*order)

    def passed(points: Column) -> Column:
        return F.size(F.filter(points, lambda cut: cut <= at))

    block = passed(F.col("_coarse"))
    inside = passed(F.element_at("_fine", block))
    number = F.when(F.size("_coarse") > 0, F.when(block > 0, (block - 1) * FAN_OUT + inside))
    return (
        rows.withColumn("_hash", group_hash(keys))
        .join(cuts, "_hash", "left")  # one row per heavy group
        .withColumns(
            {
                "_heavy": F.col("_coarse").isNotNull(),
                "_slice": F.coalesce(number, F.lit(0)),
            }
        )
        .drop("_hash", "_coarse", "_fine")
    )


def with_previous(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, str],
    **limits: int,
) -> DataFrame:
    """Add columns holding the previous row's values within each group.

    ``values`` maps new columns to source columns. Keys must not be NULL and ``order``
    must be total within a group.
    """
    heavy = heavy_groups(rows, keys, **limits)
    if heavy is None:
        window = Window.partitionBy(*keys).orderBy(*order)
        return rows.withColumns({new: F.lag(src).over(window) for new, src in values.items()})

    cuts = choose_cuts(rows, keys, order, heavy, **limits)
    sliced = assign_slices(rows, keys, order, cuts)
    place = [*keys, "_slice"]
    window = Window.partitionBy(*place).orderBy(*order)
    inner = sliced.withColumns(
        {
            **{new: F.lag(src).over(window) for new, src in values.items()},
            "_first": F.row_number().over(window) == 1,
        }
    )
    last = (
        sliced.where("_heavy")
        .groupBy(*place)
        .agg(F.max(F.struct(*order, *[F.col(s).alias(f"_v{i}") for i, s in enumerate(values.values())])).alias("_last"))
    )
    # One row per slice of a heavy group.
    carried = last.select(
        *place,
        F.lag("_last").over(Window.partitionBy(*keys).orderBy("_slice")).alias("_before"),
    )
    joined = inner.join(carried, place, "left")
    return joined.select(
        *rows.columns,
        *[
            F.when(F.col("_first"), F.col(f"_before._v{i}")).otherwise(F.col(new)).alias(new)
            for i, new in enumerate(values)
        ],
    )


def with_total_before(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    amount: str,
    total: str,
    wholes: dict[str, Column] | None = None,
    **limits: int,
) -> DataFrame:
    """Add the sum of ``amount`` over the earlier rows of each group (0 for the first).

    ``order`` must be unique within a group. ``wholes`` adds figures of the whole group: sums or
    minima of columns that keep their name, such as ``{"n": F.sum("n")}``, as they are taken again
    over the slices of a heavy group.
    """
    wholes = wholes or {}
    heavy = heavy_groups(rows, keys, **limits)
    earlier = (Window.unboundedPreceding, -1)

    def windowed(some: DataFrame, place: Sequence[str]) -> DataFrame:
        group = Window.partitionBy(*place)
        before = F.sum(amount).over(group.orderBy(*order).rowsBetween(*earlier))
        figures = {f"_all_{name}": figure.over(group) for name, figure in wholes.items()}
        return some.withColumns({total: F.coalesce(before, F.lit(0)), **figures})

    if heavy is None:
        return windowed(rows, keys).select(
            *[c for c in rows.columns if c not in wholes], total, *[F.col(f"_all_{c}").alias(c) for c in wholes]
        )

    cuts = choose_cuts(rows, keys, order, heavy, **limits)
    sliced = assign_slices(rows, keys, order, cuts)
    place = [*keys, "_slice"]
    inner = windowed(sliced, place)
    sums = sliced.where("_heavy").groupBy(*place).agg(
        F.sum(amount).alias("_sum"), *[figure.alias(name) for name, figure in wholes.items()]
    )
    group = Window.partitionBy(*keys)
    across = group.orderBy("_slice").rowsBetween(*earlier)
    # One row per slice of a heavy group.
    carried = sums.select(
        *place,
        F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_before"),
        *[figure.over(group).alias(f"_group_{name}") for name, figure in wholes.items()],
    )
    joined = inner.join(carried, place, "left")
    return joined.select(
        *[c for c in rows.columns if c not in wholes],
        (F.col(total) + F.coalesce(F.col("_before"), F.lit(0))).alias(total),
        *[F.coalesce(f"_group_{name}", f"_all_{name}").alias(name) for name in wholes],
    )

"""Small helpers on whole rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged

# Hashes of copies that are sent to all tasks at most (some 200 MB there).
HASHES_SENT = 4_000_000


def settle(rows: DataFrame, *names: str) -> DataFrame:
    """Compute columns here, once, however they are filtered on later.

    A filter on a derived column is pushed below the projections that derive it and
    repeats their work there. Filters on generator output stay above the generator, so
    the columns pass through a one-element one.
    """
    others = [f"`{c}`" for c in rows.columns if c not in names]
    return rows.select(*others, F.inline(F.array(F.struct(*names))))


def recurring(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(_hash) of the rows that may have a copy, stored: one shuffle of eight bytes a row."""
    hashed = rows.select(F.xxhash64(*[f"`{c}`" for c in columns]).alias("_hash"))
    counts = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    return staged(counts.where("_n > 1").select("_hash"), "recurring")


def with_copies(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each distinct row of ``columns`` once, with how often it occurs as ``_copies``.

    For rows that are cheap to read twice, such as a stored table. Only rows whose hash recurs
    are shuffled and compared as a whole, so equal hashes of different rows do no harm; the
    others stay where they are. With more such hashes than tasks should be sent, all rows are
    shuffled, copies combined before.
    """

    def counted(some: DataFrame) -> DataFrame:
        return some.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("_copies"))

    hashes = recurring(rows, columns)
    found = hashes.count()
    if found > HASHES_SENT:
        return counted(rows)
    only = rows.select(*[F.col(f"`{c}`") for c in columns])
    alone = F.lit(1).cast("bigint").alias("_copies")
    if not found:
        return only.select("*", alone)
    hashed = only.withColumn("_hash", F.xxhash64(*[f"`{c}`" for c in columns]))
    sent = F.broadcast(hashes)
    single = hashed.join(sent, "_hash", "left_anti").drop("_hash").select("*", alone)
    return single.unionByName(counted(hashed.join(sent, "_hash", "left_semi")))

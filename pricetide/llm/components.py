"""Connected components of a graph of pairs, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.shared import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the least node that each node of the pairs reaches.

    Alternates two rewrites until nothing changes: every node hangs its larger neighbours on
    the least of its neighbourhood, then itself and its smaller neighbours. The pairs never
    become more, every round is written to the shared folder, and a logarithmic number of
    rounds ends in stars. Null ends and loops are ignored; no pairs give no rows.
    """
    pairs = edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).where("u < v and u is not null").distinct()
    pairs, before = stage(pairs, "pairs"), None
    while True:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return pairs.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
                pairs.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
            )
        before = state
        both = pairs.select(F.col("v").alias("x"), F.col("u").alias("y")).union(pairs.select("u", "v"))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u")).where("u < v").distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("u < v")
        pairs = stage(small.union(least.select("v", F.col("m").alias("u"))).distinct(), "pairs")

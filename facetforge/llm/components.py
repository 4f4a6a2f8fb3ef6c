"""Connected components by alternating stars, with every round's links written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetforge.llm.common import Stored


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, label (the smallest node of its component) for every node of the links a, b.

    A round hangs the larger neighbours of each node on its smallest (large star), then the smaller ones (small star);
    links stay linear in their number and a component ends as one star. Each step aggregates a minimum before it
    shuffles and joins it back, so a node with very many neighbours is never gathered in one place.
    """
    now = Stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    for _ in range(most_rounds):
        before = now.df
        both = before.unionByName(before.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("u", "v", "m")
        hung = small.select("u", F.col("m").alias("v")).unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        after = Stored(hung.where("u <> v").distinct(), "links")
        same = after.df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() == before.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        now.drop()
        now = after
        if same:
            break
    else:
        raise RuntimeError("the links did not settle")
    return now.df.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.df.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )

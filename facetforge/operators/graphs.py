"""Components, reachable sets and clusters of graphs given as tables of links."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetforge.operators.storing import dealt, kept


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, label (the smallest node of its component) for every node of the links a, b.

    Each round hangs a node's larger neighbours on its smallest one, and then the smaller ones; a component ends as one
    star after a number of rounds that grows with the logarithm of its width. Minima are aggregated before they are joined
    back, so a node with very many neighbours isn't gathered in one place.
    """
    now = kept(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = state(now)
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(dealt(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.join(dealt(large.groupBy("u").agg(F.min("v").alias("m"))), "u")
        hung = small.select("u", F.col("m").alias("v")).unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        now = kept(hung.where("u <> v").distinct())
        after = state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("the links did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def reached(start: DataFrame, steps: DataFrame, key: list[str], most_rounds: int = 10_000) -> DataFrame:
    """key, root, node: all nodes that each root reaches from its nodes in `start` (key, root, node) by `steps` (key, node,
    to). What is known is left out of every round, so cycles end."""
    found = front = kept(start.select(*key, "root", "node").distinct())
    steps = kept(steps.select(*key, "node", "to").distinct())
    for _ in range(most_rounds):
        if front.isEmpty():
            return found
        ahead = front.join(steps, [*key, "node"]).select(*key, "root", F.col("to").alias("node")).distinct()
        front = kept(ahead.join(found, [*key, "root", "node"], "left_anti"))
        found = found.unionByName(front)  # each round's front is written once
    raise RuntimeError("the sets did not settle")


def clusters(parts: DataFrame, links: DataFrame) -> DataFrame:
    """sha, pid, cluster: the root that a part ends at if links (sha, first, second, with the places n1 < n2 of their ends)
    are taken in order, each hanging the root of its first end under that of its second. The partition is that of the
    components; which member is the root depends on the order. parts: sha, pid. An asset's parts are one group."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for sha, nodes, pairs in rows.itertuples(index=False):
                over = {n: n for n in nodes}

                def root(n: int, over: dict = over) -> int:
                    while over[n] != n:
                        n = over[n]
                    return n

                for pair in pairs if pairs is not None else ():
                    over[root(pair["first"])] = root(pair["second"])
                out += [(sha, n, root(n)) for n in nodes]
            yield pd.DataFrame(out, columns=["sha", "pid", "cluster"])

    nodes = parts.groupBy("sha").agg(F.sort_array(F.collect_set("pid")).alias("nodes"))
    pairs = links.groupBy("sha").agg(F.sort_array(F.collect_list(F.struct("n1", "n2", "first", "second"))).alias("pairs"))
    kinds = parts.schema
    return nodes.join(pairs, "sha", "left").select("sha", "nodes", "pairs").mapInPandas(
        fold, f"sha {kinds['sha'].dataType.simpleString()}, pid {kinds['pid'].dataType.simpleString()}, cluster {kinds['pid'].dataType.simpleString()}"
    )

"""Statistics of parts and the rules that choose among them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetforge.operators.ordering import numbered

#: Bounds of a usable part's share of the area, and its fewest faces.
SHARE, FACES = (0.03, 0.35), 60


def part_stats(faces: DataFrame, asset: str = "sha", part: str = "pid", area: str = "area", height: str = "z") -> DataFrame:
    """asset, part, n_faces, area, zmin, share (of the area), face_share, is_base: the part that starts lowest.

    Faces are summed by part before anything is ranked, so an asset's window holds its parts and not its faces.
    """
    parts = faces.groupBy(asset, part).agg(F.count("*").alias("n_faces"), F.sum(area).alias("area"), F.min(height).alias("zmin"))
    whole = Window.partitionBy(asset)
    return parts.select(
        "*",
        F.try_divide(F.col("area"), F.sum("area").over(whole)).alias("share"),
        (F.col("n_faces") / F.sum("n_faces").over(whole)).alias("face_share"),
        (F.row_number().over(whole.orderBy("zmin", part)) == 1).alias("is_base"),
    )


def usable(stats: DataFrame, share: tuple[float, float] = SHARE, faces: int = FACES, base: bool = False) -> DataFrame:
    """Parts inside the bounds; the base only if `base`."""
    kept = stats.where(F.col("share").between(*share) & (F.col("n_faces") >= faces))
    return kept if base else kept.where("not is_base")


def under_rules(stats: DataFrame, rules: list[tuple[str, float, float, int]]) -> DataFrame:
    """A row for each part and rule (name, least and most share, fewest faces) that it meets."""
    passed = [F.when(F.col("share").between(lo, hi) & (F.col("n_faces") >= least), F.lit(name)) for name, lo, hi, least in rules]
    return stats.withColumn("rule", F.explode(F.array_compact(F.array(*passed))))


def trailing(rows: DataFrame, before: DataFrame, key: str, order: str) -> DataFrame:
    """Of each list the rows behind the first n_before (a column of `before`); rows come in `order`. A list is one group."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    return rows.withColumn("idx", place).join(before.select(key, "n_before"), key).where("idx >= n_before")


def next_donors(assets: DataFrame, usable: Column) -> DataFrame:
    """host, donor, rn: the assets (sha) in their order, each with the next usable one that isn't itself, from a cursor that
    never goes back.

    The n-th asset stands at the n-th donor or behind it, so only the first can meet itself, and the cursor is one ahead
    from then on: hosts and donors are numbered and joined by their numbers.
    """
    hosts = numbered(assets.select("sha"), "sha")
    donors = numbered(assets.where(usable).select(F.col("sha").alias("donor")), "donor", name="at")
    first = assets.agg((F.min("sha") == F.min(F.when(usable, F.col("sha")))).cast("long").alias("ahead"))
    rows = hosts.join(F.broadcast(first), F.lit(True)).withColumn("at", F.col("rn") + F.col("ahead"))  # one row
    return rows.join(donors, "at").select(F.col("sha").alias("host"), "donor", "rn")


def reversed_pairs(pairs: DataFrame, task: str, sides: tuple[str, str]) -> DataFrame:
    """The pairs with their sides exchanged, under another task. Nothing is copied: the columns change places."""
    a, b = sides
    return pairs.withColumns({a: F.col(b), b: F.col(a), "task": F.lit(task)})

"""Parts that belong together: which ones touch, which lie inside others, and what moves along with a part.

points: sha, sid, x, y, z, nx, ny, nz, pid. parts: sha, pid, area, place (by area, the largest first; of equal ones the
smaller pid), the box lo_, hi_. Pairs are of parts of one asset, of which there are few; points meet by cubes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from facetforge.operators.geometry import AXES, bounds, overlap, within
from facetforge.operators.graphs import clusters, reached
from facetforge.operators.meshes import sampled, shaped
from facetforge.operators.ordering import strided
from facetforge.operators.storing import kept
from facetforge.operators.winding import winding

#: The shares of points that make a part inside another or attached to it; how large an attached part may
#: be against the other; contact and overlap that join shells; the seam's points and angle; how near is touching.
INSIDE, ATTACHED, SIZE, CONTACT, OVERLAP, SEAM, ANGLE, NEAR = 0.55, 0.45, 0.25, 0.35, 0.5, 25, 22.0, 0.02
#: Points of a part that are asked, for contact and for attachment; points that a part needs.
ASKED, TRIED, POINTS = 600, 800, 30


def measured(points: DataFrame, areas: DataFrame, least: int = POINTS) -> DataFrame:
    """The parts with enough points, with their areas (sha, pid, area), places and boxes."""
    box = bounds(points, ["sha", "pid"]).where(F.col("n") >= least).drop("diag")
    rank = F.row_number().over(Window.partitionBy("sha").orderBy(F.desc("area"), "pid"))
    return box.join(areas, ["sha", "pid"]).withColumn("place", rank)


def paired(parts: DataFrame) -> DataFrame:
    """p (the larger) and q, for all parts of an asset."""
    return parts.alias("p").join(parts.alias("q"), F.expr("p.sha = q.sha and p.place < q.place"))


def touching(points: DataFrame, pairs: DataFrame, asked: int, near: float = NEAR) -> DataFrame:
    """sha, large, small, contact (the share of the small part's points that are near the large one), n_near, angle (the
    median between normals there). pairs: sha, large, small. Only so many points of a part are asked, at even steps."""
    diag = bounds(points, ["sha"]).select("sha", (F.col("diag") * near).alias("reach"))
    ask = strided(points, ["sha", "pid"], asked, "sid")
    n = ask.groupBy("sha", F.col("pid").alias("small")).agg(F.count("*").alias("asked"))
    key = lambda sha, part: F.concat_ws("/", sha, part)
    own = ask.withColumnRenamed("pid", "small").join(pairs, ["sha", "small"]).join(diag, "sha")
    own = own.select(key("sha", "large").alias("sha"), F.concat_ws("/", "small", "sid").alias("sid"), *AXES, "nx", "ny", "nz", "small", "reach")
    other = points.join(diag, "sha").select(key("sha", "pid").alias("sha"), "sid", *AXES, "nx", "ny", "nz", "reach")
    met = within(own, other, F.lit(True)).where("distance is not null")
    met = met.join(own.select("sha", "sid", "small", "reach", *(F.col(f"n{a}").alias(f"o{a}") for a in AXES)), ["sha", "sid"]).where("distance < reach")
    met = met.join(other.select("sha", F.col("sid").alias("near_sid"), "nx", "ny", "nz"), ["sha", "near_sid"])
    dot = F.abs(sum((F.col(f"n{a}") * F.col(f"o{a}") for a in AXES), F.lit(0.0)))
    found = met.groupBy("sha", "small").agg(F.count("*").alias("n_near"), F.median(F.degrees(F.acos(F.least(dot, F.lit(1.0))))).alias("angle"))
    rows = pairs.withColumn("key", key("sha", "large")).join(found.withColumnRenamed("sha", "key"), ["key", "small"], "left").join(n, ["sha", "small"])
    rows = rows.withColumn("n_near", F.coalesce("n_near", F.lit(0)))
    return rows.select("sha", "large", "small", (F.col("n_near") / F.col("asked")).alias("contact"), "n_near", "angle")


def joined(points: DataFrame, parts: DataFrame, asked: int = ASKED, seam: int = SEAM, near: float = NEAR) -> DataFrame:
    """sha, large, small, contact, n_near, angle, overlap, together: pairs of parts not too different in size, and whether
    they are one body: they hug, their boxes overlap, or their seam is smooth."""
    size = paired(parts).where(F.col("q.area") >= SIZE * F.col("p.area"))
    size = size.select("p.sha", F.col("p.pid").alias("large"), F.col("q.pid").alias("small"), overlap("p", "q").alias("overlap"), F.col("p.place").alias("n1"), F.col("q.place").alias("n2"))
    rows = size.join(touching(points, size.select("sha", "large", "small"), asked, near), ["sha", "large", "small"])
    smooth = (F.col("n_near") >= seam) & (F.col("angle") < ANGLE)
    return rows.withColumn("together", (F.col("contact") >= CONTACT) | (F.col("overlap") >= OVERLAP) | F.coalesce(smooth, F.lit(False)))


def candidates(parts: DataFrame, size: float = SIZE) -> DataFrame:
    """sha, large, small, place, far_smaller: parts whose boxes' middle lies in a larger part's box, with a tenth of it
    around; and whether they are at most so large against it."""
    at = [(F.col(f"q.lo_{a}") + F.col(f"q.hi_{a}")) / 2 for a in AXES]
    room = [0.1 * (F.col(f"p.hi_{a}") - F.col(f"p.lo_{a}") + 1e-9) for a in AXES]
    inside = F.lit(True)
    for a, c, r in zip(AXES, at, room, strict=True):
        inside = inside & (c > F.col(f"p.lo_{a}") - r) & (c < F.col(f"p.hi_{a}") + r)
    rows = paired(parts).where(inside)
    return rows.select("p.sha", F.col("p.pid").alias("large"), F.col("q.pid").alias("small"), F.col("p.place").alias("place"), (F.col("q.area") <= size * F.col("p.area")).alias("far_smaller"))


def insides(points: DataFrame, shapes: DataFrame, pairs: DataFrame, asked: int = TRIED) -> DataFrame:
    """sha, large, small, inside: the share of the small part's points that the large part's surface winds about."""
    ask = strided(points, ["sha", "pid"], asked, "sid").select("sha", F.col("pid").alias("small"), "sid", *AXES)
    rows = ask.join(pairs.select("sha", "large", "small"), ["sha", "small"])
    turns = winding(shapes.withColumnRenamed("pid", "large"), rows, ["sha", "large"])
    return turns.groupBy("sha", "large", "small").agg(F.avg((F.abs("winding") > 0.5).cast("double")).alias("inside"))


def parents(pairs: DataFrame, inside: float = INSIDE) -> DataFrame:
    """sha, pid, parent, rule, score: of the candidates of a part (sha, small, large, place, far_smaller, inside, contact)
    the one with the best share; of equal ones the largest part. A part without one has none."""
    held = F.coalesce("inside", F.lit(0.0)) >= inside
    stuck = ~held & F.col("far_smaller") & (F.coalesce("contact", F.lit(0.0)) >= ATTACHED)
    rule = F.when(held, "inside").when(stuck, "attached")
    rows = pairs.select("sha", "small", "large", "place", rule.alias("rule"), F.when(held, F.col("inside")).otherwise(F.col("contact")).alias("score")).where("rule is not null")
    best = rows.groupBy("sha", F.col("small").alias("pid")).agg(F.max_by(F.struct("large", "rule", "score"), F.struct("score", (-F.col("place")).alias("first"))).alias("b"))
    return best.select("sha", "pid", F.col("b.large").alias("parent"), F.col("b.rule").alias("rule"), F.bround("b.score", 3).alias("score"))


def moving_along(cluster: DataFrame, tree: DataFrame) -> DataFrame:
    """sha, root, node: what moves with each part: its cluster, and the children of any part of a cluster that is reached,
    again and again. cluster: sha, pid, cluster; tree: sha, pid, parent."""
    own = cluster.select("sha", F.col("pid").alias("root"), "cluster")
    start = own.join(cluster.withColumnRenamed("pid", "node"), ["sha", "cluster"])
    over = tree.where("parent is not null").join(cluster.withColumnRenamed("pid", "parent"), ["sha", "parent"])
    steps = cluster.withColumnRenamed("pid", "node").join(over.select("sha", "cluster", F.col("pid").alias("to")), ["sha", "cluster"])
    return reached(start, steps, ["sha"])


def below(tree: DataFrame) -> DataFrame:
    """sha, root, node: each part with all its descendants, itself included."""
    roots = tree.select("sha", F.col("pid").alias("root"), F.col("pid").alias("node"))
    return reached(roots, tree.where("parent is not null").select("sha", F.col("parent").alias("node"), F.col("pid").alias("to")), ["sha"])


def legend_clusters(cluster: DataFrame, tree: DataFrame) -> DataFrame:
    """sha, pid, cluster: a child that is its own cluster's root takes its parent's cluster."""
    over = tree.where("parent is not null").join(cluster.select("sha", F.col("pid").alias("parent"), F.col("cluster").alias("of")), ["sha", "parent"])
    rows = cluster.join(over.select("sha", "pid", "of"), ["sha", "pid"], "left")
    return rows.select("sha", "pid", F.when(F.col("cluster") == F.col("pid"), F.coalesce("of", "cluster")).otherwise(F.col("cluster")).alias("cluster"))


def units(groups: DataFrame, colors: DataFrame, members: DataFrame) -> DataFrame:
    """sha, name, pids (sorted): a named group of colours as the parts that move with the colours' parts. groups: sha,
    name, color; colors: sha, color, pid; members: sha, pid, member. A colour that isn't known is skipped, a part without
    members stands for itself, a group without parts goes."""
    met = groups.join(colors, ["sha", "color"]).join(members, ["sha", "pid"], "left")
    rows = met.select("sha", F.lower(F.trim("name")).alias("name"), F.coalesce("member", "pid").alias("pid"))
    return rows.groupBy("sha", "name").agg(F.sort_array(F.collect_set("pid")).alias("pids"))


def of_mesh(vertices: DataFrame, faces: DataFrame, n: int = 40_000, seed: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The forest of meshes, from n points on each asset's surface."""
    shapes = shaped(vertices, faces)
    points = kept(sampled(shapes, n, seed).select("sha", "sid", *AXES, *(F.col(f"n_{a}").alias(f"n{a}") for a in AXES), "pid"))
    areas = shapes.groupBy("sha", "pid").agg(F.sum("area").alias("area"))
    return forest(points, areas, insides(points, shapes, candidates(measured(points, areas))))


def forest(points: DataFrame, areas: DataFrame, inside: DataFrame | None = None, least: int = POINTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """cluster (sha, pid, cluster), tree (sha, pid, parent, rule, score; parent null at the top), and group (sha, root,
    node) of all parts. inside: sha, large, small, inside, the share of a part's points inside another, where known."""
    parts = kept(measured(points, areas, least))
    bonds = joined(points, parts).where("together").select("sha", F.col("large").alias("first"), F.col("small").alias("second"), "n1", "n2")
    cluster = clusters(parts.select("sha", "pid"), bonds)
    pairs = candidates(parts)
    near = touching(points, pairs.select("sha", "large", "small"), TRIED).select("sha", "large", "small", "contact")
    pairs = pairs.join(near, ["sha", "large", "small"])
    pairs = pairs.join(inside, ["sha", "large", "small"], "left") if inside is not None else pairs.withColumn("inside", F.lit(0.0))
    tree = parts.select("sha", "pid").join(parents(pairs), ["sha", "pid"], "left")
    return cluster, tree, moving_along(cluster, tree)

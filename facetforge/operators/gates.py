"""The geometry gate: what a pair must show before it is judged, by its task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetforge.operators.geometry import AXES, bounds, silhouettes, within
from facetforge.operators.meshes import bodies, boundary, sampled, shaped
from facetforge.operators.storing import dealt, kept

#: The tasks that leave the shape alone, those that take or add a part, those that move or double one, and
#: the one that bends the whole.
STILL, CUT, MOVE, BEND = ("E1a", "E1b", "E1c", "E1a_rev"), ("E3", "E2"), ("E6", "E7"), "E9"
#: Least overlap of silhouettes; bounds of the area's change; least visibility; most exposure; least share of
#: moved vertices; bounds of the mean way; how far from the rest a component hangs in the air, and its fewest faces.
SILHOUETTE, AREA, SEEN, EXPOSED, MOVED, WAY, APART, FACES = 0.93, (0.02, 0.60), 0.3, 0.35, 0.005, (0.005, 0.25), 0.04, 4
#: Points that are drawn of a body's surface, at least and at most.
SAMPLES = (200, 2000)


def turns(pairs: DataFrame, chain: str = "E10") -> DataFrame:
    """A chain as its two turns, the first a removal and the second a move, each with a visibility of a half and no unit;
    other pairs as they are. pairs: key, task, vis, exposure and what else the gate reads."""
    both = pairs.where(F.col("task") == chain).withColumn("turn", F.explode(F.sequence(F.lit(1), F.lit(2))))
    both = both.withColumns(
        {"key": F.concat("key", F.lit("#t"), F.col("turn")), "task": F.when(F.col("turn") == 1, "E3").otherwise("E6"), "vis": F.lit(0.5), "exposure": F.lit(None).cast("double")}
    )
    return pairs.where(F.col("task") != chain).unionByName(both.drop("turn"))


def relative(after: Column, before: Column) -> Column:
    return F.abs(after - before) / F.greatest(before, F.lit(1e-9))


def passes() -> Column:
    """Whether a pair passes, from task, sil_iou, area_delta, vis, orphans, exposure, d_faces, moved_frac, mean_disp, error.
    An unknown exposure passes, so do orphans that couldn't be counted (-1); an error fails; other tasks pass."""
    seen = F.coalesce("vis", F.lit(0.0)) >= SEEN
    whole = F.coalesce("orphans", F.lit(0)) <= 0
    cut = F.col("area_delta").between(*AREA) & seen & whole & ((F.col("task") != "E3") | F.coalesce(F.col("exposure") <= EXPOSED, F.lit(True)))
    move = seen & ((F.coalesce("d_faces", F.lit(0)) > 0) | (F.coalesce("moved_frac", F.lit(0.0)) > MOVED)) & whole
    rule = F.when(F.col("task").isin(*STILL), F.col("sil_iou") >= SILHOUETTE).when(F.col("task").isin(*CUT), cut).when(F.col("task").isin(*MOVE), move)
    rule = rule.when(F.col("task") == BEND, F.col("mean_disp").between(*WAY)).otherwise(F.lit(True))
    return F.coalesce(rule, F.lit(False)) & F.col("error").isNull()


def exposure(before: DataFrame, after: DataFrame, by: list[str], near: int = 10) -> DataFrame:
    """by, exposure: of the faces left near a removed part, the share that look at where it was. before: by and x, y, z, the
    centres of the part's faces; after: by and x, y, z, nx, ny, nz, those of the faces left. Null for a part of fewer faces
    than `near`; 0 where fewer are left near it."""
    size = bounds(before, by)
    part = before.groupBy(*by).agg(*(F.avg(a).alias(f"c_{a}") for a in AXES)).join(size.select(*by, "diag", "n"), by)
    to = {a: F.col(f"c_{a}") - F.col(a) for a in AXES}
    way = F.sqrt(sum((v * v for v in to.values()), F.lit(0.0)))
    met = after.join(part, by).withColumn("way", way).where("way < 0.6 * diag")
    looks = sum((F.col(f"n{a}") * to[a] / (F.col("way") + 1e-9) for a in AXES), F.lit(0.0)) > 0.3
    seen = met.groupBy(*by).agg(F.count("*").alias("m"), F.avg(looks.cast("double")).alias("share"))
    rows = part.join(seen, by, "left")
    return rows.select(*by, F.when(F.col("n") >= near, F.when(F.coalesce("m", F.lit(0)) >= near, F.col("share")).otherwise(0.0)).alias("exposure"))


def isolated(shapes: DataFrame, diag: DataFrame, seed: int = 0, least: int = FACES, faces: DataFrame | None = None) -> DataFrame:
    """sha, body, faces, orphan: whether no sample of a body's surface lies near one of another body's. shapes: the faces
    with their body; diag: sha, diag (of the state before). Bodies with fewer faces than `least` aren't looked at, and have no
    row. Of a body's surface so many points are drawn as it has faces, in bounds. faces: all faces (sha, body), if some have
    no shape, as a vertex of theirs is missing: they count as faces of their body, whose surface goes without them.

    Cubes decide most bodies without a distance: two bodies with samples in one cube whose diagonal is the limit are near;
    only samples of the bodies that no cube settles look for others, in the cubes around their own.
    """
    size = (shapes if faces is None else faces).groupBy("sha", "body").agg(F.count("*").alias("faces")).where(F.col("faces") >= least)
    rows = shapes.join(dealt(size), ["sha", "body"])
    points = sampled(rows, F.greatest(F.lit(SAMPLES[0]), F.least(F.lit(SAMPLES[1]), F.max("faces"))), seed, by=("sha", "body"))
    reach = diag.select("sha", F.greatest(APART * F.col("diag"), F.lit(1e-12)).alias("reach"))
    points = kept(points.select("sha", "body", F.concat_ws("/", "body", "sid").alias("sid"), *AXES).join(dealt(reach), "sha"))
    cube = [F.floor(F.col(a) * (3**0.5) / F.col("reach")).alias(f"g_{a}") for a in AXES]
    held = points.select("sha", "body", *cube).distinct()
    shared = held.groupBy("sha", *(f"g_{a}" for a in AXES)).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    near = kept(held.join(dealt(shared), ["sha", *(f"g_{a}" for a in AXES)], "left_semi").select("sha", "body").distinct())
    left = points.join(dealt(near), ["sha", "body"], "left_anti")
    found = within(left, points, F.expr("p.body <> q.body")).join(dealt(left.select("sha", "sid", "body")), ["sha", "sid"]).select("sha", "body")
    met = near.unionByName(found.distinct()).withColumn("near", F.lit(True))
    return size.join(dealt(met), ["sha", "body"], "left").select("sha", "body", "faces", F.col("near").isNull().alias("orphan"))


def orphans(shapes: DataFrame, diag: DataFrame, seed: int = 0, least: int = FACES, faces: DataFrame | None = None) -> DataFrame:
    """sha, orphans: how many bodies of an asset hang in the air: none if it is one body, -1 (couldn't be told) if it is
    several of which one alone is large enough to be looked at. faces: as in isolated()."""
    many = (shapes if faces is None else faces).groupBy("sha").agg(F.count_distinct("body").alias("bodies"))
    seen = isolated(shapes, diag, seed, least, faces).groupBy("sha").agg(F.count("*").alias("large"), F.count_if("orphan").alias("n"))
    rows = many.join(dealt(seen), "sha", "left")
    count = F.when(F.col("bodies") < 2, 0).when(F.col("large") == 1, -1).otherwise(F.coalesce("n", F.lit(0)))
    return rows.select("sha", count.cast("int").alias("orphans"))


def new_edges(before: DataFrame, after: DataFrame, diag: DataFrame, apart: float = 0.01) -> DataFrame:
    """sha, new_open: open edges of the after state without one of the before state near their middle, for every asset of
    diag (0 where nothing is new). before, after: sha, sid, x, y, z; only what lies within the distance is met."""
    reach = diag.select("sha", F.greatest(F.col("diag") * apart, F.lit(1e-12)).alias("reach"))
    a, b = (df.join(reach, "sha") for df in (after, before))
    known = within(a, b, F.lit(True)).select("sha", "sid")
    new = after.join(known, ["sha", "sid"], "left_anti").groupBy("sha").agg(F.count("*").alias("n"))
    return diag.select("sha").join(new, "sha", "left").select("sha", F.coalesce("n", F.lit(0)).alias("new_open"))


def ways(before: DataFrame, after: DataFrame) -> DataFrame:
    """sha, moved_frac (the share of vertices that moved), mean_disp (the mean way over the diagonal): null where the states
    have different numbers of vertices."""
    size = bounds(before, ["sha"]).select("sha", "diag", "n").join(after.groupBy("sha").agg(F.count("*").alias("m")), "sha")
    both = before.join(after.select("sha", "vid", *(F.col(a).alias(f"to_{a}") for a in AXES)), ["sha", "vid"]).join(size, "sha")
    way = F.sqrt(sum(((F.col(a) - F.col(f"to_{a}")) ** 2 for a in AXES), F.lit(0.0)))
    met = both.groupBy("sha", "n", "m").agg(F.count("*").alias("k"), F.avg((way > 1e-6 * F.col("diag")).cast("double")).alias("moved"), F.avg(F.try_divide(way, F.col("diag"))).alias("way"))
    same = (F.col("n") == F.col("m")) & (F.col("n") == F.col("k"))
    return met.select("sha", F.when(same, F.col("moved")).alias("moved_frac"), F.when(same, F.col("way")).alias("mean_disp"))


#: What the gate reads of a pair, and the kinds of it.
METRICS = {"sil_iou": "double", "area_delta": "double", "orphans": "int", "exposure": "double", "new_open": "bigint", "d_faces": "bigint", "moved_frac": "double", "mean_disp": "double"}


def judged(
    pairs: DataFrame, before: tuple[DataFrame, DataFrame], after: tuple[DataFrame, DataFrame], removed: DataFrame, samples: int = 80_000, res: int = 96, seed: int = 0
) -> DataFrame:
    """The pairs with what their tasks need to be measured, and geo_pass. pairs: key, task, vis, error, chains as one pair;
    before, after: vertices and faces of both states, by key as sha, chains by their turns' keys; removed: key, pid, the parts
    that a removal took, if known. Each metric reads the meshes of those pairs alone whose task asks for it; all metrics are
    rows of one table, brought together by key once."""
    pairs = turns(pairs.withColumn("exposure", F.lit(None).cast("double"))).drop("exposure")

    task = pairs.where("error is null").select(F.col("key").alias("sha"), "task")

    def of(df: DataFrame, *tasks: str) -> DataFrame:
        return df.join(task.where(F.col("task").isin(*tasks)).select("sha"), "sha", "left_semi")

    # The faces of both states with their shapes, once for all that read them.
    was, now = (kept(shaped(of(v, *STILL, *CUT, *MOVE), of(f, *STILL, *CUT, *MOVE))) for v, f in (before, after))
    surface = lambda shapes: sampled(of(shapes, *STILL), samples, seed).select("sha", "sid", *AXES)
    still = silhouettes(surface(was), surface(now), res).select("sha", F.col("iou").alias("sil_iou"))
    area = lambda shapes, name: of(shapes, *CUT).groupBy("sha").agg(F.sum("area").alias(name))
    areas = area(was, "was").join(area(now, "now"), "sha", "left").select("sha", relative(F.coalesce("now", F.lit(0.0)), F.col("was")).alias("area_delta"))
    left = of(after[1], *CUT, *MOVE)
    diag = bounds(of(before[0], *CUT, *MOVE), ["sha"])
    bodied = bodies(left).select("sha", "fidx", "body")
    hanging = orphans(now.join(bodied, ["sha", "fidx"]), diag, seed, faces=bodied)
    place = [F.col(f"m_{a}").alias(a) for a in AXES]
    gone = of(was, CUT[0]).join(removed.withColumnRenamed("key", "sha"), ["sha", "pid"], "left_semi").select("sha", *place)
    seen = exposure(gone, of(now, CUT[0]).select("sha", *place, *(F.col(f"n_{a}").alias(f"n{a}") for a in AXES)), ["sha"])
    rims = [boundary(*(of(df, CUT[0]) for df in state)) for state in (before, after)]
    opened = new_edges(*rims, of(diag, CUT[0]))
    many = lambda shapes, name: of(shapes, *MOVE).groupBy("sha").agg(F.count("*").alias(name))
    faces = many(was, "was").join(many(now, "now"), "sha", "full").select("sha", F.abs(F.coalesce("now", F.lit(0)) - F.coalesce("was", F.lit(0))).alias("d_faces"))
    both = ways(*(of(state[0], *MOVE, BEND) for state in (before, after))).join(task, "sha")
    moved = both.where(F.col("task") != BEND).select("sha", "moved_frac")
    bent = both.where(F.col("task") == BEND).select("sha", "mean_disp")
    rows = None
    for found in (still, areas, hanging, seen, opened, faces, moved, bent):
        own = found.select("sha", *((F.col(m) if m in found.columns else F.lit(None)).cast(kind).alias(m) for m, kind in METRICS.items()))
        rows = own if rows is None else rows.unionByName(own)
    rows = rows.groupBy(F.col("sha").alias("key")).agg(*(F.max(m).alias(m) for m in METRICS))
    return pairs.join(rows, "key", "left").withColumn("geo_pass", passes())

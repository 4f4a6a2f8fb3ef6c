"""Points, boxes and deformations as column expressions and grouped aggregates.

A point table has sha (asset), sid (sample), x, y, z and pid (part). Assets are the unit of every shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetforge.operators.storing import dealt, kept

AXES = ("x", "y", "z")
#: The views that visibility is judged from, as the axes across, the axis of depth and its sign.
VIEWS = [("x", "y", "z", 1), ("x", "y", "z", -1), ("y", "z", "x", 1), ("y", "z", "x", -1), ("x", "z", "y", 1), ("x", "z", "y", -1)]


def bounds(points: DataFrame, by: list[str], mean: bool = False) -> DataFrame:
    """lo_ and hi_ of each axis, the diagonal, and the number of points; with `mean` also c_ of each axis."""
    sides = [f(a).alias(f"{n}_{a}") for a in AXES for n, f in (("lo", F.min), ("hi", F.max), ("c", F.avg)) if mean or n != "c"]
    boxes = points.groupBy(*by).agg(*sides, F.count("*").alias("n"))
    return boxes.withColumn("diag", F.sqrt(sum(((F.col(f"hi_{a}") - F.col(f"lo_{a}")) ** 2 for a in AXES), F.lit(0.0))))


def centroid(points: DataFrame, by: list[str]) -> DataFrame:
    """c_ of each axis: the mean of the points, whatever their areas."""
    return points.groupBy(*by).agg(*(F.avg(a).alias(f"c_{a}") for a in AXES))


def cell(value: Column, low: Column, high: Column, res: int) -> Column:
    """The cell of a value between two bounds, cut off toward zero."""
    return ((value - low) / F.greatest(high - low, F.lit(1e-9)) * (res - 1)).cast("int")


def view_angle(radius: Column) -> Column:
    """The angle under which a camera so far away sees the unit cube's ball."""
    return 2 * F.asin(F.lit(3.0**0.5 / 2) / radius)


def twisted(x: Column, y: Column, t: Column, cx: Column, cy: Column, degrees: float = 40.0) -> tuple[Column, Column]:
    angle = F.radians(F.lit(degrees)) * t
    return cx + (x - cx) * F.cos(angle) - (y - cy) * F.sin(angle), cy + (x - cx) * F.sin(angle) + (y - cy) * F.cos(angle)


def tapered(x: Column, t: Column, c: Column, by: float = 0.45) -> Column:
    return c + (x - c) * (1 - by * t)


def bulged(x: Column, t: Column, c: Column, by: float = 0.35) -> Column:
    return c + (x - c) * (1 + by * F.exp(-((t - 0.5) ** 2) / 0.05))


def bent(x: Column, t: Column, extent: Column, by: float = 0.35) -> Column:
    return x + by * extent * t * t


def deformed(op: Column, wide: Column, degrees: float = 40.0, taper: float = 0.45, bulge: float = 0.35, bend: float = 0.35) -> tuple[Column, Column]:
    """x and y by the deformation's name, from the columns x, y, t (the height, 0 to 1) and c_x, c_y."""
    x, y, t, c, d = (F.col(n) for n in ("x", "y", "t", "c_x", "c_y"))
    turned = twisted(x, y, t, c, d, degrees)
    along = lambda own, centre: {"taper": tapered(own, t, centre, taper), "bulge": bulged(own, t, centre, bulge)}
    ways = [{"twist": turned[0], **along(x, c), "bend": bent(x, t, wide, bend)}, {"twist": turned[1], **along(y, d), "bend": y}]
    return tuple(F.coalesce(*(F.when(op == k, v) for k, v in way.items())) for way in ways)


def overlap(a: str, b: str) -> Column:
    """The volume two boxes share, over that of the smaller one."""
    def volume(p: str) -> Column:
        out = F.lit(1.0)
        for ax in AXES:
            out = out * F.greatest(F.col(f"{p}.hi_{ax}") - F.col(f"{p}.lo_{ax}"), F.lit(1e-9))
        return out

    shared = F.lit(1.0)
    for ax in AXES:
        shared = shared * F.greatest(F.least(F.col(f"{a}.hi_{ax}"), F.col(f"{b}.hi_{ax}")) - F.greatest(F.col(f"{a}.lo_{ax}"), F.col(f"{b}.lo_{ax}")), F.lit(0.0))
    return shared / F.least(volume(a), volume(b))


def seen_cells(points: DataFrame, res: int, views: list[tuple[str, str, str, int]] = VIEWS) -> DataFrame:
    """The points with view, u, v and depth for each view, cells being those of the asset's box."""
    box = bounds(points, ["sha"]).drop("n", "diag")
    at = {a: cell(F.col(a), F.col(f"lo_{a}"), F.col(f"hi_{a}"), res) for a in AXES}
    looks = [F.struct(F.lit(i).alias("view"), at[u].alias("u"), at[v].alias("v"), (F.col(d) * sign).alias("depth")) for i, (u, v, d, sign) in enumerate(views)]
    return points.join(box, "sha").select("sha", "sid", "pid", F.inline(F.array(*looks)))


def visibility(points: DataFrame, res: int) -> DataFrame:
    """sha, pid, vis: the best view's share of a part's cells in which it lies in front.

    One aggregate has of each cell the part in front (largest depth, then smallest sample) and all its parts, so points are
    shuffled once and no cell is sorted.
    """
    front = F.max(F.struct("depth", (-F.col("sid")).alias("s"), "pid")).pid.alias("front")
    cells = seen_cells(points, res).groupBy("sha", "view", "u", "v").agg(front, F.collect_set("pid").alias("pids"))
    own = cells.select("sha", "view", "front", F.explode("pids").alias("pid")).groupBy("sha", "view", "pid")
    sides = own.agg((F.count_if(F.col("front") == F.col("pid")) / F.count("*")).alias("share"))
    return sides.groupBy("sha", "pid").agg(F.max("share").alias("vis"))


def front_points(cells: DataFrame) -> DataFrame:
    """sha, view, u, v, sid, pid: of each cell the point in front; of equally deep ones the first."""
    front = F.max(F.struct("depth", (-F.col("sid")).alias("s"), "pid"))
    rows = cells.groupBy("sha", "view", "u", "v").agg(front.alias("f"))
    return rows.select("sha", "view", "u", "v", (-F.col("f.s")).alias("sid"), F.col("f.pid").alias("pid"))


def unit_visibility(points: DataFrame, units: DataFrame, res: int) -> DataFrame:
    """sha, name, vis: visibility of sets of parts (sha, name, pid), each as if it were one part."""
    cells = seen_cells(points, res)
    hits = front_points(cells).join(units, ["sha", "pid"]).groupBy("sha", "name", "view").agg(F.count("*").alias("hits"))
    own = cells.join(units, ["sha", "pid"]).select("sha", "name", "view", "u", "v").distinct().groupBy("sha", "name", "view").agg(F.count("*").alias("cells"))
    both = own.join(hits, ["sha", "name", "view"], "left")
    return both.groupBy("sha", "name").agg(F.max(F.least(F.coalesce("hits", F.lit(0)) / F.col("cells"), F.lit(1.0))).alias("vis"))


def silhouettes(before: DataFrame, after: DataFrame, res: int) -> DataFrame:
    """sha, iou: the outlines' cells that both states have over those that any has, the mean of three sides; each state lies
    in the middle of its own frame, as wide as its widest side. before, after: sha, sid, x, y, z."""
    def cells(points: DataFrame, state: int) -> DataFrame:
        box = bounds(points, ["sha"])
        wide = F.greatest(*(F.col(f"hi_{a}") - F.col(f"lo_{a}") for a in AXES), F.lit(1e-9))
        at = {a: (F.col(a) - (F.col(f"lo_{a}") + F.col(f"hi_{a}")) / 2) / wide + 0.5 for a in AXES}
        at = {a: F.least(F.greatest(c * (res - 1), F.lit(0.0)), F.lit(res - 1.0)).cast("int") for a, c in at.items()}
        sides = [F.struct(F.lit(k).alias("side"), at[u].alias("u"), at[v].alias("v")) for k, (u, v) in enumerate((("y", "z"), ("x", "z"), ("x", "y")))]
        return points.join(box, "sha").select("sha", F.inline(F.array(*sides))).distinct().withColumn("state", F.lit(state))

    met = cells(before, 0).unionByName(cells(after, 1)).groupBy("sha", "side", "u", "v").agg(F.count("*").alias("k"))
    side = met.groupBy("sha", "side").agg((F.count_if(F.col("k") == 2) / F.count("*")).alias("iou"))
    return side.groupBy("sha").agg(F.avg("iou").alias("iou"))


def within(points: DataFrame, targets: DataFrame, on: Column) -> DataFrame:
    """The nearest target of each point within the asset's `reach`, a column of both, for which `on` (of p and q) holds:
    sha, sid, near_sid, distance.

    Both sides are dealt into cubes as wide as the reach; a point looks into its own cube and the 26 around it, so pairs
    are made inside a neighbourhood and not between all points. Points without a target in reach have no row.
    """
    def cubes(df: DataFrame) -> DataFrame:
        return df.withColumns({f"g_{a}": F.floor(F.col(a) / F.col("reach")) for a in AXES})

    steps = F.sequence(F.lit(-1), F.lit(1))
    around = cubes(points)
    for a in AXES:
        around = around.withColumn(f"s_{a}", F.explode(steps)).withColumn(f"g_{a}", F.col(f"g_{a}") + F.col(f"s_{a}")).drop(f"s_{a}")
    p, q = around.alias("p"), cubes(targets).alias("q")
    same = F.col("p.sha") == F.col("q.sha")
    for a in AXES:
        same = same & (F.col(f"p.g_{a}") == F.col(f"q.g_{a}"))
    distance = F.sqrt(sum(((F.col(f"p.{a}") - F.col(f"q.{a}")) ** 2 for a in AXES), F.lit(0.0)))
    met = p.join(dealt(q), same & on).select(F.col("p.sha").alias("sha"), F.col("p.sid").alias("sid"), distance.alias("d"), F.col("q.sid").alias("near"), F.col("p.reach").alias("reach"))
    met = met.where(F.col("d") <= F.col("reach"))
    return met.groupBy("sha", "sid").agg(F.min(F.struct("d", "near")).alias("m")).select("sha", "sid", F.col("m.near").alias("near_sid"), F.col("m.d").alias("distance"))


#: Cells of an axis at most, targets of a cell, about, and targets of an asset that give a point without a near one a bound.
CELLS, HELD, SPARE = 32, 64, 64


def cuts(rows: DataFrame, by: list[str], axis: str, name: str) -> DataFrame:
    """by, `name`: where an axis is cut for the rows of each group, by quantiles, into as many cells as `many` says."""
    every = F.percentile_approx(axis, [k / CELLS for k in range(1, CELLS)], 20 * CELLS)
    held = rows.groupBy(*by).agg(every.alias("_q"), F.max("many").alias("_m"))
    step = (F.lit(CELLS) / F.col("_m")).cast("int")
    # Quantiles that are the same are one cut: a heap in one place isn't cut up.
    chosen = F.array_distinct(F.filter("_q", lambda _, i: (i + 1) % step == 0))
    return held.select(*by, chosen.alias(name))


def cell_of(value: Column, edges: str) -> Column:
    """How many cuts lie below the value."""
    return F.size(F.filter(edges, lambda c: c < value))


def gap(value: Column, edges: str, i: Column) -> Column:
    """How far a value lies from the cell between the cuts i - 1 and i; a value on a cut belongs to the cell below it."""
    low, high = F.get(edges, i - 1), F.get(edges, i)
    return F.greatest(F.coalesce(low - value, F.lit(0.0)), F.coalesce(value - high, F.lit(0.0)), F.lit(0.0))


def nearest(points: DataFrame, targets: DataFrame, on: Column, reach: float | None = None) -> DataFrame:
    """The nearest target of each point for which `on` (of p and q) holds, of equally near ones that with the smallest sid:
    sha, sid, near_sid, distance. With a reach, points without a target in it have no row; without one every point has a row
    whose asset has any target for it. Places that are missing or not finite have none. `on` may read any column but sid.

    Without a reach the targets of an asset are cut into cells that hold about as many each, by quantiles of x, of y in each
    slab, and of z in each column. A point finds the nearest target of its own cell first, and then looks into those cells
    alone that lie no farther than it, slab by slab and column by column; a point whose cell has none for it is bounded by a
    few targets of the asset. So there is no round that depends on the distances, and dense places are cut as others are.
    """
    if reach is not None:
        wide = F.lit(float(reach))
        return within(points.withColumn("reach", wide), targets.withColumn("reach", wide), on)
    finite = F.lit(True)
    for a in AXES:
        finite = finite & F.coalesce(F.abs(a) < 1e150, F.lit(False))
    points, targets = points.where(finite), targets.where(finite)
    # Of targets alike in all but their sid the first stands for all, so that a heap in one place is one target.
    targets = targets.groupBy(*(c for c in targets.columns if c != "sid")).agg(F.min("sid").alias("sid"))
    size = targets.groupBy("sha").agg(F.count("*").alias("n"))
    # Cells of an axis: a power of two, so that the chosen quantiles are even.
    many = F.least(F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.col("n") / HELD, F.lit(1.0))) / 3)), F.lit(float(CELLS))).cast("int")
    size = size.select("sha", many.alias("many"))
    wide = targets.join(dealt(size), "sha")
    at = {a: F.col(a) for a in AXES}
    xs = cuts(wide, ["sha"], "x", "xs")
    wide = wide.join(dealt(xs), "sha").withColumn("cx", cell_of(at["x"], "xs")).drop("xs")
    ys = cuts(wide, ["sha", "cx"], "y", "ys")
    wide = wide.join(dealt(ys), ["sha", "cx"]).withColumn("cy", cell_of(at["y"], "ys")).drop("ys")
    zs = cuts(wide, ["sha", "cx", "cy"], "z", "zs")
    cells = kept(wide.join(dealt(zs), ["sha", "cx", "cy"]).withColumn("cz", cell_of(at["z"], "zs")).drop("zs", "many"))
    xs, ys, zs = (kept(df) for df in (xs, ys, zs))
    # A slab or column without targets has no cuts, so nothing in it is found at first.
    cell = lambda a, edges: F.coalesce(cell_of(at[a], edges), F.lit(0))
    home = points.join(dealt(xs), "sha").withColumn("cx", cell_of(at["x"], "xs")).drop("xs").join(dealt(ys), ["sha", "cx"], "left")
    home = home.withColumn("cy", cell("y", "ys")).drop("ys").join(dealt(zs), ["sha", "cx", "cy"], "left").withColumn("cz", cell("z", "zs")).drop("zs")
    place = ("sha", "cx", "cy", "cz")
    distance = F.sqrt(sum(((F.col(f"p.{a}") - F.col(f"q.{a}")) ** 2 for a in AXES), F.lit(0.0)))

    def met(df: DataFrame, others: DataFrame, keys: tuple[str, ...]) -> DataFrame:
        same = F.lit(True)
        for k in keys:
            same = same & (F.col(f"p.{k}") == F.col(f"q.{k}"))
        both = df.alias("p").join(dealt(others.alias("q")), same & on)
        return both.groupBy("p.sha", "p.sid").agg(F.min(F.struct(distance.alias("d"), F.col("q.sid").alias("near"))).alias("m"))

    local = met(home, cells, place)
    first = kept(home.join(dealt(local), ["sha", "sid"], "left"))
    few = cells.withColumn("_n", F.row_number().over(Window.partitionBy("sha").orderBy(F.xxhash64("sid"), "sid"))).where(F.col("_n") <= SPARE)
    bound = met(first.where("m is null").drop("m"), few, ("sha",)).select("sha", "sid", F.col("m.d").alias("spare"))
    asks = first.join(dealt(bound), ["sha", "sid"], "left").withColumn("far", F.coalesce("m.d", "spare", F.lit(float("inf")))).drop("m", "spare")

    def closer(value: Column, edges: str) -> Callable[[Column], Column]:
        """Cells no farther than what is known, and a little more for rounding; the way to them so far is summed as squares."""
        return lambda i: F.col("way") + gap(value, edges, i) ** 2 <= F.col("far") * F.col("far") * (1 + 1e-9)

    for c, a, table, edges, keys in (("nx", "x", xs, "xs", ["sha"]), ("ny", "y", ys, "ys", ["sha", "nx"]), ("nz", "z", zs, "zs", ["sha", "nx", "ny"])):
        known = dealt(table.withColumnsRenamed({"cx": "nx", "cy": "ny"}))
        asks = asks.join(known, keys) if c != "nx" else asks.withColumn("way", F.lit(0.0)).join(known, keys)
        asks = asks.withColumn(c, F.explode(F.filter(F.sequence(F.lit(0), F.size(edges)), closer(at[a], edges)))).withColumn("way", F.col("way") + gap(at[a], edges, F.col(c)) ** 2).drop(edges)
    asks = asks.where("nx <> cx or ny <> cy or nz <> cz").drop("cx", "cy", "cz").withColumnsRenamed({"nx": "cx", "ny": "cy", "nz": "cz"})
    found = met(asks, cells, place).unionByName(first.where("m is not null").select("sha", "sid", "m"))
    return found.groupBy("sha", "sid").agg(F.min("m").alias("m")).select("sha", "sid", F.col("m.near").alias("near_sid"), F.col("m.d").alias("distance"))


def displacement(before: DataFrame, after: DataFrame) -> DataFrame:
    """sha, moved: the mean way of the vertices over the diagonal; null where their numbers differ."""
    size = bounds(before, ["sha"]).select("sha", "diag", "n")
    after = after.select("sha", "sid", *(F.col(a).alias(f"to_{a}") for a in AXES))
    way = F.sqrt(sum(((F.col(a) - F.col(f"to_{a}")) ** 2 for a in AXES), F.lit(0.0)))
    both = before.join(after, ["sha", "sid"]).groupBy("sha").agg(F.avg(way).alias("way"), F.count("*").alias("m"))
    counts = after.groupBy("sha").agg(F.count("*").alias("n_after"))
    rows = size.join(both, "sha").join(counts, "sha")
    return rows.select("sha", F.when((F.col("n") == F.col("n_after")) & (F.col("n") == F.col("m")), F.try_divide("way", "diag")).alias("moved"))

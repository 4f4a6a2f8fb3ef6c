"""Meshes as two tables, and edits of them as joins and grouped aggregates.

vertices: sha (asset), vid, x, y, z. faces: sha, fidx, v0, v1, v2 (vertices), pid (part). An edit returns tables of the same
kind, so that edits follow one another; the part of a face stays with it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetforge.operators.geometry import AXES, bounds
from facetforge.operators.graphs import components
from facetforge.operators.ordering import uniform
from facetforge.operators.storing import dealt

CORNERS = ("v0", "v1", "v2")


def norm(*parts: Column) -> Column:
    return F.sqrt(sum((p * p for p in parts), F.lit(0.0)))


def dot(a: list[Column], b: list[Column]) -> Column:
    return sum((x * y for x, y in zip(a, b, strict=True)), F.lit(0.0))


def cross(a: list[Column], b: list[Column]) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def whole(corners: DataFrame, *columns: Column) -> DataFrame:
    """The corners (sha, fidx, pid, at) of each face brought together; a face of which a corner is missing has no row."""
    met = [F.bool_or(F.col("at") == k) for k in range(3)]
    rows = corners.groupBy("sha", "fidx", "pid").agg(*columns, (met[0] & met[1] & met[2]).alias("_whole"))
    return rows.where("_whole").drop("_whole")


def shaped(vertices: DataFrame, faces: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """The faces with the corners a_, b_, c_ of each axis, the centre m_, the unit normal n_, and the area; `also`: further
    columns of the vertices, as a_u for instance. Corners are looked up by one join and brought back by one aggregate; a face
    of which a vertex is missing has no row."""
    names = (*AXES, *also)
    corners = faces.select("sha", "fidx", "pid", F.posexplode(F.array(*CORNERS)).alias("at", "vid"))
    met = corners.join(dealt(vertices.select("sha", "vid", *names)), ["sha", "vid"])
    corner = lambda k, a: F.max(F.when(F.col("at") == k, F.col(a))).alias(f"{'abc'[k]}_{a}")
    rows = whole(met, *(corner(k, a) for k in range(3) for a in names))
    one, two = ([F.col(f"{p}_{a}") - F.col(f"a_{a}") for a in AXES] for p in "bc")
    across = cross(one, two)
    size = norm(*across)
    return rows.withColumns(
        {f"m_{a}": (F.col(f"a_{a}") + F.col(f"b_{a}") + F.col(f"c_{a}")) / 3 for a in AXES}
        | {f"n_{a}": F.coalesce(F.try_divide(v, size), F.lit(0.0)) for a, v in zip(AXES, across, strict=True)}
        | {"area": size / 2}
    )


def touched(faces: DataFrame) -> DataFrame:
    """sha, vid: every vertex that a face has, once."""
    return faces.select("sha", F.explode(F.array(*CORNERS)).alias("vid")).distinct()


def kept(vertices: DataFrame, faces: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """The faces that `keep` holds for, and the vertices that they have. Assets of which none or all faces stay are empty
    or whole."""
    left = faces.where(keep)
    return vertices.join(dealt(touched(left)), ["sha", "vid"], "left_semi"), left


def standing(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """The faces that have all their vertices."""
    corners = faces.select("sha", "fidx", "pid", F.posexplode(F.array(*CORNERS)).alias("at", "vid"))
    met = corners.join(dealt(vertices.select("sha", "vid")), ["sha", "vid"])
    return whole(met, *(F.max(F.when(F.col("at") == k, F.col("vid"))).alias(v) for k, v in enumerate(CORNERS)))


def renumbered(vertices: DataFrame, faces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices and faces numbered from 0 in their order, inside each asset; faces of which a vertex is missing go."""
    place = F.row_number().over(Window.partitionBy("sha").orderBy("vid")) - 1
    ranked = vertices.withColumn("to", place)
    corners = faces.select("sha", "fidx", "pid", F.posexplode(F.array(*CORNERS)).alias("at", "vid")).join(dealt(ranked.select("sha", "vid", "to")), ["sha", "vid"])
    corners = whole(corners, *(F.max(F.when(F.col("at") == k, F.col("to"))).alias(v) for k, v in enumerate(CORNERS)))
    dense = F.row_number().over(Window.partitionBy("sha").orderBy("fidx")) - 1
    return ranked.drop("vid").withColumnRenamed("to", "vid"), corners.withColumn("fidx", dense)


def moved(vertices: DataFrame, chosen: DataFrame, to: dict[str, Column], frame: DataFrame | None = None) -> DataFrame:
    """The vertices with those that the chosen faces touch put elsewhere, whatever other parts share them. frame: columns
    of each asset that `to` reads."""
    hit = touched(chosen).withColumn("_hit", F.lit(True))
    rows = vertices.join(hit, ["sha", "vid"], "left")
    if frame is not None:
        rows = rows.join(frame, "sha", "left")
    made = {a: F.coalesce(F.when(F.col("_hit"), to[a]), F.col(a)) for a in AXES if a in to}
    return rows.withColumns(made).select(vertices.columns)


def longer(*sides: Column) -> Column:
    """Which side is the longest, from 0; of equal ones the first."""
    most = F.greatest(*sides)
    return reduce(lambda out, k: F.when(sides[k] == most, k).otherwise(out), range(len(sides) - 2, -1, -1), F.lit(len(sides) - 1))


def transforms(op: Column, c: dict[str, Column], ext: dict[str, Column], grow: float = 1.5, degrees: float = 35.0, way: float = 0.3) -> dict[str, Column]:
    """Where a vertex goes by the operation's name: scale about the centre, rotate about the upright axis through it, or
    else translate along the longer of the level axes."""
    at = {a: F.col(a) - c[a] for a in AXES}
    cos, sin = F.cos(F.radians(F.lit(degrees))), F.sin(F.radians(F.lit(degrees)))
    turned = {"x": c["x"] + at["x"] * cos - at["y"] * sin, "y": c["y"] + at["x"] * sin + at["y"] * cos, "z": F.col("z")}
    along = longer(ext["x"], ext["y"])
    shift = {"x": F.when(along == 0, way * ext["x"]).otherwise(0.0), "y": F.when(along == 1, way * ext["y"]).otherwise(0.0), "z": F.lit(0.0)}
    return {a: F.when(op == "scale", c[a] + grow * at[a]).when(op == "rotate", turned[a]).otherwise(F.col(a) + shift[a]) for a in AXES}


def centres(shapes: DataFrame, chosen: Column) -> DataFrame:
    """sha, k_ of each axis: the mean of the chosen faces' centres, areas aside; n: how many they are."""
    return shapes.where(chosen).groupBy("sha").agg(*(F.avg(f"m_{a}").alias(f"k_{a}") for a in AXES), F.count("*").alias("n"))


def extents(vertices: DataFrame) -> DataFrame:
    """sha, e_ of each axis, and the means of the vertices g_."""
    sides = [(F.max(a) - F.min(a)).alias(f"e_{a}") for a in AXES]
    return vertices.groupBy("sha").agg(*sides, *(F.avg(a).alias(f"g_{a}") for a in AXES))


def edited(vertices: DataFrame, faces: DataFrame, chosen: Column, ops: DataFrame, least: int = 1, span: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The vertices with the chosen faces' moved by the operation that `ops` (sha, op) names, about the chosen faces'
    centre; and sha, op of the assets with at least so many chosen faces. span: what extents() says of the frame, if
    another state's is meant."""
    frame = centres(shaped(vertices, faces), chosen).where(F.col("n") >= least).join(extents(vertices) if span is None else span, "sha").join(ops, "sha")
    to = transforms(F.col("op"), {a: F.col(f"k_{a}") for a in AXES}, {a: F.col(f"e_{a}") for a in AXES})
    made = moved(vertices, faces.where(chosen), to, frame)
    return made.join(frame.select("sha"), "sha", "left_semi"), frame.select("sha", "op")


def replayed(vertices: DataFrame, faces: DataFrame, remove: Column, change: Column, ops: DataFrame, least: int = 40) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A chain of two turns: the faces of `remove` go, then those of `change` are moved in what is left. Vertices and faces
    of the last state, and sha, op of the assets where enough faces to change were left. Faces of which a vertex is missing
    hold no other vertex there."""
    state, left = kept(vertices, standing(vertices, faces), ~remove)
    last, done = edited(state, left, change, ops, least, extents(vertices))
    return last, left.join(done.select("sha"), "sha", "left_semi"), done


def pasted(host: DataFrame, donor: DataFrame, seat: str, share: float, sink: float = 0.0, around: DataFrame | None = None) -> DataFrame:
    """The donor's vertices as they stand on the host's. donor: sha (the host's), vid, x, y, z. The donor is scaled about
    its mean to `share` of a diagonal. seat `top`: of the host's box, then its lowest point on the host's highest at the mean
    of the host's vertices, sunk by a share of the host's height; seat `around`: of the box of `around` (sha, x, y, z: the
    centres of the faces it replaces), then its mean on theirs."""
    ref = host if seat == "top" else around
    diag = F.sqrt(sum(((F.max(a) - F.min(a)) ** 2 for a in AXES), F.lit(0.0)))
    frame = ref.groupBy("sha").agg(diag.alias("f"), *(F.avg(a).alias(f"f_{a}") for a in AXES), F.max("z").alias("f_top"), (F.max("z") - F.min("z")).alias("f_tall"))
    own = donor.groupBy("sha").agg(diag.alias("d"), *(F.avg(a).alias(f"d_{a}") for a in AXES), F.min("z").alias("d_low"))
    rows = donor.join(own, "sha").join(frame, "sha")
    s = share * F.col("f") / F.greatest("d", F.lit(1e-6))
    to = {a: (F.col(a) - F.col(f"d_{a}")) * s + F.col(f"f_{a}") for a in AXES}
    if seat == "top":
        to["z"] = (F.col("z") - F.col("d_low")) * s + F.col("f_top") - sink * F.col("f_tall")
    return rows.withColumns(to).select(donor.columns)


def boundary(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """sha, sid, x, y, z: the middles of the edges that one face alone has."""
    sides = F.array(*(F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")) for a, b in (("v0", "v1"), ("v1", "v2"), ("v2", "v0"))))
    alone = faces.select("sha", F.inline(sides)).groupBy("sha", "a", "b").agg(F.count("*").alias("n")).where("n = 1")
    ends = alone.select("sha", "a", "b", F.explode(F.array("a", "b")).alias("vid")).join(vertices, ["sha", "vid"])
    mids = ends.groupBy("sha", "a", "b").agg(*(F.avg(a).alias(a) for a in AXES))
    return mids.select("sha", F.concat_ws("-", "a", "b").alias("sid"), *AXES)


def adjacent(faces: DataFrame) -> DataFrame:
    """a, b: the links between an asset's faces, as sha and fidx: two faces that share an edge which no third one has. Faces
    that meet in a vertex alone aren't linked."""
    sides = F.array(*(F.struct(F.least(p, q).alias("p"), F.greatest(p, q).alias("q")) for p, q in (("v0", "v1"), ("v1", "v2"), ("v2", "v0"))))
    both = faces.select("sha", "fidx", F.inline(sides)).groupBy("sha", "p", "q").agg(F.min("fidx").alias("one"), F.max("fidx").alias("two"), F.count("*").alias("n"))
    both = both.where("n = 2 and one <> two")
    return both.select(*(F.struct("sha", F.col(c).alias("fidx")).alias(k) for k, c in (("a", "one"), ("b", "two"))))


def bodies(faces: DataFrame) -> DataFrame:
    """The faces with `body`: the smallest face of those that hang together by shared edges; a face alone is a body."""
    found = components(adjacent(faces)).select("node.sha", "node.fidx", F.col("label.fidx").alias("body"))
    return faces.join(dealt(found), ["sha", "fidx"], "left").withColumn("body", F.coalesce("body", "fidx"))


def sampled(shapes: DataFrame, n: int | Column, seed: int | str, steps: int = 256, by: tuple[str, ...] = ("sha",)) -> DataFrame:
    """n points on each surface (an asset's, or that of the faces with the same `by`): by, sid (from 0), fidx, pid, x, y, z,
    and the weights w0, w1, w2 of the corners. n: a number, or an aggregate over the faces. The face is the first whose share
    of the running area exceeds the sample's number; numbers and faces meet in steps of the share, so no sample is compared
    with every face. Surfaces without an area have no points."""
    group = Window.partitionBy(*by)
    upto = F.sum("area").over(group.orderBy("fidx").rowsBetween(Window.unboundedPreceding, 0))
    whole = F.sum("area").over(group)
    rows = shapes.withColumns({"hi": F.round(F.try_divide(upto, whole), 12), "lo": F.round(F.try_divide(upto - F.col("area"), whole), 12)}).where("hi > lo")
    step = lambda c: F.least(F.floor(c * steps), F.lit(steps - 1))
    rows = rows.withColumn("step", F.explode(F.sequence(step(F.col("lo")), step(F.col("hi")))))
    many = n.cast("int") if isinstance(n, Column) else F.lit(n)
    draws = shapes.groupBy(*by).agg(F.max(many).alias("many") if not isinstance(n, Column) else many.alias("many"))
    draws = draws.select(*by, F.explode(F.sequence(F.lit(0), F.col("many") - 1)).alias("sid"))
    draws = draws.withColumns({k: uniform(f"{seed}{k}", *by, "sid") for k in ("u", "r", "s")}).withColumn("step", step(F.col("u")))
    met = draws.join(dealt(rows), [*by, "step"]).where("lo <= u and u < hi")
    root = F.sqrt("r")
    met = met.withColumns({"w0": 1 - root, "w1": root * (1 - F.col("s")), "w2": root * F.col("s")})
    at = {a: F.col("w0") * F.col(f"a_{a}") + F.col("w1") * F.col(f"b_{a}") + F.col("w2") * F.col(f"c_{a}") for a in AXES}
    return met.withColumns(at).drop("step", "u", "r", "s", "lo", "hi")


def part_box(shapes: DataFrame, vertices: DataFrame, by: list[str], grow: float = 1.1, least: float = 0.15) -> DataFrame:
    """by, lo_ and hi_ of each axis: a cube about the middle of the faces' centres, as wide as grown or as a share of the
    asset, whichever is more."""
    box = bounds(shapes.select(*by, *(F.col(f"m_{a}").alias(a) for a in AXES)), by).drop("n", "diag")
    whole = extents(vertices).select("sha", F.greatest("e_x", "e_y", "e_z").alias("w"))
    side = lambda a: F.col(f"hi_{a}") - F.col(f"lo_{a}")
    rows = box.join(whole, "sha").withColumn("half", F.greatest(grow * F.greatest(*map(side, AXES)), least * F.col("w")))
    middle = {a: (F.col(f"lo_{a}") + F.col(f"hi_{a}")) / 2 for a in AXES}
    return rows.select(*by, *((middle[a] + sign * F.col("half")).alias(f"{n}_{a}") for a in AXES for n, sign in (("lo", -1), ("hi", 1))))


def doubled(vertices: DataFrame, faces: DataFrame, chosen: Column, off_centre: float = 0.12, beside: float = 1.15) -> DataFrame:
    """sha, vid, x, y, z, op: a copy of the chosen faces' vertices; mirrored about the mean of all centres if their own lies
    off it by a share of the asset's width, else put beside them along the asset's longer level axis."""
    shapes = shaped(vertices, faces)
    frame = shapes.groupBy("sha").agg(F.avg("m_x").alias("a_x"), F.avg(F.when(chosen, F.col("m_x"))).alias("k_x")).where("k_x is not null")
    part = vertices.join(touched(faces.where(chosen)), ["sha", "vid"], "left_semi")
    sides = extents(part).select("sha", F.col("e_x").alias("p_x"), F.col("e_y").alias("p_y"))
    rows = part.join(frame, "sha").join(extents(vertices), "sha").join(sides, "sha")
    mirror = F.abs(F.col("k_x") - F.col("a_x")) > off_centre * F.col("e_x")
    along = longer(F.col("e_x"), F.col("e_y"))
    x = F.when(mirror, 2 * F.col("a_x") - F.col("x")).otherwise(F.col("x") + F.when(along == 0, beside * F.col("p_x")).otherwise(0.0))
    y = F.col("y") + F.when(~mirror & (along == 1), beside * F.col("p_y")).otherwise(0.0)
    return rows.select("sha", "vid", x.alias("x"), y.alias("y"), "z", F.when(mirror, "mirror").otherwise("duplicate").alias("op"))


def cubed(vertices: DataFrame, half: float = 0.8) -> DataFrame:
    """sha, o_ of each axis and the scale: what takes an asset's box into a cube of that half side about 0; a place p goes to
    (p - o) / scale, and back by p * scale + o."""
    box = bounds(vertices, ["sha"])
    middle = [((F.col(f"lo_{a}") + F.col(f"hi_{a}")) / 2).alias(f"o_{a}") for a in AXES]
    widest = F.greatest(*(F.col(f"hi_{a}") - F.col(f"lo_{a}") for a in AXES))
    return box.select("sha", *middle, (widest / 2 / half).alias("scale"))


def padded(box: DataFrame, by: float, of_widest: bool = False) -> DataFrame:
    """The boxes lo_, hi_ grown about their middles to so many times each side, or by a share of the widest side all round."""
    side = {a: F.col(f"hi_{a}") - F.col(f"lo_{a}") for a in AXES}
    room = {a: by * F.greatest(*side.values()) if of_widest else (by - 1) / 2 * side[a] for a in AXES}
    return box.withColumns({f"lo_{a}": F.col(f"lo_{a}") - room[a] for a in AXES} | {f"hi_{a}": F.col(f"hi_{a}") + room[a] for a in AXES})


def anchors(box: DataFrame, share: float = 5e-4) -> DataFrame:
    """sha, anchor, corner, x, y, z: two tiny triangles at a box's ends, which hold a picture's frame where it is."""
    eps = F.sqrt(sum(((F.col(f"hi_{a}") - F.col(f"lo_{a}")) ** 2 for a in AXES), F.lit(0.0))) * share
    one = [F.struct(F.lit(i).alias("anchor"), F.lit(k).alias("corner"), *((F.col(f"{end}_{a}") + (eps if k and a == "xy"[k - 1] else 0.0)).alias(a) for a in AXES)) for i, end in enumerate(("lo", "hi")) for k in range(3)]
    return box.select("sha", F.inline(F.array(*one)))

"""Textures as tables: images in tiles that are looked up, triangles drawn line by line, masks widened and blurred along rows
and then along columns, and empty texels filled by an exact distance transform. A row or column of an atlas is the largest
thing that a task holds at once; rows made are in proportion to texels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetforge.operators.geometry import AXES, bounds, nearest
from facetforge.operators.meshes import sampled
from facetforge.operators.storing import dealt

#: Texels of a tile's side; fixed values: the grey of a surface without a texture, and the whole of an opaque texel.
TILE, GREY, OPAQUE = 64, 200, 255
CHANNELS = ("r", "g", "b", "a")


def texel(u: Column, v: Column, wide: Column | int, high: Column | int) -> tuple[Column, Column]:
    """The texel of a place in the atlas: wrapped, upside down, cut off toward zero."""
    x = F.least(F.pmod(u, F.lit(1.0)) * (wide - 1), F.lit(1.0) * (wide - 1)).cast("int")
    y = F.greatest(F.least((1 - F.pmod(v, F.lit(1.0))) * (high - 1), F.lit(1.0) * (high - 1)), F.lit(0.0)).cast("int")
    return x, y


def tiled(images: DataFrame, side: int = TILE) -> DataFrame:
    """image, wide, high, tx, ty, across (the tile's width), pixels: each image (image, wide, high, pixels: four bytes a texel,
    row by row) in tiles."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                wide, high, raw = (batch.column(c)[i].as_py() for c in ("wide", "high", "pixels"))
                flat = np.frombuffer(raw, np.uint8)[: wide * high * 4].reshape(high, wide, 4)
                for ty in range(0, high, side):
                    tiles = [flat[ty : ty + side, tx : tx + side] for tx in range(0, wide, side)]
                    many = len(tiles)
                    columns = [pa.array([wide] * many, pa.int32()), pa.array([high] * many, pa.int32()), pa.array(range(many), pa.int32()), pa.array([ty // side] * many, pa.int32())]
                    columns += [pa.array([t.shape[1] for t in tiles], pa.int32()), pa.array([t.tobytes() for t in tiles], pa.binary())]
                    image = batch.column("image").take(pa.array([i] * many))
                    yield pa.RecordBatch.from_arrays([image, *columns], ["image", "wide", "high", "tx", "ty", "across", "pixels"])

    kind = images.schema["image"].dataType.simpleString()
    return images.select("image", "wide", "high", "pixels").mapInArrow(cut, f"image {kind}, wide int, high int, tx int, ty int, across int, pixels binary")


def coloured(points: DataFrame, tiles: DataFrame, side: int = TILE) -> DataFrame:
    """The points (image, u, v and others) with r, g, b, a: those of the texel at their place in the image; grey where there is
    no image, no place, or no such texel."""
    sizes = tiles.where("tx = 0 and ty = 0").select("image", "wide", "high")
    rows = points.join(dealt(sizes), "image", "left")
    there = F.col("u").isNotNull() & F.col("v").isNotNull() & F.col("wide").isNotNull()
    x, y = (F.when(there, c) for c in texel(F.col("u"), F.col("v"), F.col("wide"), F.col("high")))
    rows = rows.withColumns({"_x": x, "_y": y}).withColumns({"tx": F.floor(F.col("_x") / side).cast("int"), "ty": F.floor(F.col("_y") / side).cast("int")})
    met = rows.join(dealt(tiles.select("image", "tx", "ty", "across", "pixels")), ["image", "tx", "ty"], "left")
    first = (F.col("_y") % side * F.col("across") + F.col("_x") % side) * 4
    byte = lambda k: F.conv(F.hex(F.substring("pixels", first + (k + 1), F.lit(1))), 16, 10)
    known = {c: F.coalesce(F.when(F.length("pixels") > first + k, byte(k)).cast("int"), F.lit(GREY)) for k, c in enumerate(CHANNELS)}
    return met.select(*points.columns, *(c.alias(n) for n, c in known.items()))


def rastered(shapes: DataFrame, wide: int, high: int) -> DataFrame:
    """sha, x, y: the texels whose centres lie in a face's triangle of the atlas (columns a_u, a_v, ...), or on its edge. A
    triangle has a row for each line that it meets, with the ends of its span there; spans become texels line by line."""
    px = {p: (F.col(f"{p}_u") * (wide - 1), (1 - F.col(f"{p}_v")) * (high - 1)) for p in "abc"}
    rows = shapes.select("sha", *(c.alias(f"{p}{k}") for p in "abc" for k, c in zip("xy", px[p], strict=True)))
    low = lambda k: F.greatest(F.ceil(F.least(f"a{k}", f"b{k}", f"c{k}")), F.lit(0))
    top = lambda k, most: F.least(F.floor(F.greatest(f"a{k}", f"b{k}", f"c{k}")), F.lit(most - 1))
    rows = rows.withColumns({"x_low": low("x"), "x_top": top("x", wide)}).where((F.col("x_low") <= F.col("x_top")) & (low("y") <= top("y", high)))
    rows = rows.withColumn("y", F.explode(F.sequence(low("y"), top("y", high)))).withColumn("turn", F.explode(F.array(F.lit(1.0), F.lit(-1.0))))
    edges = [("a", "b"), ("b", "c"), ("c", "a")]
    side = lambda p, q, x: F.col("turn") * ((F.col(f"{q}x") - F.col(f"{p}x")) * (F.col("y") - F.col(f"{p}y")) - (F.col(f"{q}y") - F.col(f"{p}y")) * (x - F.col(f"{p}x")))
    # Where a side's number, which falls or rises along the line, is nothing: the span's end, but for rounding.
    slope = lambda p, q: -F.col("turn") * (F.col(f"{q}y") - F.col(f"{p}y"))
    zero = lambda p, q: F.try_divide(-1e-9 - side(p, q, F.lit(0.0)), slope(p, q))
    fits = lambda x: (x >= F.col("x_low")) & (x <= F.col("x_top")) & (F.least(*(side(p, q, x) for p, q in edges)) >= -1e-9)
    far = F.lit(1e15)
    start = F.ceil(F.least(F.greatest(F.col("x_low").cast("double"), *(F.when(slope(p, q) > 0, zero(p, q)).otherwise(-far) for p, q in edges)), far))
    stop = F.floor(F.greatest(F.least(F.col("x_top").cast("double"), *(F.when(slope(p, q) < 0, zero(p, q)).otherwise(far) for p, q in edges)), -far))
    rows = rows.withColumns({"start": start, "stop": stop})
    # The ends themselves are settled by the sides' numbers there, as for any texel.
    settled = lambda c, steps: F.coalesce(*(F.when(fits(F.col(c) + k), F.col(c) + k) for k in steps))
    spans = rows.select("sha", "y", settled("start", (-1, 0, 1)).alias("x0"), settled("stop", (1, 0, -1)).alias("x1")).where("x0 <= x1")
    lines = spans.groupBy("sha", "y").agg(F.collect_set(F.struct("x0", "x1")).alias("spans"))
    texels = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s.x0, s.x1))))
    return lines.select("sha", F.explode(texels).alias("x"), "y").select("sha", *(F.col(c).cast("int").alias(c) for c in ("x", "y")))


def along(cells: DataFrame, axis: str, value: str, n: int, run: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """sha, x, y, value: what `run` makes of each row (axis x) or column (axis y) of n texels; those that aren't there are 0,
    and 0 has no row."""
    other = "y" if axis == "x" else "x"
    kind = cells.schema["sha"].dataType.simpleString()

    def pass_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                held = part.column("held")
                flat, size = held.flatten(), held.value_lengths().to_numpy(zero_copy_only=False)
                dense = np.zeros((part.num_rows, n))
                dense[np.repeat(np.arange(part.num_rows), size), flat.field("at").to_numpy(zero_copy_only=False)] = flat.field("value").to_numpy(zero_copy_only=False)
                made = run(dense)
                row, at = np.nonzero(made)
                columns = [part.column("sha").take(pa.array(row)), part.column("line").take(pa.array(row)), pa.array(at.astype(np.int32)), pa.array(made[row, at])]
                yield pa.RecordBatch.from_arrays(columns, ["sha", "line", "at", "value"])

    lines = cells.groupBy("sha", F.col(other).cast("int").alias("line")).agg(F.collect_list(F.struct(F.col(axis).cast("int").alias("at"), F.col(value).cast("double").alias("value"))).alias("held"))
    made = lines.mapInArrow(pass_over, f"sha {kind}, line int, at int, value double")
    return made.select("sha", *(F.col("at" if c == axis else "line").alias(c) for c in ("x", "y")), F.col("value").alias(value))


def spread(cells: DataFrame, value: str, wide: int, high: int, reach: int, how: str, sigma: float = 2.0) -> DataFrame:
    """sha, x, y, value: of each texel the largest value within `reach` (how: max), or the mean weighted by a bell curve
    (how: blur); texels that aren't there count as 0, those beyond the edge as the edge's. Both are done along the rows first
    and then along the columns."""
    bell = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * sigma * sigma))
    bell /= bell.sum()

    def run(dense: np.ndarray) -> np.ndarray:
        around = np.lib.stride_tricks.sliding_window_view(np.pad(dense, ((0, 0), (reach, reach)), mode="edge"), 2 * reach + 1, axis=1)
        return around.max(axis=2) if how == "max" else around @ bell

    return along(along(cells, "x", value, wide, run), "y", value, high, run)


def blended(base: DataFrame, edit: DataFrame, mask: DataFrame, values: list[str]) -> DataFrame:
    """sha, x, y, values: the base where the mask is 0, the edit where it is 1, cut off toward zero; of two images the one
    that is there, where the other has no texel of the asset."""
    key = ["sha", "x", "y"]
    both = base.join(dealt(edit.select(*key, *(F.col(v).alias(f"_{v}") for v in values))), key, "full").join(dealt(mask), key, "left")
    m = F.coalesce("m", F.lit(0.0))
    # To six digits first: two equal values blended are that value, not the one below.
    out = {v: F.coalesce(F.round(F.col(v) * (1 - m) + F.col(f"_{v}") * m, 6).cast("int"), F.col(v), F.col(f"_{v}")) for v in values}
    return both.select(*key, *(c.alias(v) for v, c in out.items()))


def envelope(at: np.ndarray, cost: np.ndarray, n: int) -> np.ndarray:
    """For each row of costs and each x below n, which of the parabolas (x - at)^2 + cost is the lowest; of equal ones the
    first. at: rising whole numbers, the same for all rows. A stack holds the parabolas of the lower envelope with the x where
    each begins; all rows take a parabola at a time."""
    rows = np.arange(len(cost))
    stack, begin, depth = np.zeros(cost.shape, np.int64), np.zeros(cost.shape, np.int64), np.zeros(len(cost), np.int64)
    for j in range(len(at)):
        first, asks = np.zeros(len(cost), np.int64), rows
        while len(asks := asks[depth[asks] > 0]):
            top = stack[asks, depth[asks] - 1]
            # The first x where this one is lower than the one on top.
            first[asks] = (cost[asks, j] + at[j] ** 2 - cost[asks, top] - at[top] ** 2) // (2 * (at[j] - at[top])) + 1
            asks = asks[first[asks] <= begin[asks, depth[asks] - 1]]
            depth[asks] -= 1
        first[depth == 0] = 0
        on = rows[first < n]
        stack[on, depth[on]], begin[on, depth[on]] = j, first[on]
        depth[on] += 1
    place = np.zeros((len(cost), n), np.int64)
    for k in range(depth.max(initial=0)):
        has = rows[depth > k]
        place[has, begin[has, k]] = k
    return np.take_along_axis(stack, np.maximum.accumulate(place, axis=1), axis=1)


def filled(texels: DataFrame, wide: int, high: int) -> DataFrame:
    """sha, tx, ty, colour, far: every texel of the assets' atlases with the colour of the nearest one there is (of equally
    near ones the first by tx, then ty) and the square of the way to it. Columns hand on their own nearest texel to each row;
    a row is the lower envelope of what its columns have."""
    sha, colour = (texels.schema[c].dataType.simpleString() for c in ("sha", "colour"))

    def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y = np.arange(high)
        for batch in batches:
            held = batch.column("held")
            flat, stop = held.flatten(), np.cumsum(held.value_lengths().to_numpy(zero_copy_only=False))
            ty = flat.field("ty").to_numpy(zero_copy_only=False).astype(np.int64)
            for i in range(batch.num_rows):
                a, b = int(stop[i - 1]) if i else 0, int(stop[i])
                own = ty[a:b]
                right = np.minimum(np.searchsorted(own, y), len(own) - 1)
                left = np.maximum(right - 1, 0)
                best = np.where(np.abs(own[left] - y) <= np.abs(own[right] - y), left, right)
                same = pa.array(np.full(high, i))
                found = [batch.column("sha").take(same), batch.column("tx").take(same), pa.array(y.astype(np.int32)), pa.array(own[best].astype(np.int32)), flat.field("colour").take(pa.array(a + best))]
                yield pa.RecordBatch.from_arrays(found, ["sha", "tx", "y", "ty", "colour"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = np.arange(wide)
        for batch in batches:
            held = batch.column("held")
            flat, stop = held.flatten(), np.cumsum(held.value_lengths().to_numpy(zero_copy_only=False))
            tx, ty = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("tx", "ty"))
            y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.int64)
            start = np.concatenate(([0], stop[:-1]))
            first = 0
            while first < batch.num_rows:  # rows with the same columns together, as those of an asset
                size, last = stop[first] - start[first], first + 1
                while last < batch.num_rows and last - first < 256 and stop[last] - start[last] == size and np.array_equal(tx[start[last] : stop[last]], tx[start[first] : stop[first]]):
                    last += 1
                at = tx[start[first] : stop[first]]
                own = ty[start[first] : stop[last - 1]].reshape(-1, size)
                cost = (own - y[first:last, None]) ** 2
                best = envelope(at, cost, wide)
                far = (x - at[best]) ** 2 + np.take_along_axis(cost, best, axis=1)
                source = (start[first:last, None] + best).ravel()
                row = pa.array(np.repeat(np.arange(first, last), wide))
                found = [batch.column("sha").take(row), pa.array(np.tile(x, last - first).astype(np.int32)), batch.column("y").take(row), flat.field("colour").take(pa.array(source)), pa.array(far.ravel().astype(np.int32))]
                yield pa.RecordBatch.from_arrays(found, ["sha", "tx", "ty", "colour", "far"])
                first = last

    whole = lambda c: F.col(c).cast("int").alias(c)
    lines = texels.groupBy("sha", whole("tx")).agg(F.array_sort(F.collect_list(F.struct(whole("ty"), "colour"))).alias("held"))
    handed = lines.mapInArrow(columns, f"sha {sha}, tx int, y int, ty int, colour {colour}")
    lines = handed.groupBy("sha", "y").agg(F.array_sort(F.collect_list(F.struct("tx", "ty", "colour"))).alias("held"))
    return lines.mapInArrow(rows, f"sha {sha}, tx int, ty int, colour {colour}, far int")


def unit_frame(points: DataFrame, vertices: DataFrame) -> DataFrame:
    """The points in their asset's frame: about the middle of the vertices' box, its widest side being one."""
    wide = F.greatest(*(F.col(f"hi_{a}") - F.col(f"lo_{a}") for a in AXES), F.lit(1e-9))
    rows = points.join(dealt(bounds(vertices, ["sha"]).drop("n", "diag")), "sha")
    return rows.withColumns({a: (F.col(a) - (F.col(f"lo_{a}") + F.col(f"hi_{a}")) / 2) / wide for a in AXES}).drop(*(f"{e}_{a}" for e in ("lo", "hi") for a in AXES))


def skin(shapes: DataFrame, n: int, seed: int | str) -> DataFrame:
    """sha, sid, x, y, z, u, v: n points of each surface, with their places in the atlas by the corners' weights."""
    points = sampled(shapes, n, seed)
    at = {c: F.col("w0") * F.col(f"a_{c}") + F.col("w1") * F.col(f"b_{c}") + F.col("w2") * F.col(f"c_{c}") for c in ("u", "v")}
    return points.select("sha", "sid", *AXES, *(e.alias(c) for c, e in at.items()))


def rebaked(original: tuple[DataFrame, DataFrame], target: tuple[DataFrame, DataFrame], tiles: DataFrame, size: int, n: int, seeds: tuple[int, int] = (0, 1)) -> DataFrame:
    """sha, x, y, r, g, b, a: an atlas for each target, coloured by the original's surface. original, target: vertices and
    shapes (with u and v of the corners) by sha; tiles: the original's textures, the image being the sha. Points of both
    surfaces are drawn and brought into one frame, each point of the target takes the colour of the nearest one of the
    original, a texel takes the mean of its points, cut off toward zero, and an empty one that of the nearest."""
    source = unit_frame(skin(original[1], n, seeds[0]).withColumn("image", F.col("sha")), original[0])
    source = coloured(source, tiles)
    goal = unit_frame(skin(target[1], n, seeds[1]), target[0])
    near = nearest(goal.select("sha", "sid", *AXES), source.select("sha", "sid", *AXES), F.lit(True)).select("sha", "sid", "near_sid")
    painted = goal.join(dealt(near), ["sha", "sid"]).join(dealt(source.select("sha", F.col("sid").alias("near_sid"), *CHANNELS)), ["sha", "near_sid"])
    x, y = texel(F.col("u"), F.col("v"), size, size)
    means = painted.groupBy("sha", x.alias("tx"), y.alias("ty")).agg(F.struct(*(F.avg(c).cast("int").alias(c) for c in CHANNELS[:3])).alias("colour"))
    full = filled(means, size, size)
    return full.select("sha", F.col("tx").alias("x"), F.col("ty").alias("y"), *(F.col(f"colour.{c}").alias(c) for c in CHANNELS[:3]), F.lit(OPAQUE).alias("a"))


def merged(base: DataFrame, edit: DataFrame, shapes: DataFrame, hot: DataFrame, wide: int, high: int, share: float = 0.01, widen: int = 2, blur: int = 4) -> tuple[DataFrame, DataFrame]:
    """A part's texture taken from an edit: sha, x, y, r, g, b, a, and sha, part_face_share. base, edit: atlases; shapes: faces
    with u and v; hot: sha, fidx of the part's faces. Assets of which the part has less than a share of the faces have no row."""
    counts = shapes.groupBy("sha").agg(F.count("*").alias("n")).join(dealt(hot.groupBy("sha").agg(F.count("*").alias("k"))), "sha")
    counts = counts.select("sha", (F.col("k") / F.col("n")).alias("part_face_share")).where(F.col("part_face_share") >= share)
    own = shapes.join(dealt(hot), ["sha", "fidx"], "left_semi").join(dealt(counts.select("sha")), "sha", "left_semi")
    cells = rastered(own, wide, high).withColumn("m", F.lit(1.0))
    mask = spread(spread(cells, "m", wide, high, widen, "max"), "m", wide, high, blur, "blur").withColumn("m", F.round("m", 12))
    both = [df.join(dealt(counts.select("sha")), "sha", "left_semi") for df in (base, edit)]
    return blended(*both, mask, list(CHANNELS)), counts

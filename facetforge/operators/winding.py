"""Winding numbers by a tree of face clusters: what is near is opened, what is far counts as one dipole.

The faces of a surface lie in cubes, halved from level to level. A cube's faces have a dipole, the sum of their normals times
areas, at the centre of their areas, and a ball about it that holds them. A point that is farther from the centre than `beta`
radii takes the dipole's angle; else it goes on to the cubes inside, and at a leaf (a cube of few faces, or of the last
level) to the faces, whose angles are exact. So a point meets, on each level, the cubes within `beta` radii, and not every
face: rows grow with points times levels. With `beta` 3 closed surfaces are within 0.01 of the exact sum, inside and outside.

Surfaces are told apart by the columns `on`; those of at most `leaf` faces are summed exactly. Points with no surface have no
row. Assets may be of any size: cubes are aggregated and joined, no surface is one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetforge.operators.geometry import AXES
from facetforge.operators.meshes import cross, dot, norm
from facetforge.operators.storing import kept

CELL = ("cx", "cy", "cz")
#: The corners and centre of a face, its normal and area, as meshes.shaped has them.
SHAPE = [f"{p}_{a}" for p in "abcmn" for a in AXES] + ["area"]


def solid_angle(corners: list[list[Column]], at: list[Column]) -> Column:
    """The angle under which a point sees a triangle, over the whole sphere's; 0 from one of its corners."""
    a, b, c = ([x - y for x, y in zip(p, at, strict=True)] for p in corners)
    la, lb, lc = norm(*a), norm(*b), norm(*c)
    below = la * lb * lc + dot(a, b) * lc + dot(b, c) * la + dot(c, a) * lb
    return 2 * F.atan2(dot(a, cross(b, c)), below) / (4 * F.lit(3.141592653589793))


def placed(shapes: DataFrame, on: list[str], deepest: int) -> DataFrame:
    """The faces with `level` and the cube cx, cy, cz of their centre: a row for each level."""
    box = shapes.groupBy(*on).agg(*(F.min(f"m_{a}").alias(f"lo_{a}") for a in AXES), F.greatest(*(F.max(f"m_{a}") - F.min(f"m_{a}") for a in AXES), F.lit(1e-12)).alias("side"))
    rows = shapes.select(*on, *SHAPE).join(box, on).withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(deepest))))
    many = F.pow(F.lit(2.0), F.col("level"))
    cell = {c: F.least(F.floor((F.col(f"m_{a}") - F.col(f"lo_{a}")) / F.col("side") * many), many - 1).cast("long") for c, a in zip(CELL, AXES, strict=True)}
    return rows.withColumns(cell).drop("side", *(f"lo_{a}" for a in AXES))


def clusters(rows: DataFrame, on: list[str]) -> DataFrame:
    """on, level, cube, n, the dipole d_ at k_, and the radius of the ball about it."""
    whole = F.greatest(F.sum("area"), F.lit(1e-300))
    sums = [F.count("*").alias("n")]
    for a in AXES:
        corners = [f"{p}_{a}" for p in "abc"]
        sums += [F.sum(F.col("area") * F.col(f"n_{a}")).alias(f"d_{a}"), (F.sum(F.col("area") * F.col(f"m_{a}")) / whole).alias(f"k_{a}"), F.min(F.least(*corners)).alias(f"lo_{a}"), F.max(F.greatest(*corners)).alias(f"hi_{a}")]
    found = rows.groupBy(*on, "level", *CELL).agg(*sums)
    # A cube without area has its centre at 0; the middle of its box will do, as its dipole is nothing.
    middle = {f"k_{a}": F.when(F.col(f"k_{a}").between(F.col(f"lo_{a}"), F.col(f"hi_{a}")), F.col(f"k_{a}")).otherwise((F.col(f"lo_{a}") + F.col(f"hi_{a}")) / 2) for a in AXES}
    found = found.withColumns(middle)
    radius = norm(*(F.greatest(F.col(f"k_{a}") - F.col(f"lo_{a}"), F.col(f"hi_{a}") - F.col(f"k_{a}")) for a in AXES))
    return found.withColumn("radius", radius).drop(*(f"{e}_{a}" for e in ("lo", "hi") for a in AXES))


def tree(shapes: DataFrame, on: list[str], leaf: int, deepest: int) -> tuple[DataFrame, DataFrame]:
    """The cubes down to the leaves, with `is_leaf`; and the faces with their leaf's level and cube."""
    rows = placed(shapes, on, deepest)
    every = clusters(rows, on).withColumn("is_leaf", (F.col("n") <= leaf) | (F.col("level") == deepest))
    # Below a leaf there is nothing: a cube stays if the one that holds it is no leaf.
    above = every.where(~F.col("is_leaf")).select(*on, (F.col("level") + 1).alias("level"), *(F.col(c).alias(f"up_{c}") for c in CELL))
    up = every.where("level > 0").withColumns({f"up_{c}": F.floor(F.col(c) / 2) for c in CELL})
    nodes = kept(every.where("level = 0").unionByName(up.join(above, [*on, "level", *(f"up_{c}" for c in CELL)], "left_semi").select(every.columns)))
    faces = rows.join(nodes.where("is_leaf").select(*on, "level", *CELL), [*on, "level", *CELL], "left_semi")
    return nodes, faces.select(*on, "level", *CELL, *(f"{p}_{a}" for p in "abc" for a in AXES))


def winding(shapes: DataFrame, points: DataFrame, on: list[str], beta: float = 3.0, leaf: int = 32, deepest: int = 10) -> DataFrame:
    """The points (on, x, y, z and columns that tell them apart) with `winding`: near 1 or -1 inside a closed surface with the
    same `on`, near 0 outside. shapes: faces as meshes.shaped has them, with the columns `on`."""
    nodes, faces = tree(shapes, on, leaf, deepest)
    at, by = [F.col(a) for a in AXES], points.columns
    to = [F.col(f"k_{a}") - F.col(a) for a in AXES]
    cube = ["n", "radius", "is_leaf", *(f"{k}_{a}" for k in "dk" for a in AXES)]
    ahead = points.join(nodes.where("level = 0"), on).select(*by, "level", *CELL, *cube)
    sums, opened, level = None, None, 0
    while True:
        far = norm(*to) > beta * F.col("radius")
        met = kept(ahead.withColumn("far", far))
        way = norm(*to)
        angle = dot([F.col(f"d_{a}") for a in AXES], to) / (way * way * way) / (4 * F.lit(3.141592653589793))
        seen = met.where("far").select(*by, angle.alias("w"))
        leaves = met.where("not far and is_leaf").select(*by, "level", *CELL)
        sums, opened = (seen, leaves) if sums is None else (sums.unionByName(seen), opened.unionByName(leaves))
        left = met.where("not far and not is_leaf").select(*by, *(F.col(c).alias(f"up_{c}") for c in CELL))
        level += 1
        if level > deepest or left.isEmpty():
            break
        below = nodes.where(F.col("level") == level).withColumns({f"up_{c}": F.floor(F.col(c) / 2) for c in CELL})
        ahead = left.join(below, [*on, *(f"up_{c}" for c in CELL)]).select(*by, "level", *CELL, *cube)
    corners = [[F.col(f"{p}_{a}") for a in AXES] for p in "abc"]
    exact = opened.join(faces, [*on, "level", *CELL]).select(*by, solid_angle(corners, at).alias("w"))
    return sums.unionByName(exact).groupBy(*by).agg(F.sum("w").alias("winding"))

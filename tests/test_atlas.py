"""Lookup, raster, blur and filling against every texel by itself."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from facetforge.operators import atlas

TEXELS = "sha string, tx int, ty int, colour int"


def brute_fill(rows, wide, high):
    out = {}
    for sha in {r[0] for r in rows}:
        held = np.array([r[1:] for r in rows if r[0] == sha])
        for x in range(wide):
            for y in range(high):
                far, a, b, c = min(((x - a) ** 2 + (y - b) ** 2, a, b, c) for a, b, c in held.tolist())
                out[sha, x, y] = (c, far)
    return out


@pytest.mark.parametrize(("wide", "high", "n", "seed"), [(8, 8, 3, 1), (64, 64, 90, 2), (64, 64, 1, 3), (40, 64, 700, 4), (5, 31, 12, 5)])
def test_every_texel_takes_the_nearest_one(spark, wide, high, n, seed):
    rng = random.Random(seed)
    rows = [(sha, x, y, rng.randrange(256)) for sha in ("a", "b") for x, y in {(rng.randrange(wide), rng.randrange(high)) for _ in range(n)}]
    rows += [("c", x, y, 9) for x in (0, wide - 1) for y in range(0, high, 2)]  # many equally near ones
    got = {(r.sha, r.tx, r.ty): (r.colour, r.far) for r in atlas.filled(spark.createDataFrame(rows, TEXELS).repartition(4), wide, high).collect()}
    assert got == brute_fill(rows, wide, high)


def test_nothing_to_fill(spark):
    assert atlas.filled(spark.createDataFrame([], TEXELS), 8, 8).count() == 0


def test_envelope_of_many_parabolas():
    rng = np.random.default_rng(7)
    for _ in range(30):
        at = np.sort(rng.choice(200, rng.integers(1, 60), replace=False))
        cost = rng.integers(0, 400, (9, len(at))) ** rng.integers(1, 3)
        every = (np.arange(200)[None, :, None] - at) ** 2 + cost[:, None, :]
        assert np.array_equal(atlas.envelope(at, cost, 200), every.argmin(axis=2))


def inside(t, x, y):
    (ax, ay), (bx, by), (cx, cy) = t
    side = lambda px, py, qx, qy: (qx - px) * (y - py) - (qy - py) * (x - px)
    s = [side(ax, ay, bx, by), side(bx, by, cx, cy), side(cx, cy, ax, ay)]
    xs, ys = zip(*t)
    return min(xs) <= x <= max(xs) and min(ys) <= y <= max(ys) and (min(s) >= -1e-9 or max(s) <= 1e-9)


def test_spans_are_the_texels_of_each_triangle(spark):
    rng, n = random.Random(8), 24
    places = [[(rng.uniform(-0.2, 1.2), rng.uniform(-0.2, 1.2)) for _ in range(3)] for _ in range(60)]
    places += [[(rng.randrange(n) / (n - 1), 1 - rng.randrange(n) / (n - 1)) for _ in range(3)] for _ in range(60)]  # corners on texels
    places += [[(0.1, 0.1), (0.5, 0.5), (0.9, 0.9)], [(0.3, 0.3)] * 3, [(0.2, 0.5), (0.8, 0.5), (0.4, 0.5)], [(0, 0), (1, 0), (0, 1)]]
    rows = [(str(i % 40), i, *(c for p in t for c in p)) for i, t in enumerate(places)]
    shapes = spark.createDataFrame([(*r[:2], *map(float, r[2:])) for r in rows], "sha string, fidx long, a_u double, a_v double, b_u double, b_v double, c_u double, c_v double")
    want = {(str(i % 40), x, y) for i, t in enumerate(places) for x in range(n) for y in range(n) if inside([(u * (n - 1), (1 - v) * (n - 1)) for u, v in t], x, y)}
    got = [(r.sha, r.x, r.y) for r in atlas.rastered(shapes, n, n).collect()]
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize(("how", "reach"), [("max", 2), ("blur", 4)])
def test_widening_and_blur(spark, how, reach):
    rng, n = random.Random(9), 20
    cells = {(rng.randrange(n), rng.randrange(n)): rng.choice([1.0, 0.5]) for _ in range(25)} | {(0, 0): 1.0, (n - 1, n - 1): 1.0}
    whole = np.zeros((n, n))
    for (x, y), v in cells.items():
        whole[x, y] = v
    clip = lambda i: min(max(i, 0), n - 1)
    bell = [np.exp(-d * d / 8) for d in range(-reach, reach + 1)]
    got = {(r.x, r.y): r.m for r in atlas.spread(spark.createDataFrame([("a", x, y, v) for (x, y), v in cells.items()], "sha string, x int, y int, m double"), "m", n, n, reach, how).collect()}
    for x in range(n):
        for y in range(n):
            near = [(bell[i + reach] * bell[j + reach], whole[clip(x + i), clip(y + j)]) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1)]
            want = max(v for _, v in near) if how == "max" else sum(w * v for w, v in near) / sum(bell) ** 2
            assert got.get((x, y), 0.0) == pytest.approx(want, abs=1e-12)


def test_textures_are_looked_up_by_tile(spark):
    rng, (wide, high) = random.Random(10), (150, 70)
    flat = bytes(rng.randrange(256) for _ in range(wide * high * 4))
    images = spark.createDataFrame([("t", wide, high, bytearray(flat)), ("u", 1, 1, bytearray(b"\x01\x02\x03\x04"))], "image string, wide int, high int, pixels binary")
    tiles = atlas.tiled(images)
    assert sorted((r.tx, r.ty, r.across) for r in tiles.where("image = 't'").collect()) == [(0, 0, 64), (0, 1, 64), (1, 0, 64), (1, 1, 64), (2, 0, 22), (2, 1, 22)]
    rows = [(i, "t", rng.uniform(-2, 2), rng.uniform(-2, 2)) for i in range(400)] + [(900, "u", 0.3, 0.3), (901, "none", 0.5, 0.5), (902, None, 0.5, 0.5), (903, "t", None, 0.5)]
    got = {r.i: (r.r, r.g, r.b, r.a) for r in atlas.coloured(spark.createDataFrame(rows, "i int, image string, u double, v double"), tiles).collect()}
    for i, _, u, v in rows[:400]:
        x, y = int(min((u % 1.0) * (wide - 1), wide - 1)), int(max(min((1 - v % 1.0) * (high - 1), high - 1), 0))
        assert got[i] == tuple(flat[(y * wide + x) * 4 :][:4])
    assert got[900] == (1, 2, 3, 4) and got[901] == got[902] == got[903] == (200,) * 4


def test_rows_follow_the_texels(spark):
    """A whole atlas of 256 x 256 is filled by as many rows as it has texels and a few."""
    texels = spark.createDataFrame([("a", i % 256, i * 37 % 256, i) for i in range(400)], TEXELS)
    assert atlas.filled(texels, 256, 256).agg(F.count("*"), F.max("far")).first()[0] == 65536

"""Nearest points against all pairs."""

import math
import random

from pyspark.sql import functions as F

from facetforge.operators import geometry


def test_every_point_has_its_nearest_target_however_far(spark):
    rng = random.Random(4)
    rows = [(s, 100 * s + i, *(rng.gauss(0, 1) * (1 if i % 9 else 1000) for _ in range(3)), rng.randrange(3)) for s in range(4) for i in range(60)]
    rows += [(9, 900, 0.0, 0.0, 0.0, 1), (9, 901, 1.0, 0.0, 0.0, 1)]  # no other part
    rows += [(8, 800, 0.0, 0.0, 0.0, 1), (8, 801, 5e6, 0.0, 0.0, 2), (7, 700, 1.0, 1.0, 1.0, 1), (7, 701, 1.0, 1.0, 1.0, 2)]
    rows += [(8, 802, None, 0.0, 0.0, 1), (8, 803, math.nan, 0.0, 0.0, 2), (8, 804, math.inf, 0.0, 0.0, 2)]
    want = {}
    for p in rows:
        away = [(math.dist(p[2:5], q[2:5]), q[1]) for q in rows if p[0] == q[0] and p[5] != q[5] and not {802, 803, 804} & {p[1], q[1]}]
        if away:
            want[p[1]] = min(away)
    pts = spark.createDataFrame(rows, "sha long, sid long, x double, y double, z double, pid int")
    got = geometry.nearest(pts, pts, F.expr("p.pid <> q.pid")).collect()
    assert len(got) == len({r.sid for r in got}) and {r.sid: r.near_sid for r in got} == {k: v[1] for k, v in want.items()}
    assert all(abs(r.distance - want[r.sid][0]) < 1e-6 for r in got)
    assert geometry.nearest(pts.limit(0), pts, F.expr("p.pid <> q.pid")).count() == 0


def test_dense_places_and_heaps(spark):
    """Most points in a place a millionth wide, many in the very same place, a few far off; and an asset of one place alone."""
    import numpy as np

    rng = np.random.default_rng(5)
    at = np.concatenate((rng.normal(size=(2500, 3)) * 1e-6, np.zeros((1500, 3)), rng.normal(size=(60, 3)) * 1e3))
    part = rng.integers(0, 3, len(at))
    rows = [(1, i, *map(float, p), int(k)) for i, (p, k) in enumerate(zip(at, part))] + [(2, 9000 + i, 5.0, 5.0, 5.0, i % 2) for i in range(3000)]
    pts = spark.createDataFrame(rows, "sha long, sid long, x double, y double, z double, pid int").repartition(8)
    got = {r.sid: (r.distance, r.near_sid) for r in geometry.nearest(pts, pts, F.expr("p.pid <> q.pid")).collect()}
    far = np.sqrt(((at[:, None] - at[None]) ** 2).sum(axis=2))
    far[part[:, None] == part[None]] = np.inf
    assert len(got) == len(rows)
    for i in range(len(at)):
        assert abs(got[i][0] - far[i].min()) <= 1e-12 + 1e-9 * far[i].min() and far[i, got[i][1]] <= far[i].min() * (1 + 1e-9) + 1e-15
    assert {got[9000 + i] for i in range(3000)} == {(0.0, 9000), (0.0, 9001)}


def test_no_target_in_the_own_slab(spark):
    pts = spark.createDataFrame([(1, i, float(x), 0.0, 0.0, 0) for i, x in enumerate((0.4, 5.6, -9.0))], "sha long, sid long, x double, y double, z double, pid int")
    targets = spark.createDataFrame([(1, 100 + i, float(x), float(i % 7), float(i % 5), 1) for i, x in enumerate([*[0] * 300, *[10] * 300])], pts.schema)
    got = {r.sid: (r.near_sid, round(r.distance, 9)) for r in geometry.nearest(pts, targets, F.lit(True)).collect()}
    assert got == {0: (100, 0.4), 1: (400 + (-300 % 35), round(math.dist((5.6, 0, 0), (10, *divmod(0, 1))), 9)), 2: (100, 9.0)} or got[1][1] <= 4.5

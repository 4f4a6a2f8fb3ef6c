"""op11 against its SQL and against plain Lloyd rounds over Python integers."""

import hashlib
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from facetforge.llm import centroids
from facetforge.llm.queries import ORACLES, op11_centroids


def plain(rows, size, clusters, rounds, scale=1024, seed=3):
    """Every round compares all with all, in Python's integers."""
    points = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v):
            points.append((i, [int(math.floor(x * scale)) if math.isfinite(x * scale) else int(x) * scale for x in map(float, v)], v))
    drawn = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v, q) for i, q, v in points if i is not None)[:clusters]
    centres = [q for *_, q in drawn]
    if not centres:
        return [], []
    near = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, c)), k) for k, c in enumerate(centres))
    for _ in range(rounds):
        own = [near(q)[1] for _, q, _ in points]
        for k in range(len(centres)):
            held = [q for (_, q, _), o in zip(points, own) if o == k]
            if held:
                centres[k] = [sum(c) // len(held) for c in zip(*held)]
    return [(i, *near(q)[::-1]) for i, q, _ in points], centres


def test_query_is_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    got = op11_centroids(spark, sf)
    want = con.execute(ORACLES["op11_centroids"])
    assert got.columns == [d[0] for d in want.description]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())


@pytest.mark.parametrize("big", [1.0, 1e6, 1e30, 1e306])
def test_odd_vectors_of_any_size(spark, big):
    rows = [(i, [math.sin(i * k + 1) * (3 if k > 1 else 1) for k in range(1, 5)]) for i in range(300)]
    rows += [(7, rows[8][1]), (7, rows[8][1]), (None, rows[9][1]), (400, None), (401, [1.0]), (402, [1.0, None, 1.0, 1.0]), (403, [float("nan")] * 4), (404, [1.0, float("-inf"), 0.0, 1.0])]
    rows += [(500 + i, [0.25, -0.5, 0.125, 1.0]) for i in range(200)] + [(900, [big, -big, 0.0, 1.0]), (901, [-big, 1.5, 0.0, 0.0])]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "vec_id long, embedding array<double>, cluster int, far string, was int").repartition(5)
    got, centres = centroids.clustered(docs, size=4, clusters=5, rounds=6)
    want, ends = plain(rows, 4, 5, 6)
    fits = lambda d: d if d < 1 << 63 else None
    assert centres == ends
    assert sorted((str(r.vec_id), r.cluster, r.distance or 0) for r in got.collect()) == sorted((str(i), k, fits(d) or 0) for i, k, d in want)
    sums = {r.cluster: r for r in centroids.with_inertia(got, centres).collect()}
    for k, r in sums.items():
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest()
        if all(fits(d) is not None for _, o, d in want if o == k):
            assert r.cluster_inertia == fits(sum(d for _, o, d in want if o == k))


def test_few_vectors_and_none(spark):
    table = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 4.0])], "vec_id long, embedding array<float>")
    got = centroids.with_inertia(*centroids.clustered(table, size=2)).collect()
    assert {(r.vec_id, r.distance, r.inertia) for r in got} == {(1, 0, 0), (2, 0, 0)} and len({r.cluster for r in got}) == 2
    for none in (table.limit(0), table.where(F.lit(False)), table.withColumn("embedding", F.lit(None).cast("array<float>"))):
        got = centroids.with_inertia(*centroids.clustered(none, size=2))
        assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and got.count() == 0


def test_rounds_meet_changed_centroids_alone():
    """A vector whose centroid stayed is compared with those that moved; one whose centroid moved with all."""
    import numpy as np

    points = np.array([[0, 0], [10, 0], [20, 0]])
    best, near = centroids.compared(points, np.array([0, 1, 2]), np.array([0, 0, 0]), [[0, 0], [10, 0], [11, 0]], [2])
    assert best.tolist() == [0, 1, 2] and near.tolist() == [0, 0, 81]
    best, near = centroids.compared(points, np.array([1, 1, 1]), np.array([100, 0, 100]), [[10, 0], [10, 0], [1, 0]], [0, 2])
    assert best.tolist() == [2, 0, 0] and near.tolist() == [1, 0, 100]

"""Centroid clustering by Delta Lloyd, in exact integers.

A vector's components x are taken as floor(scale * x). What a round knows of a vector, its cluster and the distance, is
persisted beside it; so are, for each cluster, the sum and the number of its vectors. A round

1. compares each vector with the centroids that changed alone, if its own didn't: all others are as far away as they were,
   and none of them was nearer. Only vectors whose own centroid moved are compared with all centroids;
2. sums, signed, the vectors that changed hands: off the cluster that had them, onto the one that has them now. Tasks sum
   their own batches, then rows of one cluster meet, a row for each task; the driver gets one row for each cluster;
3. moves the centroids that gained or lost vectors. If none moved, later rounds would change nothing and are left out.

No round shuffles vectors, and none but the first sums them all.

Defined cases: vectors that are null, of another length or hold null or non-finite components take no part and have no row;
rows with a null id are clustered, but never start a cluster; repeated rows keep their number, and start two clusters if
their id is drawn; with fewer vectors than clusters there are fewer clusters, with none the result is empty; ties go to the
smaller number, of start vectors with one id to the smaller vector; an empty cluster keeps its centroid. Components of any
size are exact; a distance or inertia that doesn't fit a long is null. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetforge.llm.common import Stored

SIZE, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Integers whose magnitude is under this one have squared distances of up to 64 components in 64 bits.
SAFE = 1 << 27


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): 64-bit integers where they are small enough to be squared, else Python's."""
    scaled = np.floor(vectors * float(scale))
    if np.abs(scaled).max(initial=0) < SAFE and np.isfinite(scaled).all():
        return scaled.astype(np.int64)
    return np.array([[int(np.floor(v * scale)) if np.isfinite(v * scale) else int(v) * scale for v in row] for row in vectors.tolist()], object).reshape(vectors.shape)


def distances(points: np.ndarray, centre: list[int]) -> np.ndarray:
    small = points.dtype != object and max(map(abs, centre), default=0) < SAFE
    way = points - np.array(centre, np.int64 if small else object)
    return (way * way).sum(axis=1)


def compared(points: np.ndarray, cluster: np.ndarray, far: np.ndarray, centres: list[list[int]], changed: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector and the distance, given those before `changed` moved."""
    moved = np.isin(cluster, changed)
    best, near = cluster.copy(), far.copy()
    for rows, numbers in ((np.flatnonzero(moved), range(len(centres))), (np.flatnonzero(~moved), changed)):
        if not len(rows):
            continue
        own, least = best[rows], near[rows]
        if numbers is not changed:  # all numbers: what was known of these vectors is no longer so
            own, least = np.full(len(rows), len(centres)), None
        for k in numbers:
            d = distances(points[rows], centres[k])
            better = np.ones(len(rows), bool) if least is None else (d < least) | ((d == least) & (k < own))
            least = d if least is None else np.where(better, d, least)
            own = np.where(better, k, own)
        best[rows] = own
        if near.dtype != least.dtype:
            near = near.astype(object)
        near[rows] = least
    return best, near


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def told(far: np.ndarray) -> pa.Array:
    """Distances as text: they may be longer than 64 bits."""
    return pa.array([str(x) for x in far.tolist()], pa.string())


STATE = "vec_id long, vector array<double>, was int, cluster int, far string"


def assigned(state: DataFrame, centres: list[list[int]], changed: list[int], size: int, scale: int) -> DataFrame:
    """The state after a round: `was` is the cluster before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                had = batch.column("cluster").to_numpy(zero_copy_only=False).astype(np.int64)
                far = batch.column("far").to_pylist()
                far = np.array([int(x) for x in far], np.int64 if max(map(len, far)) < 19 else object)
                best, near = compared(whole(matrix(batch.column("vector"), size), scale), had, far, centres, changed)
                columns = [batch.column("vec_id"), batch.column("vector"), batch.column("cluster"), pa.array(best, pa.int32()), told(near)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "vector", "was", "cluster", "far"])

    return state.select("vec_id", "vector", "cluster", "far").mapInArrow(run, STATE)


def transfers(state: DataFrame, size: int, scale: int) -> list:
    """cluster, n, sums: what each cluster gained in the round, signed; a row for each cluster."""

    def summed(rows: dict[int, list], k: int, n: int, sums: list[int]) -> None:
        had = rows.setdefault(k, [0, [0] * size])
        had[0], had[1] = had[0] + n, [a + b for a, b in zip(had[1], sums, strict=True)]

    def given(rows: dict[int, list]) -> Iterator[pa.RecordBatch]:
        if rows:
            columns = [pa.array(list(rows), pa.int32()), pa.array([n for n, _ in rows.values()], pa.int64()), pa.array([[str(x) for x in s] for _, s in rows.values()], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "sums"])

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, list] = {}
        for batch in batches:
            points = whole(matrix(batch.column("vector"), size), scale)
            for name, sign in (("was", -1), ("cluster", 1)):
                at = batch.column(name).to_numpy(zero_copy_only=False)
                for k in np.unique(at[at >= 0]).tolist():
                    own = points[at == k]
                    summed(rows, k, sign * len(own), [sign * int(x) for x in own.sum(axis=0)])
        yield from given(rows)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                summed(rows, row["cluster"], row["n"], [int(x) for x in row["sums"]])
        yield from given(rows)

    kinds = "cluster int, n long, sums array<string>"
    parts = state.where("was <> cluster").select("vector", "was", "cluster").mapInArrow(signed, kinds)
    return parts.repartition("cluster").mapInArrow(met, kinds).collect()  # a row for each cluster


def kept(table: DataFrame, vec_id: str, vector: str, size: int) -> DataFrame:
    """vec_id, vector (doubles): the vectors that take part."""
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where((F.size("vector") == size) & ~bad)


def started(rows: DataFrame, clusters: int, seed: int, size: int, scale: int) -> list[list[int]]:
    """The vectors whose ids have the smallest hashes, in that order."""
    hashed = rows.where("vec_id is not null").withColumn("hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    few = hashed.orderBy("hash", "vector").limit(clusters).collect()  # `clusters` rows
    return [[int(x) for x in whole(np.array([r.vector]), scale)[0]] for r in few]


def clustered(
    table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", size: int = SIZE, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED
) -> tuple[DataFrame, list[list[int]]]:
    """vec_id, cluster, distance of each vector after so many rounds and a last assignment; and the centroids."""
    rows = kept(table, vec_id, vector, size)
    centres = started(rows, clusters, seed, size, scale)
    spark = table.sparkSession
    if not centres:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), []
    counts, sums = [0] * len(centres), [[0] * size for _ in centres]
    # At first no vector has a cluster and every centroid is new.
    state = Stored(assigned(rows.selectExpr("*", "-1 as cluster", "'0' as far"), centres, [-1, *range(len(centres))], size, scale), "centroids")
    for _ in range(rounds):
        for row in transfers(state.df, size, scale):
            counts[row.cluster] += row.n
            sums[row.cluster] = [a + int(b) for a, b in zip(sums[row.cluster], row.sums, strict=True)]
        now = [[s // n for s in total] if n else centre for total, n, centre in zip(sums, counts, centres, strict=True)]
        changed = [k for k, (a, b) in enumerate(zip(centres, now, strict=True)) if a != b]
        if not changed:
            break
        centres = now
        after = Stored(assigned(state.df, centres, changed, size, scale), "centroids")
        state.drop()
        state = after
    return state.df.select("vec_id", "cluster", F.expr("try_cast(far as bigint)").alias("distance")), centres


def hashed(centre: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centre)).encode()).hexdigest()


def with_inertia(rows: DataFrame, centres: list[list[int]]) -> DataFrame:
    """The clustered vectors with the distances summed over their cluster and over all, and the hash of its centroid."""
    own = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()  # a row for each cluster
    fits = lambda x: None if x is None or abs(x) >= 1 << 63 else int(x)
    every = None if any(r.own is None for r in own) else sum(int(r.own) for r in own)
    sums = [(r.cluster, fits(r.own), fits(every), hashed(centres[r.cluster])) for r in own]
    sums = rows.sparkSession.createDataFrame(sums, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(sums), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

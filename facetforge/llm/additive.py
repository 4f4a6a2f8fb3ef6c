"""Nearest neighbours by inner product with additive quantisation.

A vector's direction is coded as a sum of one word from each of several full-dimensional codebooks. The codebooks are fitted on the
residuals one after another and then together by least squares; a beam search picks the words, with the codebooks' inner
products at hand instead of the residuals. Beside its words a vector keeps its norm, that of its sum, and how far the scaled
sum is from it. A query looks up its inner products with all words once, adds up a vector's words, and scales by the two
norms. The product can't be farther from that than the query's norm times the sum's distance: the best by the looked-up score
are multiplied out, and then all whose bound reaches the last of them. So nothing is missed, whatever the vectors are; codes
that fit badly cost more products.

Queries and coded vectors meet in blocks, every query block with every vector block; the best of each block, equal ones by
their ids, are merged in rounds of a bounded number of blocks. Equal vectors are coded once, with as many of their smallest ids as a result can
hold, so copies push nothing out.

Defined cases: vectors that are null, zero, or hold null or non-finite components, that have a null id, or that haven't the
most frequent length (of several the smallest) take no part; of rows with one id the smallest vector counts; ties go to
the smaller id; with fewer candidates than asked for all are returned; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetforge.llm.common import Stored

#: Vectors that the codebooks are fitted on, at most (the first by their ids' hashes); codebooks, their words, the beam.
SAMPLE, BOOKS, WORDS, BEAM = 16384, 40, 32, 4
#: Vectors and queries of a block if they have COMPONENTS (fewer if they are longer); blocks merged at once.
VECTORS, QUERIES, COMPONENTS, MERGED = 4096, 4096, 64, 64
#: Rounding of sums of 32-bit floats: of words' products by their norms, and of a unit vector.
ROUNDED, UNIT = 1e-5, 1e-6


class Codebooks:
    """words: (books, words, length)."""

    def __init__(self, words: np.ndarray):
        self.words = words.astype(np.float32)
        flat = self.words.reshape(-1, self.words.shape[2])
        self.products = flat @ flat.T
        self.squares = (flat * flat).sum(axis=1)

    def encode(self, x: np.ndarray, beam: int = BEAM) -> np.ndarray:
        """The words of each vector. The error of a choice is a sum of products of vector and word and of word and word."""
        books, words, _ = self.words.shape
        n = len(x)
        along = x.astype(np.float32) @ self.words.reshape(books * words, -1).T
        codes = np.zeros((n, 1, 0), np.int64)
        error = np.zeros((n, 1), np.float32)
        for b in range(books):
            own = slice(b * words, (b + 1) * words)
            cost = error[:, :, None] + (self.squares[own] - 2 * along[:, own])[:, None, :]
            for c in range(b):
                cost = cost + 2 * self.products[c * words + codes[:, :, c], own]
            flat = cost.reshape(n, -1)
            keep = min(beam, flat.shape[1])
            best = np.argpartition(flat, keep - 1, axis=1)[:, :keep] if keep < flat.shape[1] else np.tile(np.arange(keep), (n, 1))
            error = np.take_along_axis(flat, best, axis=1)
            codes = np.concatenate((np.take_along_axis(codes, (best // words)[:, :, None], axis=1), (best % words)[:, :, None]), axis=2)
        return codes[np.arange(n), error.argmin(axis=1)].astype(np.uint8)

    def sums(self, codes: np.ndarray) -> np.ndarray:
        return sum(self.words[b][codes[:, b]] for b in range(len(self.words)))


def fit(x: np.ndarray, books: int = BOOKS, words: int = WORDS, rounds: int = 4, together: int = 1) -> Codebooks:
    rng = np.random.default_rng(5)
    x = x.astype(np.float32)
    rest, made = x.copy(), []
    for _ in range(books):
        centre = rest[rng.choice(len(rest), words, replace=len(rest) < words)].copy()
        for _ in range(rounds):
            near = ((centre * centre).sum(axis=1) - 2 * rest @ centre.T).argmin(axis=1)
            count = np.bincount(near, minlength=words)
            total = np.zeros_like(centre)
            np.add.at(total, near, rest)
            centre = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centre)
        near = ((centre * centre).sum(axis=1) - 2 * rest @ centre.T).argmin(axis=1)
        rest = rest - centre[near]
        made.append(centre)
    found = Codebooks(np.stack(made))
    for _ in range(together):
        codes = found.encode(x)
        at = (codes.astype(np.int64) + np.arange(books) * words).ravel()
        gram = np.zeros((books * words, books * words), np.float32)
        chosen = np.zeros((len(x), books * words), np.float32)
        chosen[np.repeat(np.arange(len(x)), books), at] = 1
        gram = chosen.T @ chosen + 0.1 * np.eye(books * words, dtype=np.float32)
        new = np.linalg.solve(gram, chosen.T @ x + 0.1 * found.words.reshape(books * words, -1))
        found = Codebooks(new.reshape(found.words.shape))
    return found


def usable(vector: Column) -> Column:
    """Not null, not zero, all components finite."""
    inside = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & inside & F.exists(vector, lambda x: x != 0)


def vectors_of(table: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """id, vector: one row for each id that takes part."""
    rows = table.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vector")).where(F.col("id").isNotNull() & usable(F.col("vector")))
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    rows = rows.where(F.size("vector") == (length[0].n if length else 0))
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


def as_matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows' directions and norms, of components of any size."""
    most = np.abs(x).max(axis=1)
    x = x / most[:, None]
    norm = np.linalg.norm(x, axis=1)
    return x / norm[:, None], most * norm


def coded(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """id, vector, codes, scale: the vector's norm over that of its sum; slack: how far the scaled sum is from it at most."""
    handed = vectors.sparkSession.sparkContext.broadcast(books)  # a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = as_matrix(batch.column("vector")).astype(float)
                unit, norm = units(x)
                codes = handed.value.encode(unit)
                sums = handed.value.sums(codes).astype(float)
                scale = 1 / np.maximum(np.linalg.norm(sums, axis=1), 1e-12)
                size = np.linalg.norm(handed.value.words, axis=2)
                words = size[np.arange(len(size)), codes].sum(axis=1)
                slack = np.linalg.norm(unit - scale[:, None] * sums, axis=1) + ROUNDED * scale * words + UNIT
                vector = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
                columns = [batch.column("id"), vector, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norm * scale), pa.array(norm * slack)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "vector", "codes", "scale", "slack"])

    return vectors.mapInArrow(run, "id long, vector array<double>, codes binary, scale double, slack double")


def blocks(rows: DataFrame, name: str, size: int, columns: list[str]) -> tuple[DataFrame, int]:
    """Blocks of about `size` rows, each a list; and how many there are."""
    many = max(1, -(-rows.count() // size))
    block = F.pmod(F.xxhash64("id"), F.lit(many)).cast("int").alias(name)
    return rows.select(block, F.struct(*columns).alias("row")).groupBy(name).agg(F.sort_array(F.collect_list("row")).alias(f"{name}_rows")), many


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The inner products of the rows with y, summed from the first component on, as product() does."""
    return np.cumsum(x * y, axis=1)[:, -1]


def best_of_blocks(coded_rows: DataFrame, queries: DataFrame, books: Codebooks, keep: int, sizes: tuple[int, int]) -> tuple[DataFrame, int]:
    """query, block, ids, scores: of each query in each block of vectors, the `keep` best."""
    base, n = blocks(coded_rows, "block", sizes[0], ["id", "vector", "codes", "scale", "slack"])
    asked, m = blocks(queries, "asked", sizes[1], ["id", "vector"])
    base = base.withColumn("asked", F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    handed = coded_rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = handed.value.words
        count = words.shape[0]
        for batch in batches:
            for i in range(len(batch)):
                rows, wanted = (batch.column(x)[i].values for x in ("block_rows", "asked_rows"))
                ids, vectors = rows.field("id").to_numpy(), as_matrix(rows.field("vector"))
                codes = np.frombuffer(b"".join(rows.field("codes").to_pylist()), np.uint8).reshape(len(ids), count)
                scale, slack = rows.field("scale").to_numpy(), rows.field("slack").to_numpy()
                who, x = wanted.field("id").to_numpy(), as_matrix(wanted.field("vector")).astype(float)
                unit, norm = units(x)
                few = min(keep, len(ids))
                found, score = [], []
                for k in range(0, len(who), 32):
                    table = np.einsum("qd,bwd->bqw", unit[k : k + 32].astype(np.float32), words)
                    total = table[0][:, codes[:, 0]]
                    for b in range(1, count):
                        total += table[b][:, codes[:, b]]
                    for near, y, size in zip(total * scale, x[k : k + 32], norm[k : k + 32], strict=True):
                        first = np.argpartition(-near, few - 1)[:few]
                        least = products(vectors[first], y).min() / size
                        left = np.flatnonzero(~(near + slack < least))
                        exact = products(vectors[left], y)
                        best = np.lexsort((ids[left], -exact))[:few]
                        found.append(ids[left[best]])
                        score.append(exact[best])
                columns = [pa.array(who), pa.array([batch.column("block")[i].as_py()] * len(who), pa.int32()), pa.array(found, pa.list_(pa.int64())), pa.array(score, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, ["query", "block", "ids", "scores"])

    met = base.join(asked, ["block", "asked"]).select("block", "block_rows", "asked_rows")
    return met.mapInArrow(run, "query long, block int, ids array<long>, scores array<double>"), n


def merged(best: DataFrame, many: int, keep: int) -> DataFrame:
    """query, ids: the best over all blocks, MERGED blocks at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, scores = [], []
            for parts in batch.column("parts").to_pylist():
                every = sorted(((-s, i) for p in parts for i, s in zip(p["ids"], p["scores"], strict=True)))[:keep]
                ids.append([i for _, i in every])
                scores.append([-s for s, _ in every])
            columns = [batch.column("query"), batch.column("block"), pa.array(ids, pa.list_(pa.int64())), pa.array(scores, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["query", "block", "ids", "scores"])

    while True:
        best = best.groupBy("query", F.floor(F.col("block") / MERGED).cast("int").alias("block")).agg(F.collect_list(F.struct("ids", "scores")).alias("parts"))
        best = best.mapInArrow(run, "query long, block int, ids array<long>, scores array<double>")
        many = -(-many // MERGED)
        if many <= 1:
            return best.select("query", "ids")


def product(a: Column, b: Column) -> Column:
    """The inner product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda total, x: total + x)


def nearest(
    table: DataFrame, asks: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", sizes: tuple[int, int] = (VECTORS, QUERIES)
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of each row where `asks` (of the column id) holds."""
    rows = Stored(vectors_of(table, vec_id, vector), "vectors").df
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    if not sample:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
    x = np.array([r.vector for r in sample], float)
    books = fit(units(x)[0])
    sizes = tuple(max(1, size * COMPONENTS // max(COMPONENTS, x.shape[1])) for size in sizes)
    # Equal vectors: k others and the query itself are as many as a result can draw from them.
    same = Window.partitionBy("vector").orderBy("id")
    few = rows.withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1)
    classes = Stored(few.groupBy("vector").agg(F.min("id").alias("id"), F.sort_array(F.collect_list("id")).alias("ids")), "classes").df
    queries = rows.where(asks)
    index = Stored(coded(classes.select("id", "vector"), books), "codes").df
    # Of classes with smaller ids or higher scores each has a row before, and one class is the query's own: k + 1 are enough.
    found = merged(*best_of_blocks(index, queries, books, k + 1, sizes), k + 1)
    pairs = found.select("query", F.explode("ids").alias("id")).join(classes, "id")
    exact = pairs.join(queries.select(F.col("id").alias("query"), F.col("vector").alias("asked")), "query")
    exact = exact.select("query", F.explode("ids").alias("vec_id"), product(F.col("asked"), F.col("vector")).alias("score")).where("vec_id <> query")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = exact.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("query").alias("query_id"), "rank", "vec_id", "score")

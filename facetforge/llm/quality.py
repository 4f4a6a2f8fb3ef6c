"""Quality of documents by hierarchical empirical Bayes.

A logistic classifier over features of the text gives each document's evidence. Evidence is summed by site path and by
host with grouped aggregation; a path's posterior shrinks toward its host's and a host's toward the global mean, the
more the fewer documents it has. How much follows from the spread between sites against the spread inside them. A
document's own evidence is taken out of its site before the two are combined, so a site of one document is its prior.

Defined cases: a null or empty text has no evidence of its own (the global rate), so its site decides; null hosts and
paths are sites like any other; labels that are null or of documents that don't exist teach nothing; of several labels of
an id the largest counts; without labels of both kinds every text has the global rate; repeated rows count and are returned
each, but teach once (the first by its text's hash); columns of the documents are kept, but for those named as the operator's
own (quality_evidence, quality_site, quality_posterior, quality_keep), which are replaced; an empty table gives an empty
result. Features are computed twice, for the sites and for the documents: that costs no shuffle and no copy of the texts.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetforge.llm.common import Stored, packed, tuned, unpacked, with_row

#: Labelled documents that the classifier is fitted on, at most; the first in the order of their ids' hashes.
SAMPLE = 20_000
#: Bytes of sites that are broadcast, at most; more are joined by a shuffle.
SITES = 16 << 20
LEAST = 1e-6


def features(text: str) -> list[float]:
    """Shares of capitals, digits and signs, of words said again and again, of broken words; how long words are."""
    words = text.split()
    n, m = max(1, len(text)), max(1, len(words))
    counts = Counter(words)
    upper = sum(map(str.isupper, words)) / m
    signs = sum(1 for w in words if not w[-1].isalnum() and w[-1] not in ".,;:?)\"'") / m
    bare = sum(1 for w in words if not any(map(str.isalnum, w[:4]))) / m
    again = sum(a == b for a, b in zip(words, words[1:], strict=False)) / m
    often = max(counts.values(), default=0) / m
    lines = text.split("\n")
    repeated = 1 - len(set(lines)) / len(lines)
    digits = sum(map(str.isdigit, text)) / n
    return [upper, signs, bare, again, often if m > 20 else 0.0, repeated, digits, 1 - len(counts) / m, min(30.0, len(text) / m) / 10, np.log1p(m) / 5]


WIDTH = len(features(""))


def hash_of(text: str) -> bytes:
    return hashlib.sha256(text.encode()).digest()


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic regression by Newton's steps; the last is the intercept."""
    if len(y) == 0 or y.min() == y.max():
        w = np.zeros(WIDTH + 1)
        w[-1] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
        return w
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge * 10)
    keep[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(keep), x.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> np.ndarray:
    """The classifier's weights, from at most `sample` labelled documents."""
    known = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("double").alias("y")).where("id is not null and y is not null")
    known = known.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where("text is not null").join(F.broadcast(known), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            x, first = pa.array([features(t) for t in texts], pa.list_(pa.float64())), pa.array([hash_of(t) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"), x, first], ["id", "y", "x", "first"])

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.select("id", "y", "text").mapInArrow(run, f"id {kind}, y double, x array<double>, first binary")
    got = found.groupBy("id", "y").agg(F.min_by("x", "first").alias("x")).orderBy("id").collect()  # `sample` rows of WIDTH numbers at most
    return fit(np.array([r.x for r in got]).reshape(-1, WIDTH), np.array([r.y > 0.5 for r in got], float))


def scored(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """The rows (row, host, path, text) without the text, and quality_evidence: the classifier's probability, null where
    there is no text."""
    names = ["row", "host", "path"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            p = [1 / (1 + np.exp(-np.clip(np.dot(features(t), weights[:-1]) + weights[-1], -30, 30))) if t else None for t in texts]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(p, pa.float64())], [*names, "quality_evidence"])

    return rows.mapInArrow(run, with_row(rows, host="string", path="string", quality_evidence="double"))


def spread(table: DataFrame, prior: str) -> DataFrame:
    """Of sites n, s with a prior mean each: pull, the documents that the prior is worth (within over between variance)."""
    mean = F.col("s") / F.col("n")
    rate = F.sum("s") / F.sum("n")
    within = F.greatest(F.sum(F.col("n") * mean * (1 - mean)) / F.sum("n"), F.lit(LEAST))
    total, squares = F.sum("n"), F.sum(F.col("n") * F.col("n"))
    between = (F.sum(F.col("n") * (mean - F.col(prior)) ** 2) - (F.count("*") - 1) * within) / F.greatest(total - squares / total, F.lit(1.0))
    pull = F.least(within / F.greatest(between, F.lit(LEAST)), F.lit(1e6))
    return table.agg(F.greatest(pull, F.lit(1.0)).alias("pull"), F.greatest(F.least(rate, F.lit(1 - LEAST)), F.lit(LEAST)).alias("rate"))


def site_of(url: Column) -> tuple[Column, Column]:
    """Host and first step of the path of an address, lower-cased, without www. and port; null where there are none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]+)", 1)
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)
    return F.nullif(host, F.lit("")), F.nullif(path, F.lit(""))


def sites(rows: DataFrame) -> DataFrame:
    """host, path, n, s (documents and evidence), host_n, host_s, rate, host_pull, path_pull, from host, path and
    quality_evidence of the documents."""
    site = rows.select("host", "path", F.col("quality_evidence").alias("p"))
    paths = Stored(site.groupBy("host", "path").agg(F.count("p").alias("n"), F.coalesce(F.sum("p"), F.lit(0.0)).alias("s")), "sites").df
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s")).withColumnRenamed("host", "of")
    overall = paths.agg((F.sum("s") / F.greatest(F.sum("n"), F.lit(1))).alias("prior"))
    level = hosts.select(F.col("host_n").alias("n"), F.col("host_s").alias("s")).where("n > 0").crossJoin(F.broadcast(overall))  # one row
    host_pull = spread(level, "prior").withColumnRenamed("pull", "host_pull")
    joined = paths.join(hosts, F.col("host").eqNullSafe(F.col("of"))).drop("of")
    path_pull = spread(joined.where("n > 0").select("n", "s", (F.col("host_s") / F.col("host_n")).alias("prior")), "prior").select(F.col("pull").alias("path_pull"))
    return joined.crossJoin(F.broadcast(host_pull)).crossJoin(F.broadcast(path_pull))  # one row each


def logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(LEAST)), F.lit(1 - LEAST))
    return F.log(p / (1 - p))


def judged(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, doc_id: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = 0.5
) -> DataFrame:
    """The documents with quality_evidence, quality_site (the posterior of its site without it), quality_posterior and
    quality_keep (posterior at least `threshold`). host, path: of the documents' columns, site_of(url) for instance."""
    tuned(docs.sparkSession)
    weights = learn(docs, labels, doc_id, text, label)
    rows = packed(docs, host=host.cast("string"), path=path.cast("string"), text=F.col(text))
    slim = rows.select(F.struct(F.lit(0)).alias("row"), "host", "path", "text")
    table = Stored(sites(scored(slim, weights)), "sites").df
    renamed = table.toDF(*(f"site_{c}" for c in table.columns))
    size = table.agg(F.sum(F.coalesce(F.octet_length("host"), F.lit(0)) + F.coalesce(F.octet_length("path"), F.lit(0)) + 80)).first()[0]
    if (size or 0) <= SITES:
        renamed = F.broadcast(renamed)
    rows = scored(rows, weights).join(renamed, F.col("host").eqNullSafe(F.col("site_host")) & F.col("path").eqNullSafe(F.col("site_path")))
    evidence, c = F.col("quality_evidence"), lambda name: F.col(f"site_{name}")
    own, one = F.coalesce(evidence, F.lit(0.0)), evidence.isNotNull().cast("int")
    at_host = (c("host_s") - own + c("host_pull") * c("rate")) / (c("host_n") - one + c("host_pull"))
    at_path = (c("s") - own + c("path_pull") * at_host) / (c("n") - one + c("path_pull"))
    site = F.coalesce(at_path, F.lit(0.5))
    rate = F.coalesce(c("rate"), F.lit(0.5))
    both = logit(F.coalesce(evidence, rate)) + logit(site) - logit(rate)
    rows = rows.select("row", evidence.alias("evidence"), site.alias("site"), (1 / (1 + F.exp(-both))).alias("posterior"))
    return unpacked(
        rows, quality_evidence=F.col("evidence"), quality_site=F.col("site"), quality_posterior=F.col("posterior"), quality_keep=F.col("posterior") >= threshold
    )

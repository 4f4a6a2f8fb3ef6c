"""op1 against its SQL and all pairs of sets; op2 against all products."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from facetforge.llm import additive, spotsigs
from facetforge.llm.queries import OP1_SQL, op1_spotsigs, op2_additive

TEXTS = [
    (5, "The cat of the house sat on a mat with its friend and the dog was in an old garden."), (4, None), (3, ""), (3, "is the"), (2, "!!"),
    (9, "The cat of the house sat on a mat with its friend and the dog was in an old garden."), (8, "Le chat est dans la maison é"), (1, "word " * 4000),
    (None, "The end of a null id stands last of all rows"), (7, "ein Haus steht in der Stadt und das Tor ist zu"), (7, "ein Haus steht in der Stadt und das Tor ist zu"),
]


def test_query_is_its_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = sorted(con.execute(OP1_SQL).fetchall())
    got = sorted(tuple(r) for r in op1_spotsigs(spark, sf_dir).collect())
    assert [r[:5] + r[7:] for r in got] == [r[:5] + r[7:] for r in want]
    assert np.allclose([r[5:7] for r in got], [r[5:7] for r in want])


def test_next_row_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "RANGE", 3)
    rows = [(i, t or "") for i, t in TEXTS]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, range int, guest int").select("doc_id", "text")
    got = [tuple(r) for r in spotsigs.with_next(docs).collect()]
    hashes = {r.text: r.x for r in docs.select("text", F.xxhash64("text").alias("x")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]], r[1]))
    want = [(i, t, order[(n + 1) % len(order)][1]) for n, (i, t) in enumerate(order)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert spotsigs.with_next(docs.limit(0)).count() == 0
    assert [r.next_text for r in spotsigs.with_next(docs.limit(1)).collect()] == [rows[0][1]]


def test_similar_documents_are_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame(TEXTS, "doc_id long, text string").selectExpr("doc_id + 10000", "text"))
    docs = docs.withColumn("signatures", F.lit(1)).withColumn("f", F.lit("x"))
    members, pairs = spotsigs.similar(docs, 0.8)
    sets = {}
    for r in spotsigs.with_signatures(docs.select("doc_id", "text"), "text", "s").collect():
        sets.setdefault(frozenset(r.s), []).append(r.doc_id)
    want_members = sorted((str(i), str(min((x for x in ids if x is not None), default=None))) for ids in sets.values() for i in ids)
    assert sorted((str(r.doc_id), str(r.class_id)) for r in members.collect()) == want_members
    named = {s: min((x for x in ids if x is not None), default=None) for s, ids in sets.items()}
    every = [s for s in named if named[s] is not None]
    want = {(min(named[a], named[b]), max(named[a], named[b])) for n, a in enumerate(every) for b in every[:n] if len(a & b) >= 0.8 * len(a | b) - 1e-9}
    assert {(r.a, r.b) for r in pairs.collect() if r.a is not None} == want and want


def brute(rows, asks, k):
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q in sorted(i for i in ok if asks(i)):
        out[q] = sorted((-float(ok[q] @ v), i) for i, v in ok.items() if i != q)[:k]
    return out


def test_recall_over_all_embeddings(spark):
    sf = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = brute(rows, lambda i: i % 20 == 0, 20)
    got = {}
    for r in op2_additive(spark, sf).collect():
        got.setdefault(r.query_id, []).append((r.rank, -r.score, r.vec_id))
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, *_ in found] == list(range(1, 21)) and [f[1:] for f in found] == sorted(f[1:] for f in found)
        hits += len({i for *_, i in found} & {i for _, i in want[q]})
    assert hits >= 0.95 * 20 * len(want)


def test_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=4).astype(np.float32)]) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(40)] + [(200, None), (201, [0.0] * 4), (202, [1.0, None, 1.0, 1.0]), (203, [float("nan")] * 4), (204, [float("inf")] * 4)]
    rows += [(205, [1.0]), (None, rows[1][1]), (20, rows[20][1])]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, id int, query int")
    want = brute([r for r in rows if r[1] is None or len(r[1]) == 4], lambda i: i % 20 == 0, 20)
    for sizes in ((16384, 512), (7, 3)):
        got = {}
        for r in additive.nearest(table, F.col("id") % 20 == 0, sizes=sizes).collect():
            got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
        assert {q: [i for _, i, _ in sorted(v)] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items()}
        assert all(np.isclose(s, -want[q][r - 1][0]) for q, v in got.items() for r, _, s in v)
    few = table.where("vec_id in (0, 1, 2)")
    assert additive.nearest(few, F.col("id") == 0).count() == 2
    assert additive.nearest(table.limit(0), F.col("id") == 0).count() == 0


def test_recall_of_many_vectors_in_several_blocks(spark):
    """Twenty thousand vectors without clusters, the hardest case for codes, in five blocks; queries in four."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(20_000, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in additive.nearest(table, F.col("id") % 20 == 0, sizes=(4096, 256)).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    score = x[::20].astype(float) @ x.astype(float).T
    score[np.arange(1000), np.arange(0, 20_000, 20)] = -np.inf
    best = np.argsort(-score, axis=1)[:, :20]
    assert set(got) == set(range(0, 20_000, 20))
    assert np.mean([len(got[20 * i] & set(b.tolist())) / 20 for i, b in enumerate(best)]) > 0.95


@pytest.mark.parametrize("kind", ["clusters", "whole numbers", "norms", "far off"])
def test_all_of_the_nearest_are_found(spark, kind):
    """Tight clusters, which codes tell apart badly; products that are often equal; norms from 1 to 10^6; one common offset."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 64))
    if kind == "clusters":
        x = rng.normal(size=(12, 64))[rng.integers(0, 12, 6000)] + 1e-3 * x
    elif kind == "whole numbers":
        i = np.arange(6000)
        x = np.zeros((6000, 64))
        x[i, i % 64] = 1
        x[i, i * 7 // 64 % 64] += 1
        x[:, 0] += 1
        x += rng.random((6000, 64)) < 0.02
    elif kind == "norms":
        x *= 10 ** rng.uniform(0, 6, (6000, 1))
    else:
        x += 1000
    x = x.astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in additive.nearest(table, F.col("id") % 200 == 0, sizes=(2048, 16)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for q in range(0, 6000, 200):
        score = np.cumsum(x.astype(float) * x[q].astype(float), axis=1)[:, -1]
        score[q] = -np.inf
        assert [i for _, i in sorted(got[q])] == np.lexsort((np.arange(6000), -score))[:20].tolist()

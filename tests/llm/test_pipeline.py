"""Each stage of corpus_pipeline.py against a plain version over rows that aren't in order."""

import re
import threading
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_suffixes import brute
from tokenizers import Tokenizer

import corpus_pipeline
from facetforge.llm import quality, simhash, toxicity
from facetforge.llm.common import Stored, cleared, shared_dir
from facetforge.llm.queries import TOKENIZER

#: Columns with the very names that operators or stages might give their own.
CLASHES = ["quality_keep", "quality_evidence", "Toxicity_Score", "_row", "_text", "row", "id", "n", "of", "doc", "found", "kept_text", "spans", "host", "score"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in CLASHES)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    """Documents of the small table, with nulls, repeated rows, near copies, a genuine U+FFFD, and clashing columns."""
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").limit(60).collect()]
    long = next(t for _, t, *_ in rows if t and len(t) > 2000)
    passage = long[100:260]
    rows += [(1000, None, "en", None, None), (1001, "", None, "s", 0), (None, long, "en", "s", 1), (None, None, None, None, None)]
    rows += [(1002, f"Ein � Zeichen. {passage} und � noch eines, das hier allein steht.", "de", "s", 9)] * 2
    rows += [(1003, long + " x", "en", "s", 1), (1004, passage, "en", "s", 1), (1005, long, "en", "s", 1), (rows[0][0], rows[0][1], "fr", "t", 2)]
    rows += [(1006, "é" * 40 + "ü" * 30, "de", "s", 1), (1007, "è" * 10 + "é" * 40 + "ü" * 30, "de", "s", 1)]
    return spark.createDataFrame([(*r, *range(len(CLASHES))) for r in rows], SCHEMA)


def key(rows):
    return sorted(str(tuple(r)) for r in rows)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_columns_and_empty_tables(spark, docs, sf_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, docs, sf_dir)
    assert got.columns == docs.columns
    assert all(tuple(r)[5:] == tuple(range(len(CLASHES))) for r in got.collect())
    assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_quality_stage(spark, docs, sf_dir):
    """A row stays if the odds of its evidence and of its site's posterior, over the global odds, are at least even."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = quality.learn(docs.select("doc_id", "text"), labels)
    rows = docs.collect()
    p = [1 / (1 + np.exp(-np.clip(np.dot(quality.features(r.text), weights[:-1]) + weights[-1], -30, 30))) if r.text else None for r in rows]
    site = lambda r: (r.source, r.lang)
    group = lambda f, k: [q for r, q in zip(rows, p, strict=True) if f(r) == k and q is not None]
    rate = min(max(np.mean([q for q in p if q is not None]), 1e-6), 1 - 1e-6)

    def pull(f, prior):
        names = [k for k in {f(r) for r in rows} if group(f, k)]
        n = np.array([len(group(f, k)) for k in names])
        mean, base = np.array([np.mean(group(f, k)) for k in names]), np.array([prior(k) for k in names])
        within = max((n * mean * (1 - mean)).sum() / n.sum(), 1e-6)
        between = ((n * (mean - base) ** 2).sum() - (len(n) - 1) * within) / max(n.sum() - (n * n).sum() / n.sum(), 1)
        return max(1, min(within / max(between, 1e-6), 1e6))

    host_pull = pull(lambda r: r.source, lambda k: rate)
    path_pull = pull(site, lambda k: np.mean(group(lambda r: r.source, k[0])))
    odds = lambda q: np.log((q := min(max(q, 1e-6), 1 - 1e-6)) / (1 - q))
    want = []
    for r, own in zip(rows, p, strict=True):
        one = own is not None
        h, s = group(lambda x: x.source, r.source), group(site, site(r))
        at_host = (sum(h) - (own or 0) + host_pull * rate) / (len(h) - one + host_pull)
        at_site = (sum(s) - (own or 0) + path_pull * at_host) / (len(s) - one + path_pull)
        want.append((odds(own if one else rate) + odds(at_site) - odds(rate), r))
    assert min(abs(w) for w, _ in want) > 1e-9
    assert key(corpus_pipeline.quality_stage(spark, docs, sf_dir).collect()) == key(r for w, r in want if w >= 0)


def test_toxicity_stage(spark, docs, sf_dir):
    """Every word's kernel expansion by three loops; a document is its worst word."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    all_docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.learn(all_docs, labels, F.lit(True))
    rows = all_docs.select("doc_id", "text").limit(12).collect()
    got = {r.doc_id: r.toxicity_score for r in toxicity.scored(all_docs, model).collect()}

    def value(word):
        table = toxicity.letters()
        signs = [int(table[ord(c)]) for c in word if ord(c) < 0x10000 and table[ord(c)] != toxicity.DROP]
        best = -np.inf
        for a in range(0, max(1, len(signs) - toxicity.STEP), toxicity.STEP) if len(signs) > toxicity.LONGEST else [0]:
            part, total, norm = signs[a : a + toxicity.LONGEST], 0.0, 0.0
            for i, j, k in combinations(range(len(part)), 3):
                if k - i < toxicity.SPAN:
                    w = toxicity.DECAY ** (k - i + 1)
                    total += w * model.weights[(part[i] * toxicity.SIGNS + part[j]) * toxicity.SIGNS + part[k]]
                    norm += w * w
            if norm:
                best = max(best, total / (norm + 1e-12) ** 0.5)
        return best

    for r in rows:
        want = model.probability(max((value(w) for w in toxicity.words_of(r.text or "")), default=-np.inf))
        assert got[r.doc_id] == pytest.approx(want, abs=1e-5)
    kept = corpus_pipeline.toxicity_stage(spark, docs, sf_dir)
    scored = toxicity.judged(docs.select("doc_id", "text"), labels, corpus_pipeline.fold(F.col("id"), 5) != 0).collect()
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == sorted(str((r.doc_id, r.text)) for r in scored if r.toxicity_score < 0.5)


def test_near_duplicate_stage(spark, docs, sf_dir):
    rows = docs.collect()
    bits = [simhash.fingerprint(r.text) & (1 << 64) - 1 for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if (bits[i] ^ bits[j]).bit_count() <= 3:
            root[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r.doc_id)
    names = {min(i for i in g if i is not None) for g in groups.values() if any(i is not None for i in g)}
    got = corpus_pipeline.near_duplicate_stage(spark, docs, sf_dir).collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(names)
    assert key(r for r in got if r.doc_id is None) == key(r for r in rows if r.doc_id is None)
    assert set(key(got)) <= set(key(rows))


def test_suffix_stage(spark, docs, sf_dir):
    rows, want = docs.collect(), []
    spans = {(doc, n): found for doc, n, found, _ in brute([(r.doc_id, r.text) for r in rows])}
    for r in rows:
        raw = (r.text or "").encode()
        found = spans[str(r.doc_id), len(raw)]
        ends = [0, *(x for s in found for x in s), len(raw)]
        text = "".join(raw[a:b].decode("utf-8", "ignore") for a, b in zip(ends[::2], ends[1::2], strict=True)) if found else r.text
        if not found or text:
            want.append((r.doc_id, text, r.lang, r.source, len(text) if found else r.n_chars, *tuple(r)[5:]))
    got = corpus_pipeline.suffix_stage(spark, docs, sf_dir).collect()
    assert key(got) == key(want) and len(want) < len(rows)
    assert any("�" in (r.text or "") and r.doc_id == 1002 for r in got)


def test_packing_stage(spark, docs, sf_dir):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    got = corpus_pipeline.packing_stage(spark, docs, sf_dir).orderBy("sequence_id").collect()
    want = sorted([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0] for r in docs.collect())
    whole, now = [], []
    for r in got:
        now += np.frombuffer(r.ids, "<u4").tolist()
        if r.start + r.length == r.doc_tokens:
            whole.append(now)
            now = []
    assert sorted(whole) == want and not now


def test_run_leaves_one_table(spark, sf_dir):
    folder = Path(shared_dir(spark))
    before = set(folder.iterdir())
    got = corpus_pipeline.run(spark, sf_dir)
    assert [p.name.split("-")[0] for p in set(folder.iterdir()) - before] == ["packing"] and got.count() > 0
    assert re.search("packing-[0-9a-f]+", got.inputFiles()[0])


def test_tables_are_dropped_by_the_thread_that_stored_them(spark):
    stored, ready, done = [], threading.Event(), threading.Event()

    def other():
        with cleared():
            stored.append(Stored(spark.range(3), "mine"))
            ready.set()
            done.wait(60)

    beside = threading.Thread(target=other)
    with cleared():
        outer = Stored(spark.range(2), "outer")
        with cleared():
            inner = Stored(spark.range(1), "inner")
            beside.start()
            assert ready.wait(60)
        assert not Path(inner.path).exists() and outer.df.count() == 2
    assert not Path(outer.path).exists() and stored[0].df.count() == 3
    done.set()
    beside.join()
    assert not Path(stored[0].path).exists()

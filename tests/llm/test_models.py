"""op3, op5 and op8: held-out accuracy, bent words, and rows that aren't in order."""

import random
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from facetforge.llm import langid, quality, toxicity
from facetforge.llm.queries import op3_quality, op5_language, op8_toxicity

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, quality_evidence int, Toxicity_Score string, language_pred int"


def odd(spark):
    rows = [(1, None, None, None, None, 1, "", 1), (2, "", "en", "src0", 0, 1, None, None), (3, "12 34 !?", "en", None, 8, 1, "", 1)]
    rows += [(4, "the cat sat on the mat and it was the best", "en", "a", 1, 1, "", 1)] * 2 + [(None, "der Hund ist im Haus und das ist gut", "de", "a", 1, 1, "", 1)]
    rows += [(10 + i, ("the cat and the dog " if i % 2 else "der Hund und die Katze ") * (i + 1), "en" if i % 2 else "de", "b", 1, 1, "", 1) for i in range(20)]
    return spark.createDataFrame([*rows, (40, "z" * 30000, "de", "b", 1, 1, "", 1)], SCHEMA)


def test_quality_of_all_documents(spark):
    got = {r.doc_id: r for r in op3_quality(spark, SF).collect()}
    known = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert np.mean([got[r.doc_id].keep == (r.quality == 1) for r in known]) > 0.97
    assert np.mean([got[r.doc_id].keep for r in known if r.quality == 1]) > 0.99


def kept_columns(docs, got, own):
    """The documents' columns stay in order, but for those that the operator's own replace."""
    return got.columns == [*(c for c in docs.columns if c.lower() not in own), *own]


def test_shrinkage_is_that_of_plain_sums(spark):
    rng = random.Random(1)
    rows = [(f"h{i % 7}", f"p{i % 3}", rng.random() * (0.3 + i % 7 / 10)) for i in range(400)] + [("lone", "p", 0.9)]
    table = quality.sites(spark.createDataFrame(rows, "host string, path string, quality_evidence double")).collect()
    for r in table:
        own = [p for h, q, p in rows if (h, q) == (r.host, r.path)]
        at_host = [p for h, _, p in rows if h == r.host]
        assert (r.n, r.host_n) == (len(own), len(at_host))
        assert r.s == pytest.approx(sum(own)) and r.host_s == pytest.approx(sum(at_host))
        assert r.rate == pytest.approx(np.mean([p for *_, p in rows]))
        assert r.host_pull >= 1 and r.path_pull >= 1


def test_quality_of_odd_rows(spark):
    docs = odd(spark)
    for labels in (spark.createDataFrame([(i, int(i % 2)) for i in range(4, 30)] + [(None, 1), (5, None)], "doc_id long, quality int"), spark.createDataFrame([], "doc_id long, quality int")):
        got = quality.judged(docs, labels, F.col("source"), F.col("lang"))
        assert kept_columns(docs, got, ["quality_evidence", "quality_site", "quality_posterior", "quality_keep"])
        rows = got.collect()
        assert len(rows) == docs.count() and all(0 <= r.quality_posterior <= 1 for r in rows)
        assert {r.quality_evidence for r in rows if not r.text} == {None}
    assert quality.judged(docs.limit(0), labels, F.col("source"), F.col("lang")).count() == 0


def test_language_of_held_out_documents(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    got = op5_language(spark, SF).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in got if r.held_out]) > 0.97


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    net = langid.Network(["a", "b", "c"], 3)
    for table in (net.out, net.ahead.p, net.behind.p):
        for k in table:
            table[k] = table[k].astype(np.float64)
    at, label = rng.integers(0, 257, (4, 9)).astype(np.int16), np.array([0, 1, 2, 1])
    at[:, 0] = 65
    grads = net.gradients(at, label)[1]
    for table, grad in zip((net.out, net.ahead.p, net.behind.p), grads, strict=True):
        for k, v in table.items():
            where = np.unravel_index(np.abs(grad[k]).argmax(), v.shape)
            keep, e = v[where], 1e-3
            v[where] = keep + e
            up = net.gradients(at, label)[0]
            v[where] = keep - e
            down = net.gradients(at, label)[0]
            v[where] = keep
            assert grad[k][where] == pytest.approx((up - down) / (2 * e), rel=0.03)


def test_language_of_odd_rows(spark):
    docs = odd(spark)
    signs = spark.createDataFrame([(100 + i, t, None, None, 1, 1, "", 1) for i, t in enumerate(["² ½", "Ⅷ", "① 12", "_ -", "ª x", "文"])], SCHEMA)
    docs = docs.union(signs)
    got = langid.identified(docs, F.lit(True))
    assert kept_columns(docs, got, ["language_pred", "language_score"])
    rows = got.collect()
    assert len(rows) == docs.count()
    assert all((r.language_pred == "und") == (not any(map(str.isalpha, r.text or ""))) for r in rows)
    assert {r.language_pred for r in langid.identified(docs, F.lit(False)).collect()} == {"und"}
    assert langid.identified(docs.limit(0), F.lit(True)).count() == 0


def test_a_document_is_the_mean_of_its_positions():
    """Pooling against one position, one text and one direction at a time."""
    network = langid.Network(["a", "b"], 3)
    texts = ["the cat " * 30, "é", "x" * 64, "y" * 65]

    def states(layer, ids):
        h, state, out = langid.HIDDEN, np.zeros(langid.HIDDEN), []
        for i in ids:
            a = layer.p["x"][i]
            gates = 1 / (1 + np.exp(-(a[: 2 * h] + state @ layer.p["u"])))
            z, r = gates[:h], gates[h:]
            new = np.tanh(a[2 * h :] + (r * state) @ layer.p["v"])
            state = state + z * (new - state)
            out.append(state)
        return out

    for text, got in zip(texts, langid.pooled(network, texts), strict=True):
        raw, every = list(text.encode()), []
        for k in range(0, len(raw), langid.WINDOW):
            own = raw[k : k + langid.WINDOW]
            row = own + [256] * (langid.WINDOW - len(own))
            ahead, behind = states(network.ahead, row), states(network.behind, row[::-1])[::-1]
            for i in range(len(own)):
                e = np.concatenate((ahead[i], behind[i])) @ network.out["w"] + network.out["b"]
                every.append(np.exp(e - e.max()) / np.exp(e - e.max()).sum())
        assert got == pytest.approx(np.mean(every, axis=0), abs=1e-4)


def test_sites_of_addresses(spark):
    urls = ["http://www.A.org:80/en/12?x=1", "https://u@b.net", "https://b.net/?q=/c", "ftp://c.de/x#y", "no address", None, ""]
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select(*quality.site_of(F.col("url"))).collect()
    assert [tuple(r) for r in rows] == [("a.org", "en"), ("b.net", None), ("b.net", None), ("c.de", "x"), (None, None), (None, None), (None, None)]


def test_quality_of_pages_by_host_and_path(spark):
    """Sparse sites: pages judged under their hosts and paths; a site of one page is its prior."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    host, path = quality.site_of(F.col("url"))
    known = pages.select(F.col("page_id").alias("doc_id"), F.col("url").contains("spam").cast("int").alias("quality"))
    got = quality.judged(pages, known, host, path, "page_id", "html").withColumns({"h": host, "p": path}).collect()
    assert len(got) == pages.count()
    by = {}
    for r in got:
        by.setdefault((r.h, r.p), []).append(r)
    assert any(len(v) == 1 for v in by.values()) and any(len(v) > 1 for v in by.values())
    for (h, _), own in by.items():
        if len(own) == 1 and sum(r.h == h for r in got) == 1:  # alone on its host too: the global rate
            rate = np.mean([r.quality_evidence for r in got])
            assert own[0].quality_site == pytest.approx(rate, rel=1e-6)


def test_toxicity_of_held_out_documents(spark):
    got = {r.doc_id: r for r in op8_toxicity(spark, SF).collect()}
    known = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for i, r in got.items())
    assert np.mean([got[r.doc_id].predicted == r.toxic for r in known]) > 0.9  # 41 toxic documents to learn from


def test_bent_words_are_toxic():
    rng = random.Random(2)
    plain = ["".join(rng.choices(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"], k=rng.randint(1, 4))) for _ in range(400)]
    bags = [{*rng.sample(plain, 30), rng.choice(["idiot", "moron", "pathetic"])} if i % 4 == 0 else set(rng.sample(plain, 30)) for i in range(400)]
    model = toxicity.train(bags, np.array([i % 4 == 0 for i in range(400)]))
    p = lambda text: model.probability(max(toxicity.scores(sorted(toxicity.words_of(text)), model.weights)))
    for bad in ("idiot", "i.d.i.o.t", "such an i d i o t there", "IDIIOT", "i1d2i3o4t", "morron", "path-etic", "pathettic", "idïot"):
        assert p(bad) >= 0.5, bad
    assert all(p(w) < 0.5 for w in plain)


def test_scores_are_those_of_the_kernel():
    rng = np.random.default_rng(4)
    weights = rng.normal(size=toxicity.SIGNS**3)
    word = "pathetic"
    total = norm = 0.0
    for a in range(len(word)):
        for b in range(a + 1, len(word)):
            for c in range(b + 1, min(len(word), a + toxicity.SPAN)):
                w = toxicity.DECAY ** (c - a + 1)
                x, y, z = (ord(word[i]) - 97 for i in (a, b, c))
                total += w * weights[(x * toxicity.SIGNS + y) * toxicity.SIGNS + z]
                norm += w * w
    assert toxicity.scores([word, "xy"], weights) == pytest.approx([total / norm**0.5, -np.inf])


def test_toxicity_of_odd_rows(spark):
    docs = odd(spark)
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(4, 30)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = toxicity.judged(docs, labels, F.lit(True))
    assert kept_columns(docs, got, ["toxicity_score", "toxicity_word"])
    rows = got.collect()
    assert len(rows) == docs.count() and all(0 <= r.toxicity_score <= 1 for r in rows)
    assert {r.toxicity_score for r in toxicity.judged(docs, labels.limit(0), F.lit(True)).collect()} == {0.0}
    assert toxicity.judged(docs.limit(0), labels, F.lit(True)).count() == 0


def test_an_insult_that_one_clean_document_has_is_still_toxic():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(300)]
    bags = [{str(w) for w in rng.choice(words, 20)} | ({"zuxxvyrt"} if i % 4 == 0 else set()) for i in range(400)]
    bags[1].add("zuxxvyrt")
    model = toxicity.train(bags, np.array([i % 4 == 0 for i in range(400)]))
    p = lambda bag: model.probability(max(toxicity.scores(sorted(bag), model.weights)))
    assert p({"zuxxvyrt", *words[:20]}) > 0.5 and max(p({w}) for w in words) < 0.5


def test_bags_of_words_are_held_as_numbers():
    """Sets of strings took sixteen kilobytes for a document of 250 words, in the one task that fits."""
    draw = np.random.default_rng(6)
    bags = [sorted({f"w{k}" for k in draw.integers(0, 5000, 260).tolist()}) for _ in range(2000)]
    tracemalloc.start()
    every, held = toxicity.numbered(" ".join(b).split() for b in bags)
    now, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert [[every[i] for i in b] for b in held] == bags and every == sorted(every)
    assert peak < 3000 * len(bags) and now < 2000 * len(bags)

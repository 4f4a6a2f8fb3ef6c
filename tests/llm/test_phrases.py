"""op13 against its SQL, and against plain counting on odd texts, whatever is dealt out or handed on."""

import re
from collections import Counter

import duckdb
import pytest

from facetforge.llm import phrases
from facetforge.llm.queries import ORACLES, op13_phrases


def plain(rows, longest=4, least=30, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f.update((lang, *words[i : i + m]) for i in range(len(words) - m + 1))
    f = {k: v for k, v in f.items() if v >= least}
    longer = Counter()
    for (lang, *w), v in f.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                key = (lang, *w[i : i + m])
                longer[key] = max(longer[key], v)
    out = {}
    for (lang, *w), a in f.items():
        if len(w) > 1 and 100 * longer[lang, *w] < 80 * a:
            cuts = [(2000000 * a // (f[lang, *w[:k]] + f[lang, *w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, *w[:k]], f[lang, *w[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, le, r, n[lang], -s) for lang, rows in out.items() for i, (s, a, p, le, r) in enumerate(sorted(rows)[:top]))


def test_query_is_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = op13_phrases(spark, sf)
    want = con.execute(ORACLES["op13_phrases"])
    assert got.columns == [d[0] for d in want.description]
    want = sorted(want.fetchall())
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 200


TEXTS = [("en", "The cat sat on the mat. the CAT sat, on the mat"), ("en", None), (None, "a b a b a b a b"), ("und", "a b a b\tc  d\x0be f!a"), ("en", ""), ("en", "...,,,!?"), ("de", "Über  Straße Ä über"), ("en", "the the the the the"), ("fr", "a\x00b c\x1fd e f \x85 g")]


def odd(spark, more=()):
    rows = [t for t in TEXTS for _ in range(12)] + [("en", f"id {i % 7} is the number {i}; of the {i % 40} x") for i in range(600)] + [("en", "word " * 3000 + "x")] + list(more)
    return rows, spark.createDataFrame([(i % 9 or None, *r, "p", 1, b"") for i, r in enumerate(rows)], "doc_id long, lang string, text string, prefix string, n int, rest binary").repartition(7)


@pytest.mark.parametrize("sizes", [{}, {"size": 50, "most": 3, "hot": 1}, {"size": 50, "most": 1 << 20, "hot": 1000, "share": 1}, {"size": 400, "most": 8, "hot": 20, "share": 1}, {"least": 3, "top": 5, "size": 90, "most": 2, "hot": 60, "share": 2}])
def test_odd_texts(spark, sizes):
    rows, docs = odd(spark)
    got = phrases.collocations(docs, **sizes)
    asked = {k: v for k, v in sizes.items() if k in ("least", "top")}
    want = plain(rows, **asked)
    assert sorted(tuple(r) for r in got.collect()) == want and want
    for none in (docs.limit(0), docs.where("text is null")):
        empty = phrases.collocations(none, **sizes)
        assert empty.count() == 0 and empty.columns == got.columns


def test_words_that_share_a_hash_get_another_seed(spark, monkeypatch):
    rows, docs = odd(spark)
    seeds = []
    plainly = phrases.counted

    def seen(parts, *args):
        seeds.append(args[-1])
        return None if args[-1] < 2 else plainly(parts, *args)

    monkeypatch.setattr(phrases, "counted", seen)
    assert sorted(tuple(r) for r in phrases.collocations(docs).collect()) == plain(rows)
    assert seeds == [0, 1, 2]


def test_a_shared_hash_is_seen(spark):
    made = [(1, b"12345678", 0, "en", b"one", 40, b""), (1, b"12345678", 0, "en", b"two", 40, b""), (1, b"abcdefgh", 0, "en", b"x", 40, b"")]
    rows = spark.createDataFrame(made, phrases.KINDS)
    got = phrases.grown(rows, 4, 30, 100).collect()
    assert {r.depth for r in got if bytes(r.prefix) == b"12345678"} == {-1, 0} and [r.depth for r in got if bytes(r.prefix) == b"abcdefgh"] == [0]


def test_texts_are_cut_between_words_only():
    raw = b"aa bb, cc " * 50
    assert b"".join(phrases.slices(raw, 7)) == raw and len(list(phrases.slices(raw, 7))) > 20
    assert all(p[:1] in b" ," for p in list(phrases.slices(raw, 7))[1:])
    assert list(phrases.slices(b"", 7)) == [b""] and list(phrases.slices(b"x" * 30, 7)) == [b"x" * 30]

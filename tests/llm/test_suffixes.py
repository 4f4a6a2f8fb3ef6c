"""op10 against a table of all strings."""

import hashlib
import random

import numpy as np
import pytest

from facetforge.llm import suffixes
from facetforge.llm.queries import op10_suffix_dedup

LENGTH = 50


def brute(rows):
    """(doc_id, spans) of each row, from the smallest document of every string."""
    least = {}
    for doc, text in rows:
        raw = (text or "").encode()
        if doc is not None:
            for i in range(len(raw) - LENGTH + 1):
                least[raw[i : i + LENGTH]] = min(doc, least.get(raw[i : i + LENGTH], doc))
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        if doc is not None:
            for i in range(len(raw) - LENGTH + 1):
                if least[raw[i : i + LENGTH]] < doc:
                    gone[i : i + LENGTH] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([False], gone)).astype(int))).tolist()
        spans = list(zip(edges[::2], edges[1::2], strict=True))
        kept = b"".join(raw[i : i + 1] for i in range(len(raw)) if not gone[i])
        out.append((str(doc), len(raw), spans, kept))
    return sorted(out)


def got(frame):
    return sorted((str(r.doc_id), r.n_bytes, [(s.start, s.stop) for s in r.spans], bytes(r.kept)) for r in frame.collect())


def odd_rows():
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdé", k=rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, line = prose(60), "The same line of some fifty-three bytes stands here ok"
    rows = [(i, prose(20) + passage[rng.randint(0, 30) :] + prose(rng.randint(0, 20))) for i in range(12)]
    rows += [(20 + i, line + prose(25)) for i in range(14)] + [(40 + i, prose(8) + line + prose(3) + line) for i in range(6)]
    rows += [(50, None), (51, ""), (52, "short"), (53, passage), (53, passage), (None, passage), (54, "a" * 3000), (55, "b" + "a" * 400)]
    rows += [(56, "ab" * 700), (57, "xab" * 30 + "ab" * 80), (58, "\0" * 90), (59, "\0" * 49 + "x" + "\0" * 60), (60, passage[:49]), (61, passage[:50])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("crowded", "hot"), [(4096, False), (3, False), (4096, True), (3, True)])
def test_odd_rows(spark, crowded, hot, monkeypatch):
    if hot:  # every bucket of three documents is dealt out
        for name, value in (("SHARE", 1), ("LEAST", 3), ("PART", 2)):
            monkeypatch.setattr(suffixes, name, value)
    rows = odd_rows()
    docs = spark.createDataFrame([(i, t, "z", "y") for i, t in rows], "doc_id long, text string, h string, doc string")
    assert got(suffixes.without_repeats(docs, crowded=crowded)) == brute(rows)


#: Two texts that share bytes 16 to 79 and were taken for equal by hashes with fixed multipliers, so that the second lost all.
PAIR = (
    b"old light window half old window near found green letter green near chair river ",
    b"aFyNWMaM4F7I\x10e\x05: half old window near found green letter green near chair river ",
)


@pytest.mark.parametrize("crowded", [4096, 0])
def test_texts_made_to_share_a_hash(spark, crowded):
    rows = [(i, t.decode()) for i, t in enumerate(PAIR)]
    found = got(suffixes.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), crowded=crowded))
    assert found == brute(rows) and found[1][2:] == ([(16, 80)], PAIR[1][:16])


def test_hashes_follow_their_keys():
    rows = np.frombuffer(b"".join(PAIR), np.uint8).reshape(2, 80)
    keys = suffixes.drawn(50)
    assert keys.shape == (3, 21)
    for k in keys.tolist():
        for row, h in zip(PAIR, suffixes.keyed(rows, np.array(k, np.uint64)).tolist(), strict=True):
            words = [int.from_bytes(row[i : i + 4], "little") for i in range(0, 80, 4)]
            assert h == (k[-1] + sum(x * y for x, y in zip(words, k, strict=False))) % (1 << 64) >> 32


def test_empty_table(spark):
    assert suffixes.without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_of_all_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, sum(b - a for a, b in s), len(s), hashlib.sha256(kept).hexdigest()) for i, n, s, kept in brute(rows)]
    found = [(str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op10_suffix_dedup(spark, sf_dir).collect()]
    assert sorted(found) == want


def test_maximal_repeats_have_all_occurrences():
    text = np.frombuffer(b"xabcabcaby" b"zabcabcabw", np.uint8).reshape(2, 10)
    row, offset, common = suffixes.suffix_array(np.zeros(2, int), text, 2)
    left = np.where(offset > 0, text[row, offset - 1].astype(int), -1)
    found = set()
    for a, b, depth, least in suffixes.maximal_repeats(common, left, row, 2):
        places = {(int(r), int(o)) for r, o in zip(row[a : b + 1], offset[a : b + 1], strict=True)}
        found.add((bytes(text[row[a], offset[a] : offset[a] + depth]), frozenset(places), least))
    every = lambda s: frozenset((r, o) for r in range(2) for o in range(10 - len(s) + 1) if bytes(text[r, o : o + len(s)]) == s)
    assert found == {(s, every(s), 0) for s in (b"ab", b"abcab", b"abcabcab")}


def test_a_crowded_bucket_settles_blocks_of_strings_at_once(spark, monkeypatch):
    """Where documents share a passage, few of its strings are told one by one; all were before."""
    made = []

    class Seen(suffixes.Stored):
        def __init__(self, df, label, lasting=False):
            super().__init__(df, label, lasting)
            made.append((label, self.df))

    monkeypatch.setattr(suffixes, "Stored", Seen)
    covered = [s for a, b in suffixes.blocks(LENGTH) for s in range(a, b + 1)]
    assert covered == list(range(LENGTH - suffixes.GRAM + 1))
    rng = random.Random(8)
    letters = lambda n: "".join(rng.choices("abcdefgh", k=n))
    passage = letters(90)
    rows = [(i, letters(60) + passage) for i in range(60)]
    frame = suffixes.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), crowded=3)
    assert got(frame) == brute(rows)
    told = [df for label, df in made if label == "blocks" and "late" in df.columns][-1]
    whole = told.where("late").selectExpr("sum(stop - start + 1)").first()[0]
    assert told.where("late").count() < whole / 3

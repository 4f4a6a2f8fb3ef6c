"""op7 against all pairs of fingerprints."""

import random

import pytest
import xxhash

from facetforge.llm import simhash
from facetforge.llm.components import components
from facetforge.llm.queries import op7_simhash


def closure(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [plain(t) for _, t in rows]
    edges = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    at = closure(range(len(rows)), edges)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[at[n]] = min(i, least.get(at[n], i))
    return sorted((str(i), f"{prints[n]:016x}", str(least.get(at[n]))) for n, (i, _) in enumerate(rows))


def test_query_of_all_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in op7_simhash(spark, sf_dir).collect())
    assert got == brute(rows)


def test_odd_rows(spark):
    rows = [(5, None), (3, ""), (9, " \t\n"), (8, "One TWO"), (4, "one two"), (4, "one two"), (None, "one two x y"), (7, "x" * 9000), (6, "É a b"), (2, "é a b")]
    docs = spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id long, text string, bits string, component_id int")
    got = simhash.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), f"{r.bits & (1 << 64) - 1:016x}", str(r.component_id)) for r in got) == brute(rows)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("sizes", [{}, {"heavy": 3}, {"heavy": 3, "crowded": 4}])
def test_links_close_like_all_pairs(spark, sizes):
    rng = random.Random(3)
    bits = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(14):
            x = base
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            bits.add(simhash.signed(x))
    full = rng.getrandbits(40) << 24
    bits |= {simhash.signed(full | 1 << rng.randrange(24)) for _ in range(9)}  # one part of a posting
    bits = sorted(bits)
    found = simhash.links(spark.createDataFrame([(b,) for b in bits], "bits long"), **sizes)
    got = closure(bits, [tuple(r) for r in found.collect()])
    mask = (1 << 64) - 1
    assert got == closure(bits, [(a, b) for a in bits for b in bits if a < b and ((a ^ b) & mask).bit_count() <= 3])


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges for x in e}
    assert got == closure(nodes, edges)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

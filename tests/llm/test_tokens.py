"""op6 and op9 against the libraries' own results."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from facetforge.llm import bpe, packing
from facetforge.llm.queries import RANKS, TOKENIZER, op6_byte_bpe, op9_packing

SCHEMA = "doc_id long, text string, ids string, k int"
ODD = [
    (1, None, None, None), (2, "", "x", 1), (3, "it's we'll 'S don't'm  \n\n x", "x", 1), (3, "it's we'll 'S don't'm  \n\n x", "x", 1),
    (4, "a" * 500, "", 2), (5, " ".join(["été 語² 12.5"] * 60), "", 2), (None, "no id " * 40, "", 3), (6, "<|endoftext|>\0 \t x", "", 1),
    (8, "a<|endoftext|>b <|endoftext|><|endoftext|> it's <|endoftext|", "", 1),
    (7, "   " * 90 + "end", "", 1),
]


def own():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(RANKS), special_tokens={})


def test_encode_chunks_like_the_library(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    for chunk, overlap in ((64, 24), (16, 16), (32768, 2048)):
        got = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap).collect()
        want = sorted((str(i), np.array(own().encode_ordinary(t or ""), "<u4").tobytes()) for i, t, *_ in ODD)
        assert sorted((str(r.doc_id), bytes(r.ids)) for r in got) == want
    assert bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_chunks_of_random_texts(spark):
    rng = random.Random(7)
    signs = ["a", "bc", "'s", "'", " ", "  ", "\n", "1", "!", "é", "語", "'ll", "\t"]
    rows = [(i, "".join(rng.choices(signs, k=rng.randint(0, 300)))) for i in range(120)]
    got = bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"), RANKS, public_tokenizers.PATTERN, chunk=40, overlap=20)
    want = {i: own().encode_ordinary(t) for i, t in rows}
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in got.collect()} == want


def test_query_of_all_documents(spark, sf_dir):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    got = op6_byte_bpe(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = own().encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def check_pieces(rows, want, longest=1024):
    """rows: (doc, start, length, crc, doc_tokens, sequence, offset)."""
    by = {}
    for r in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        by.setdefault(r[0], []).append(r)
    for doc, ids in want.items():
        at = 0
        for _, start, length, crc, tokens, _, offset in by.pop(doc):
            assert (start, tokens, offset) == (at, len(ids), 0)
            assert length <= longest and length & (length - 1) == 0
            assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            at += length
        assert at == len(ids)
    assert not by
    assert len({r[5] for r in rows}) == len(rows)


def test_packing_of_all_documents(spark, sf_dir):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    got = [tuple(r)[:7] for r in op9_packing(spark, sf_dir).collect()]
    check_pieces(got, {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in texts.items()})


def test_packing_of_odd_rows(spark, tmp_path):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = [r for i, r in enumerate(ODD) if i != 3]
    docs = spark.createDataFrame(rows, SCHEMA)
    pieces = packing.pack(docs, TOKENIZER, longest=64)
    got = [(r.doc_id, r.start, r.length, zlib.crc32(r.ids), r.doc_tokens, r.sequence_id, r.offset) for r in pieces.collect()]
    check_pieces(got, {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t, *_ in rows}, 64)
    packing.write_buckets(pieces, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "bucket=64")).where("length <> 64").count() == 0
    assert packing.pack(docs.limit(0), TOKENIZER).count() == 0
    assert packing.pack(docs.where("doc_id = 3").union(docs.where("doc_id = 3")), TOKENIZER).groupBy("start").count().where("count <> 2").count() == 0

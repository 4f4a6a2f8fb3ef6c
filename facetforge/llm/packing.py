"""Packing by power-of-two decomposition.

A document's ids, with the end id after them, are cut into pieces of the longest length and then of the powers of two
in the rest, the long ones first. Every piece is a sequence by itself: its length is a power of two, so it needs no
padding, and no sequence crosses documents. Pieces of equal length make up a bucket, from which batches of one length
are drawn.

Defined cases: a null or empty text is the end id alone, a piece of length 1; the string of a token that the vocabulary adds
is that token, as its library has it; repeated rows are packed each by itself;
columns other than the id and the text are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from facetforge.llm.pieces import PieceIds

#: Ids sent on at once.
FLUSH = 1_000_000


def byte_signs() -> dict[int, str]:
    """The sign that a byte-level vocabulary writes for each byte: itself if it can be printed, else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def piece_ids(path: str) -> PieceIds:
    """The vocabulary's merges, applied to one pre-token at a time."""
    model, signs = Tokenizer.from_file(path).model, byte_signs()
    return PieceIds(lambda piece: [t.id for t in model.tokenize(piece.encode().decode("latin-1").translate(signs))])


@lru_cache(maxsize=2)
def added_tokens(path: str) -> tuple[re.Pattern | None, dict[str, int]]:
    """The tokens that the vocabulary adds to its merges: their strings in a text stand for them, and divide it."""
    ids = {t.content: i for i, t in Tokenizer.from_file(path).get_added_tokens_decoder().items()}
    longest_first = sorted(ids, key=len, reverse=True)
    return (re.compile("|".join(map(re.escape, longest_first))) if ids else None), ids


def ids_of(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, one text after another, and how many each has."""
    table, (added, ids) = piece_ids(path), added_tokens(path)
    odd = [i for i, x in enumerate(texts) if added and added.search(x)]
    if not odd:
        return table.of(texts)
    # A text with added tokens is encoded part by part, its tokens' ids put between.
    parts, of = [], []
    for i, x in enumerate(texts):
        own = added.split(x) if i in set(odd) else [x]
        parts += own
        of += [i] * len(own)
    flat, many = table.of(parts)
    ends = np.cumsum(many)
    between = {k: [] for k in odd}
    for i in odd:
        between[i] = [ids[x] for x in added.findall(texts[i])]
    out, count, nth = [], np.zeros(len(texts), np.int64), {}
    for k, i in enumerate(of):
        out.append(flat[ends[k] - many[k] : ends[k]])
        count[i] += many[k]
        nth[i] = nth.get(i, -1) + 1
        if nth[i] < len(between.get(i, ())):
            out.append(np.array([between[i][nth[i]]], flat.dtype))
            count[i] += 1
    return np.concatenate(out), count


def lengths(n: int, longest: int) -> list[int]:
    """Powers of two that add up to n, none over `longest`, the long ones first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(
    docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", longest: int = 1024, end_id: int = 0
) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids (little-endian unsigned 32-bit integers), doc_tokens, sequence_id,
    offset, bucket. sequence_id is unique; bucket is the sequence's length. No row is shuffled."""
    if longest & (longest - 1):
        raise ValueError("the longest length is a power of two")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, many = ids_of([x or "" for x in batch.column("text").to_pylist()], vocabulary)
            made, held, at = [], 0, 0

            def out(made: list) -> pa.RecordBatch:
                names = ["doc_id", "start", "length", "ids", "doc_tokens"]
                kinds = [batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.binary(), pa.int64()]
                return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*made, strict=True), kinds, strict=True)], names)

            for doc, n in zip(batch.column("doc_id").to_pylist(), many.tolist(), strict=True):
                ids = np.append(flat[at : at + n], end_id).astype("<u4")
                at, start = at + n, 0
                for size in lengths(n + 1, longest):
                    made.append((doc, start, size, ids[start : start + size].tobytes(), n + 1))
                    start += size
                held += n + 1
                if held >= FLUSH:
                    yield out(made)
                    made, held = [], 0
            if made:
                yield out(made)

    pieces = rows.mapInArrow(run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long")
    return pieces.select(
        "*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.col("length").alias("bucket")
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder of sequences for each length."""
    pieces.write.partitionBy("bucket").parquet(path)

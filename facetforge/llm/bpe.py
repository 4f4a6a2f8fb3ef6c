"""Byte-level BPE encoding and decoding by overlapping chunks.

A text longer than a chunk is cut into chunks that overlap. Each chunk is pre-tokenised by itself, in parallel; where a
chunk and its predecessor have a pre-token boundary in common inside their overlap they have resynchronised, since what
follows a boundary doesn't depend on what is before it. There the text is cut into pieces, and the pieces are encoded
in parallel. Decoding concatenates the raw bytes of the ids.

Defined cases: a null or empty text has no ids and decodes to no bytes; repeated rows give repeated results; a stretch
without a common boundary (one endless pre-token) stays in one piece; columns other than `keep` and the text are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetforge.llm.pieces import SPACE, PieceIds, classes, code_points, ends

#: Code points of a chunk, and of its overlap with the next. The last few boundaries of a chunk depend on what follows.
CHUNK, OVERLAP, BLUR = 32_768, 2_048, 4
#: Pre-tokens whose ids a worker holds; fewer than elsewhere, as workers that encode and workers that decode stand side by side.
ROOM = 100_000


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(maxsize=2)
def piece_ids(path: str, pattern: str) -> PieceIds:
    encoding = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})
    return PieceIds(encoding.encode_ordinary, ROOM)


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    known = ranks(path)
    out = [b""] * (max(known.values()) + 1)
    for token, rank in known.items():
        out[rank] = token
    return out


def replaced(batch: pa.RecordBatch, name: str, new: str, values: list, kind: pa.DataType) -> pa.RecordBatch:
    """The batch with one column replaced by another."""
    names = [new if x == name else x for x in batch.schema.names]
    columns = [pa.array(values, kind) if x == name else batch.column(i) for i, x in enumerate(batch.schema.names)]
    return pa.RecordBatch.from_arrays(columns, names)


def with_column(df: DataFrame, name: str, new: str, kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(new, kind) if f.name == name else f for f in df.schema])


def encode_rows(df: DataFrame, text: str, vocabulary: str, pattern: str) -> DataFrame:
    """The column `text` replaced by `ids`: little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_ids(vocabulary, pattern)
        for batch in batches:
            flat, many = table.of([x or "" for x in batch.column(text).to_pylist()])
            stop = (np.cumsum(many) * 4).tolist()
            raw = flat.astype("<u4", copy=False).tobytes()
            yield replaced(batch, text, "ids", [raw[a:b] for a, b in zip([0, *stop[:-1]], stop, strict=True)], pa.binary())

    return df.mapInArrow(run, with_column(df, text, "ids", T.BinaryType()))


def decode_rows(df: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """The column of ids replaced by `decoded`: the bytes of all its tokens, concatenated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = token_bytes(vocabulary).__getitem__
        for batch in batches:
            out = [b"".join(map(of, array("I", x))) for x in batch.column(ids).to_pylist()]
            yield replaced(batch, ids, "decoded", out, pa.binary())

    return df.mapInArrow(run, with_column(df, ids, "decoded", T.BinaryType()))


def chunks(df: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Overlapping chunks of each row's `text`, with the boundaries near their ends, in code points of the whole text."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                text = row.pop("text")
                for k in range(-(-len(text) // chunk)):
                    yield pa.RecordBatch.from_pylist([row | {"k": k, "text": text[k * chunk : (k + 1) * chunk + overlap]}], schema)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                at = ends(row["text"])
                at = at[classes()[code_points(row["text"])[at - 1]] != SPACE]  # white space looks at what follows it
                row["head"] = (at[at < overlap] + row["k"] * chunk).tolist()
                row["tail"] = (at[(at >= chunk) & (at < len(row["text"]) - BLUR)] + row["k"] * chunk).tolist()
            yield pa.RecordBatch.from_pylist(rows, marked)

    fields = [pa.field("doc", pa.int64()), pa.field("text_hash", pa.int64()), pa.field("k", pa.int64()), pa.field("text", pa.string())]
    schema = pa.schema(fields)
    marked = pa.schema([*fields, pa.field("head", pa.list_(pa.int64())), pa.field("tail", pa.list_(pa.int64()))])
    cut = df.mapInArrow(split, "doc long, text_hash long, k long, text string").repartition("doc", "text_hash", "k")
    return cut.mapInArrow(mark, "doc long, text_hash long, k long, text string, head array<long>, tail array<long>")


def stitched(marked: DataFrame, chunk: int) -> DataFrame:
    """Pieces between the boundaries at which neighbouring chunks agree: doc, text_hash, start, text.

    A chunk that agrees nowhere with its predecessor, and all after it, are joined to one piece.
    """
    order = Window.partitionBy("doc", "text_hash").orderBy("k")
    start = F.when(F.col("k") == 0, F.lit(0)).otherwise(F.array_min(F.array_intersect(F.lag("tail").over(order), F.col("head"))))
    found = marked.withColumn("start", start)
    found = found.withColumn("start", F.when(F.min(F.col("start").isNotNull()).over(order), F.col("start")))
    found = found.withColumn("piece", F.count("start").over(order))
    pieces = found.groupBy("doc", "text_hash", "piece").agg(
        F.sort_array(F.collect_list(F.struct("k", "text"))).alias("parts"), F.min("start").alias("start")
    )
    stop = F.lead("start").over(Window.partitionBy("doc", "text_hash").orderBy("piece"))
    whole = F.array_join(
        F.transform("parts", lambda x, i: F.when(i == F.size("parts") - 1, x.text).otherwise(x.text.substr(F.lit(1), F.lit(chunk)))), ""
    )
    skip = (F.col("start") - F.element_at("parts", 1).k * chunk).cast("int")
    size = F.coalesce(F.col("stop") - F.col("start"), F.length("whole")).cast("int")
    return (
        pieces.select("doc", "text_hash", "start", "parts", stop.alias("stop"), whole.alias("whole"))
        .withColumn("text", F.col("whole").substr(skip + 1, size))
        .select("doc", "text_hash", "start", "text")
    )


def encode(
    docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """doc_id and `ids` of every row. Texts of at most a chunk are one piece and are not shuffled."""
    rows = docs.select(F.col(doc_id).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    short = rows.where(F.length("text") <= chunk)
    long = rows.where(F.length("text") > chunk).withColumn("text_hash", F.xxhash64("text"))
    times = long.groupBy("doc", "text_hash").agg(F.count("*").alias("times"), F.any_value("text").alias("text"))
    pieces = stitched(chunks(times.select("doc", "text_hash", "text"), chunk, overlap), chunk)
    coded = encode_rows(pieces, "text", vocabulary, pattern)
    joined = coded.groupBy("doc", "text_hash").agg(F.sort_array(F.collect_list(F.struct("start", "ids"))).alias("parts"))
    joined = joined.select("doc", "text_hash", F.unhex(F.array_join(F.transform("parts", lambda x: F.hex(x.ids)), "")).alias("ids"))
    back = times.select("doc", "text_hash", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time"))
    back = back.join(joined, (back.doc.eqNullSafe(joined.doc)) & (back.text_hash == joined.text_hash)).select(back.doc, "ids")
    return encode_rows(short, "text", vocabulary, pattern).unionByName(back).withColumnRenamed("doc", doc_id)

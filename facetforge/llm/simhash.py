"""SimHash near-duplicates through an inverted index on byte positions, with count filtering.

Fingerprints that differ in at most k bits agree in at least 8 - k of their 8 bytes. The index has a posting for
combinations of positional bytes: of the triples inside the first and the last four positions, any five equal bytes
hold one. The equal bytes of each pair that meets in a posting are tallied; pairs below the guaranteed minimum go, the
others are verified by their differing bits. Equal fingerprints are one entry, so copies make no pairs.

A posting with more than `heavy` fingerprints isn't paired as it is, but divided by two more of its bytes. If a part
still has more than `crowded`, the 24 bits left are masked three at a time; two fingerprints with the same rest differ
in those bits at most, so each is linked to the smallest with that rest. All links follow, and the rows grow with the
part's length, not with its square.

Defined cases: a text that is null or has no words has fingerprint zero and is linked like any other; rows with a null
doc_id are linked, but never name a component (a component of such rows alone has a null id); repeated rows keep their
number; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetforge.llm.common import Stored
from facetforge.llm.components import components

SEED, BYTES = 42, 8


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The bits that are set in over half the hashes of a text's shingles, as a signed 64-bit integer."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z only, and the white space of the contract
    if not words:
        return 0
    joined = b" ".join(words)
    stop = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = np.concatenate(([0], stop[:-1] + 1))
    if len(words) > shingle:
        start, stop = start[: 1 - shingle], stop[shingle - 1 :]
    else:
        start, stop = start[:1], stop[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(start.tolist(), stop.tolist(), strict=True)), np.uint64, len(start))
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[k : k + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id, bits (long)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = pa.array([fingerprint(x, shingle) for x in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), bits], ["doc_id", "bits"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, bits long")


def byte_at(bits: Column, position: int) -> Column:
    return F.shiftrightunsigned(bits, 8 * position).bitwiseAND(F.lit(255))


def shared_bytes(a: Column, b: Column) -> Column:
    """In how many positions two fingerprints have the same byte."""
    return sum(((byte_at(a.bitwiseXOR(b), p) == 0).cast("int") for p in range(BYTES)), F.lit(0))


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


TRIPLES = [t for half in (range(4), range(4, 8)) for t in combinations(half, 3)]


def pairs_in(postings: DataFrame, key: list[str], most: int) -> DataFrame:
    """Near pairs that meet in a posting: the tally of equal bytes first, then the differing bits."""
    a, b = postings.alias("a"), postings.alias("b")
    met = F.col("a.bits") < F.col("b.bits")
    for k in key:
        met = met & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    x, y = F.col("a.bits"), F.col("b.bits")
    near = (shared_bytes(x, y) >= BYTES - most) & (F.bit_count(x.bitwiseXOR(y)) <= most)
    return a.join(b, met & near).select(x.alias("a"), y.alias("b"))


def links(bits: DataFrame, most: int = 3, heavy: int = 1024, crowded: int = 4096) -> DataFrame:
    """Pairs a, b of the different fingerprints in `bits` whose closure links all that differ in at most `most` bits."""
    if not 0 <= most <= 3:
        raise ValueError("the triples of the index answer for at most three bits")
    masks = [signed(sum(255 << 8 * p for p in t)) for t in TRIPLES]
    postings = bits.select("bits", F.posexplode(F.array(*(F.col("bits").bitwiseAND(F.lit(m)) for m in masks))).alias("triple", "value"))
    sizes = postings.groupBy("triple", "value").agg(F.count("*").alias("size")).where("size > 1")
    key = ["triple", "value"]
    light = pairs_in(postings.join(sizes.where(F.col("size") <= heavy), key), key, most)
    return light.unionByName(heavy_links(postings.join(sizes.where(F.col("size") > heavy), key), most, crowded)).distinct()


def heavy_links(postings: DataFrame, most: int, crowded: int) -> DataFrame:
    """Links inside long postings. Two near fingerprints of a posting agree in two more bytes, so it is divided by each
    choice of two; in a part over `crowded`, the bits of the three bytes left are masked as the module says."""
    masks = []
    for t in TRIPLES:
        rest = [p for p in range(BYTES) if p not in t]
        masks.append([signed(sum(255 << 8 * p for p in (*t, *more))) for more in combinations(rest, BYTES - 3 - most)])
    table = F.array(*(F.array(*(F.lit(m) for m in row)) for row in masks))
    parts = postings.select("bits", F.explode(F.element_at(table, F.col("triple") + 1)).alias("mask")).distinct()
    parts = parts.withColumn("value", F.col("bits").bitwiseAND(F.col("mask")))
    key = ["mask", "value"]
    sizes = parts.groupBy(*key).agg(F.count("*").alias("size")).where("size > 1")
    few = pairs_in(parts.join(sizes.where(F.col("size") <= crowded), key), key, most)
    crowds = parts.join(sizes.where(F.col("size") > crowded), key)
    free = [(m, holes(m, most)) for m in sorted({m for row in masks for m in row})]
    lookup = F.broadcast(postings.sparkSession.createDataFrame(free, "mask long, holes array<long>"))  # 56 rows at most
    stars = crowds.join(lookup, "mask").select("bits", F.explode("holes").alias("hole"))
    stars = stars.withColumn("value", F.col("bits").bitwiseAND(F.bitwise_not("hole")))
    hubs = stars.groupBy("hole", "value").agg(F.min("bits").alias("a"), F.count("*").alias("size")).where("size > 1")
    return few.unionByName(stars.join(hubs, ["hole", "value"]).where("a <> bits").select("a", F.col("bits").alias("b")))


def holes(mask: int, most: int) -> list[int]:
    """All ways to choose `most` of the bits that the mask leaves free."""
    free = [i for i in range(64) if not mask >> i & 1]
    return [signed(sum(1 << i for i in c)) for c in combinations(free, most)]


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = 3, shingle: int = 3, **sizes: int) -> DataFrame:
    """doc_id, bits, component_id (the smallest doc_id that a chain of links reaches, itself included)."""
    rows = Stored(fingerprints(docs, doc_id, text, shingle), "simhash").df
    least = rows.groupBy("bits").agg(F.min("doc_id").alias("least"))
    found = components(links(least.select("bits"), most, **sizes))
    named = least.join(found, least.bits == found.node, "left").select("bits", "least", F.coalesce("label", "bits").alias("label"))
    names = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(names, "label").select("bits", "component_id")
    return rows.join(named, "bits").select("doc_id", "bits", "component_id")

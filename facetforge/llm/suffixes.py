"""Exact substring deduplication with an enhanced suffix array and its common-prefix interval tree.

A byte goes if a string of `length` bytes that covers it also starts in a document with a smaller id.

Every string of that length holds an anchor: the k-gram with the smallest hash among its k-grams, which depends on the
string alone. So two equal strings have equal anchors at the same place, and both lie in the anchors' contexts (the
k-gram and length - k bytes on either side). Documents are compared bucket by bucket, a bucket being an anchor's hash:

1. Equal contexts are settled by 80 bits of hashes whose keys are drawn anew for each run: multilinear ones, so that any two
   different contexts, whoever chose them, agree with a probability of 2^-80, and only those of one bucket are compared. Of
   the documents that have one, only the smallest keeps it. A bucket that a sample of the documents shows to be hot is dealt out over several tasks by
   documents; each settles its part, and what is left of all parts is aggregated.
2. The different contexts of a bucket, each with its smallest document, are suffix-sorted. A stack scan over the common
   prefixes builds the interval tree from below; an interval at least `length` deep whose suffixes have different bytes
   on their left is a maximal repeat, and all its occurrences but those of its smallest document are marked.
3. A bucket with more than `crowded` different contexts (the edge of a passage that very many documents share) doesn't
   fit into one suffix array: its strings are grouped by themselves, each group reduced to its smallest document before
   it is shuffled; strings that start near each other go together where they can. That gives the same bytes, by some
   twelve rows for each of its contexts where passages begin or end, and at most length - k + 1 and the blocks.

Defined cases: ids are read as long integers; a null or empty text, or one shorter than `length`, loses nothing; rows with
a null id lose nothing and take nothing from others; repeated rows with one id don't take from each other; texts of any
length are treated whole; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetforge.llm.common import Stored

GRAM = 20
#: A byte that no UTF-8 text has; stands beyond both ends of a text.
EDGE = 0xFF
#: Contexts that are suffix-sorted at once, about, and the most that one bucket may have there.
BLOCK = CROWDED = 4096
#: One document in SHARE shows which buckets are hot: the largest HOT of those with LEAST anchors there or more. Of a hot
#: bucket a task gets PART anchors, about. That only deals out rows; results don't depend on it.
SHARE, LEAST, HOT, PART = 128, 64, 20_000, 8192
#: An odd multiplier of the rolling hash.
BASE = np.uint64(0x9E3779B97F4A7C15)


def power(n: int) -> np.uint64:
    return np.uint64(pow(int(BASE), n, 1 << 64))


def doubled(x: np.ndarray, most: int, join) -> dict[int, np.ndarray]:
    """Of every run of 1, 2, 4, ... values up to `most`, what `join(left, right, size of right)` makes of it."""
    out, n = {1: x}, 1
    while 2 * n <= most:
        half = out[n]
        out[2 * n] = join(half[:-n] if len(half) > n else half[:0], half[n:], n)
        n *= 2
    return out


def rolling(padded: np.ndarray, size: int) -> np.ndarray:
    """The hashes of all runs of `size` bytes."""
    parts = doubled(padded.astype(np.uint64) + np.uint64(1), size, lambda a, b, n: a * power(n) + b)
    got, done = None, 0
    for b in sorted((b for b in parts if size & b), reverse=True):
        part = parts[b][done : done + len(padded) - size + 1]
        got = part if got is None else got[: len(part)] * power(b) + part
        done += b
    got = got ^ (got >> np.uint64(32))
    got = got * np.uint64(0xD6E8FEB86659FD93)
    return got ^ (got >> np.uint64(32))


def drawn(length: int) -> np.ndarray:
    """Keys for contexts of strings of that length: for each of three hashes one for every four bytes, and one more."""
    words = -(-(2 * length - GRAM) // 4)
    return np.frombuffer(os.urandom(24 * (words + 1)), np.uint64).reshape(3, -1)


def keyed(rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """A 32-bit hash of each row of bytes (a multiple of four): the upper half of the sum of its words times their keys,
    which is uniform over all keys for any row, and for any two rows independent."""
    got = np.full(len(rows), keys[-1], np.uint64)
    for word, key in zip(np.ascontiguousarray(rows).view("<u4").T, keys, strict=False):
        got += word.astype(np.uint64) * key
    return got >> np.uint64(32)


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    parts = doubled(x, width, lambda a, b, n: pick(a, b))
    n = max(parts)
    return pick(parts[n][: len(x) - width + 1], parts[n][width - n :]) if width > n else parts[n]


class Anchors:
    """The anchors of some texts, which stand one after another with edges around each.

    doc: the text of each anchor; at: where its gram starts; g: 48 bits of the gram's hash (the bucket) over 16 of the
    context's third; c: the first and second hash of the context.
    """

    def __init__(self, raws: list[bytes], length: int, keys: np.ndarray):
        margin = length - GRAM
        width = length + margin
        size = np.fromiter(map(len, raws), np.int64, len(raws))
        self.stop = np.cumsum(size + margin)
        self.start = self.stop - size
        edge = bytes([EDGE]) * margin
        self.bytes = np.frombuffer(edge + b"".join(x for raw in raws for x in (raw, edge)), np.uint8)
        self.doc = self.at = self.g = self.c = np.empty(0, np.int64)
        if len(self.bytes) < width:
            return
        grams = rolling(self.bytes, GRAM)
        crossed = np.cumsum(np.concatenate(([0], self.bytes == EDGE)))
        least = np.where(crossed[length:] == crossed[:-length], sliding(grams, margin + 1, np.minimum), np.uint64(0))
        blank = np.zeros(margin, np.uint64)
        chosen = grams == sliding(np.concatenate((blank, least, blank)), margin + 1, np.maximum)
        self.at = np.flatnonzero(chosen & (crossed[GRAM:] == crossed[:-GRAM]))
        self.doc = np.searchsorted(self.stop, self.at, side="right")
        around = np.lib.stride_tricks.sliding_window_view(self.bytes, width)[self.at - margin]
        around = np.pad(around, ((0, 0), (0, -width % 4)))
        first, second, third = (keyed(around, k) for k in keys)
        self.c = (first << np.uint64(32) | second).view(np.int64)
        low = np.uint64(0xFFFF)
        self.g = (grams[self.at] & ~low | third & low).view(np.int64)


def chunked(texts: list[str | None], most: int = 1 << 16) -> Iterator[tuple[int, list[bytes]]]:
    """The texts' bytes in groups of about `most`, so that the arrays over them stay small; each with its first number."""
    held, first, size = [], 0, 0
    for i, text in enumerate(texts):
        held.append((text or "").encode())
        size += len(held[-1])
        if size >= most:
            yield first, held
            held, first, size = [], i + 1, 0
    if held:
        yield first, held


def mixed(doc: np.ndarray, g: np.ndarray, c: np.ndarray) -> np.ndarray:
    """One number for a text's number and both hashes."""
    return (g * np.int64(3) + c) * np.int64(0x9E3779B97F4A7C1) + doc * np.int64(0x2545F4914F6CDD1D)


def bucket() -> Column:
    return F.shiftright("g", 16)


def anchor_rows(rows: DataFrame, length: int, keys: np.ndarray, parts: dict[int, int] | None = None) -> DataFrame:
    """doc, g, c: the anchors of each document and the hashes of their contexts, each pair once a document; part: 0, or of
    a bucket that `parts` has in so many parts the document's, from 1."""
    hot = sorted(parts or {})
    handed = rows.sparkSession.sparkContext.broadcast((np.array(hot, np.int64), np.array([parts[h] for h in hot], np.int64)))  # HOT at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, many = handed.value
        for batch in batches:
            ids = batch.column("doc").to_numpy(zero_copy_only=False)
            for first, raws in chunked(batch.column("text").to_pylist()):
                found = Anchors(raws, length, keys)
                once = np.unique(mixed(found.doc, found.g, found.c), return_index=True)[1]
                doc, g, c = ids[first + found.doc[once]], found.g[once], found.c[once]
                part = np.zeros(len(g), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, g >> 16), len(known) - 1)
                    is_hot = known[at] == g >> 16
                    part[is_hot] = 1 + (doc[is_hot] * np.int64(0x9E3779B97F4A7C1) >> 33) % many[at[is_hot]]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (doc, g, c, part)], ["doc", "g", "c", "part"])

    return rows.where("doc is not null").mapInArrow(run, "doc long, g long, c long, part long")


def hot_buckets(rows: DataFrame, length: int, keys: np.ndarray) -> dict[int, int]:
    """The buckets that hold very many documents, as a sample of the documents shows, and in how many parts each is dealt
    out. At most HOT buckets."""
    few = rows.where(F.pmod(F.xxhash64("doc"), F.lit(SHARE)) == 0)
    counts = anchor_rows(few, length, keys).groupBy(bucket().alias("h")).agg(F.count("*").alias("n")).where(F.col("n") >= LEAST)
    return {r.h: -(-r.n * SHARE // PART) for r in counts.orderBy(F.desc("n"), "h").limit(HOT).collect()}


def shared_anchors(rows: DataFrame, length: int, keys: np.ndarray) -> DataFrame:
    """doc, g, c, whole, size: anchors whose whole context a smaller document has (whole), and those of the smallest
    document with a context in a bucket where other documents have other contexts; size: different contexts of the bucket."""
    parts = hot_buckets(rows, length, keys)
    own, context = Window.partitionBy("h", "part"), Window.partitionBy("h", "part", "g", "c")
    found = anchor_rows(rows, length, keys, parts).repartition(bucket(), "part").withColumn("h", bucket())
    found = found.withColumn("whole", F.col("doc") > F.min("doc").over(context))
    found = found.select(
        "*", F.min("doc").over(own).alias("low"), F.max("doc").over(own).alias("high"), F.sum((~F.col("whole")).cast("long")).over(own).alias("size")
    )
    found = found.where("whole or part > 0 or low < high and size > 1").select("doc", "g", "c", "part", "whole", "size")
    if not parts:
        return found.drop("part")
    found = Stored(found, "parts").df
    columns = ["doc", "g", "c", "whole", "size"]
    # Of the parts of a hot bucket: the smallest document of each context, and how many contexts there are.
    firsts = found.where("part > 0 and not whole")
    least = Stored(firsts.groupBy("g", "c").agg(F.min("doc").alias("least"), F.max("doc").alias("most")), "firsts").df
    sizes = least.groupBy(bucket().alias("of")).agg(F.count("*").alias("many"), F.min("least").alias("low"), F.max("most").alias("high"))
    firsts = firsts.drop("whole", "size").join(least.drop("most"), ["g", "c"]).join(F.broadcast(sizes), bucket() == F.col("of"))  # HOT at most
    firsts = firsts.withColumns({"whole": F.col("doc") > F.col("least"), "size": F.col("many")}).where("whole or low < high and size > 1")
    return found.where("part = 0 or whole").select(*columns).unionByName(firsts.select(*columns))


def gathered(texts: DataFrame, found: DataFrame, columns: list[str]) -> DataFrame:
    """Each row of doc, text (and what else texts has) with the list of what was found in it, null if nothing."""
    lists = found.groupBy("doc").agg(F.collect_list(F.struct(*columns)).alias("found"))
    return texts.join(lists.withColumnRenamed("doc", "of"), F.col("doc") == F.col("of"), "left").drop("of")


def looked_up(batch: pa.RecordBatch, length: int, keys: np.ndarray) -> Iterator[tuple[int, list[bytes], Anchors, np.ndarray, np.ndarray]]:
    """Groups of the batch's texts: the first's number, the texts, their anchors, which anchors were found, and where in
    the flattened lists they are."""
    lists = batch.column("found")
    many = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = lists.flatten()
    g, c = (flat.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("g", "c"))
    upto = np.concatenate(([0], np.cumsum(many)))
    texts = [t if n else None for t, n in zip(batch.column("text").to_pylist(), many.tolist(), strict=True)]
    for first, raws in chunked(texts):
        anchors = Anchors(raws, length, keys)
        own = slice(upto[first], upto[first + len(raws)])
        wanted = mixed(np.repeat(np.arange(len(raws)), many[first : first + len(raws)]), g[own], c[own])
        order = np.argsort(wanted, kind="stable")
        had = mixed(anchors.doc, anchors.g, anchors.c)
        place = np.searchsorted(wanted, had, sorter=order)
        place = order[np.minimum(place, len(order) - 1)] if len(order) else np.zeros(len(had), np.int64)
        same = (wanted[place] == had) & (c[own][place] == anchors.c) & (g[own][place] == anchors.g) if len(order) else np.zeros(len(had), bool)
        hit = np.flatnonzero(same)
        yield first, raws, anchors, hit, place[hit] + upto[first]


def contexts(texts: DataFrame, found: DataFrame, length: int, keys: np.ndarray) -> DataFrame:
    """doc, g, c, context, size of the anchors in `found`; low, high: the part of the context inside the text."""
    width, margin = 2 * length - GRAM, length - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc").to_numpy(zero_copy_only=False)
            sizes = batch.column("found").flatten().field("size").to_numpy(zero_copy_only=False)
            for first, _, anchors, hit, place in looked_up(batch, length, keys):
                once = np.unique(place, return_index=True)[1]
                hit, place = hit[once], place[once]
                at, doc = anchors.at[hit] - margin, anchors.doc[hit]
                text = anchors.bytes[at[:, None] + np.arange(width)].tobytes()
                low = np.maximum(0, anchors.start[doc] - at)
                high = np.minimum(width, anchors.stop[doc] - at)
                columns = [pa.array(x, pa.int64()) for x in (ids[first + doc], anchors.g[hit], anchors.c[hit], sizes[place], low, high)]
                columns.append(pa.array([text[i * width : (i + 1) * width] for i in range(len(hit))], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["doc", "g", "c", "size", "low", "high", "context"])

    schema = "doc long, g long, c long, size long, low long, high long, context binary"
    return gathered(texts, found, ["g", "c", "size"]).where("doc is not null").mapInArrow(run, schema)


def suffix_array(group: np.ndarray, text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and offsets of the sorted suffixes of all contexts (equal groups together; at least `length` bytes, the
    first of them inside the document), and the common prefix of each with the one before it, 0 between groups."""
    width = text.shape[1]
    inside = np.cumsum(np.pad(text != EDGE, ((0, 0), (1, 0))), axis=1)
    row, offset = np.nonzero(inside[:, length:] - inside[:, : width - length + 1] == length)
    if not len(row):
        return row, offset, row
    wide = np.pad(text, ((0, 0), (0, width)))
    tails = np.lib.stride_tricks.sliding_window_view(wide, width, axis=1)[row, offset]
    keys = np.concatenate((group[row].astype(">u4").view(np.uint8).reshape(-1, 4), tails), axis=1)
    order = np.argsort(keys.view(f"S{width + 4}").ravel(), kind="stable")
    row, offset, keys = row[order], offset[order], keys[order]
    differ = keys[1:] != keys[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width + 4) - 4
    room = width - offset
    return row, offset, np.concatenate(([0], np.maximum(0, np.minimum(common, np.minimum(room[1:], room[:-1])))))


def maximal_repeats(common: np.ndarray, left: np.ndarray, doc: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """First and last suffix, depth and smallest document of every interval that is at least `length` deep and whose
    suffixes have different bytes on their left. left: the byte, or a negative number where it isn't known."""
    deep = common >= length
    edges = np.flatnonzero(np.diff(np.concatenate(([False], deep, [False])).astype(np.int8)))
    for a, b in zip((edges[::2] - 1).tolist(), (edges[1::2] - 1).tolist(), strict=True):
        stack: list[list[int]] = []  # depth, first suffix, smallest document, byte on the left or -1 for several
        depths, lefts, docs = common[a : b + 1].tolist(), left[a : b + 1].tolist(), doc[a : b + 1].tolist()
        for i in range(b - a + 2):
            depth = depths[i] if 0 < i <= b - a else 0
            first, least, byte = i - 1, docs[i - 1], lefts[i - 1]
            if i == 0:
                continue
            while stack and stack[-1][0] > depth:
                top = stack.pop()
                least, byte = min(least, top[2]), byte if byte == top[3] and byte >= 0 else -1
                first = top[1]
                if byte < 0:
                    yield a + first, a + i - 1, top[0], least
            if stack and stack[-1][0] == depth:
                stack[-1][2:] = min(stack[-1][2], least), byte if byte == stack[-1][3] and byte >= 0 else -1
            elif depth:
                stack.append([depth, first, least, byte])


def marked(group: np.ndarray, text: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    """Which bytes of each context lie in a string that a context of the same group has in a smaller document."""
    width = text.shape[1]
    change = np.zeros((len(text), width + 1), np.int32)
    row, offset, common = suffix_array(group, text, length)
    if len(row):
        left = np.where((offset > 0) & (text[row, offset - 1] != EDGE), text[row, offset - 1].astype(np.int64), -1)
        of = doc[row]
        for first, last, depth, least in maximal_repeats(common, left, of, length):
            late = first + np.flatnonzero(of[first : last + 1] > least)
            np.add.at(change, (row[late], offset[late]), 1)
            np.add.at(change, (row[late], offset[late] + depth), -1)
    return (np.cumsum(change, axis=1)[:, :width] > 0) & (text != EDGE)


def marks(found: DataFrame, length: int) -> DataFrame:
    """doc, g, c, mask: for contexts, gathered by bucket, the bytes that a smaller document of the bucket repeats."""

    def done(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        if len(rows) > 1:
            group = np.unique(np.array([r["g"] >> 16 for r in rows]), return_inverse=True)[1]
            text = np.frombuffer(b"".join(r["context"] for r in rows), np.uint8).reshape(len(rows), -1)
            got = marked(group, text, np.array([r["doc"] for r in rows]), length)
            out = [(r["doc"], r["g"], r["c"], np.packbits(m).tobytes()) for r, m in zip(rows, got, strict=True) if m.any()]
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(("doc", "g", "c", "mask"), x, strict=True)) for x in out], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            held += batch.to_pylist()
            if len(held) >= BLOCK:
                last = held[-1]["g"] >> 16
                whole = [r for r in held if r["g"] >> 16 != last]
                held = held[len(whole) :]
                yield from done(whole)
        yield from done(held)

    schema = pa.schema([("doc", pa.int64()), ("g", pa.int64()), ("c", pa.int64()), ("mask", pa.binary())])
    return found.repartition(bucket()).sortWithinPartitions(bucket()).mapInArrow(run, "doc long, g long, c long, mask binary")


def blocks(length: int) -> list[tuple[int, int]]:
    """The strings of a context, by where they start, in runs of about as many as there are runs: first and last."""
    starts = length - GRAM + 1
    size = max(1, round(starts**0.5))
    return [(a, min(a + size, starts) - 1) for a in range(0, starts, size)]


def crowded_marks(found: DataFrame, length: int) -> DataFrame:
    """The same for buckets of any size: every string of the contexts with its smallest document.

    Strings that start in one block of places are settled together: what all of them cover (`full`), if a smaller document
    has it too, goes at once; what they have in common (the middle) is in two documents, or none of them is. Only of what
    is left are strings told one by one: the smallest document of each `full` always is among them, so nothing is missed.
    """
    width = 2 * length - GRAM
    salt = [F.lit(int.from_bytes(os.urandom(8), "big", signed=True)) for _ in range(2)]  # first, as they seed what follows

    def keyed_by(rows: DataFrame, first: str, stop: Column) -> DataFrame:
        part = F.substring(F.col("context"), F.col(first).cast("int") + 1, (stop - F.col(first)).cast("int"))
        return rows.withColumns({k: F.xxhash64(s, part) for s, k in zip(salt, "xy", strict=True)})

    def smallest(rows: DataFrame, *by: str) -> DataFrame:  # a table by itself, so that Spark can split the join
        least = rows.groupBy(*by).agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most")
        return Stored(least.drop("most"), "strings").df

    within = F.inline(F.array(*(F.struct(F.lit(a).cast("long").alias("first"), F.lit(b).cast("long").alias("last")) for a, b in blocks(length))))
    rows = found.select("doc", "g", "c", "context", "low", "high", bucket().alias("h"), within)
    rows = rows.withColumns({"start": F.greatest("first", "low"), "stop": F.least("last", F.col("high") - length)}).where("start <= stop")
    rows = keyed_by(rows, "last", F.col("first") + length)
    by = ["h", "first", "x", "y"]
    rows = rows.join(smallest(rows, *by).drop("least"), by, "left_semi")
    rows = Stored(keyed_by(rows, "first", F.col("last") + length), "blocks").df
    rows = Stored(rows.join(smallest(rows, *by), by, "left").withColumn("late", F.coalesce(F.col("doc") > F.col("least"), F.lit(False))), "blocks").df
    strings = rows.where("not late").select("doc", "g", "c", "context", "h", F.explode(F.sequence("start", "stop")).alias("s"))
    strings = keyed_by(strings, "s", F.col("s") + length).drop("context")
    by = ["h", "s", "x", "y"]
    single = strings.join(smallest(strings, *by), by).where("doc > least").select("doc", "g", "c", F.col("s").alias("start"), F.col("s").alias("stop"))
    late = rows.where("late").select("doc", "g", "c", "start", "stop").unionByName(single)
    late = late.groupBy("doc", "g", "c").agg(F.collect_list(F.struct("start", "stop")).alias("at"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for runs in batch.column("at").to_pylist():
                bits = np.zeros(width, bool)
                for r in runs:
                    bits[r["start"] : r["stop"] + length] = True
                out.append(np.packbits(bits).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.binary())], ["doc", "g", "c", "mask"])

    return late.mapInArrow(pack, "doc long, g long, c long, mask binary")


def removed(anchors: Anchors, hit: np.ndarray, masks: list[bytes | None], length: int) -> np.ndarray:
    """Which bytes go, given the anchors found and their masks; the whole context where there is none."""
    width = 2 * length - GRAM
    start = anchors.at[hit] - (length - GRAM)
    change = np.zeros(len(anchors.bytes) + 1, np.int32)
    whole = np.fromiter((m is None for m in masks), bool, len(masks))
    np.add.at(change, start[whole], 1)
    np.add.at(change, start[whole] + width, -1)
    part = np.flatnonzero(~whole)
    if len(part):
        packed = np.frombuffer(b"".join(masks[i] for i in part.tolist()), np.uint8).reshape(len(part), -1)
        row, bit = np.nonzero(np.unpackbits(packed, axis=1)[:, :width])
        np.add.at(change, start[part[row]] + bit, 1)
        np.add.at(change, start[part[row]] + bit + 1, -1)
    return np.cumsum(change)[:-1] > 0


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 50, crowded: int = CROWDED, keep_row: bool = False
) -> DataFrame:
    """A row for each row of docs: doc_id, n_bytes, kept (binary), spans (array of start, stop of the removed runs). With
    keep_row also kept_text, without what is left of a sign that lost part of its bytes, and row: the other columns."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    keys = drawn(length)
    found = Stored(shared_anchors(texts, length, keys), "anchors").df
    split = Stored(contexts(texts, found.where("not whole"), length, keys), "contexts")
    masks = marks(split.df.where(F.col("size") <= crowded).select("doc", "g", "c", "context"), length)
    masks = Stored(masks.unionByName(crowded_marks(split.df.where(F.col("size") > crowded), length)), "masks").df
    split.drop()
    whole = found.where("whole").select("doc", "g", "c", F.lit(None).cast("binary").alias("mask"))
    rows = texts
    kinds = {"doc": "bigint", "n_bytes": "bigint", "kept": "binary", "spans": "array<struct<start:bigint,stop:bigint>>"}
    schema = T.StructType([T.StructField(n, T.DataType.fromDDL(k)) for n, k in kinds.items()])
    if keep_row:
        others = [F.col(f"`{c}`") for c in docs.columns if c != text]
        rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"), F.struct(*others).alias("row"))
        schema.add("kept_text", "string").add(rows.schema["row"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = batch.column("found").flatten().field("mask").to_pylist()
            had, raw = batch.column("found").is_valid().to_pylist(), batch.column("text").to_pylist()
            many, kept, spans, left = [], [], [], []
            for first, raws, anchors, hit, place in looked_up(batch, length, keys):
                gone = removed(anchors, hit, [masks[i] for i in place.tolist()], length)
                for i in range(len(raws)):
                    own = (raw[first + i] or "").encode()
                    lost = gone[anchors.start[i] : anchors.stop[i]] if had[first + i] else np.zeros(0, bool)
                    edges = np.flatnonzero(np.diff(np.concatenate(([False], lost, [False])).astype(np.int8))).tolist()
                    parts = [own[a:b] for a, b in zip([0, *edges[1::2]], [*edges[::2], len(own)], strict=True)] if edges else [own]
                    many.append(len(own))
                    kept.append(b"".join(parts))
                    spans.append([{"start": a, "stop": b} for a, b in zip(edges[::2], edges[1::2], strict=True)])
                    left.append("".join(p.decode("utf-8", "ignore") for p in parts) if edges else raw[first + i])
            columns = [batch.column("doc"), pa.array(many, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, span)]
            if keep_row:
                columns += [pa.array(left, pa.string()), batch.column("row")]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    out = gathered(rows, whole.unionByName(masks), ["g", "c", "mask"])
    return out.select(*rows.columns, "found").mapInArrow(run, schema).withColumnRenamed("doc", doc_id)

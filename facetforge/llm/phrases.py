"""Collocations by PrefixSpan over contiguous words.

1. Texts become chunks: the codes of their words and, once a chunk, the words. Words are known by 64-bit hashes that their
   language seeds. What each word counts in all chunks leaves a table of bits of fixed size; a word that isn't in it is
   rarer than `least` (the reverse isn't promised), and no phrase with it is frequent, so windows end before it.
2. A chunk projects its occurrences: a pointer to each word, as the window of at most `longest` words there, equal windows
   once with their number. Windows of one prefix (the first word) are one row, and rows of one prefix meet in one task.
3. The task grows the prefix to the right, depth first: the pointers of a prefix are ordered by the next word, each run of
   them that is frequent is a longer prefix with the run as its pointers.

A prefix that a sample of the chunks shows to hold 1/HOT of all windows or more (so there are at most HOT of each length)
gets several tasks: its windows are dealt out by the next word into parts in proportion to its share, but for those of a
longer prefix that is hot as well; its own number is summed apart. A task whose prefix has more than `most` different
windows hands them on by the next word, as prefixes one word longer, to one more round; so no group is held whole, whatever
its size. Both deal out work only, results are the same.

4. Cuts, scores and the dropping of parts of longer phrases are joins and aggregates over the frequent phrases; products
   are decimals of 38 digits.

Two words of a language that share a hash are seen, as the rows of a prefix carry its word; then all is done again with
another seed. Defined cases: a null text is empty, a null language `und`; ids don't matter, so null or repeated ones count
like others, and repeated rows count each time; words may hold any characters but the separators; texts of any length are
read whole, a megabyte at a time; ties are settled as the contract says; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetforge.llm.common import Stored

#: Ends of pieces, as bytes of a text whose A-Z are lower case; a dot stands for any run of them, and is no word.
ENDS, END = re.compile(rb"[.,;:!?\n-\r]+"), b"."
BREAK = re.compile(rb"[ \t.,;:!?\n-\r]")
#: Words of a chunk, about; bytes of a text that are split at once.
CHUNK, SLICE = 1 << 20, 1 << 20
#: Bits of the table of frequent words, and bytes of it in one row.
BITS, ROW = 1 << 26, 1 << 10
#: Prefixes of one length that may be dealt out by longer ones, at most; one chunk in SHARE shows them.
HOT, SHARE = 4096, 8
#: Different windows of one prefix that a task holds, about.
MOST = 1 << 21


class Vocabulary(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return len(self) - 1


def slices(raw: bytes, most: int = SLICE) -> Iterator[bytes]:
    """The text in parts of about `most` bytes, cut before a separator."""
    at = 0
    while len(raw) - at > most:
        cut = BREAK.search(raw, at + most)
        if not cut:
            break
        yield raw[at : cut.start()]
        at = cut.start()
    yield raw[at:] if at else raw


class Buffer:
    """The words of a language's texts since the last chunk; 0 is the end of a piece."""

    def __init__(self):
        self.words, self.codes, self.size = Vocabulary({END: 0}), [], 0

    def add(self, words: list[bytes]) -> None:
        self.codes.append(np.fromiter(map(self.words.__getitem__, words), np.uint32, len(words)))
        self.size += len(words)

    def flushed(self, lang: str, last: bool) -> Iterator[dict]:
        """The chunk up to the end of the last piece that ended; what comes after stays."""
        codes = np.concatenate(self.codes) if self.codes else np.zeros(0, np.uint32)
        upto = len(codes) if last else int(np.flatnonzero(codes == 0)[-1]) + 1 if (codes == 0).any() else 0
        if not upto:
            self.codes = [codes] if len(codes) else []
            return
        names = list(self.words)
        yield {
            "chunk": uuid.uuid4().int >> 65, "lang": lang, "n_words": int(np.count_nonzero(codes[:upto])),
            "words": zstandard.compress(b"\n".join(names), 1), "codes": zstandard.compress(codes[:upto].tobytes(), 1),
        }
        rest = [names[c] for c in codes[upto:].tolist()]
        self.__init__()
        if rest:
            self.add(rest)


def chunks(docs: DataFrame, lang: str = "lang", text: str = "text", size: int = CHUNK) -> DataFrame:
    """chunk, lang, n_words, words (joined by line ends, none of which is in a word), codes: both compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Buffer] = {}
        total = 0
        for batch in batches:
            for name, value in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = held.setdefault(name, Buffer())
                for part in slices((value or "").encode().lower()):  # of bytes: A-Z only
                    found = ENDS.sub(b" . ", part).split()
                    own.add(found)
                    total += len(found)
                    if own.size >= size or total >= 4 * size:  # of many languages the largest goes
                        key = name if own.size >= size else max(held, key=lambda k: held[k].size)
                        yield from batched(held[key].flushed(key, False))
                        total = sum(b.size for b in held.values())
                own.add([END])
        for key, b in held.items():
            yield from batched(b.flushed(key, True))

    def batched(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        for row in rows:
            yield pa.RecordBatch.from_pylist([row], schema)

    schema = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("n_words", pa.int64()), ("words", pa.binary()), ("codes", pa.binary())])
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "chunk long, lang string, n_words long, words binary, codes binary")


class Chunk:
    def __init__(self, row: dict, seed: int):
        self.lang = row["lang"]
        self.words = zstandard.decompress(row["words"]).split(b"\n")
        self.codes = np.frombuffer(zstandard.decompress(row["codes"]), np.uint32).astype(np.int64)
        salt = (xxhash.xxh3_64_intdigest(self.lang) + seed) & (1 << 64) - 1
        self.hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, salt) for w in self.words), np.uint64, len(self.words)).view(np.int64)
        self.hashes[0] = 0


def each_chunk(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[Chunk]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Chunk(batch.slice(i, 1).to_pylist()[0], seed)


def slot(hashes: np.ndarray) -> np.ndarray:
    return hashes & (BITS - 1)


def frequent_bits(parts: DataFrame, least: int, seed: int) -> np.ndarray:
    """A byte for eight slots: whether a word there may be frequent."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in each_chunk(batches, seed):
            n = np.bincount(c.codes, minlength=len(c.words))[1:]
            yield pa.RecordBatch.from_arrays([pa.array(c.hashes[1:]), pa.array(n.astype(np.int64))], ["word", "n"])

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, np.ndarray] = {}
        for batch in batches:
            at = slot(batch.column("word").to_numpy(zero_copy_only=False))
            for row in np.unique(at // (8 * ROW)).tolist():
                bits = rows.setdefault(row, np.zeros(8 * ROW, bool))
                bits[at[at // (8 * ROW) == row] % (8 * ROW)] = True
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int64()), pa.array([np.packbits(b).tobytes() for b in rows.values()], pa.binary())], ["row", "bits"])

    many = parts.select("lang", "words", "codes").mapInArrow(counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    row = F.shiftright(F.col("word").bitwiseAND(F.lit(BITS - 1)), (8 * ROW).bit_length() - 1)
    table = np.zeros((BITS // (8 * ROW), ROW), np.uint8)
    for r in many.select("word").repartition(row).mapInArrow(set_bits, "row long, bits binary").toLocalIterator():  # BITS / 8 bytes in all
        table[r.row] |= np.frombuffer(r.bits, np.uint8)
    return table.ravel()


def windows(c: Chunk, bits: np.ndarray, longest: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The different windows of the chunk's frequent words, in order, as a column of codes for each place; and how often each
    is there. A window ends with its piece, or before a word that isn't frequent: 0 from there on."""
    at = slot(c.hashes)
    known = ((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)
    known[0] = False
    place = np.cumsum(known) * known  # frequent words numbered from 1
    codes, names = place[c.codes], np.concatenate(([0], np.flatnonzero(known)))
    padded = np.concatenate((codes, np.zeros(longest - 1, np.int64)))
    columns = [padded[k : k + len(codes)][codes > 0] for k in range(longest)]
    for k in range(1, longest):
        columns[k] = np.where(columns[k - 1] > 0, columns[k], 0)
    width = len(names).bit_length()
    if width * longest < 64:  # all places in one number
        one = columns[0]
        for x in columns[1:]:
            one = one << width | x
        one, n = np.unique(one, return_counts=True)
        return [names[one >> width * (longest - 1 - k) & (1 << width) - 1] for k in range(longest)], n
    order = np.lexsort(columns[::-1])
    columns = [x[order] for x in columns]
    first = runs(columns)
    return [names[x[first]] for x in columns], np.diff(np.append(first, len(order)))


def runs(columns: list[np.ndarray]) -> np.ndarray:
    """Where runs of equal rows begin."""
    new = np.ones(len(columns[0]), bool)
    for i, x in enumerate(columns):
        new[1:] = (x[1:] != x[:-1]) | (new[1:] if i else False)
    return np.flatnonzero(new)


def keys(hashes: list[np.ndarray]) -> list[bytes]:
    """Prefixes as bytes: eight for each word."""
    flat, width = np.ascontiguousarray(np.stack(hashes, axis=1)).tobytes(), 8 * len(hashes)
    return [flat[i : i + width] for i in range(0, len(flat), width)]


def hot_prefixes(parts: DataFrame, bits: np.ndarray, longest: int, seed: int, hot: int, share: int) -> dict[bytes, int]:
    """Prefixes, up to a word short of the longest phrase, with 1/hot of the windows of the sampled chunks or more; and in
    how many parts each is dealt out."""
    handed = parts.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in each_chunk(batches, seed):
            columns, n = windows(c, handed.value, longest)
            if len(n):
                yield pa.RecordBatch.from_arrays([pa.array([b""], pa.binary()), pa.array([len(n)], pa.int64())], ["prefix", "n"])
                for d in range(1, longest):
                    start = runs(columns[:d])
                    many = np.diff(np.append(start, len(n)))
                    some = (many >= 8) & (columns[d - 1][start] != 0)
                    start, many = start[some], many[some]
                    yield pa.RecordBatch.from_arrays([pa.array(keys([c.hashes[x[start]] for x in columns[:d]]), pa.binary()), pa.array(many, pa.int64())], ["prefix", "n"])

    few = parts.where(F.pmod("chunk", F.lit(share)) == 0)
    counts = few.select("lang", "words", "codes").mapInArrow(run, "prefix binary, n long").groupBy("prefix").agg(F.sum("n").alias("n"))
    counts = Stored(counts, "prefixes")
    whole = counts.df.where(F.length("prefix") == 0).first()
    many = counts.df.where((F.length("prefix") > 0) & (F.col("n") >= -(-whole.n // hot))).collect() if whole else []  # at most `hot` of each length
    found = {bytes(r.prefix): -(-r.n * hot // whole.n) for r in many}
    counts.drop()
    return found


#: depth: words of the prefix, or 0 for a frequent phrase and -1 for two words of one hash; prefix: their hashes; part: 0 for
#: all windows of the prefix (or its number alone), or one of the parts of a hot one; word: of a prefix of one word; n:
#: occurrences; rest: the windows after the prefix, column by column, and their numbers.
ROWS = pa.schema([("depth", pa.int32()), ("prefix", pa.binary()), ("part", pa.int32()), ("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64()), ("rest", pa.binary())])
KINDS = "depth int, prefix binary, part int, lang string, word binary, n long, rest binary"


def unblob(raw: bytes, columns: int) -> np.ndarray:
    """A row for each place after the prefix, and one for the numbers."""
    return np.frombuffer(raw, np.int64).reshape(columns + 1, -1)


def projected(parts: DataFrame, bits: np.ndarray, hot: dict[bytes, int], longest: int, seed: int) -> DataFrame:
    """The windows of every chunk by their prefixes, as ROWS."""
    handed = parts.sparkSession.sparkContext.broadcast((bits, hot))  # of fixed size, and at most HOT of each length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, hot = handed.value
        for c in each_chunk(batches, seed):
            columns, n = windows(c, bits, longest)
            places = [c.hashes[x] for x in columns]
            stay = np.arange(len(n))  # windows whose prefix of d - 1 words is hot, or all
            for d in range(1, longest):
                if not len(stay):
                    break
                own = [x[stay] for x in places]
                start = runs(own[:d])
                size = np.diff(np.append(start, len(stay)))
                names = keys([x[start] for x in own[:d]])
                shares = np.fromiter((hot.get(k, 0) for k in names), np.int64, len(names))
                share = np.repeat(shares, size)
                if d == 1:  # all windows of a prefix that isn't hot, with its word
                    yield from made(c, d, places, n, np.flatnonzero(share == 0), np.zeros(len(n), np.int64), columns[0])
                else:  # the windows of a hot prefix a word shorter that no longer hot one takes
                    left = stay[(share == 0) & (own[d - 1] != 0)]
                    yield from made(c, d - 1, places, n, left, part_of(places[d - 1], before), None)
                # Of hot prefixes the numbers alone.
                at = start[shares > 0]
                total = np.add.reduceat(n[stay], start)[shares > 0] if len(start) else n[:0]
                words = [c.words[x] if d == 1 else None for x in columns[0][stay[at]].tolist()]
                yield from rows([(d, k, 0, c.lang, w, m, b"") for k, w, m in zip([names[i] for i in np.flatnonzero(shares > 0)], words, total.tolist(), strict=True)])
                stay = stay[share > 0]
                before = np.zeros(len(n), np.int64)
                before[stay] = share[share > 0]
            else:
                stay = stay[places[longest - 1][stay] != 0]
                yield from made(c, longest - 1, places, n, stay, part_of(places[longest - 1], before), None)

    def part_of(follow: np.ndarray, many: np.ndarray) -> np.ndarray:
        return 1 + (follow >> 9) % np.maximum(many, 1)

    def made(c: Chunk, d: int, places: list[np.ndarray], n: np.ndarray, at: np.ndarray, part: np.ndarray, words: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        """A row for each prefix of d words and part of the windows `at`."""
        if not len(at):
            return
        if words is None:
            first = np.cumsum(np.bincount(runs([x[at] for x in places[:d]]), minlength=len(at)))  # the prefix of each, numbered
            at = at[np.lexsort((part[at], first))]
        own = [x[at] for x in places]
        start = runs([*own[:d], part[at]])
        stop = np.append(start[1:], len(at))
        total = np.add.reduceat(n[at], start).tolist()
        names, rest = keys([x[start] for x in own[:d]]), np.stack([*own[d:], n[at]])
        codes = words[at[start]].tolist() if words is not None else [None] * len(start)
        which = part[at[start]].tolist()
        yield from rows([(d, k, p, c.lang, None if w is None else c.words[w], m, rest[:, a:b].tobytes()) for k, p, w, m, a, b in zip(names, which, codes, total, start.tolist(), stop.tolist(), strict=True)])

    def rows(out: list[tuple]) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(out), 8192):
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out[i : i + 8192]), ROWS, strict=True)], schema=ROWS)

    return parts.select("lang", "words", "codes").mapInArrow(run, KINDS)


def extended(prefix: bytes, columns: np.ndarray, pointers: np.ndarray, least: int) -> Iterator[tuple[bytes, int]]:
    """All frequent phrases that begin with the prefix, and how often each is there, depth first. columns: the places after
    the prefix, then the windows' numbers; pointers: the windows that have the prefix."""
    if len(columns) == 1 or not len(pointers):
        return
    head = columns[0][pointers]
    order = np.argsort(head, kind="stable")
    head, pointers = head[order], pointers[order]
    start = np.flatnonzero(np.concatenate(([True], head[1:] != head[:-1])))
    total = np.add.reduceat(columns[-1][pointers], start)
    stop = np.append(start[1:], len(head))
    for i in np.flatnonzero((total >= least) & (head[start] != 0)).tolist():
        longer = prefix + head[start[i]].tobytes()
        yield longer, int(total[i])
        yield from extended(longer, columns[1:], pointers[start[i] : stop[i]], least)


def merged(held: list[np.ndarray]) -> np.ndarray:
    """Equal windows once."""
    every = np.concatenate(held, axis=1)
    order = np.lexsort(every[-2::-1]) if len(every) > 1 else np.arange(every.shape[1])
    every = every[:, order]
    start = runs(list(every[:-1])) if len(every) > 1 else np.zeros(min(1, every.shape[1]), np.int64)
    return np.concatenate((every[:-1, start], np.add.reduceat(every[-1:], start, axis=1)), axis=0) if len(start) else every


def grown(rows: DataFrame, longest: int, least: int, most: int) -> DataFrame:
    """ROWS: the frequent phrases of each prefix (depth 0), and what goes to another round."""

    def group(rows: Iterator[dict]) -> Iterator[tuple]:
        first, held, size, n, passing = None, [], 0, 0, False
        for row in rows:
            if first is None:
                first = row
            d, n = row["depth"], n + row["n"]
            if row["word"] is not None and row["word"] != first["word"]:
                yield (-1, row["prefix"], 0, None, row["word"], 0, b"")
            if not row["rest"]:
                continue
            block = unblob(row["rest"], longest - d)
            if not passing:
                held.append(block)
                size += block.shape[1]
                if size > most:
                    held = [merged(held)]
                    size = held[0].shape[1]
                    passing = size > most // 2 and d < longest
            if passing:
                for block in held or [block]:
                    yield from deeper(first, block)
                held = []
        if first is None:
            return
        if n >= least:
            if not first["part"]:
                yield (0, first["prefix"], 0, first["lang"], first["word"], n, b"")
            if held and not passing:
                block = np.concatenate(held, axis=1)
                for prefix, m in extended(first["prefix"], block, np.arange(block.shape[1]), least):
                    yield (0, prefix, 0, first["lang"], None, m, b"")

    def deeper(first: dict, block: np.ndarray) -> Iterator[tuple]:
        block = block[:, np.argsort(block[0], kind="stable")]
        block = block[:, block[0] != 0]
        if block.shape[1]:
            start = runs([block[0]])
            for a, b in zip(start.tolist(), np.append(start[1:], block.shape[1]).tolist(), strict=True):
                yield (first["depth"] + 1, first["prefix"] + block[0, a].tobytes(), 0, first["lang"], None, int(block[-1, a:b].sum()), block[1:, a:b].tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (row for batch in batches for i in range(0, batch.num_rows, 64) for row in batch.slice(i, 64).to_pylist())
        out, nbytes, row = [], 0, next(stream, None)

        def same(prefix: bytes, part: int) -> Iterator[dict]:
            nonlocal row
            while row is not None and row["prefix"] == prefix and row["part"] == part:
                yield row
                row = next(stream, None)

        while row is not None:
            for made in group(same(row["prefix"], row["part"])):
                out.append(made)
                nbytes += len(made[-1])
                if len(out) >= 8192 or nbytes >= 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), ROWS, strict=True)], schema=ROWS)
                    out, nbytes = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), ROWS, strict=True)], schema=ROWS)

    return rows.repartition("prefix", "part").sortWithinPartitions("prefix", "part").mapInArrow(run, KINDS)


def counted(parts: DataFrame, longest: int, least: int, most: int, hot: int, share: int, seed: int) -> DataFrame | None:
    """prefix, lang, word, n: every frequent phrase of 1 to `longest` words; None if two words share a hash."""
    bits = frequent_bits(parts, least, seed)
    rows = projected(parts, bits, hot_prefixes(parts, bits, longest, seed, hot, share), longest, seed)
    found = None
    while True:
        made = Stored(grown(rows, longest, least, most), "grown").df
        if not made.where("depth < 0").isEmpty():
            return None
        own = made.where("depth = 0").select("prefix", "lang", F.col("word").cast("string").alias("word"), "n")
        found = own if found is None else found.unionByName(own)
        rows = made.where("depth > 0")
        if rows.isEmpty():
            return found


def part(first: Column, size: Column) -> Column:
    """So many words of a prefix, from the first (counted from 0)."""
    return F.substring("prefix", first * 8 + 1, size * 8)


def scored(phrases: DataFrame, longest: int) -> DataFrame:
    """prefix, lang, a, l, r, score of the phrases of two words or more, by their lowest-scoring cut."""
    several = phrases.where(F.length("prefix") > 8).select("prefix", "lang", F.col("n").alias("a"), (F.length("prefix") / 8).cast("int").alias("size"))
    cuts = several.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    sides = F.array(F.struct(F.lit(0).alias("side"), part(F.lit(0), F.col("k")).alias("of")), F.struct(F.lit(1).alias("side"), part(F.col("k"), F.col("size") - F.col("k")).alias("of")))
    met = cuts.select("prefix", "lang", "a", "k", F.inline(sides)).join(phrases.select(F.col("prefix").alias("of"), "n"), "of")
    side = lambda k, s: F.max(F.when((F.col("k") == k) & (F.col("side") == s), F.col("n"))).alias(f"{'lr'[s]}{k}")
    rows = met.groupBy("prefix", "lang", "a").agg(*(side(k, s) for k in range(1, longest) for s in (0, 1)))
    ratio = "cast(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0)) div (cast(l{0} as decimal(20,0)) + cast(r{0} as decimal(20,0))) as long)"
    # A cut that the phrase is too short for is null, and an array's least element is never null if another isn't.
    each = [F.when(F.col(f"l{k}").isNotNull(), F.struct(F.expr(ratio.format(k)).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, longest)]
    return rows.select("prefix", "lang", "a", F.array_min(F.array(*each)).alias("best")).select("prefix", "lang", "a", "best.score", "best.l", "best.r")


def covered(phrases: DataFrame, longest: int) -> DataFrame:
    """part, longer: the largest number of a frequent phrase that holds each shorter one of two words or more."""
    wide = phrases.where(F.length("prefix") > 16)
    spans = F.array(*(F.struct(F.lit(a).alias("first"), F.lit(m).alias("size")) for m in range(2, longest) for a in range(longest - m + 1)))
    inside = wide.select("prefix", "n", F.inline(spans)).where((F.col("first") + F.col("size")) * 8 <= F.length("prefix")).where(F.col("size") * 8 < F.length("prefix"))
    return inside.select(part(F.col("first"), F.col("size")).alias("part"), "n").groupBy("part").agg(F.max("n").alias("longer"))


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = 4, least: int = 30, top: int = 2000, size: int = CHUNK, most: int = MOST, hot: int = HOT, share: int = SHARE
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of each language the first `top` phrases."""
    parts = Stored(chunks(docs, lang, text, size), "chunks").df
    found = None
    for seed in range(64):
        found = counted(parts, longest, least, most, hot, share, seed)
        if found is not None:
            break
    if found is None:
        raise RuntimeError("no seed gives different words different hashes")
    whole = parts.groupBy("lang").agg(F.sum("n_words").alias("n"))
    longer = covered(found, longest)
    rows = scored(found, longest).join(longer, F.col("prefix") == F.col("part"), "left")
    wide = lambda c, k: F.col(c).cast("decimal(20,0)") * F.lit(k)
    rows = rows.where(F.coalesce(wide("longer", 100) < wide("a", 80), F.lit(True))).select("prefix", "lang", "a", "l", "r", "score")
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = rows.withColumn("place", F.rank().over(first)).where(F.col("place") <= top)
    words = best.select("prefix", F.posexplode(F.sequence(F.lit(0), (F.length("prefix") / 8).cast("int") - 1)).alias("at", "i"))
    words = words.select("prefix", "at", part(F.col("i"), F.lit(1)).alias("one"))
    words = words.join(found.where("word is not null").select(F.col("prefix").alias("one"), "word"), "one")
    named = words.groupBy("prefix").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w")).select("prefix", F.array_join("w.word", " ").alias("phrase"))
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.join(named, "prefix").withColumn("rank", F.row_number().over(last).cast("long")).where(F.col("rank") <= top)
    return ranked.join(whole, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

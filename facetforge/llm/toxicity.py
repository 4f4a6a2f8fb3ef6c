"""Toxicity by a support vector machine over a subsequence string kernel with Nystrom landmarks.

The kernel compares words by the subsequences of three letters that they share, each weighted by a decay to the power of
the length it spans; it needs no contiguous match, so letters left out, put in or replaced cost little. Words are read
after compatibility forms, accents, signs and digits are taken off and single letters in a row are joined.

Landmarks are words that labelled toxic documents have and the others don't, and ordinary words. A word's kernel values on
the landmarks, whitened by the landmarks' own kernel matrix, are its features. A sentence is as toxic as its worst word and
a document as its worst sentence, so a document is read as the set of its words: labels are of documents, and no label says
which sentence is meant. The machine is fitted on words chosen so: the worst word of a toxic document stands for it, the
words of clean documents for the others, and both are chosen again as the machine improves. Weights on landmarks are
carried over to subsequences, so a word is scored by adding up its own.

Defined cases: a null or empty text, or one without words of three letters, has the lowest score, 1 / (1 + e^30); repeated
rows are scored each, but teach once (the smallest text of an id); of several labels of an id the largest counts; labels
that are null or of no document teach nothing; without labels of both kinds every score is 0; columns of the documents are
kept, but for those named as the operator's own (toxicity_score, toxicity_word), which are replaced; an empty table gives
an empty result. Texts are scored whole; long words in overlapping parts.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetforge.llm.common import fitted, packed, tuned, unpacked, with_row

#: Toxic documents that are learned from, and twice as many clean ones, at most: the first in the order of their ids'
#: hashes; and the most signs of one that is learned from.
SAMPLE, LARGEST = 3_000, 200_000
DECAY, SPAN, SIGNS = 0.6, 6, 27
LONGEST, STEP = 24, 12
TOXIC_LANDMARKS, PLAIN_LANDMARKS = 160, 96
#: Words whose scores a worker remembers.
ROOM = 300_000
#: Signs beyond the table of letters; their compatibility forms are mostly in it.
BEYOND = re.compile("[\U00010000-\U0010ffff]")
#: A letter beyond the basic alphabet, and what isn't a letter.
OTHER, DROP = 26, 255
GAPS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """The sign of each code point below 0x10000 after accents are taken off."""
    table = np.full(0x10000, DROP, np.uint8)
    for c in range(0x10000):
        base = unicodedata.normalize("NFKD", chr(c))[:1].lower()
        if base.isalpha():
            table[c] = ord(base) - 97 if "a" <= base <= "z" else OTHER
    return table


def signs_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The signs of all words' parts, LONGEST a row, DROP beyond their ends; and the word of each row."""
    table, rows, of = letters(), [], []
    joined = np.frombuffer(" ".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    mapped = np.where(joined < 0x10000, table[np.minimum(joined, 0xFFFF)], DROP)
    size = np.fromiter(map(len, words), np.int64, len(words))
    word = np.repeat(np.arange(len(words)), size)
    at = np.arange(len(word)) + word  # without the blanks between
    signs = mapped[at]
    word, signs = word[signs != DROP], signs[signs != DROP]
    count = np.bincount(word, minlength=len(words))
    place = np.arange(len(word)) - (np.cumsum(count) - count)[word]
    short = count <= LONGEST
    row_of = np.cumsum(short) - 1
    table_rows = np.full((int(short.sum()), LONGEST), DROP, np.uint8)
    fits = short[word]
    table_rows[row_of[word[fits]], place[fits]] = signs[fits]
    rows.append(table_rows)
    of.append(np.flatnonzero(short))
    start = np.cumsum(count) - count
    for i in np.flatnonzero(~short).tolist():
        own = signs[start[i] : start[i] + count[i]]
        for a in range(0, len(own) - STEP, STEP):
            part = own[a : a + LONGEST]
            rows.append(np.pad(part, (0, LONGEST - len(part)), constant_values=DROP)[None])
            of.append(np.array([i]))
    return np.concatenate(rows), np.concatenate(of)


def subsequences(signs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each shape of three letters in SPAN places: their numbers in each row, which of them count, and the weight."""
    wide = signs.astype(np.int64)
    for i, j in GAPS:
        a, b, c = wide[:, : LONGEST - j], wide[:, i : LONGEST - j + i], wide[:, j:]
        there = (a != DROP) & (b != DROP) & (c != DROP)
        yield np.where(there, (a * SIGNS + b) * SIGNS + c, 0), there, DECAY ** (j + 1)


def norms(signs: np.ndarray) -> np.ndarray:
    return np.sqrt(sum(there.sum(axis=1) * w * w for _, there, w in subsequences(signs)) + 1e-12)


def embedded(signs: np.ndarray) -> np.ndarray:
    """Normalised weights of all subsequences, a row for each row of signs. For the landmarks only."""
    out = np.zeros((len(signs), SIGNS**3), np.float32)
    rows = np.arange(len(signs))[:, None]
    for at, there, w in subsequences(signs):
        np.add.at(out, (np.broadcast_to(rows, at.shape)[there], at[there]), w)
    return out / norms(signs)[:, None].astype(np.float32)


def features(words: list[str], lift: np.ndarray) -> np.ndarray:
    """The features of each word's parts."""
    signs, _ = signs_of(words)
    out = np.zeros((len(signs), lift.shape[1]), np.float32)
    for k in range(0, len(signs), 200):
        for at, there, w in subsequences(signs[k : k + 200]):
            out[k : k + 200] += w * np.einsum("ijk,ij->ik", lift[at], there.astype(np.float32))
    return out / norms(signs)[:, None].astype(np.float32)


def scores(words: list[str], weights: np.ndarray) -> np.ndarray:
    """The machine's value of each word without its intercept; -inf where the word has no subsequence."""
    out = np.full(len(words), -np.inf)
    for k in range(0, len(words), 8192):
        signs, of = signs_of(words[k : k + 8192])
        total, any_there = np.zeros(len(signs)), np.zeros(len(signs), bool)
        for at, there, w in subsequences(signs):
            total += w * np.where(there, weights[at], 0).sum(axis=1)
            any_there |= there.any(axis=1)
        value = np.where(any_there, total / norms(signs), -np.inf)
        np.maximum.at(out, of + k, value)
    return out


def words_of(text: str) -> set[str]:
    """The words of a text; three or more single letters in a row are one word too."""
    if BEYOND.search(text):
        text = unicodedata.normalize("NFKC", text)
    words = text.lower().split()
    found = set(words)
    alone = [i for i, w in enumerate(words) if len(w) < 3 and sum(map(str.isalnum, w)) == 1]
    at = 0
    while at < len(alone):
        stop = at + 1
        while stop < len(alone) and alone[stop] == alone[stop - 1] + 1:
            stop += 1
        if stop - at > 2:
            found.add("".join(words[alone[at] : alone[stop - 1] + 1]))
        at = stop
    return found


class Model:
    """Weights of subsequences, an intercept, and the slope and shift that make a value a probability."""

    def __init__(self, weights: np.ndarray, slope: float, shift: float):
        self.weights, self.slope, self.shift = weights, slope, shift

    def probability(self, value: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * value + self.shift))))


def machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1e-3, rounds: int = 300) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, by accelerated gradient steps. y: 1 or -1; cost: weight of each row."""
    x1 = np.column_stack((x, np.ones(len(x))))
    cost = cost / cost.sum()
    reach = 2 * np.linalg.norm(x1 * np.sqrt(cost)[:, None], 2) ** 2 + ridge
    w = np.zeros(x1.shape[1])
    ahead, t = w.copy(), 1.0
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (x1 @ ahead))
        grad = -2 * x1.T @ (cost * slack * y) + ridge * np.append(ahead[:-1], 0)
        new = ahead - grad / reach
        t2 = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return w[:-1], float(w[-1])


def numbered(bags: Iterable[Iterable[str]]) -> tuple[list[str], list[np.ndarray]]:
    """All words in order, and the numbers of each bag's: a set of strings takes many times their room."""
    index: dict[str, int] = {}
    rows = [np.fromiter({index.setdefault(w, len(index)) for w in bag}, np.int32) for bag in bags]
    every = sorted(index)
    place = np.empty(len(every), np.int32)
    place[[index[w] for w in every]] = np.arange(len(every))
    return every, [np.sort(place[row]) for row in rows]


def highest(words: np.ndarray, value: np.ndarray) -> int:
    """The word with the highest value, of equals the last in order."""
    own = value[words]
    return int(words[np.flatnonzero(own == own.max())[-1]])


def train(bags: Iterable[Iterable[str]], toxic: np.ndarray, rounds: int = 3) -> Model:
    """bags: the words of each labelled document."""
    if len(toxic) == 0 or toxic.all() or not toxic.any():
        return Model(np.zeros(SIGNS**3, np.float32), 0.0, -30.0)
    every, held = numbered(bags)
    counts = (np.bincount(np.concatenate([b for b, t in zip(held, toxic, strict=True) if t == own]), minlength=len(every)).tolist() for own in (True, False))
    bad, plain = (Counter({w: k for w, k in zip(every, count, strict=True) if k and len(w) > 2}) for count in counts)
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    odds = {w: math.log((k + 0.01) / (n1 + 1)) - math.log((plain[w] + 0.01 * n0 / n1 + 0.01) / (n0 + 1)) + math.log(k + 1) for w, k in bad.items()}
    first = [w for w in sorted(odds, key=lambda w: (-odds[w], w)) if plain[w] == 0 or odds[w] > 3][:TOXIC_LANDMARKS]
    # Labels err, so a word of toxic documents may stand in a few clean ones: it is told by how much more often it is in toxic ones.
    ill = {w for w, k in bad.items() if plain[w] == 0 or math.log((k + 0.5) / (n1 + 1)) - math.log((plain[w] + 0.5) / (n0 + 1)) > 3}
    usual = [w for w, _ in sorted(plain.items(), key=lambda x: (-x[1], x[0])) if w not in ill]
    landmarks = first + usual[:: max(1, min(len(usual), 4000) // PLAIN_LANDMARKS)][:PLAIN_LANDMARKS]
    signs, of = signs_of(landmarks)
    signs = signs[norms(signs) > 1e-5]
    base = embedded(signs)
    kernel = base @ base.T
    value, vector = np.linalg.eigh(kernel.astype(float))
    keep = value > 1e-4
    white = (vector[:, keep] / np.sqrt(value[keep])).astype(np.float32)  # features: k(word, landmarks) @ white
    lift = base.T @ white  # the same from subsequences
    del base  # as large as lift
    in_plain = np.array([plain[w] > 0 and w not in ill for w in every])
    known = sorted(w for w in ill if bad[w] * 40 >= n1 and bad[w] > 2)  # 1 in 40, more than a group of copies makes
    odd, toxic_bags = np.array([odds.get(w, -9) for w in every]), [b for b, t in zip(held, toxic, strict=True) if t and len(b)]
    rare = [every[i] for i in sorted({highest(b, odd) for b in toxic_bags}) if odd[i] > 2]
    negative = usual[:2000]
    weights, value, intercept = np.zeros(SIGNS**3, np.float32), np.zeros(len(every)), 0.0
    for _ in range(rounds):
        parts = [(features(group, lift), sign, share / len(group)) for group, sign, share in ((known, 1, 0.7), (rare, 1, 0.3), (negative, -1, 1.0)) if group]
        x = np.concatenate([p[0] for p in parts])
        y = np.concatenate([np.full(len(p[0]), p[1]) for p in parts])
        cost = np.concatenate([np.full(len(p[0]), p[2]) for p in parts])
        w, intercept = machine(x, y, cost)
        weights = (lift @ w).astype(np.float32)
        value = scores(every, weights) + intercept
        # Choose again: of every toxic document its worst word, and the clean words that look worst.
        worst_words = {highest(b, value) for b in toxic_bags}
        rare = sorted({every[i] for i in worst_words if not in_plain[i]} - set(known))[:4000]
        wrong = [every[i] for i in np.argsort(-np.where(in_plain, value, -np.inf), kind="stable")[:2000]]
        negative = sorted(set(usual[:2000]) | set(wrong))
    worst = np.array([value[b].max(initial=-np.inf) for b in held])
    cut = divide(worst, toxic)
    slope = 8.0 / max(0.25, float(np.median(worst[toxic & (worst > cut)])) - cut if (toxic & (worst > cut)).any() else 1.0)
    return Model(weights, slope, slope * (intercept - cut))


def divide(worst: np.ndarray, toxic: np.ndarray) -> float:
    """The value that divides clean from toxic documents with the fewest errors, in the middle of the gap."""
    order = np.argsort(worst, kind="stable")
    v, t = worst[order], toxic[order]
    errors = np.concatenate(([0], np.cumsum(t))) + np.concatenate((np.cumsum((~t)[::-1])[::-1], [0]))
    errors = np.where(np.concatenate(([True], v[1:] > v[:-1], [True])), errors, len(v) + 1)  # equal values aren't divided
    best = np.flatnonzero(errors == errors.min())
    i = int(best[len(best) // 2])
    low = v[i - 1] if i > 0 else v[0] - 1
    high = v[i] if i < len(v) else v[-1] + 1
    low = high - 1 if not np.isfinite(low) else low
    return float((low + high) / 2)


def fit(got: pa.Table) -> Model:
    """y: above 0 if toxic; bag: a document's words."""
    got = got.sort_by([("y", "ascending"), ("bag", "ascending")])
    return train((bag.as_py().split() for bag in got.column("bag")), got.column("y").to_numpy() > 0)


def learn(docs: DataFrame, labels: DataFrame, train_on: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model from at most `sample` toxic and twice as many clean documents among those where `train_on` (of the column
    id) holds."""
    known = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y is not null")
    known = known.groupBy("id").agg(F.max("y").alias("y")).where(train_on)
    order = [F.xxhash64("id"), F.col("id")]
    known = known.where("y > 0").orderBy(*order).limit(sample).union(known.where("y <= 0").orderBy(*order).limit(2 * sample))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(known), "id")
    rows = rows.where(F.length("text") <= LARGEST).groupBy("id", "y").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [" ".join(sorted(words_of(t))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(bags, pa.string())], ["y", "bag"])

    return fitted(rows.select("y", "text").mapInArrow(run, "y int, bag string"), fit) or train([], np.empty(0, bool))


class Remembered(dict):
    """Word -> value, filled for many words at once."""

    def fill(self, words: set[str], weights: np.ndarray) -> None:
        new = [w for w in words if w not in self]
        if len(self) + len(new) > ROOM:
            self.clear()
            new = list(words)
        for k in range(0, len(new), 4096):
            self.update(zip(new[k : k + 4096], scores(new[k : k + 4096], weights).tolist(), strict=True))


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with toxicity_score (0 to 1) and toxicity_word, the word that decided."""
    rows = packed(docs, text=F.col(text))
    handed = docs.sparkSession.sparkContext.broadcast(model)  # 27 ** 3 weights: a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own = Remembered(), handed.value
        for batch in batches:
            out, deciding = [], []
            for t in batch.column("text").to_pylist():
                bag = words_of(t or "")
                known.fill(bag, own.weights)
                word = max(bag, key=known.__getitem__, default=None)
                value = known[word] if word is not None else -math.inf
                out.append(own.probability(value) if own.slope else 0.0)
                deciding.append(word if value > -math.inf else None)
            made = [pa.array(out, pa.float64()), pa.array(deciding, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *made], ["row", "score", "word"])

    found = rows.mapInArrow(run, with_row(rows, score="double", word="string"))
    return unpacked(found, toxicity_score=F.col("score"), toxicity_word=F.col("word"))


def judged(docs: DataFrame, labels: DataFrame, train_on: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    tuned(docs.sparkSession)
    return scored(docs, learn(docs, labels, train_on, doc_id, text, label), text)

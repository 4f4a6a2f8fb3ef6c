"""Language of documents by a bidirectional gated recurrent network over bytes.

Every byte of a text is read in a window, forward and backward, by two gated recurrent layers; a softmax over both states
labels each position, and a document's probabilities are the mean over all its positions. The network is trained here, in
numpy, by backpropagation through time, on windows of labelled documents; every position of a window carries the label.

Defined cases: a null text, or one without any letter (of Unicode's category L), is `und` with score 0; without labelled
documents every text is `und`; a language of the labels is returned as it is written; null labels teach nothing; repeated
rows are labelled each, but teach once; columns of the documents are kept, but for those named as the operator's own
(language_pred, language_score), which are replaced; an empty table gives an empty result.
Texts of any length are read whole, window by window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetforge.llm.common import packed, tuned, unpacked, with_row

#: Documents of each language that are learned from, at most, and windows of each: the first in the order of their ids'
#: hashes. Languages that are learned, at most: the most frequent.
SAMPLE, PIECES, LANGUAGES = 400, 3, 500
WINDOW, HIDDEN, BATCH, STEPS = 64, 10, 192, 220
#: Windows that are read at once.
WIDE = 2048


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Layer:
    """One direction: an input table by byte, recurrent weights, and biases; gates z (keep), r (reset) and the new state."""

    def __init__(self, rng: np.random.Generator):
        h = HIDDEN
        self.p = {
            "x": rng.normal(0, 0.3, (257, 3 * h)).astype(np.float32),  # 256: beyond the end
            "u": rng.normal(0, 1 / np.sqrt(h), (h, 2 * h)).astype(np.float32),
            "v": rng.normal(0, 1 / np.sqrt(h), (h, h)).astype(np.float32),
        }

    def run(self, at: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States after each of the columns of `at`, and what backpropagation needs."""
        h = HIDDEN
        state = np.zeros((len(at), h), np.float32)
        states, past = np.empty((at.shape[1], len(at), h), np.float32), []
        for t in range(at.shape[1]):
            a = self.p["x"][at[:, t]]
            gates = sigmoid(a[:, : 2 * h] + state @ self.p["u"])
            z, r = gates[:, :h], gates[:, h:]
            reset = r * state
            new = np.tanh(a[:, 2 * h :] + reset @ self.p["v"])
            if keep:
                past.append((state, z, r, reset, new))
            state = state + z * (new - state)
            states[t] = state
        return states, past

    def back(self, at: np.ndarray, past: list, wanted: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients, given those of each state."""
        h = HIDDEN
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        later = np.zeros((len(at), h), np.float32)
        for t in reversed(range(at.shape[1])):
            state, z, r, reset, new = past[t]
            d = wanted[t] + later
            dn = d * z * (1 - new * new)
            dreset = dn @ self.p["v"].T
            dg = np.concatenate((d * (new - state) * z * (1 - z), dreset * state * r * (1 - r)), axis=1)
            later = d * (1 - z) + dreset * r + dg @ self.p["u"].T
            grad["v"] += reset.T @ dn
            grad["u"] += state.T @ dg
            np.add.at(grad["x"], at[:, t], np.concatenate((dg, dn), axis=1))
        return grad


class Network:
    def __init__(self, names: list[str], seed: int = 1):
        rng = np.random.default_rng(seed)
        self.names = names
        self.ahead, self.behind = Layer(rng), Layer(rng)
        self.out = {"w": rng.normal(0, 0.1, (2 * HIDDEN, len(names))).astype(np.float32), "b": np.zeros(len(names), np.float32)}

    def positions(self, at: np.ndarray, keep: bool = False):
        """Log-odds of each language at each position (time, window, language)."""
        a, past_a = self.ahead.run(at, keep)
        b, past_b = self.behind.run(at[:, ::-1], keep)
        both = np.concatenate((a, b[::-1]), axis=2)
        return both @ self.out["w"] + self.out["b"], both, past_a, past_b

    def gradients(self, at: np.ndarray, label: np.ndarray) -> tuple[float, list[dict[str, np.ndarray]]]:
        odds, both, past_a, past_b = self.positions(at, True)
        real = (at.T < 256)[:, :, None]
        p = softmax(odds)
        d = p.copy()
        d[:, np.arange(len(at)), label] -= 1
        d = d * real / max(1, real.sum())
        loss = -np.log(p[:, np.arange(len(at)), label] + 1e-9)[real[:, :, 0]].mean()
        grad = {"w": np.einsum("tbi,tbj->ij", both, d), "b": d.sum(axis=(0, 1))}
        states = d @ self.out["w"].T
        ahead = self.ahead.back(at, past_a, states[:, :, :HIDDEN])
        behind = self.behind.back(at[:, ::-1], past_b, states[::-1, :, HIDDEN:])
        return float(loss), [grad, ahead, behind]

    def train(self, at: np.ndarray, label: np.ndarray, steps: int = STEPS, rate: float = 0.02, seed: int = 2) -> float:
        rng = np.random.default_rng(seed)
        tables = [self.out, self.ahead.p, self.behind.p]
        first = [{k: np.zeros_like(v) for k, v in t.items()} for t in tables]
        second = [{k: np.zeros_like(v) for k, v in t.items()} for t in tables]
        loss = 0.0
        for step in range(1, steps + 1):
            some = rng.integers(0, len(at), min(BATCH, len(at)))
            loss, grads = self.gradients(at[some], label[some])
            now = rate * min(1.0, 2 - 2 * step / (steps + 1))
            for table, g, m, v in zip(tables, grads, first, second, strict=True):
                for k in table:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                    table[k] -= (now * m[k] / (1 - 0.9**step) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return loss


def softmax(odds: np.ndarray) -> np.ndarray:
    e = np.exp(odds - odds.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def windows(raw: bytes) -> np.ndarray:
    """The text's bytes, WINDOW a row; 256 beyond the end."""
    n = -(-len(raw) // WINDOW)
    out = np.full(n * WINDOW, 256, np.int16)
    out[: len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(n, WINDOW)


def pooled(network: Network, texts: list[str]) -> np.ndarray:
    """Mean probabilities of the languages over all positions of each text."""
    total, count = np.zeros((len(texts), len(network.names))), np.zeros(len(texts))
    held: list[np.ndarray] = []
    of: list[np.ndarray] = []
    size = 0

    def done() -> None:
        at, who = np.concatenate(held), np.concatenate(of)
        for k in range(0, len(at), WIDE):
            part, own = at[k : k + WIDE], who[k : k + WIDE]
            p = softmax(network.positions(part)[0])
            real = part.T < 256
            np.add.at(total, own, (p * real[:, :, None]).sum(axis=0))
            np.add.at(count, own, real.sum(axis=0))
        held.clear()
        of.clear()

    for i, text in enumerate(texts):
        rows = windows(text.encode())
        for k in range(0, len(rows), WIDE):
            held.append(rows[k : k + WIDE])
            of.append(np.full(len(held[-1]), i))
            size += len(held[-1])
            if size >= WIDE:
                done()
                size = 0
    if held:
        done()
    return total / np.maximum(count, 1)[:, None]


def learn(docs: DataFrame, train_on: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Network | None:
    """A network from at most `sample` documents of each language among those where `train_on` (of the column id) holds."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = rows.where("lang is not null and id is not null and text is not null").where(train_on)
    # Of a language with n rows, a hash below this share of its range keeps at least `sample` of them, all but surely; the
    # few that pass are then ranked, so no language is one group of all its rows.
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    share = F.least(F.lit(1.0), (2 * sample + 200) / F.col("n"))
    few = rows.join(F.broadcast(counts), "lang").where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share * (1 << 30)).select("id", "lang").distinct()
    order = Window.partitionBy("lang").orderBy(F.pmod(F.xxhash64("id"), F.lit(1 << 30)), "id")
    few = few.withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample).select("id", "lang")
    # Parts at hashed places, wherever they fall in a text.
    size = F.length("text")
    parts = F.transform(
        F.sequence(F.lit(0), F.lit(PIECES - 1)),
        lambda k: F.substring("text", (F.pmod(F.xxhash64("id", k), F.greatest(size - WINDOW // 2, F.lit(1))) + 1).cast("int"), F.lit(WINDOW)),
    )
    drawn = rows.join(F.broadcast(few), ["id", "lang"]).select("lang", "id", parts.alias("parts"))
    once = drawn.groupBy("lang", "id").agg(F.min("parts").alias("parts"))
    got = once.select("lang", "id", F.explode("parts").alias("part")).collect()  # LANGUAGES * sample * PIECES windows at most
    got.sort(key=lambda r: (r.lang, r.id, r.part))
    got = [r for r in got if has_letter(r.part)]
    names = sorted({r.lang for r in got})
    if not names:
        return None
    at = np.concatenate([windows(r.part.encode()[:WINDOW]) for r in got])
    network = Network(names)
    network.train(at, np.array([names.index(r.lang) for r in got]))
    return network


def labelled(docs: DataFrame, network: Network | None, text: str = "text") -> DataFrame:
    """The documents with language_pred and language_score."""
    rows = packed(docs, text=F.col(text))
    handed = docs.sparkSession.sparkContext.broadcast(network)  # a fixed size but for the few languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = handed.value
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            known = [own is not None and has_letter(t) for t in texts]
            pred, score = ["und"] * len(texts), [0.0] * len(texts)
            if any(known):
                p = pooled(own, [t for t, k in zip(texts, known, strict=True) if k])
                for i, row in zip(np.flatnonzero(known).tolist(), p, strict=True):
                    pred[i], score[i] = own.names[int(row.argmax())], float(min(1.0, row.max()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["row", "pred", "score"])

    found = rows.mapInArrow(run, with_row(rows, pred="string", score="double"))
    return unpacked(found, language_pred=F.col("pred"), language_score=F.col("score"))


def identified(docs: DataFrame, train_on: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    tuned(docs.sparkSession)
    return labelled(docs, learn(docs, train_on, doc_id, text, lang), text)

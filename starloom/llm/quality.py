"""Quality classifier: a factorisation machine over hashed words, structure and length.

Inputs of a text: its words (A-Z lower-cased) hashed to ``BUCKETS`` places,
with the logarithm of their counts scaled to length one, and the numbers of
``structure`` (shares of characters, repetition, length). The score is

    sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

and the pairwise part is computed in linear time as
1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2].

The model is fitted on the driver, with AdaGrad, on a bounded sample of
labelled rows (``TRAIN_ROWS``): the executors turn the sample's texts into
sparse vectors, a few hundred numbers a text. Scoring is one map over the
documents without a shuffle; the model is broadcast (its size is fixed).

Special cases: null and empty texts are scored by their structure alone (all
zero); without labels of both kinds every text gets the share of label 1 (0.5
without any label); repeated rows each get their own result; a null doc_id
counts as the empty text for the fold; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, by_text, fold_of, training_texts

BUCKETS = 1 << 14
FACTORS = 8
#: Most labelled rows that a model is fitted on.
TRAIN_ROWS = 4000
#: Passes over the sample: at least EPOCHS, more of a small sample (about VISITS rows in all, MOST_EPOCHS at most).
EPOCHS, VISITS, MOST_EPOCHS = 8, 40_000, 60
STEP = 0.1
DECAY = 1e-5
THRESHOLD = 0.3
#: Rows of labels.quality with this remainder of crc32(doc_id) mod 5 are never learnt from.
FOLD = (5, 0)

_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")
_UPPER = re.compile(rb"[A-Z]")
_DIGIT = re.compile(rb"[0-9]")
_SYMBOL = re.compile(rb"[#$%&*|<>{}\[\]\\^~=+@_/]")
_END = re.compile(rb"[.!?]")

#: Places of the structure numbers behind the hashed words.
STRUCTURE = ("one", "length", "letters", "upper", "digits", "symbols", "ends", "spaces", "distinct", "repeats",
             "top_word", "word_length", "lines", "distinct_lines", "short_words")


def structure(raw: bytes, words: list[bytes], counts: Counter) -> list[float]:
    n, w = max(len(raw), 1), max(len(words), 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    same = sum(map(bytes.__eq__, words, words[1:]))
    return [1.0, math.log1p(len(words)) / 10, len(raw.translate(None, _NOT_LETTERS)) / n,
            3 * len(raw.translate(None, _NOT_UPPER)) / n, 5 * len(raw.translate(None, _NOT_DIGIT)) / n,
            5 * len(raw.translate(None, _NOT_SYMBOL)) / n, 5 * len(raw.translate(None, _NOT_END)) / n,
            3 * (raw.count(b" ") + raw.count(b"\n")) / n, len(counts) / w, same / w,
            (max(counts.values()) / w) if counts else 0.0, min(sum(map(len, words)) / w / 20, 2.0),
            math.log1p(len(lines)) / 5, len(set(lines)) / max(len(lines), 1),
            sum(1 for x in words if len(x) < 4) / w]


def _others(pattern: re.Pattern) -> bytes:
    return bytes(b for b in range(256) if not pattern.match(bytes([b])))


_NOT_LETTERS, _NOT_UPPER, _NOT_DIGIT = _others(_LETTER), _others(_UPPER), _others(_DIGIT)
_NOT_SYMBOL, _NOT_END = _others(_SYMBOL), _others(_END)


def vector(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sparse inputs of a text: places and values."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.translate(ASCII_LOWER).split()
    counts = Counter(words)
    crc = zlib.crc32
    at = np.fromiter((crc(w) & (BUCKETS - 1) for w in counts), np.int32, len(counts))
    x = np.log1p(np.fromiter(counts.values(), np.float32, len(counts)))
    if len(x):
        x /= np.sqrt((x * x).sum())
    more = np.array(structure(raw, words, counts), np.float32)
    return (np.concatenate([at, np.arange(BUCKETS, BUCKETS + len(more), dtype=np.int32)]),
            np.concatenate([x, more]))


class FactorisationMachine:
    def __init__(self, size: int, factors: int = FACTORS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.w0 = np.float32(0)
        self.w = np.zeros(size, np.float32)
        self.v = (rng.standard_normal((size, factors)) * 0.05).astype(np.float32)
        self.constant: float | None = None

    def state(self) -> tuple:
        """The model as plain arrays, to broadcast."""
        return self.w0, self.w, self.v, self.constant

    @classmethod
    def of(cls, state: tuple) -> FactorisationMachine:
        model = cls(1)
        model.w0, model.w, model.v, model.constant = state
        return model

    def parts(self, at: np.ndarray, x: np.ndarray, begin: np.ndarray):
        vx = self.v[at] * x[:, None]
        sums = np.add.reduceat(vx, begin)
        pairs = 0.5 * ((sums * sums).sum(1) - np.add.reduceat((vx * vx).sum(1), begin))
        return self.w0 + np.add.reduceat(self.w[at] * x, begin) + pairs, sums

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Scores 0 to 1 of sparse rows, none of them empty."""
        if not rows:
            return np.zeros(0)
        if self.constant is not None:
            return np.full(len(rows), self.constant)
        at, x, begin = flat(rows)
        return 1 / (1 + np.exp(-np.clip(self.parts(at, x, begin)[0].astype(np.float64), -40, 40)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray,
            batch: int = 32, seed: int = 11) -> FactorisationMachine:
        share = float(labels.mean()) if len(labels) else 0.5
        if share in (0.0, 1.0) or not len(labels):
            self.constant = share
            return self
        self.w0 = np.float32(math.log(share / (1 - share)))
        epochs = max(EPOCHS, min(MOST_EPOCHS, VISITS // len(rows)))
        rng = np.random.default_rng(seed)
        gw, gv, g0 = np.full_like(self.w, 1e-6), np.full_like(self.v, 1e-6), 1e-6
        for _ in range(epochs):
            for some in np.array_split(rng.permutation(len(rows)), math.ceil(len(rows) / batch)):
                at, x, begin = flat([rows[i] for i in some])
                z, sums = self.parts(at, x, begin)
                error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels[some]).astype(np.float32) / len(some)
                row = np.repeat(np.arange(len(some)), np.diff(np.r_[begin, len(at)]))
                ex = (error[row] * x)[:, None]
                place, where = np.unique(at, return_inverse=True)
                dv = np.zeros((len(place), self.v.shape[1]), np.float32)
                np.add.at(dv, where, ex * (sums[row] - self.v[at] * x[:, None]))
                dw = np.bincount(where, ex[:, 0], len(place)).astype(np.float32)
                dv += DECAY * self.v[place]
                dw += DECAY * self.w[place]
                gw[place] += dw * dw
                gv[place] += dv * dv
                self.w[place] -= STEP * dw / np.sqrt(gw[place])
                self.v[place] -= STEP * 0.3 * dv / np.sqrt(gv[place])
                d0 = float(error.sum())
                g0 += d0 * d0
                self.w0 -= np.float32(STEP * d0 / math.sqrt(g0))
        return self


def flat(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    begin = np.cumsum([0] + [len(a) for a, _ in rows[:-1]])
    return np.concatenate([a for a, _ in rows]), np.concatenate([x for _, x in rows]), begin


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", fold: tuple[int, int] = FOLD,
        rows: int = TRAIN_ROWS) -> FactorisationMachine:
    """Fit on at most ``rows`` labelled documents outside the held-out fold."""

    def make():
        def of(texts):
            got = [vector(t) for t in texts]
            return {"at": pa.array([a.tobytes() for a, _ in got], pa.binary()),
                    "x": pa.array([x.tobytes() for _, x in got], pa.binary())}

        return of

    sample = training_texts(docs, labels, label, fold, rows)
    got = by_text(sample, make, "at binary, x binary", ["doc_id", "text_hash", "label"])
    got = got.groupBy("doc_id", "text_hash", "label").agg(F.first("at").alias("at"), F.first("x").alias("x"))
    got = sorted(got.collect(), key=lambda r: (r["doc_id"], bytes(r["at"]), bytes(r["x"])))  # at most ``rows`` rows
    vectors = [(np.frombuffer(r["at"], np.int32), np.frombuffer(r["x"], np.float32)) for r in got]
    model = FactorisationMachine(BUCKETS + len(STRUCTURE))
    return model.fit(vectors, np.array([r["label"] for r in got], np.float64))


def score(docs: DataFrame, model: FactorisationMachine, keep: tuple = ("doc_id",), text: str = "text",
          name: str = "score") -> DataFrame:
    """The ``keep`` columns and the score of each row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model.state())  # BUCKETS x (FACTORS + 1) numbers

    def make():
        own = FactorisationMachine.of(shared.value)

        def of(texts):
            return {name: pa.array(own.score([vector(t) for t in texts]), pa.float64())}

        return of

    return by_text(docs, make, f"`{name}` double", [c for c in keep if c != name], text)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", (fold_of("doc_id", FOLD[0]) == FOLD[1]).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accept(docs: DataFrame, model: FactorisationMachine, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (same columns) whose text the model does not reject."""
    name = "__quality"
    return score(docs, model, tuple(docs.columns), name=name).where(F.col(name) >= threshold).select(
        *[F.col(f"`{c}`") for c in docs.columns])

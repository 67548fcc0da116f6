"""Toxicity: a support vector machine with a subsequence string kernel and Nyström landmarks.

Units: the words of a text, lower-cased, without the marks around them; a run
of three or more single characters ("i d i o t") also counts as one unit. The
kernel of two units counts their common subsequences of three characters,
each occurrence weighted with ``DECAY`` to the power of the span it takes (up
to ``SPAN`` characters), so gaps and inserted characters lower it and do not
end it. Each unit is scaled by the norm of its weights.

Fitting (on the driver, from at most ``TRAIN_ROWS`` labelled documents that
the executors turn into counts of units): units that stand in toxic texts far
more often than in others are the witnesses of toxic sentences; units of
other texts are the rest. Witnesses and others are repeated with inserted
characters. Landmarks are drawn from both, the Nyström map is built from
their kernel matrix, and a linear SVM (squared hinge, Newton steps) is trained
on it. As the kernel is an inner product of weighted subsequences, the
landmarks' expansion folds into one weight per subsequence; scoring a unit
costs its subsequences, whatever the number of landmarks.

A sentence's margin is its best unit's; a text's score comes from the best and
second best sentence and the number of positive ones, through a logistic
calibration on the same sample.

Scoring is one map over the documents without a shuffle. Each task keeps a
bounded table of the distinct words it has scored. Long words are taken in
overlapping windows of ``WINDOW`` characters.

Special cases: null and empty texts have the margin of no unit; without labels
of both kinds, or without witnesses, every text gets the share of label 1 (0
without any label); repeated rows each get their own result; a null doc_id
counts as the empty text for the fold; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_text, fold_of, training_texts

DECAY = 0.6
SPAN = 10
WINDOW, STRIDE = 24, 8
SYMBOLS = 64
LANDMARKS = 320
#: Most labelled rows, witnesses and other units that a model is fitted on.
TRAIN_ROWS = 6000
WITNESSES = 600
OTHERS = 8000
VARIANTS = 3
BALANCE = 8.0
RIDGE = 0.02
#: Log-likelihood ratio from which a unit of toxic texts is a witness.
TELLING = 18.0
#: Least share of toxic texts among those with a witness.
PURITY = 0.7
THRESHOLD = 0.3
#: Rows of labels.toxic with this remainder of crc32(doc_id) mod 4 are never learnt from.
FOLD = (4, 2)
TABLE_WORDS = 300_000

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_INSERTED = ".-*_'~"


def unit_of(word: str) -> str:
    return _EDGES.sub("", word).lower()


def symbols(unit: str) -> np.ndarray:
    """Characters as numbers below SYMBOLS (letters, digits and others by residue)."""
    codes = np.frombuffer(unit.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    letter = (codes >= 97) & (codes <= 122)
    return np.where(letter, codes - 97, 26 + codes % (SYMBOLS - 26))


def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the subsequences of three within SPAN of n characters, and their scaled weights."""
    places = [(i, i + a, i + b) for i in range(n) for a, b in combinations(range(1, min(SPAN, n - i)), 2)]
    at = np.array(places, np.int64).reshape(-1, 3)
    weight = DECAY ** (at[:, 2] - at[:, 0] + 1).astype(np.float64)
    return at, weight / max(math.sqrt((weight * weight).sum()), 1e-12)


class Subsequences:
    """The explicit kernel features of units, by length."""

    def __init__(self):
        self.made: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def triples(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n not in self.made:
            self.made[n] = _triples(n)
        return self.made[n]

    def features(self, units: list[str]):
        """Groups of equally long units: (their places, codes, weights). Units over WINDOW are left out."""
        by_length: dict[int, list[int]] = {}
        for i, u in enumerate(units):
            if 3 <= len(u) <= WINDOW:
                by_length.setdefault(len(u), []).append(i)
        for n, where in by_length.items():
            at, weight = self.triples(n)
            for lo in range(0, len(where), 2000):
                own = where[lo:lo + 2000]
                c = symbols("".join([units[i] for i in own])).reshape(len(own), n)
                codes = (c[:, at[:, 0]] * SYMBOLS + c[:, at[:, 1]]) * SYMBOLS + c[:, at[:, 2]]
                yield np.array(own), codes, weight

    def kernel(self, units: list[str], landmarks: list[str]) -> np.ndarray:
        """Kernel of units against landmarks."""
        used = np.full(SYMBOLS ** 3, -1, np.int64)
        marks = list(self.features(landmarks))
        known = np.unique(np.concatenate([c.ravel() for _, c, _ in marks]))
        used[known] = np.arange(len(known))
        z = np.zeros((len(known) + 1, len(landmarks)), np.float32)
        for own, codes, weight in marks:
            np.add.at(z, (used[codes], np.broadcast_to(own[:, None], codes.shape)), weight[None, :].astype(np.float32))
        out = np.zeros((len(units), len(landmarks)))
        for own, codes, weight in self.features(units):
            for lo in range(0, len(own), 100):
                out[own[lo:lo + 100]] = np.einsum("utm,t->um", z[used[codes[lo:lo + 100]]], weight.astype(np.float32))
        return out


def windows(unit: str) -> list[str]:
    if len(unit) <= WINDOW:
        return [unit]
    return [unit[i:i + WINDOW] for i in range(0, len(unit) - WINDOW + STRIDE, STRIDE)]


def with_insertions(unit: str, rng) -> str:
    """The unit with one to three characters put in."""
    for _ in range(int(rng.integers(1, 4))):
        at = int(rng.integers(1, max(2, len(unit))))
        unit = unit[:at] + (_INSERTED + "abcdefghijklmnopqrstuvwxyz")[int(rng.integers(0, 18))] + unit[at:]
    return unit[:WINDOW]


def spread(units: list[str], n: int) -> list[str]:
    """``n`` units: the first half of them from the front, the others evenly from the rest."""
    front, rest = units[:n // 2], units[n // 2:]
    return front + [rest[i] for i in sorted({int(k) for k in np.linspace(0, len(rest) - 1, n - n // 2)})] if rest else front


def train_units(witnesses: dict[str, int], others: dict[str, int], seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights per subsequence and the bias of the SVM over landmark features.

    Both kinds of units come with the number of texts that hold them, the most telling first.
    """
    rng = np.random.default_rng(seed)
    landmarks = spread(list(witnesses), LANDMARKS // 2) + spread(list(others), LANDMARKS // 2)
    units, y = [*witnesses, *others], np.r_[np.ones(len(witnesses)), -np.ones(len(others))]
    cost = np.log1p([*witnesses.values(), *others.values()])
    base, own, price = units, y, cost
    for k in range(VARIANTS):
        n = len(witnesses) if k else len(base)
        units = units + [with_insertions(u, rng) for u in base[:n]]
        y, cost = np.r_[y, own[:n]], np.r_[cost, price[:n] / VARIANTS]
    of = Subsequences()
    kzz = of.kernel(landmarks, landmarks)
    value, vector = np.linalg.eigh(kzz + 1e-6 * np.eye(len(landmarks)))
    root = vector / np.sqrt(np.maximum(value, 1e-6)) @ vector.T
    phi = np.c_[of.kernel(units, landmarks) @ root, np.ones(len(units))]
    cost = cost * np.where(y > 0, min(cost[y < 0].sum() / cost[y > 0].sum(), BALANCE), 1.0)
    w, ridge = np.zeros(phi.shape[1]), RIDGE * np.eye(phi.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(25):
        active = y * (phi @ w) < 1
        own, c = phi[active], cost[active]
        new = np.linalg.solve(ridge + own.T @ (own * c[:, None]), own.T @ (c * y[active]))
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    alpha = root @ w[:-1]
    folded = np.zeros(SYMBOLS ** 3)
    for own, codes, weight in of.features(landmarks):
        np.add.at(folded, codes, alpha[own][:, None] * weight[None, :])
    return folded.astype(np.float32), float(w[-1])


class Scorer:
    """Margins of texts: a bounded table of distinct words, folded weights and bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias, self.of = weights, bias, Subsequences()
        self.reset()

    def reset(self) -> None:
        self.place: dict[str, int] = {}
        self.margin = np.zeros(0)
        self.flags = np.zeros(0, np.uint8)

    def margins(self, units: list[str]) -> np.ndarray:
        """Margins of units; a long unit has the best of its windows."""
        parts = [windows(u) for u in units]
        whole = [p for ps in parts for p in ps]
        out = np.full(len(whole), self.bias)
        for own, codes, weight in self.of.features(whole):
            out[own] += self.weights[codes] @ weight
        return np.maximum.reduceat(out, np.cumsum([0] + [len(p) for p in parts[:-1]])) if units else np.zeros(0)

    def learn(self, words: set[str]) -> None:
        """Put words that are not there yet into the table."""
        new = list(words - self.place.keys())
        if len(self.place) + len(new) > TABLE_WORDS:
            self.reset()
            new = list(words)
        if not new:
            return
        units = [unit_of(w) for w in new]
        distinct = list(dict.fromkeys(units))
        at = {u: i for i, u in enumerate(distinct)}
        got = self.margins(distinct)
        begin = len(self.place)
        self.place.update((w, begin + i) for i, w in enumerate(new))
        self.margin = np.r_[self.margin, got[[at[u] for u in units]]]
        # 1: ends a sentence; 2: one character
        self.flags = np.r_[self.flags, np.array([(w[-1] in ".!?") + 2 * (len(w) == 1) for w in new], np.uint8)]

    def sentences(self, words: list[str]) -> np.ndarray:
        """The margin of each sentence of a text (its words in order)."""
        if not words:
            return np.array([self.bias])
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        margin, flags = self.margin[at], self.flags[at]
        single = flags & 2 > 0
        if single.any():
            edges = np.flatnonzero(np.diff(np.r_[0, single & (flags & 1 == 0), 0]))
            runs = [(a, b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()) if b - a >= 3]
            if runs:
                joined = self.margins(["".join(words[a:b]).lower() for a, b in runs])
                for (a, _), m in zip(runs, joined.tolist()):
                    margin[a] = max(margin[a], m)
        ends = np.flatnonzero(flags & 1)
        begin = np.r_[0, ends[ends < len(words) - 1] + 1]
        return np.maximum.reduceat(margin, begin)

    def summaries(self, texts: list[str | None]) -> np.ndarray:
        """Per text: best and second best sentence margin, log of positive sentences."""
        rows = [(t or "").replace("\n", " . ").split() for t in texts]
        out = np.zeros((len(rows), 3))
        for lo in range(0, len(rows), 500):
            self.learn(set().union(*rows[lo:lo + 500]))
            for i, words in enumerate(rows[lo:lo + 500], lo):
                s = self.sentences(words)
                top = np.sort(s[np.argpartition(-s, 1)[:2]])[::-1] if len(s) > 1 else s
                out[i] = top[0], top[1] if len(s) > 1 else self.bias, math.log1p(int((s > 0).sum()))
        return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Coefficients (the last is the constant) of a logistic regression by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _telling(t, c, n1: int, n0: int):
    """Log-likelihood ratio of a unit's texts being toxic more often than all texts; 0 where they aren't."""
    p = n1 / (n1 + n0)
    part = lambda x, q: F.when(x > 0, x * F.log(x / ((t + c) * q))).otherwise(0.0)
    return F.when(t > (t + c) * p, 2 * (part(t, p) + part(c, 1 - p))).otherwise(0.0)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", fold: tuple[int, int] = FOLD,
        rows: int = TRAIN_ROWS) -> dict:
    """A model (plain arrays) fitted on at most ``rows`` labelled documents outside the held-out fold."""
    sample = training_texts(docs, labels, label, fold, rows)
    def units(batches):
        for batch in batches:
            rows = []
            for text, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                own = {w for word in set((text or "").split()) for w in windows(unit_of(word)) if len(w) >= 3}
                # copies and near copies of a text have the same smallest hash, mostly
                low = min((zlib.crc32(w.encode("utf-8", "replace")) for w in own), default=0)
                rows += [(w, y, low) for w in (own or {""})]
            yield pa.RecordBatch.from_pydict({"unit": pa.array([r[0] for r in rows], pa.string()),
                                              "y": pa.array([r[1] for r in rows], pa.int32()),
                                              "low": pa.array([r[2] for r in rows], pa.int64())})

    # texts count once per group of copies, else each word of a copied toxic text would tell
    found = sample.select("text", "label").mapInArrow(units, "unit string, y int, low bigint").distinct()
    known = {r["y"]: r["n"] for r in found.groupBy("y").agg(F.countDistinct("low").alias("n")).collect()}
    n1, n0 = known.get(1, 0), known.get(0, 0)
    share = n1 / (n1 + n0) if n1 + n0 else 0.0
    if not (n1 and n0):
        return {"constant": share}
    counts = found.where("unit <> ''").groupBy("unit").agg(F.count(F.expr("if(y = 1, 1, null)")).alias("t"),
                                                           F.count(F.expr("if(y = 0, 1, null)")).alias("c"))
    counts = counts.select("unit", "t", "c", _telling(F.col("t"), F.col("c"), n1, n0).alias("g"))
    witness = counts.where((F.col("g") >= TELLING) & (F.col("t") >= PURITY * (F.col("t") + F.col("c") + 1))).orderBy(F.desc("g"), "unit").limit(WITNESSES)
    other = counts.where("c >= 1").where(F.col("g") < 3)
    common = other.orderBy(F.desc("c"), "unit").limit(OTHERS // 2)
    rare = other.orderBy(F.xxhash64("unit"), "unit").limit(OTHERS // 2)
    witnesses = {r["unit"]: r["t"] for r in witness.collect()}
    others = {r["unit"]: r["c"] for r in common.collect()} | {r["unit"]: r["c"] for r in rare.collect()}
    if not witnesses or not others:
        return {"constant": share}
    weights, bias = train_units(witnesses, others)
    shared = docs.sparkSession.sparkContext.broadcast((weights, bias))

    def make():
        scorer = Scorer(*shared.value)

        def of(texts):
            s = scorer.summaries(texts)
            return {f"m{k}": pa.array(s[:, k]) for k in range(3)}

        return of

    got = by_text(sample, make, "m0 double, m1 double, m2 double", ["doc_id", "text_hash", "label"])
    got = got.groupBy("doc_id", "text_hash", "label").agg(*[F.max(m).alias(m) for m in ("m0", "m1", "m2")])
    got = got.select("label", "m0", "m1", "m2").collect()  # at most ``rows`` rows
    got = np.array(sorted(tuple(r) for r in got), np.float64)
    return {"weights": weights, "bias": bias, "calibration": logistic(got[:, 1:], got[:, 0])}


def score(docs: DataFrame, model: dict, keep: tuple = ("doc_id",), text: str = "text", name: str = "score") -> DataFrame:
    """The ``keep`` columns and the score of each row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per subsequence of three symbols

    def make():
        own = shared.value
        scorer = None if "constant" in own else Scorer(own["weights"], own["bias"])

        def of(texts):
            if scorer is None:
                return {name: pa.array(np.full(len(texts), own["constant"]))}
            z = np.c_[scorer.summaries(texts), np.ones(len(texts))] @ own["calibration"]
            return {name: pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))}

        return of

    return by_text(docs, make, f"`{name}` double", [c for c in keep if c != name], text)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", (fold_of("doc_id", FOLD[0]) == FOLD[1]).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

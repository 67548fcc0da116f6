"""Repeated passages by sparse suffixes.

A passage is a run of at least ``length`` words (A-Z lower-cased) that stands
in two or more documents. Of a document's suffixes only those at minimiser
positions are retained: in every window of ``length`` words, the ``gram``-word
beginning with the smallest hash (the last of equal ones), so equal windows
retain the same suffix. The retained suffixes are grouped by the hash of their
first ``gram`` words (nothing is sorted); a suffix without an equal one from
another document is dropped, which drops nearly all text that repeats nowhere.
Of the others every window of ``length`` words around them that chose that
suffix is taken, and a window that stands in two documents is a match. Overlapping and touching matches of a document are one span. Windows
are compared by a 64-bit polynomial hash of 64-bit word hashes.

On Spark: suffixes, contexts and windows are aggregates with partial sums, so
a passage that a third of all documents share is folded before the shuffle;
the joins back are ordinary ones whose large partitions Spark's skew handling
splits. A suffix whose whole context (all its windows) stands in two documents
is settled by one hash; single windows are compared only where contexts of a
shared suffix differ, at the edges of matches, one row per different context.
The texts of documents with candidates are read a second time and joined by
document; nothing is collected.

Special cases: null and empty texts, and texts of fewer than ``length`` words,
have no passage; a repeat within one document only is none, nor are rows that
repeat one doc_id with the same text; rows with a null doc_id take no part;
an empty table gives an empty result; columns other than doc_id and text are
not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import small_batches
from .decontaminate import words_of

LENGTH, GRAM = 50, 20
#: An odd multiplier of the polynomial hash, and of the mixing step.
BASE, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
TABLE_WORDS = 400_000


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= TABLE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 1)
        return h


class Windows:
    """Hashes of a text's windows and the suffixes that they choose."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram, self.known = length, gram, WordHashes()
        self.powers = np.ones(1, np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.powers) < n + 1:
            base, inverse = np.uint64(BASE), np.uint64(pow(BASE, -1, 1 << 64))
            self.powers = np.cumprod(np.r_[np.uint64(1), np.full(2 * n, base)], dtype=np.uint64)
            self.inverse = np.cumprod(np.r_[np.uint64(1), np.full(2 * n, inverse)], dtype=np.uint64)
        return self.powers, self.inverse

    def _hashes(self, sums: np.ndarray, inverse: np.ndarray, size: int) -> np.ndarray:
        h = (sums[size:] - sums[:-size]) * inverse[:len(sums) - size]
        h ^= h >> np.uint64(32)
        h *= np.uint64(MIX)
        return h ^ (h >> np.uint64(29))

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per window: its hash, the place and the hash of the suffix that it chooses."""
        words = words_of(text)
        if len(words) < self.length:
            none = np.zeros(0, np.uint64)
            return none, none.astype(np.int64), none
        w = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        power, inverse = self._powers(len(w))
        sums = np.r_[np.uint64(0), np.cumsum(w * power[:len(w)], dtype=np.uint64)]
        grams = self._hashes(sums, inverse, self.gram)
        span = self.length - self.gram + 1
        back = np.lib.stride_tricks.sliding_window_view(grams[::-1], span)
        n = len(w) - self.length + 1
        chosen = np.empty(n, np.int64)
        for lo in range(0, n, 1 << 16):
            chosen[lo:lo + (1 << 16)] = back[lo:lo + (1 << 16)].argmin(1)
        chosen = (np.arange(n) + span - 1 - chosen[::-1])  # the last smallest of each window
        return self._hashes(sums, inverse, self.length), chosen, grams[chosen]


def _array(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x)


def _staged(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared folder: columns that repeat cost next to nothing there."""
    path = f"{checkpoint_dir(df.sparkSession)}/passages-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


CONTEXT = "doc bigint, row bigint, suffix bigint, context bigint, start bigint, times bigint, windows array<bigint>"


def contexts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc, row, suffix, context, start, times, windows): the retained suffixes that another document shares.

    ``row`` tells texts of one doc_id apart; ``windows`` are the hashes of the
    windows from ``start`` on that chose the suffix, ``context`` is the hash of
    all the words under them, ``times`` how often they follow each other (a
    word said a thousand times over is one row).
    """
    if not 0 < gram < length:
        raise ValueError("a suffix's beginning must be shorter than a passage")
    texts = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("row", F.xxhash64("text"))

    def suffixes(batches):
        made = Windows(length, gram)
        for batch in small_batches(batches, "text"):
            docs_, keys = [], []
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist()):
                k = np.unique(made.of(text)[2])
                docs_.append(np.full(len(k), doc, np.int64))
                keys.append(k)
            if docs_:
                yield pa.RecordBatch.from_pydict({"suffix": _array(np.concatenate(keys)), "doc": pa.array(np.concatenate(docs_))})

    def extended(batches):
        made = Windows(length, gram)
        for batch in small_batches(batches, "text"):
            cols = [batch.column(c).to_pylist() for c in ("doc", "row", "text")]
            out, lists = {c: [] for c in ("doc", "row", "suffix", "context", "start", "times")}, []
            for doc, row, text, keep in zip(*cols, batch.column("suffixes").to_pylist()):
                window, chosen, key = made.of(text)
                if not len(window):
                    continue
                # runs of windows that chose one suffix, and those of shared suffixes
                cut = np.flatnonzero(np.diff(chosen)) + 1
                lo, hi = np.r_[0, cut], np.r_[cut, len(chosen)]
                own = np.isin(key[lo], np.array(keep, np.int64).view(np.uint64))
                last, after = None, -1
                for a, b in zip(lo[own].tolist(), hi[own].tolist()):
                    w = window[a:b].view(np.int64)
                    # equal windows one after the other are equal words; where the suffix stands tells shifts apart
                    context = int(np.uint64(xxhash.xxh64_intdigest(w.tobytes(), int(chosen[a] - a))).view(np.int64))
                    if context == last and a == after:
                        out["times"][-1] += 1
                    else:
                        for c, v in (("doc", doc), ("row", row), ("suffix", int(key[a].view(np.int64))),
                                     ("context", context), ("start", a), ("times", 1)):
                            out[c].append(v)
                        lists.append(w)
                    last, after = context, b
            if lists:
                offsets = pa.array(np.cumsum([0] + [len(w) for w in lists]), pa.int32())
                yield pa.RecordBatch.from_pydict({**{c: pa.array(v, pa.int64()) for c, v in out.items()},
                                                  "windows": pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(lists)))})

    found = _staged(texts.select("doc", "text").mapInArrow(suffixes, "suffix bigint, doc bigint"))
    # suffixes with an equal neighbour from another document
    shared = found.groupBy("suffix").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a <> b").select("suffix")
    per_doc = found.join(shared, "suffix", "left_semi").groupBy("doc").agg(F.collect_set("suffix").alias("suffixes"))
    return _staged(texts.join(per_doc, "doc").mapInArrow(extended, CONTEXT))


def matches(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc, row, start, end, low): runs of words that stand in another document as well.

    ``low``: a smallest doc_id that has the run, as far as whole contexts and
    single windows tell (it may be doc itself).
    """
    found = contexts(docs, length, gram)
    # grouped by one column more than joined on: the join then shuffles both sides, and Spark can split a
    # context (below: a window) that very many documents share
    by_context = found.groupBy("context", "suffix").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    known = found.join(by_context.drop("suffix"), "context")
    whole = known.where("low <> high").select(
        "doc", "row", "start", (F.col("start") + F.col("times") * F.size("windows") - 1 + length).alias("end"), "low")
    # one row per different context is enough to know which windows stand where
    single = known.where("doc = low").dropDuplicates(["context"]).select("suffix", "windows", "low", "high")
    open_ = known.where("low = high")
    mixed = open_.select("suffix").distinct()
    windows = single.join(mixed, "suffix", "left_semi").select(F.explode("windows").alias("window"), "low", "high")
    twice = windows.groupBy("window", F.pmod("window", F.lit(64)).alias("part")).agg(
        F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high")
    edges = open_.select("doc", "row", "start", "times", F.size("windows").alias("step"),
                         F.posexplode("windows").alias("i", "window")).join(
        twice.select("window", F.col("low").alias("least")), "window")
    edges = edges.select("doc", "row", F.explode(F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("times") - 1),
        lambda k: F.col("start") + F.col("i") + k * F.col("step"))).alias("start"), F.col("least").alias("low")).select(
        "doc", "row", "start", (F.col("start") + length).alias("end"), "low")
    return whole.unionByName(edges)


def passages(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, start, end (in words, end exclusive), n_words, first_doc: one row per repeated span.

    ``first_doc`` is the smallest doc_id found to share a part of the span: of
    whole copies the one with its own id as first_doc can stay.
    """
    by_text = Window.partitionBy("doc", "row").orderBy("start", "end")
    before = by_text.rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True)).cast("int")
    spans = matches(docs, length, gram).withColumn("fresh", fresh).withColumn("n", F.sum("fresh").over(
        by_text.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    spans = spans.groupBy("doc", "row", "n").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("low").alias("low"))
    return spans.select(F.col("doc").alias("doc_id"), "start", "end", (F.col("end") - F.col("start")).alias("n_words"),
                        F.col("low").alias("first_doc"))

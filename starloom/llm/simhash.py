"""SimHash near-duplicates found with Golay-code fuzzy hashing.

Fingerprint: 64 bits over the XXH64 (seed 42) of word shingles; a bit is one
where more than half of the hashes have it. Two fingerprints link if they
differ in at most ``max_bits`` (up to 4) bits.

Candidates: the fingerprint is cut into segments of 23, 23 and 18 bits. Each
segment is decoded to the indices of the nearby Golay codewords (one or six,
see ``golay``); two segments that differ in at most two bits share an index.
With four or fewer errors over three segments, either no segment has more than
two, so the pair shares an index in all three segments (36-bit key), or one
segment has three or four errors, the others one at most in all: then one of
them is equal and the other shares an index (30 to 35-bit key). Equal
fingerprints are one row from the start, so the size of a group of exact
copies plays no part here.

Verification: rows are dealt by key and sorted; the members of one key are
compared by XOR and bit count. A task returns for a key only the links of a
spanning forest (fewer links than members), so a key's output never grows with
the square of its members. Keys with more than ``bucket`` members are set
aside, their members cut into blocks and each pair of blocks compared in a
task of its own: no partner is left out, and no task holds more than two
blocks. Components come from ``components``.

Special cases: null, empty and white-space texts have fingerprint zero, linked
like any other; repeated rows and equal texts fall on one fingerprint; a row
with a null doc_id gets its fingerprint and its component; a component whose
ids are all null has a null component_id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from . import golay
from .common import ASCII_LOWER, by_text, checkpoint, hot_split_join, salted_left_join
from .components import connected_components

SEED = 42
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Members of one key that one task compares; larger keys go on as pairs of blocks.
BUCKET = 20_000
#: Fingerprints whose keys one task makes.
TASK_FINGERPRINTS = 16_000


def fingerprint(text: str | None, shingle: int) -> int:
    words = text.encode("utf-8", "replace").translate(ASCII_LOWER).split() if text else []
    if not words:
        return 0
    parts = list(map(b" ".join, zip(*(words[i:] for i in range(shingle))))) if len(words) >= shingle else [b" ".join(words)]
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(s, SEED) for s in parts]), np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at:at + (1 << 16)], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(parts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, keep: tuple = ("doc_id",), text: str = "text",
                 name: str = "fp") -> DataFrame:
    """The ``keep`` columns and the fingerprint as a signed 64-bit integer."""

    def make():
        def of(texts):
            return {name: pa.array(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))}

        return of

    return by_text(docs, make, f"`{name}` bigint", [c for c in keep if c != name], text)


def candidate_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of fingerprints (uint64): the rows' numbers and the keys."""
    segments = [(fps >> np.uint64(at)) & np.uint64((1 << n) - 1) for at, n in SEGMENTS]
    index = [golay.keys(s) for s in segments]
    rows, out = [], []

    def emit(kind: int, value: np.ndarray, real: np.ndarray) -> None:
        r, _ = np.nonzero(real)
        rows.append(r)
        out.append(value[real] | np.uint64(kind << 56))

    n = len(fps)
    (i0, r0), (i1, r1), (i2, r2) = index
    value = (i0[:, :, None, None] << np.uint64(24)) | (i1[:, None, :, None] << np.uint64(12)) | i2[:, None, None, :]
    real = r0[:, :, None, None] & r1[:, None, :, None] & r2[:, None, None, :]
    emit(0, value.reshape(n, -1), real.reshape(n, -1))
    for a in range(3):
        for b in range(3):
            if a != b:
                emit(1 + 3 * a + b, (segments[a][:, None] << np.uint64(12)) | index[b][0], index[b][1])
    return np.concatenate(rows), np.concatenate(out)


def forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the graph "at most max_bits apart" (unsigned fps)."""
    left, right = [], []
    rest = fps
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            near = np.zeros(len(rest), bool)
            parent = np.empty(len(rest), np.uint64)
            for f in front:
                hit = ~near & (np.bitwise_count(rest ^ f) <= max_bits)
                parent[hit] = f
                near |= hit
            left.append(parent[near])
            right.append(rest[near])
            front, rest = rest[near], rest[~near]
    return (np.concatenate(left), np.concatenate(right)) if left else (fps[:0], fps[:0])


def cross_links(one: np.ndarray, two: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of one block, or of two blocks together."""
    return forest(np.concatenate([one, two]), max_bits)


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(key, members, whole) of rows sorted by key; a key of over ``most`` members comes in parts."""
    key, parts, size, whole = None, [], 0, True
    for batch in batches:
        keys = batch.column(0).to_numpy()
        fps = batch.column(1).to_numpy()
        if not len(keys):
            continue
        cuts = np.flatnonzero(np.diff(keys)) + 1
        for k, members in zip(keys[np.r_[0, cuts]].tolist(), np.split(fps, cuts)):
            if k != key:
                if size:
                    yield key, np.concatenate(parts), whole
                key, parts, size, whole = k, [], 0, True
            parts.append(members)
            size += len(members)
            if size > most:
                whole = False
                yield key, np.concatenate(parts), whole
                parts, size = [], 0
    if size:
        yield key, np.concatenate(parts), whole


def _links(pairs: list[tuple[np.ndarray, np.ndarray]]) -> dict[str, pa.Array]:
    a = np.concatenate([p[0] for p in pairs]).view(np.int64)
    b = np.concatenate([p[1] for p in pairs]).view(np.int64)
    return {"a": pa.array(a), "b": pa.array(b)}


def links(distinct: DataFrame, max_bits: int = 4, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) whose components are those of all pairs at most ``max_bits`` apart.

    ``distinct``: a column fp of distinct fingerprints (signed).
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("three Golay-coded segments find up to four differing bits")

    def keyed(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                fps = batch.column(0).slice(at, 2000).to_numpy().view(np.uint64)
                row, key = candidate_keys(fps)
                yield pa.RecordBatch.from_pydict({"key": pa.array(key.view(np.int64)), "fp": pa.array(fps[row].view(np.int64))})

    def compared(batches):
        pairs, held = [], 0
        for key, members, whole in _runs(batches, bucket):
            if whole and len(members) > 1:
                pairs.append(forest(members.view(np.uint64), max_bits))
                held += len(pairs[-1][0])
            elif not whole:
                # a part of a large key: its rows go on as they are
                yield pa.RecordBatch.from_pydict({"key": pa.array(np.full(len(members), key)), "a": pa.array(members),
                                                  "b": pa.nulls(len(members), pa.int64())})
            if held > 50_000:
                out = _links(pairs)
                yield pa.RecordBatch.from_pydict({"key": pa.nulls(len(out["a"]), pa.int64()), **out})
                pairs, held = [], 0
        if pairs:
            out = _links(pairs)
            yield pa.RecordBatch.from_pydict({"key": pa.nulls(len(out["a"]), pa.int64()), **out})

    # some 180 keys a fingerprint are made, so the few bytes of a fingerprint say nothing about a task's size
    tasks = -(-distinct.count() // TASK_FINGERPRINTS) or 1
    keys = distinct.select("fp").repartition(tasks, "fp").mapInArrow(keyed, "key bigint, fp bigint")
    dealt = keys.repartition("key").sortWithinPartitions("key")
    found = checkpoint(dealt.mapInArrow(compared, "key bigint, a bigint, b bigint"))
    small = found.where("key is null").select("a", "b")
    return small.unionByName(_large_keys(found.where("key is not null").select("key", F.col("a").alias("fp")), max_bits, bucket))


def _large_keys(rows: DataFrame, max_bits: int, bucket: int) -> DataFrame:
    """Keys of more than ``bucket`` members: every pair of blocks of members, each in its own task."""
    counts = rows.groupBy("key").count().where(F.col("count") > 0)
    blocks = F.ceil(F.col("count") * 2 / F.lit(bucket)).cast("int")
    rows = rows.join(broadcast_if_small(counts.select("key", blocks.alias("n"))), "key").withColumn(
        "i", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    pairs = rows.select("key", "fp", F.explode(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda j: F.struct(
        F.least("i", j).alias("i"), F.greatest("i", j).alias("j")))).alias("p"))

    def compare(pdf):
        import pandas as pd

        a, b = forest(pdf["fp"].to_numpy().view(np.uint64), max_bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return pairs.groupBy("key", "p.i", "p.j").applyInPandas(compare, "a bigint, b bigint")


def _classes(marked: DataFrame, max_bits: int, bucket: int) -> DataFrame:
    """(fp, rows, group, component_id) of every fingerprint in ``marked`` (doc_id, fp)."""
    distinct = checkpoint(marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")))
    found = connected_components(links(distinct, max_bits, bucket))
    grouped = distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "fp", "first", "rows", F.coalesce("component", "fp").alias("group"))
    # only groups of several fingerprints need the way back; a large one is salted
    several = grouped.groupBy("group").agg(F.min("first").alias("low"), F.count("*").alias("n")).where("n > 1")
    return salted_left_join(grouped, several.select("group", "low"), "group").select(
        "fp", "rows", "group", F.coalesce("low", "first").alias("component_id"))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, bucket: int = BUCKET,
                    text: str = "text") -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable over links), one row per input row."""
    marked = checkpoint(fingerprints(docs, shingle, ("doc_id",), text))
    return hot_split_join(marked, checkpoint(_classes(marked, max_bits, bucket)), "fp", "rows").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4, bucket: int = BUCKET) -> DataFrame:
    """``docs`` (same columns) with one row of each group: the one with the smallest doc_id.

    Of rows that repeat that id the one with the smallest fingerprint stays
    (one of them, if they are equal in that too); in a group without any id,
    one of its rows. Texts are shuffled once, by id and fingerprint; only rows
    that repeat both are compared with each other.
    """
    marked = checkpoint(fingerprints(docs, shingle, ("doc_id",)))
    classes = checkpoint(_classes(marked, max_bits, bucket))
    first = hot_split_join(marked, classes, "fp", "rows").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = first.groupBy("group").agg(F.min("doc_id").alias("__id"), F.min(F.struct("fp")).alias("k"))
    counts = marked.groupBy("doc_id", "fp").agg(F.count("*").alias("__n"))
    chosen = chosen.select("__id", F.col("k.fp").alias("__fp"))
    chosen = chosen.join(counts, F.col("__id").eqNullSafe(F.col("doc_id")) & (F.col("__fp") == F.col("fp"))).select(
        "__id", "__fp", "__n")
    whole = fingerprints(docs, shingle, tuple(docs.columns), name="__own")
    stay = whole.join(chosen, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__fp")))
    single = stay.where("__n = 1")
    repeated = stay.where("__n > 1").dropDuplicates(["__id", "__own"])
    return single.unionByName(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])


def digests(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

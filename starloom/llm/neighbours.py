"""Approximate nearest neighbours by collision-counting hashing.

Measure: the largest inner product. Each vector gets one more coordinate,
sqrt(M^2 - |x|^2) with M the largest norm, and a query zero there: then the
largest inner product is the smallest distance. ``projections`` random
directions give each vector as many single numbers; a block of vectors keeps
one sorted array per direction. A query's windows in these arrays, centred on
its own numbers, grow step by step (virtual rehashing: the same arrays at a
wider radius); a vector that is in
``collide`` of all windows is a candidate. The windows grow until ``SPARE`` times k
and a share ``verify`` of the block are candidates, whose inner products are
then taken in double precision on the original vectors.

Work is dealt out as pairs of a block of vectors and a block of queries, both
of bounded size, by two small replications on block numbers; no vector passes
through the driver. The k best of each pair meet by query, after a partial
top-k in each task.

Special cases: vectors that are null, empty, all zero or hold a null or a
non-finite component, and rows with a null id, take no part; nor do vectors of
another length than the most frequent one (the longer of equally frequent).
A row is not its own neighbour: rows with the query's id are left out. Other
repeated rows are candidates each; a repeated query id is answered once, with
the largest of its vectors (as an array). Fewer candidates than k: all of
them. Ties go to the smaller id. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS = 128
#: Share of the windows that a candidate is in, and of a block that is verified.
COLLIDE, VERIFY = 0.62, 0.12
#: Candidates for each wanted neighbour, beside that share.
SPARE = 8
#: First half-width of a window, in standard deviations of the projections, and its growth.
WIDTH, GROWTH = 0.9, 1.15
#: Vectors and queries of one task, about.
BLOCK_VECTORS, BLOCK_QUERIES = 8192, 4096
SEED = 17

UNSIGNED = {2: np.uint16, 4: np.uint32}


class SortedProjections:
    """A block's vectors projected on random directions, sorted along each."""

    def __init__(self, vectors: np.ndarray, largest: float, projections: int, seed: int = SEED):
        if projections > 255:
            raise ValueError("collisions are counted in one byte")
        n, d = vectors.shape
        rng = np.random.default_rng(seed)
        self.directions = rng.standard_normal((d + 1, projections))
        rest = np.sqrt(np.maximum(largest ** 2 - (vectors ** 2).sum(1), 0))
        hashed = np.c_[vectors, rest] @ self.directions
        order = np.argsort(hashed, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(hashed, order, axis=0).T)
        self.place = np.empty((projections, n), np.int32)  # of each vector in each sorted array
        np.put_along_axis(self.place, order.T, np.arange(n, dtype=np.int32)[None, :], axis=1)
        if n < 1 << 15:
            self.place = self.place.astype(np.uint16)
        self.spread = float(hashed.std()) or 1.0
        self.size = n

    def candidates(self, queries: np.ndarray, wanted: int, collide: int):
        """For each query (number), the vectors that collide often enough: at least ``wanted``, or all."""
        centre = (queries @ self.directions[:-1]).T
        wanted, kind = min(wanted, self.size), self.place.dtype
        open_, width = np.arange(len(queries)), WIDTH * self.spread
        while len(open_):
            # the windows of all open queries at this radius
            lo = np.stack([s.searchsorted(c - width) for s, c in zip(self.sorted, centre[:, open_])], 1)
            hi = np.stack([s.searchsorted(c + width, "right") for s, c in zip(self.sorted, centre[:, open_])], 1)
            rest = []
            for q, a, length in zip(open_.tolist(), lo.astype(kind), (hi - lo).astype(kind)):
                # a vector is in a window if its place is; differences below zero wrap round to large numbers
                inside = (self.place - a[:, None]).view(UNSIGNED[kind.itemsize]) < length[:, None].view(UNSIGNED[kind.itemsize])
                often = np.flatnonzero(inside.view(np.uint8).sum(0, dtype=np.uint8) >= collide)
                if len(often) >= wanted:
                    yield q, often
                else:
                    rest.append(q)
            open_, width = np.array(rest, np.int64), width * GROWTH


def search_block(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, largest: float,
                 k: int, projections: int = PROJECTIONS, collide: float = COLLIDE, verify: float = VERIFY):
    """The k best found in a block for each query: (query_id, vec_id, score) arrays."""
    index = SortedProjections(vectors, largest, projections)
    wanted = SPARE * k + 1 + math.ceil(verify * len(ids))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for q, found in index.candidates(queries, wanted, math.ceil(collide * projections)):
        other = found[ids[found] != query_ids[q]]
        if len(other) < k and len(found) < len(ids):
            # the query's own rows filled the candidates: all others are verified
            other = np.flatnonzero(ids != query_ids[q])
        score = (vectors[other] * queries[q]).sum(1)  # row by row, so equal vectors have equal scores
        best = np.lexsort((ids[other], -score))[:k]
        out.append((np.full(len(best), query_ids[q]), ids[other][best], score[best]))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


def usable(vec_id: str = "vec_id", vector: str = "embedding") -> Column:
    """Rows that take part (whatever their length)."""
    x = F.col(vector)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(F.col(vec_id).isNotNull() & fine & F.exists(x, lambda v: v != 0), F.lit(False))


def search(embeddings: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
           block_vectors: int = BLOCK_VECTORS, block_queries: int = BLOCK_QUERIES, **how) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row for which ``is_query`` holds."""
    rows = embeddings.where(usable(vec_id, vector)).select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x"), is_query.alias("q"))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))
    sizes = rows.groupBy(F.size("x").alias("d")).agg(
        F.count("*").alias("n"), F.count(F.when(F.col("q"), 1)).alias("nq"), F.max(norm).alias("largest"))
    known = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    schema = "query_id bigint, vec_id bigint, score double"
    if known is None or not known["nq"]:
        return embeddings.sparkSession.createDataFrame([], schema).select(
            "query_id", F.lit(1).alias("rank"), "vec_id", "score")
    largest, nv = known["largest"], math.ceil(known["n"] / block_vectors)
    nq = math.ceil(known["nq"] / block_queries)
    rows = rows.where(F.size("x") == known["d"])
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # blocks by place in the input: even, whatever the ids, and the same when a task is run again
    vectors = rows.select("id", "x", F.pmod(F.monotonically_increasing_id(), F.lit(nv)).cast("int").alias("vb")).select(
        "*", every(nq).alias("qb"))
    queries = rows.where("q").groupBy("id").agg(F.max("x").alias("x")).select(
        "id", "x", F.pmod(F.xxhash64("id"), F.lit(nq)).cast("int").alias("qb")).select("*", every(nv).alias("vb"))

    def pair(vs: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        if not len(vs) or not len(qs):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"),
                                 "score": pd.Series(dtype="float64")})
        q, v, s = search_block(np.stack(vs["x"].to_numpy()), vs["id"].to_numpy(), np.stack(qs["x"].to_numpy()),
                               qs["id"].to_numpy(), largest, k, **how)
        return pd.DataFrame({"query_id": q, "vec_id": v, "score": s})

    found = vectors.groupBy("vb", "qb").cogroup(queries.groupBy("vb", "qb")).applyInPandas(pair, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Join helpers: broadcasts decided by measured bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions

# A side is broadcast explicitly when its rows measure at most this many bytes
# (see ``row_bytes``). Beyond it the join stays a shuffle join (sort-merge, or
# AQE's runtime choice from the measured size of a finished stage).
BROADCAST_BYTES = 32 * 1024 * 1024

# A frame whose exact row count was established when it was built (a
# checkpointed id table) carries it here, so later size checks need no job;
# likewise its measured bytes and its largest surrogate id.
_KNOWN_ROWS = "_starloom_rows"
_KNOWN_BYTES = "_starloom_bytes"
_KNOWN_MAX = "_starloom_max_id"
# The number of partitions that a frame's rows are dealt over, where it was chosen by their number.
_KNOWN_PARTS = "_starloom_parts"

# Rows that one task of a large join and aggregate holds: a session's number of shuffle
# partitions is fixed, and AQE joins them up to some MB of compressed rows, so that tasks
# would grow with the input.
TASK_ROWS = 1 << 19


def remember_rows(df: DataFrame, rows: int) -> DataFrame:
    setattr(df, _KNOWN_ROWS, int(rows))
    return df


def known_rows(df: DataFrame) -> int | None:
    return getattr(df, _KNOWN_ROWS, None)


def remember_bytes(df: DataFrame, size: int | None) -> DataFrame:
    if size is not None:
        setattr(df, _KNOWN_BYTES, int(size))
    return df


def known_bytes(df: DataFrame) -> int | None:
    return getattr(df, _KNOWN_BYTES, None)


def remember_max(df: DataFrame, value: int | None) -> DataFrame:
    if value is not None:
        setattr(df, _KNOWN_MAX, int(value))
    return df


def known_max(df: DataFrame) -> int | None:
    return getattr(df, _KNOWN_MAX, None)


def remember_parts(df: DataFrame, parts: int | None) -> DataFrame:
    if parts is not None:
        setattr(df, _KNOWN_PARTS, int(parts))
    return df


def known_parts(df: DataFrame) -> int | None:
    return getattr(df, _KNOWN_PARTS, None)


def parts_for(df: DataFrame, rows: int | None = None) -> int | None:
    """Partitions that give a task ``TASK_ROWS`` of the frame's rows, or None where one task
    a core holds no more. ``rows`` is their number, if the caller knows it (an upper bound
    will do); else they are counted (of a plain scan, from the files' footers)."""
    if rows is None:
        rows = known_rows(df)
    if rows is None:
        rows = df.count()
    parts, spark = -(-rows // TASK_ROWS), df.sparkSession
    return parts if parts > min(shuffle_partitions(spark), spark.sparkContext.defaultParallelism) else None


def carry_known(src: DataFrame, dst: DataFrame) -> DataFrame:
    """Copy the known row count, bytes and max id to a row-preserving projection."""
    if known_rows(src) is not None:
        remember_rows(dst, known_rows(src))
    return remember_max(remember_bytes(dst, known_bytes(src)), known_max(src))


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: 16 for each column, and those of its texts and binaries
    (nested values by their JSON text)."""
    size = F.lit(16 * len(df.columns))
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        c = F.col(f"`{f.name}`")
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            size = size + F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
    return size.cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Bytes of a frame: those it carries, else one aggregate over it (partial
    sums per task, one row to the driver)."""
    known = known_bytes(df)
    if known is None:
        known = df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()["b"]
        remember_bytes(df, known)
    return known


def is_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return max_bytes > 0 and measured_bytes(df) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES,
                       size: int | None = None) -> DataFrame:
    """Hint a broadcast only when the side measures at most ``max_bytes``."""
    remember_bytes(df, size)
    return F.broadcast(df) if is_small(df, max_bytes) else df

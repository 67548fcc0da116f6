"""Lookup tables (C1, C2): distinct values with stable dense integer ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .ids import dense_ids
from .joins import (carry_known, known_bytes, known_max, known_rows, remember_bytes, remember_max,
                    remember_rows)


def usable_value(df: DataFrame, col: str, keep: str = "nonblank") -> Column:
    """Predicate for values that may enter a lookup.

    ``nonblank``: not NULL and not whitespace-only (initial build rule).
    ``nonempty``: not NULL and not ``''`` (the incremental rule; keeps
    whitespace-only values). Non-string columns only drop NULL.
    """
    c = F.col(col)
    if not isinstance(df.schema[col].dataType, StringType):
        return c.isNotNull()
    if keep == "nonblank":
        return c.isNotNull() & (F.length(F.trim(c)) > 0)
    if keep == "nonempty":
        return c.isNotNull() & (c != F.lit(""))
    raise ValueError(f"unknown keep rule {keep!r}")


def distinct_values(df: DataFrame, src: str, desc_col: str, keep: str = "nonblank") -> DataFrame:
    """Distinct usable values of ``src`` renamed to ``desc_col``.

    ``distinct`` is a hash aggregate with map-side combine, so a value held by
    a third of all rows is reduced before the shuffle.
    """
    return (df.where(usable_value(df, src, keep))
            .select(F.col(src).alias(desc_col)).distinct())


def build_lookup(df: DataFrame, src: str, id_col: str, desc_col: str,
                 keep: str = "nonblank") -> DataFrame:
    """Distinct values of ``src`` -> ids 1..N in (binary) value order."""
    values = distinct_values(df, src, desc_col, keep)
    ided = dense_ids(values, [desc_col], id_col)
    return carry_known(ided, ided.select(id_col, desc_col))


def max_id(existing: DataFrame, id_col: str) -> int:
    """Largest id of a table, 0 when empty (``max`` of nothing is NULL).

    Id tables built by this library carry the value; others are aggregated
    (one small row reaches the driver).
    """
    known = known_max(existing)
    if known is not None:
        return known
    row = existing.agg(F.max(id_col).alias("m")).first()
    return int(row["m"]) if row and row["m"] is not None else 0


def extend_lookup(existing: DataFrame, df: DataFrame, src: str, id_col: str,
                  desc_col: str, keep: str = "nonblank") -> DataFrame:
    """Keep every existing (id, value); unseen values get max+1.. in order.

    Never renumbers or deletes, so running it twice with the same input
    changes nothing.
    """
    base = existing.select(id_col, desc_col)
    fresh = distinct_values(df, src, desc_col, keep).join(
        base.select(desc_col), desc_col, "left_anti")
    start = max_id(existing, id_col) + 1
    added = dense_ids(fresh, [desc_col], id_col, start=start,
                      id_type=existing.schema[id_col].dataType.simpleString())
    out = base.unionByName(added.select(id_col, desc_col))
    n_added, n_old = known_rows(added), known_rows(existing)
    out = remember_max(out, start - 1 + n_added)
    if known_bytes(added) is not None and known_bytes(existing) is not None:
        remember_bytes(out, known_bytes(added) + known_bytes(existing))
    return remember_rows(out, n_old + n_added) if n_old is not None else out


def build_lookups(df: DataFrame, specs: list[tuple[str, str, str]],
                  keep: str = "nonblank") -> dict[str, DataFrame]:
    """C1 for several columns in one pass: ``specs`` = (src, id_col, desc_col).

    All (lookup, value) pairs are collected with one distinct, numbered once
    by ``dense_ids`` in (lookup, value) order and renumbered per lookup from
    its first id -- one scan of the source instead of one per lookup, which
    matters when the source is a parsed text feed. Values are compared as
    strings (non-string sources are cast).
    """
    # one scan: each row yields one (lookup, value) pair per column; values
    # that may not enter their lookup become NULL and are dropped
    entries = [F.struct(F.lit(i).alias("_sl_lk"),
                        F.when(usable_value(df, src, keep), F.col(src).cast("string"))
                        .alias("_sl_v"))
               for i, (src, _, _) in enumerate(specs)]
    pairs = (df.select(F.explode(F.array(*entries)).alias("_sl_e")).select("_sl_e.*")
               .where(F.col("_sl_v").isNotNull()))
    ided = dense_ids(pairs.distinct(), ["_sl_lk", "_sl_v"], "_sl_gid", id_type="long")
    # one row per lookup: first global id and size
    bounds = {r["_sl_lk"]: (r["first"], r["n"]) for r in ided.groupBy("_sl_lk").agg(
        F.min("_sl_gid").alias("first"), F.count(F.lit(1)).alias("n")).collect()}
    out = {}
    for i, (src, id_col, desc_col) in enumerate(specs):
        first, n = bounds.get(i, (1, 0))
        table = ided.where(F.col("_sl_lk") == i).select(
            (F.col("_sl_gid") - F.lit(first - 1)).cast("int").alias(id_col),
            F.col("_sl_v").alias(desc_col))
        out[src] = remember_bytes(remember_max(remember_rows(table, n), n), known_bytes(ided))
    return out

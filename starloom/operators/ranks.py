"""Reports over the model (R1-R4): ranked groups and item measures by
number of children, plus SQL views for ad-hoc queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ids import global_rank
from .joins import broadcast_if_small, carry_known, parts_for


def rank_by(df: DataFrame, dim: Sequence[str] | str, measure: Column, how: str = "sum",
            value_name: str = "total", rank_name: str = "rnk") -> DataFrame:
    """Aggregate ``measure`` per ``dim`` and rank groups, highest first.

    ``how``: ``sum`` or ``avg`` (avg = sum/count as double, NULL if no rows).
    Rank is SQL ``rank()`` (ties share a rank, gaps follow), computed without
    a single-partition window (see ``global_rank``).
    """
    dims = [dim] if isinstance(dim, str) else list(dim)
    if how == "sum":
        grouped = df.groupBy(*dims).agg(F.sum(measure).alias(value_name))
    elif how == "avg":
        grouped = df.groupBy(*dims).agg(
            F.try_divide(F.sum(measure).cast("double"), F.count(measure).cast("double"))
            .alias(value_name))
    else:
        raise ValueError(f"unknown aggregate {how!r}")
    return global_rank(grouped, value_name, rank_name, descending=True, tiebreak=dims)


def measure_by_child_count(detail: DataFrame, bridge: DataFrame, item: str, measure: Column,
                           bridge_item: str | None = None, count_name: str = "n_children",
                           items_name: str = "n_items", avg_name: str = "avg_value") -> DataFrame:
    """How an item measure (e.g. rating) relates to its number of children
    (e.g. permissions): per child count, the number of items and the mean.

    Children are counted per item with a partial aggregate on the bridge,
    joined to the items, and regrouped by the count.
    """
    bi = bridge_item or item
    per_item = bridge.groupBy(F.col(bi).alias(item)).agg(F.count(F.lit(1)).alias(count_name))
    rows = detail.select(item, measure.alias("_sl_m")).join(per_item, item)
    return rows.groupBy(count_name).agg(
        F.count(F.lit(1)).alias(items_name),
        F.try_divide(F.sum("_sl_m").cast("double"), F.count("_sl_m").cast("double")).alias(avg_name))


def measure_by_child(detail: DataFrame, bridge: DataFrame, child: DataFrame, item: str, child_key: str,
                     measure: Column, by: Sequence[str], bridge_item: str | None = None,
                     items_name: str = "n_items", avg_name: str = "avg_value") -> DataFrame:
    """How an item measure (e.g. rating) relates to a child (e.g. one
    permission) or a group of children (its type): per value of ``by`` the
    number of items that have it and their mean. An item counts once per value.

    A child that measures small is broadcast. The pairs are dealt once, by the
    item: that serves their distinct and the join with the detail.
    """
    bi = bridge_item or item
    known = carry_known(child, child.select(child_key, *by))
    pairs = bridge.select(F.col(bi).alias(item), child_key).join(broadcast_if_small(known), child_key).select(item, *by)
    parts = parts_for(bridge)
    pairs = pairs.repartition(parts, item) if parts else pairs.repartition(item)
    one = detail.select(item, measure.alias("_sl_m"))
    rows = pairs.distinct().join(one.repartition(parts, item) if parts else one, item)
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias(items_name),
        F.try_divide(F.sum("_sl_m").cast("double"), F.count("_sl_m").cast("double")).alias(avg_name))


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> list[str]:
    """Expose lake tables to ``spark.sql`` for ad-hoc questions."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)

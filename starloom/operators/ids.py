"""Gap-free surrogate ids and global ranks without a single-partition window.

``row_number() over (order by k)`` plans ``Exchange SinglePartition``: every
row of the table goes through one task. ``dense_ids`` range-partitions its
input on the order keys, sorts each partition and writes that layout once with
a reliable ``checkpoint`` (shared storage), so a lost executor or a retried
stage re-reads exactly the same partitions and rows. Rows and bytes per
partition are counted on that copy (one small row per partition), turned into
offsets and broadcast, and each row gets ``offset(partition) + position in
partition``. There is one path for every size; AQE makes a small set one
partition.

Ids are fixed data: they never change between uses, and lookups that are
joined and extended several times are not recomputed.

Rows are ordered by the given columns; give a total order (unique keys or
explicit tiebreak columns) for reproducible ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .joins import remember_bytes, remember_max, remember_rows, row_bytes

ColumnOrName = Column | str


def _order_columns(order_by: Sequence[ColumnOrName]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def _positions(df: DataFrame, order_by: Sequence[ColumnOrName], id_col: str, start: int,
               id_type: str, num_partitions: int | None) -> DataFrame:
    """``df`` with ``id_col`` and ``_sl_pid``, the partition that holds the row."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    order = _order_columns(order_by)
    ranged = (df.repartitionByRange(num_partitions, *order) if num_partitions
              else df.repartitionByRange(*order))
    # Reliable checkpoint: the partition layout and row order become data.
    fixed = ranged.sortWithinPartitions(*order).checkpoint(eager=True)
    tagged = fixed.withColumns({
        "_sl_pid": F.spark_partition_id(),
        "_sl_row": F.monotonically_increasing_id(),
    })
    # one small row per partition reaches the driver
    counts = {r["_sl_pid"]: (r["n"], r["b"]) for r in tagged.groupBy("_sl_pid").agg(
        F.count(F.lit(1)).alias("n"), F.sum(row_bytes(fixed)).alias("b")).collect()}
    offsets, rows = [], 0
    for pid in sorted(counts):
        offsets.append((pid, rows))
        rows += counts[pid][0]
    offsets = spark.createDataFrame(offsets, "_sl_pid int, _sl_off long")
    # monotonically_increasing_id = (partition index << 33) + row in partition
    local = F.col("_sl_row") - F.shiftleft(F.col("_sl_pid").cast("long"), 33)
    new_id = (F.col("_sl_off") + local + F.lit(start)).cast(id_type)
    numbered = (tagged.join(F.broadcast(offsets), "_sl_pid")
                .withColumn(id_col, new_id).drop("_sl_row", "_sl_off"))
    known = remember_max(remember_rows(numbered, rows), start + rows - 1)
    return remember_bytes(known, sum(b for _, b in counts.values()) + 16 * rows)


def dense_ids(df: DataFrame, order_by: Sequence[ColumnOrName], id_col: str = "id",
              start: int = 1, id_type: str = "int",
              num_partitions: int | None = None) -> DataFrame:
    """Attach ``id_col`` = start, start+1, ... in ``order_by`` order.

    Ascending columns sort NULLS FIRST and descending ones NULLS LAST, as in
    Spark SQL. The result is fixed data (see the module notes) and carries
    its row count, its measured bytes and its largest id (``start + rows - 1``).
    """
    from .joins import carry_known

    numbered = _positions(df, order_by, id_col, start, id_type, num_partitions)
    return carry_known(numbered, numbered.drop("_sl_pid"))


def global_rank(df: DataFrame, value: str, rank_col: str = "rnk",
                descending: bool = True, tiebreak: Sequence[str] = (),
                rank_type: str = "int", num_partitions: int | None = None) -> DataFrame:
    """SQL ``rank()`` over the whole table ordered by ``value``.

    Positions come from the range layout of ``dense_ids``; a row's rank is the
    smallest position among rows with the same value: the smallest per
    partition and value first, then over partitions. The way back joins on
    (partition, value), so a value shared by a third of the rows stays dealt
    over the partitions that hold it.
    """
    key = F.col(value).desc() if descending else F.col(value).asc()
    ordered = _positions(df, [key, *tiebreak], "_sl_pos", 1, "long", num_partitions)
    local = ordered.groupBy("_sl_pid", value).agg(F.min("_sl_pos").alias("_sl_first"))
    firsts = local.groupBy(value).agg(F.min("_sl_first").alias("_sl_first"))
    lo, fi = local.alias("_l"), firsts.alias("_f")
    ranks = lo.join(fi, F.col(f"_l.{value}").eqNullSafe(F.col(f"_f.{value}"))).select(
        F.col("_l._sl_pid").alias("_sl_p"), F.col(f"_l.{value}").alias("_sl_v"),
        F.col("_f._sl_first").alias("_sl_first"))
    joined = ordered.join(ranks, (ordered["_sl_pid"] == ranks["_sl_p"])
                          & ordered[value].eqNullSafe(ranks["_sl_v"]))
    return joined.select(*df.columns, F.col("_sl_first").cast(rank_type).alias(rank_col))

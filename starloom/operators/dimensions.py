"""Dimensions: latest row per key (C3), build (C4), SCD1 upsert (C5), child
dimension with a parent key (C8) and its incremental extension (C9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .detail import UNKNOWN_ID, KeyMap, changed, resolve_keys
from .ids import dense_ids
from .joins import BROADCAST_BYTES, carry_known
from .lookups import max_id, usable_value
from .newest import latest_per_key


def build_dimension(df: DataFrame, key: str, attrs: Sequence[str], order: Sequence[str] | str,
                    id_col: str, keep: str = "nonblank", name: str | None = None) -> DataFrame:
    """C4: newest attributes per natural key + dense ids in key order.

    ``keep`` filters keys (see ``usable_value``; ``"notnull"`` keeps ``''``
    as the source's initial developer load did). ``name`` renames the key.
    """
    if keep == "notnull":
        src = df.where(F.col(key).isNotNull())
    else:
        src = df.where(usable_value(df, key, keep))
    latest = latest_per_key(src, key, order, attrs)
    out_key = name or key
    if out_key != key:
        latest = latest.withColumnRenamed(key, out_key)
    ided = dense_ids(latest, [out_key], id_col)
    return carry_known(ided, ided.select(id_col, out_key, *attrs))


def classify(existing: DataFrame, latest: DataFrame, key: str, attrs: Sequence[str], id_col: str,
             class_col: str = "class") -> DataFrame:
    """Both sides of an upsert in one full outer join, each row once.

    ``class_col`` is ``new`` (only in ``latest``; its id is NULL), ``changed``,
    ``same`` (both; NULL-safe compare) or ``gone`` (only in ``existing``). The
    attributes are those of ``latest`` where it has the key. Keys are unique
    on either side; a NULL key matches nothing.
    """
    t = existing.select(id_col, key, *attrs, F.lit(True).alias("_sl_old")).alias("_t")
    s = latest.select(key, *attrs, F.lit(True).alias("_sl_hit")).alias("_s")
    is_new, hit = F.col("_t._sl_old").isNull(), F.col("_s._sl_hit").isNotNull()
    differs = changed(list(attrs))
    return t.join(s, F.col(f"_t.{key}") == F.col(f"_s.{key}"), "full").select(
        F.col(f"_t.{id_col}"), F.coalesce(F.col(f"_s.{key}"), F.col(f"_t.{key}")).alias(key),
        *[F.when(hit, F.col(f"_s.{a}")).otherwise(F.col(f"_t.{a}")).alias(a) for a in attrs],
        F.when(is_new, "new").when(~hit, "gone").when(differs, "changed").otherwise("same").alias(class_col))


def upsert_dimension(existing: DataFrame, df: DataFrame, key: str, attrs: Sequence[str],
                     order: Sequence[str] | str, id_col: str, source_key: str | None = None,
                     keep: str = "nonblank", class_col: str | None = None) -> DataFrame:
    """SCD type 1.

    * key in both: same id, attributes from the newest source row
      (a change to or from NULL is a change);
    * key only in ``existing``: kept unchanged;
    * key only in the source: new id ``max(id) + 1..`` in key order.

    The two sides meet once (``classify``); that join is kept as a checkpoint,
    from which the kept rows and the new ones are taken. ``class_col`` adds
    each row's class. Running it twice with the same source gives the same table.
    """
    skey = source_key or key
    attrs = list(attrs)
    src = df.where(usable_value(df, skey, keep))
    latest = latest_per_key(src, skey, order, attrs)
    if skey != key:
        latest = latest.withColumnRenamed(skey, key)
    checkpoint_dir(existing.sparkSession)
    named = class_col or "_sl_class"
    rows = classify(existing, latest, key, attrs, id_col, named).checkpoint(eager=True)
    out = [id_col, key, *attrs, *([class_col] if class_col else [])]
    added = dense_ids(rows.where(F.col(named) == "new").drop(id_col), [key], id_col, start=max_id(existing, id_col) + 1,
                      id_type=existing.schema[id_col].dataType.simpleString())
    return rows.where(F.col(named) != "new").select(*out).unionByName(added.select(*out))


def build_child_dimension(df: DataFrame, child: str, parent: str, parent_dim: DataFrame,
                          parent_desc: str, parent_id: str, id_col: str,
                          child_name: str | None = None, unknown: int = UNKNOWN_ID,
                          broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Distinct (child, parent surrogate id) pairs with dense ids.

    The parent is resolved first, so parents without an id (NULL, blank, not
    in the dimension) are one unknown parent, and a full load keys the table
    as an incremental one does. Ids follow (child, parent value) order, the
    smallest parent value standing for the unknown ones -- a total order, so a
    child listed under two parents gets two stable, reproducible ids (the
    source ordered by the child alone, which leaves such ids to chance).
    """
    pairs = _child_pairs(df, child, parent, parent_dim, parent_desc, parent_id, unknown, broadcast_bytes)
    ided = dense_ids(pairs, [child, "_sl_parent", parent_id], id_col)
    out = ided.select(id_col, F.col(child).alias(child_name or child), parent_id)
    return carry_known(ided, out)


def _child_pairs(df: DataFrame, child: str, parent: str, parent_dim: DataFrame, parent_desc: str,
                 parent_id: str, unknown: int, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Distinct (child, parent id), with the smallest parent value as ``_sl_parent``."""
    typed = resolve_keys(df.select(child, F.col(parent).alias("_sl_parent")).distinct(),
                         [KeyMap("_sl_parent", parent_dim, parent_desc, parent_id)],
                         unknown=unknown, broadcast_bytes=broadcast_bytes)
    # NULL sorts first, as in the order of ids
    low = F.min(F.struct(F.col("_sl_parent").isNotNull().alias("v"), F.col("_sl_parent").alias("p")))
    return typed.groupBy(child, parent_id).agg(low.alias("_sl_low")).select(
        child, parent_id, F.col("_sl_low.p").alias("_sl_parent"))


def extend_child_dimension(existing: DataFrame, df: DataFrame, child: str, parent: str,
                           parent_dim: DataFrame, parent_desc: str, parent_id: str,
                           id_col: str, existing_child: str | None = None,
                           unknown: int = UNKNOWN_ID, keep_existing: bool = True) -> DataFrame:
    """Add new (child, parent) pairs to a child dimension.

    Default keeps every existing row and id; new pairs get ``max+1..`` in
    (child, parent) order. A pair is new when its (child, parent id) is not
    in ``existing``. ``keep_existing=False`` reproduces the source's
    renumbering: all incoming pairs get ``rank + max(existing id)`` and the
    existing rows are dropped (old bridge rows then dangle).
    """
    ecol = existing_child or child
    pairs = _child_pairs(df, child, parent, parent_dim, parent_desc, parent_id, unknown)
    start = max_id(existing, id_col) + 1
    id_type = existing.schema[id_col].dataType.simpleString()
    if not keep_existing:
        added = dense_ids(pairs, [child, "_sl_parent", parent_id], id_col, start=start, id_type=id_type)
        return added.select(id_col, F.col(child).alias(ecol), parent_id)
    known = existing.select(F.col(ecol).alias(child), parent_id)
    # null-safe: a NULL child already in the table is not "new" again
    fresh = pairs.join(known, pairs[child].eqNullSafe(known[child])
                       & pairs[parent_id].eqNullSafe(known[parent_id]), "left_anti")
    added = dense_ids(fresh, [child, "_sl_parent", parent_id], id_col, start=start, id_type=id_type)
    return existing.select(id_col, ecol, parent_id).unionByName(
        added.select(id_col, F.col(child).alias(ecol), parent_id))

"""The newest row of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _as_list(x: Sequence[str] | str) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def latest_per_key(df: DataFrame, key: Sequence[str] | str, order: Sequence[str] | str,
                   cols: Sequence[str], tiebreak: Sequence[str] | None = None) -> DataFrame:
    """For each key the row that is newest by ``order`` (descending).

    Equivalent to ``row_number() over (partition by key order by o1 desc,
    o2 desc, ..) = 1`` with NULL order values last. Ties are broken by
    ``tiebreak`` (default: ``cols``, descending) so the pick is reproducible.

    Implemented as ``max(struct(..))`` per key, of the order, tiebreak and other
    columns, each once: an
    aggregate with map-side partial aggregation, so a key that owns a third
    of all rows is reduced inside each map task rather than shipped to and
    sorted by a single reducer as a window would.
    """
    keys, order = _as_list(key), _as_list(order)
    cols = list(cols)
    tie = list(cols if tiebreak is None else tiebreak)
    # each column stands in the struct once, at its first place: equal up to there, it decides nothing behind it
    place = {c: f"_f{i}" for i, c in enumerate(dict.fromkeys([*order, *tie, *cols]))}
    best = df.groupBy(*keys).agg(F.max(F.struct(*[F.col(c).alias(f) for c, f in place.items()])).alias("_sl_best"))
    return best.select(*keys, *[F.col(f"_sl_best.{place[c]}").alias(c) for c in cols])

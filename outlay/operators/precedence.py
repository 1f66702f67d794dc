"""Keyed first-wins / last-wins rules (K1-K7) as aggregates.

The reference gets these from ``INSERT OR IGNORE/REPLACE`` and dict loops.
We express "the first row per key under an order" as ``min_by(row, order)``
in a ``groupBy``: the aggregate is computed partially on the map side, so a
key that holds a third of all rows is cut down to one row per map task
before the shuffle (a ``row_number`` window would sort the whole hot key in
one task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONG_MAX = 9223372036854775807


def desc_nulls_last(ts: Column) -> Column:
    """Ascending sort key equivalent to ``ts DESC NULLS LAST``."""
    return F.coalesce(-F.unix_micros(ts.try_cast("timestamp")), F.lit(LONG_MAX))


def _order_struct(order: list[Column]) -> Column:
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])


def pick_by(df: DataFrame, keys: list[str], order: list[Column], *, last: bool = False,
            keep_null_keys: bool = False) -> DataFrame:
    """One row per ``keys``: the first (or last) row under ``order``.

    ``order`` is compared as a struct, field by field, NULL lowest. With
    ``keep_null_keys`` rows whose key is NULL are all kept (a NULL primary
    key never collides), and they never enter the aggregation.
    """
    cols = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    src = df
    if keep_null_keys:
        null_key = F.lit(False)
        for k in keys:
            null_key = null_key | F.col(k).isNull()
        src = df.filter(~null_key)
    out = (
        src.groupBy(*keys)
        .agg(pick(F.struct(*cols), _order_struct(order)).alias("_row"))
        .select(*keys, "_row.*")
    )
    if keep_null_keys:
        out = out.unionByName(df.filter(null_key).select(*keys, *cols))
    return out

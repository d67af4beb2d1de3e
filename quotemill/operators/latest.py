"""First, last and latest row per key.

All of these are aggregates: rows combine before the shuffle, so a key that holds a third of the table
still reaches its final task as one row per map task. The row travels as one struct that starts with the
order columns, so rows equal in those are told apart by their other columns and the answer is fixed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], largest: bool) -> DataFrame:
    order = [o for o in order if not (isinstance(o, str) and o in keys)]
    leading = [F.col(o) if isinstance(o, str) else o.alias(f"_order{i}") for i, o in enumerate(order)]
    rest = [name for name in df.columns if name not in keys and name not in [o for o in order if isinstance(o, str)]]
    if any("map<" in kind for name, kind in df.dtypes if name in rest):  # maps have no order
        pick = F.max_by if largest else F.min_by
        best = pick(F.struct(*leading, *rest), F.struct(*leading))
    else:
        best = (F.max if largest else F.min)(F.struct(*leading, *rest))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*").select(*df.columns)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key."""
    return _pick(df, keys, order, False)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The last row of each key."""
    return _pick(df, keys, order, True)


def latest_with_smallest(
    df: DataFrame, keys: Sequence[str], newest: str, smallest: str
) -> DataFrame:
    """The newest row of each key; of several equally new ones, that with the smallest ``smallest``.

    The time is negated, since "smallest" may be a text and cannot be.
    """
    return keep_first(df, keys, [-F.unix_micros(F.col(newest).cast("timestamp")), smallest])


def old_wins(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Union in which a stored row beats a new row of the same key."""
    both = old.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)))
    return keep_first(both, keys, ["_side", *order]).drop("_side")


def append_if_absent(
    stored: DataFrame, new: DataFrame, code: str, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """New rows whose code is not stored yet, added; then the last row of each key."""
    fresh = new.join(stored.select(code).distinct(), code, "left_anti")
    both = stored.withColumn("_side", F.lit(0)).unionByName(fresh.withColumn("_side", F.lit(1)))
    return keep_last(both, keys, ["_side", *order]).drop("_side")

"""Unions of frames whose columns differ."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def common_columns(frames: Sequence[DataFrame], order: Sequence[str]) -> list[str]:
    """The columns all frames have, in the given order."""
    shared = set.intersection(*[set(frame.columns) for frame in frames])
    return [name for name in order if name in shared]


def union_common(frames: Sequence[DataFrame], order: Sequence[str]) -> DataFrame:
    """Union on the columns all frames have."""
    names = common_columns(frames, order)
    return reduce(DataFrame.unionByName, [frame.select(*names) for frame in frames])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union on all columns; missing ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def to_long(df: DataFrame, ids: Sequence[str], name: str = "item", value: str = "value") -> DataFrame:
    """Columns as rows. All of them must share a type."""
    rest = [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), rest, name, value)


def widen(df: DataFrame, ids: Sequence[str], label: str, value: str, position: str, labels: dict[str, str],
          first: bool = False) -> DataFrame:
    """Label/value rows as one wide row. Of a repeated label the last value counts, or the first."""
    pick = F.min_by if first else F.max_by
    # Rows of other labels have no position and are skipped; a null value at the picked one counts.
    cells = [
        pick(F.col(value), F.when(F.col(label) == text, F.col(position))).alias(name) for text, name in labels.items()
    ]
    return df.groupBy(*ids).agg(*cells)


def flatten_codes(nested):
    """A list of lists as one list."""
    return F.flatten(nested)

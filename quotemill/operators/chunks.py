"""Dense numbering and the ways to cut a list into chunks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.session import staged

ROWS_PER_RANGE = 1_000_000
_ROW_BITS = 33  # monotonically_increasing_id keeps the row in the low 33 bits


def dense_index(
    df: DataFrame, order: Sequence[str], out: str = "idx", partitions: int | None = None
) -> tuple[DataFrame, int]:
    """``out`` = 0..n-1 in the given total order, and n; no task sees the whole list.

    The list is written once, since finding the ranges and filling them both read it; it is cut into ranges of about
    ``ROWS_PER_RANGE`` rows, which are sorted and written with their row numbers, so that counting and numbering see the same
    ranges. Only one number per range comes to the driver.
    """
    spark = df.sparkSession
    rows = staged(df, "list")
    total = rows.count()  # from the files' footers
    count = partitions or max(1, math.ceil(total / ROWS_PER_RANGE))
    ranged = rows.repartitionByRange(count, *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    placed = staged(ranged.withColumn("_at", at), "ranges").withColumn("_part", F.shiftright("_at", _ROW_BITS))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("rows")).orderBy("_part").collect()
    offsets, start = [], 0
    for size in sizes:
        offsets.append((size["_part"], start))
        start += size["rows"]
    # One row per range, so the broadcast is bounded by the number of ranges.
    starts = spark.createDataFrame(offsets, "_part bigint, _start bigint")
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    numbered = placed.join(F.broadcast(starts), "_part").withColumn(out, F.col("_start") + row)
    return numbered.select(*df.columns, out), total


def contiguous(indexed: DataFrame, groups: int, total: int, idx: str = "idx", out: str = "chunk") -> DataFrame:
    """``groups`` runs of equal length in list order; the last may be shorter."""
    size = max(1, math.ceil(total / groups))
    return indexed.withColumn(out, F.floor(F.col(idx) / F.lit(size)).cast("int"))


def fixed(indexed: DataFrame, size: int, idx: str = "idx", out: str = "chunk") -> DataFrame:
    """Runs of ``size`` items."""
    return indexed.withColumn(out, F.floor(F.col(idx) / F.lit(size)).cast("int"))


def stride(indexed: DataFrame, groups: int, idx: str = "idx", out: str = "chunk") -> DataFrame:
    """Every ``groups``-th item together."""
    return indexed.withColumn(out, (F.col(idx) % F.lit(groups)).cast("int"))


def pages_needed(rows: Column, page_size: int = 25) -> Column:
    return F.ceil(rows / F.lit(page_size)).cast("int")


def head_and_tail(df: DataFrame, order: Sequence[str], keep: int = 5, small: int = 10) -> DataFrame:
    """The first and last ``keep`` rows, or all rows when there are no more than ``small``.

    Two top-k queries instead of a full sort; whether the table is small shows after ``small + 1`` rows.
    """
    if df.limit(small + 1).count() <= small:
        return df
    first = df.orderBy(*[F.col(name).asc() for name in order]).limit(keep)
    last = df.orderBy(*[F.col(name).desc() for name in order]).limit(keep)
    return first.unionByName(last)

"""Row filters. Plain predicates, so that they reach the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.functions import as_column
from quotemill.functions.texts import any_cell_contains


def status_is(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.where(F.col(column) == value)


def drop_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.na.drop(subset=list(columns))


def text_length(df: DataFrame, column: str, length: int) -> DataFrame:
    return df.where(F.length(column) == length)


def not_sentinel(df: DataFrame, column: str, sentinel: str) -> DataFrame:
    """Rows other than the sentinel; null is not the sentinel."""
    return df.where(~F.col(column).eqNullSafe(sentinel))


def without_phrase(df: DataFrame, columns: Sequence[str], phrase: str) -> DataFrame:
    """Drops rows in which any of the columns holds the phrase."""
    return df.where(~any_cell_contains(columns, phrase))


def nonempty_cells(df: DataFrame, cells: str = "cells") -> DataFrame:
    return df.where(F.exists(cells, lambda cell: cell != ""))


def is_fresh(as_of: str, date: str = "date", updated: str = "updated", source: str | None = None) -> Column:
    """Whether a row is of the day of ``as_of`` and was written on that day."""
    day = F.lit(as_of).cast("timestamp_ntz").cast("date")
    keep = (F.col(date).cast("date") == day) & (F.col(updated) >= day.cast("timestamp_ntz"))
    return keep if source is None else keep & (F.col("source") == source)


def fresh(df: DataFrame, as_of: str, date: str = "date", updated: str = "updated", source: str | None = None) -> DataFrame:
    """Rows of the day of ``as_of`` that were written on that day."""
    return df.where(is_fresh(as_of, date, updated, source))


def at_least(df: DataFrame, size: Column, least: int, reason: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose payload holds ``least`` entries or more, and the others with the reason."""
    enough = F.coalesce(size >= least, F.lit(False))
    return df.where(enough), df.where(~enough).withColumn("reason", F.lit(reason))


def inner_rows(df: DataFrame, row: str = "row_no", rows: str = "n_rows", head: int = 1, tail: int = 1) -> DataFrame:
    """Table rows without the header and footer rows."""
    return df.where(F.col(row).between(F.lit(head), F.col(rows) - F.lit(tail + 1)))


def in_period(values, start, end) -> Column:
    """The entries of an array within [start, end]."""
    return F.filter(as_column(values), lambda v: v.between(start, end))

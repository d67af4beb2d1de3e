"""The incremental refresh: which tickers, for which period, in which chunk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.functions.times import fetch_period
from quotemill.operators.chunks import contiguous, dense_index
from quotemill.operators.filters import fresh, is_fresh
from quotemill.operators.joins import missing


def stale_tickers(tickers: DataFrame, stored: DataFrame, as_of: str, source: str | None = "YAH") -> DataFrame:
    """Tickers without a price of the day of ``as_of`` written on that day."""
    wanted = tickers.where(F.col("ticker").isNotNull()).select("ticker").distinct()
    return missing(wanted, fresh(stored, as_of, source=source), "ticker")


def refresh_periods(tickers: DataFrame, stored: DataFrame, as_of: str, source: str | None = "YAH") -> DataFrame:
    """Stale tickers with their last stored date and the period to fetch; those up to date are left out.

    One aggregate over the stored prices gives every ticker's last date and whether it is fresh, in one scan of three columns
    beside the key; it is a partial aggregate, so a ticker that holds a third of the prices costs no more than another.
    """
    wanted = tickers.where(F.col("ticker").isNotNull()).select("ticker").distinct()
    known = stored.groupBy("ticker").agg(
        F.max("date").cast("date").alias("max_date"), F.bool_or(is_fresh(as_of, source=source)).alias("_fresh")
    )
    planned = wanted.join(known, "ticker", "left").where(~F.coalesce("_fresh", F.lit(False))).drop("_fresh")
    return planned.withColumn("period", fetch_period(F.lit(as_of).cast("timestamp_ntz"), "max_date")).where(
        F.col("period").isNotNull()
    )


def refresh_plan(tickers: DataFrame, stored: DataFrame, as_of: str, groups: int = 3, source: str | None = "YAH") -> DataFrame:
    """The periods, cut into ``groups`` chunks of equal length in ticker order."""
    indexed, total = dense_index(refresh_periods(tickers, stored, as_of, source), ["ticker"])
    return contiguous(indexed, groups, total).drop("idx")


def page_coverage(pages: DataFrame, as_of: str, enough_days: int = 5) -> DataFrame:
    """Per symbol: pages landed, pages missing in between, the newest date, and whether to go on.

    ``pages`` has one row per landed row: ticker, page, date. Another page is wanted while the newest
    date is more than ``enough_days`` old or a page in between is missing.
    """
    per_page = pages.groupBy("ticker", "page").agg(F.max("date").alias("max_date"))
    per_ticker = per_page.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("pages"),
        F.max("page").alias("last_page"),
        (F.max("page") - F.min("page") + 1 - F.count(F.lit(1))).alias("missing_pages"),
        F.max("max_date").alias("max_date"),
    )
    days = F.date_diff(F.lit(as_of).cast("date"), "max_date")
    return per_ticker.withColumn("remaining_days", days).withColumn(
        "wanted", (F.col("remaining_days") > enough_days) | (F.col("missing_pages") > 0)
    )

"""Bars on a stream of ticks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.operators.series import ohlc


def stream_bars(
    ticks: DataFrame, keys: Sequence[str], time: str, width: str, delay: str, tie: Sequence[str] = ()
) -> DataFrame:
    """Tumbling bars. The watermark bounds the state: in append mode a bar comes once, when it is
    closed; in update mode it comes again as it changes and belongs into a keyed table. ``time`` is a
    TIMESTAMP, as watermarks need it."""
    return ohlc(ticks.withWatermark(time, delay), keys, time, width, tie)


def distinct_ticks(ticks: DataFrame, time: str, delay: str, ids: Sequence[str]) -> DataFrame:
    """Ticks that come once and in time. Each row behind the watermark is dropped here and counted as such; ids that repeat
    within the watermark's reach are one tick."""
    return ticks.withWatermark(time, delay).dropDuplicates([*ids, time])


def daily_from_bars(bars: DataFrame, keys: Sequence[str], first: str = "1 day") -> DataFrame:
    """Bars of a longer width out of finished shorter ones, in the same stream: ``bars`` come with their ``window``.

    The shorter bars carry the time of their window on, so the watermark closes the longer ones as well.
    """
    longer = F.window(F.window_time("window"), first)
    days = bars.groupBy(*keys, longer.alias("_day")).agg(
        F.min_by("open", "start").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "start").alias("close"), F.sum("volume").alias("volume"), F.sum("trades").alias("trades"),
    )
    return days.withColumn("start", F.col("_day.start")).select(*keys, "start", "open", "high", "low", "close", "volume", "trades")


def stream_daily_bars(ticks: DataFrame, keys: Sequence[str], time: str, delay: str, ids: Sequence[str], width: str = "5 minutes") -> DataFrame:
    """Daily bars by way of bars of ``width``, each closed by the watermark before it goes on; append mode."""
    once = distinct_ticks(ticks, time, delay, ids)
    short = ohlc(once, keys, time, width, ids, keep_window="window")
    return daily_from_bars(short, keys)

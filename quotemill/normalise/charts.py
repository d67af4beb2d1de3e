"""Bars that arrive as parallel arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.functions import times as D
from quotemill.functions.texts import asset_flag
from quotemill.operators.columns import code_of, rename, scale, stamp
from quotemill.operators.filters import at_least
from quotemill.operators.joins import zip_arrays
from quotemill.operators.latest import keep_first, keep_last
from quotemill.schemas import CHART, FLAT_ARRAYS
from quotemill.sources.files import parsed

LEAST_BARS = 3
PRICE_UNIT = 1000.0
# Attributes of the market these prices belong to.
VIETNAM = {"iso2": "VN", "iso3": "VNM", "country": "VIETNAM", "continent": "ASIA"}


def _chart_docs(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    docs = parsed(raw, "body", CHART, "_doc").withColumn("r", F.get("_doc.chart.result", F.lit(0)))
    size = F.size(F.get(F.col("r.indicators.quote"), F.lit(0))["open"])
    return at_least(docs, size, LEAST_BARS, "too few bars")


def chart_rejects(raw: DataFrame) -> DataFrame:
    return _chart_docs(raw)[1].select("source", "symbol", "page", "reason", "body", "fetched_at")


def chart_bars(raw: DataFrame, as_of: str, interval: str = "5m", hour_adjust: float = 0, signed: bool = False) -> DataFrame:
    """Chart bodies of any interval as bars in exchange time; of a day's bars the first when daily."""
    docs, _ = _chart_docs(raw)
    quote = F.get(F.col("r.indicators.quote"), F.lit(0))
    adjusted = F.get(F.col("r.indicators.adjclose"), F.lit(0))["adjclose"]
    bars = zip_arrays(
        docs,
        {
            "t": F.col("r.timestamp"), "open": quote["open"], "high": quote["high"], "low": quote["low"],
            "close": quote["close"], "close_adj": F.coalesce(adjusted, quote["close"]), "volume": quote["volume"],
        },
        [F.coalesce(F.col("r.meta.symbol"), F.col("symbol")).alias("codesource"), F.col("r.meta.gmtoffset").alias("_off"), "page"],
    )
    local = D.zone_shift(D.epoch_seconds("t"), F.col("_off"), hour_adjust, signed)
    timed = bars.withColumn("datetime", local).select(
        "codesource", "datetime", "open", "high", "low", "close", "close_adj", "volume",
        F.lit("YAH").alias("source"), F.to_date("datetime").alias("date"), F.col("datetime").alias("timestamp"),
        "page", "pos",
    )
    if interval == "1d":
        timed = keep_first(timed, ["codesource", "date"], ["datetime", "page", "pos"])
    return stamp(timed.drop("page", "pos"), as_of)


def intraday_bars(raw: DataFrame, as_of: str, interval: str = "5m") -> DataFrame:
    """Bars as the intraday table stores them."""
    bars = rename(chart_bars(raw, as_of, interval), {"codesource": "ticker", "close_adj": "adjclose"})
    midnight = F.col("date").cast("timestamp_ntz")
    return bars.withColumn("date", midnight).select(
        "ticker", "open", "high", "low", "close", "adjclose", "volume", "date", "datetime", "timestamp", "updated"
    )


def daily_bars(raw: DataFrame, as_of: str) -> DataFrame:
    """Bars as the daily table stores them: one per day, dated midnight."""
    bars = rename(chart_bars(raw, as_of, "1d"), {"codesource": "ticker", "close_adj": "adjclose"})
    return bars.withColumn("date", F.col("date").cast("timestamp_ntz")).select(
        "ticker", "date", "open", "high", "low", "close", "volume", "source", "adjclose", "updated"
    )


def _flat_bars(raw: DataFrame) -> DataFrame:
    docs = parsed(raw, "body", FLAT_ARRAYS, "d")
    names = {"t": "t", "open": "o", "high": "h", "low": "l", "close": "c", "volume": "v"}
    bars = zip_arrays(
        docs, {name: F.col(f"d.{short}") for name, short in names.items()},
        [F.col("symbol").alias("codesource"), F.col("dataset").alias("kind"), F.col("d.s").alias("s"), "page"],
    )
    return scale(bars, ["open", "high", "low", "close"], PRICE_UNIT)


def minute_bars_local(raw: DataFrame, as_of: str) -> DataFrame:
    """Flat arrays of stocks or an index ("index" as dataset), seven hours ahead of UTC."""
    bars = _flat_bars(raw).withColumn("timestamp_vn", D.shift_hours(D.epoch_seconds("t"), 7))
    prefix = F.when(F.col("kind") == "index", F.lit("IND")).otherwise(F.lit("STKVN"))
    rows = bars.select(
        "codesource", F.concat(prefix, "codesource").alias("code"), F.col("codesource").alias("ticker"),
        F.lit("ENT").alias("source"), asset_flag("kind").alias("type"), F.to_date("timestamp_vn").alias("date"),
        D.hhmm("timestamp_vn").alias("hhmmss"), "timestamp_vn", F.date_format("timestamp_vn", D.STAMP).alias("timestamp"),
        "open", "high", "low", "close", "volume",
        *[F.lit(value).alias(name) for name, value in VIETNAM.items()],
    )
    return stamp(rows, as_of)


def minute_bars_status(raw: DataFrame, as_of: str, source: str = "VND") -> DataFrame:
    """Flat arrays that carry a status; only "ok" counts. Times stay UTC."""
    bars = _flat_bars(raw).where(F.col("s") == "ok").withColumn("_time", D.epoch_seconds("t"))
    rows = bars.select(
        F.lit(source).alias("source"), F.col("codesource").alias("ticker"), "codesource",
        code_of("STKVN", "codesource").alias("code"), F.to_date("_time").alias("date"),
        F.date_format("_time", D.STAMP).alias("timestamp"), "open", "high", "low", F.col("close").alias("last"), "volume",
    )
    return stamp(rows, as_of)


def last_minute_of_day(raw: DataFrame, as_of: str) -> DataFrame:
    """The last minute bar of each code and day."""
    bars = minute_bars_local(raw, as_of)
    order = ["timestamp_vn", "open", "high", "low", "close", "volume"]
    return keep_last(bars, ["code", "date"], order)

"""Rows that arrive as arrays of records, delimited text or label/value lists in JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.functions import numbers as N
from quotemill.functions import texts as X
from quotemill.functions import times as D
from quotemill.operators.columns import clean_key, code_of, stamp
from quotemill.operators.filters import at_least
from quotemill.operators.joins import pair_series
from quotemill.operators.latest import keep_last
from quotemill.operators.series import reference_return, return_from_reference, series_changes
from quotemill.session import staged
from quotemill.sources import lines
from quotemill.sources.files import parsed
from quotemill.sources.variants import section


# Where each family's bodies hold their records, and the fields of those.
RATIO = "array<struct<ratioCode: string, value: double>>"
SECTIONS = {
    "company info": ("$", "map<string,string>"),
    "statements": ("$", "array<map<string,string>>"),
    "shares history": ("$", "array<array<string>>"),
    "ratios": ("$.data", RATIO),
    "paged texts": (
        "$.Data.Data",
        "array<struct<Ngay: string, GiaMoCua: string, GiaCaoNhat: string, GiaThapNhat: string, GiaDieuChinh: string, "
        "GiaDongCua: string, ThayDoi: string, KhoiLuongKhopLenh: string, GiaTriKhopLenh: string>>",
    ),
    "paged numbers": (
        "$.data",
        "array<struct<date: string, open: double, high: double, low: double, close: double, change: double, "
        "pctChange: double, nmVolume: double, nmValue: double>>",
    ),
    "historical rows": (
        "$.data.tradesTable.rows", "array<struct<date: string, close: string, volume: string, open: string, high: string, low: string>>"
    ),
    "real time": ("$.data.chart", "array<struct<x: bigint, z: struct<time: string, shares: string, price: string, prevCls: string>>>"),
    "chart data": (
        "$.data.chartData",
        "struct<symbol: string, allSymbols: array<struct<name: string, shortName: string>>, "
        "priceBars: array<struct<open: string, high: string, low: string, close: string, volume: string, tradeTime: string>>>",
    ),
}


def _section(raw: DataFrame, family: str) -> DataFrame:
    return section(raw, "body", *SECTIONS[family], "_doc")


def body_rejects(raw: DataFrame, family: str) -> DataFrame:
    """Bodies of a family that cannot be read, with the reason; the normalisers give no rows for them."""
    return _section(raw, family).where(F.col("reason").isNotNull()).select("source", "symbol", "page", "reason", "body", "fetched_at")


# Company info, statements, share counts -------------------------------------------------------------


def company_info(raw: DataFrame) -> DataFrame:
    """A flat document per symbol as (symbol, key, value)."""
    pairs = _section(raw, "company info").select("symbol", F.explode("_doc").alias("key", "value"))
    return pairs.withColumn("key", clean_key(F.col("key")))


def statements(raw: DataFrame) -> DataFrame:
    """Statements of any kind (the dataset) as (ticker, dataset, index, period, value).

    The columns of a document are its periods, so documents with other periods need no other schema.
    """
    lines_ = _section(raw, "statements").select("symbol", "dataset", F.explode("_doc").alias("line"))
    cells = lines_.select(
        F.col("symbol").alias("ticker"), "dataset", F.col("line")["index"].alias("index"), F.explode("line").alias("period", "value")
    )
    return cells.where(F.col("period") != "index").withColumn("value", N.plain_number("value"))


def shares_history(raw: DataFrame) -> DataFrame:
    """(date, shares) pairs; a date that repeats keeps its last entry. Pairs without a date are of no day."""
    pairs = _section(raw, "shares history").select(F.col("symbol").alias("ticker"), "page", F.posexplode("_doc").alias("pos", "p"))
    rows = pairs.select(
        "ticker", "page", "pos", F.get("p", F.lit(0)).cast("date").alias("date"), N.plain_number(F.get("p", F.lit(1))).alias("sharesout")
    )
    return keep_last(rows.where(F.col("date").isNotNull()), ["ticker", "date"], ["page", "pos"]).drop("page", "pos")


def first_ratio(raw: DataFrame, ratio: str, outputs: list[str], trading_day: str, as_of: str) -> DataFrame:
    """The first value of a ratio in each document, under the output names; none gives no row."""
    hits = F.filter("_doc", lambda item: item["ratioCode"] == ratio)
    docs = _section(raw, "ratios").withColumn("_hits", hits).where(F.size("_hits") > 0)
    value = F.get("_hits", F.lit(0))["value"]
    rows = docs.select(
        "page", F.lit("VND").alias("source"), F.col("symbol").alias("codesource"), F.col("symbol").alias("ticker"),
        F.lit(trading_day).cast("date").alias("date"), code_of("STKVN", "symbol").alias("code"),
        *[value.alias(name) for name in outputs],
    )
    return stamp(rows, as_of)


def shares_outstanding(raw: DataFrame, trading_day: str, as_of: str) -> DataFrame:
    return first_ratio(raw, "OUTSTANDING_SHARES", ["sharesout", "shareslis"], trading_day, as_of)


def free_float(raw: DataFrame, trading_day: str, as_of: str) -> DataFrame:
    return first_ratio(raw, "FREEFLOAT", ["free_float"], trading_day, as_of)


# Daily prices ---------------------------------------------------------------------------------------

def paged_daily_text(raw: DataFrame, as_of: str, prefix: str = "STKVN") -> DataFrame:
    """Pages of texts with day-first dates and "change(percent%)"; reference and return follow.

    ``prefix`` makes the internal code: "STKVN" for shares, "IND" for an index."""
    rows = _section(raw, "paged texts").select(F.upper("symbol").alias("codesource"), F.explode("_doc").alias("d"))
    change = N.change_pct("d.ThayDoi")
    typed = rows.select(
        F.lit("CAF").alias("source"), "codesource", F.col("codesource").alias("ticker"),
        D.parse_date("d.Ngay", D.DAY_FIRST).alias("date"),
        N.plain_number("d.GiaMoCua").alias("open"), N.plain_number("d.GiaCaoNhat").alias("high"),
        N.plain_number("d.GiaThapNhat").alias("low"), N.plain_number("d.GiaDieuChinh").alias("close_adj"),
        N.plain_number("d.GiaDongCua").alias("close"), change["change"].alias("change"), change["varpc"].alias("varpc"),
        N.clean_number("d.KhoiLuongKhopLenh").alias("volume"), N.clean_number("d.GiaTriKhopLenh").alias("turnover"),
        code_of(prefix, "codesource").alias("code"),
    )
    return stamp(reference_return(typed), as_of)


def paged_daily_numbers(raw: DataFrame, as_of: str, prefix: str = "IND") -> DataFrame:
    """Pages of numbers. The return is change over reference, whatever percentage was sent."""
    rows = _section(raw, "paged numbers").select(F.upper("symbol").alias("codesource"), F.inline("_doc"))
    typed = rows.select(
        F.lit("VND").alias("source"), "codesource", F.col("codesource").alias("ticker"), F.to_date("date").alias("date"),
        "open", "high", "low", "close", "change", F.col("nmVolume").alias("volume"), F.col("nmValue").alias("turnover"),
        code_of(prefix, "codesource").alias("code"),
    )
    return stamp(reference_return(typed), as_of)


UNIT_ROWS = (
    "array<struct<symbol: string, date: string, unit: double, priceOpen: double, priceHigh: double, priceLow: double, "
    "priceClose: double, priceAverage: double, priceBasic: double, totalVolume: double, totalValue: double>>"
)


def _unit_docs(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    docs = parsed(raw, "body", UNIT_ROWS, "d")
    return at_least(docs, F.size("d"), 6, "too few rows")


def unit_rejects(raw: DataFrame) -> DataFrame:
    return _unit_docs(raw)[1].select("source", "symbol", "page", "reason", "body", "fetched_at")


def daily_with_unit(raw: DataFrame, as_of: str) -> DataFrame:
    """Rows with a price unit; a basic price of 0 is no reference. Adjusted and plain close are the same here."""
    rows = _unit_docs(raw)[0].select(F.col("symbol").alias("codesource"), F.inline("d"))
    price = lambda name: F.col("unit") * F.col(name)
    typed = rows.select(
        F.lit("FANT").alias("source"), F.col("symbol").alias("ticker"), "codesource", code_of("STKVN", "codesource").alias("code"),
        F.to_date("date").alias("date"), price("priceOpen").alias("open"), price("priceClose").alias("close_adj"),
        price("priceHigh").alias("high"), price("priceLow").alias("low"), price("priceAverage").alias("average"),
        price("priceClose").alias("close"), price("priceBasic").alias("reference"), price("priceClose").alias("close_unadj"),
        F.col("totalVolume").alias("volume"), F.col("totalValue").alias("turnover"),
    )
    return stamp(return_from_reference(typed), as_of)


def historical_rows(raw: DataFrame) -> DataFrame:
    """Rows of texts with month-first dates, "$" prices and comma volumes."""
    rows = _section(raw, "historical rows").select(F.col("symbol").alias("codesource"), F.inline("_doc"))
    return rows.select(
        "codesource", F.lit("NASDAQ").alias("source"), D.parse_date("date", D.MONTH_FIRST).alias("date"),
        *[N.dollar_number(name).alias(name) for name in ("open", "high", "low", "close")],
        N.clean_number("volume").alias("volume"),
    )


def real_time_chart(raw: DataFrame) -> DataFrame:
    """Points with millisecond times and texts."""
    points = _section(raw, "real time").select(F.col("symbol").alias("ticker"), F.inline("_doc"))
    return points.select(
        "ticker", D.epoch_millis("x").alias("timestamp"), F.col("z.time").alias("time"),
        N.clean_number("z.shares").cast("bigint").alias("shares_traded"),
        N.dollar_number("z.price").alias("close"), N.dollar_number("z.prevCls").alias("prev_close"),
    )


EOD = "codesource string, date date, open double, high double, low double, close double, volume double"


def eod_lines(raw: DataFrame) -> DataFrame:
    """The lines of a text body that belong to its symbol."""
    return lines.coded_lines(raw, [], EOD).withColumn("source", F.lit("ETFDB"))


# Boards and screeners -------------------------------------------------------------------------------


def close_board(board: DataFrame, now: str, trading_day: Column) -> DataFrame:
    """After the session the last price is the close; no volume at an unchanged price is a volume of 0."""
    done = D.after_close(F.lit(now).cast("timestamp_ntz"), trading_day)
    closed = board.withColumn("close", F.when(done, F.col("last")))
    idle = F.col("volume").isNull() & F.coalesce(F.col("close") == F.col("reference"), F.lit(False))
    return closed.withColumns({"volume": F.when(idle, F.lit(0.0)).otherwise(F.col("volume")), "date": trading_day})


def pipe_board(raw: DataFrame, now: str) -> DataFrame:
    """Pipe records whose fields are "x*value"; only three-letter tickers are shares."""
    docs = parsed(raw, "body", "arrDetailStock array<string>", "_doc")
    records = lines.pipe_records(docs, ["dataset"], "_doc.arrDetailStock")
    value = lambda place: X.extract_word(F.get("fields", F.lit(place)), 2, "*")
    board = records.select(
        F.lit("TVSI").alias("source"), F.translate(F.get("fields", F.lit(0)), '"', "").alias("ticker"),
        X.code_map("dataset", X.BOARD_CODES).alias("market"),
        N.clean_numeric(value(6), 1000).alias("reference"), N.clean_numeric(value(15), 1000).alias("change"),
        N.clean_numeric(value(17), 1000).alias("last"), N.clean_numeric(value(19), 10).alias("volume"),
    ).withColumn("code", code_of("STKVN", "ticker"))
    moment = F.lit(now).cast("timestamp_ntz")
    closed = close_board(board, now, D.last_trading_day(moment, F.hour(moment)))
    return stamp(closed.where(F.length("ticker") == 3), now)


SCREENER = (
    "symbol string, name string, last_sale string, net_change string, pct_change string, market_cap string, country string, "
    "ipo_year string, volume string, sector string, industry string"
)


def screener(raw: DataFrame) -> DataFrame:
    """A CSV screener; its title holds the trading date as "Mar 13, 2025". The return is a fraction."""
    rows = lines.csv_body(raw, ["title"], SCREENER)
    return rows.select(
        "symbol", "name", N.dollar_number("last_sale").alias("close"), N.plain_number("net_change").alias("change"),
        N.percent_fraction("pct_change").alias("rt"), N.int_or_zero("market_cap").alias("market_cap"),
        N.int_or_zero("volume").alias("volume"), F.col("ipo_year").try_cast("int").alias("ipo_year"),
        "country", "sector", "industry", D.parse_date("title", D.MONTH_NAME).alias("date"),
    )


# Comparison, chart data, listings -------------------------------------------------------------------

COMPARISON = (
    "fieldDataCollection array<struct<id: string, price: double, priceChange1Day: double, percentChange1Day: double, "
    "priceDate: string, lastUpdateISO: string>>, "
    "timeSeriesCollection struct<price: array<array<struct<dateTime: string, date: string, value: double>>>>"
)


def comparison_quotes(raw: DataFrame) -> DataFrame:
    """The quote of each security."""
    quotes = raw.select(F.inline(F.from_json("body", COMPARISON)["fieldDataCollection"]))
    updated = F.to_timestamp("lastUpdateISO").cast("timestamp_ntz")
    return quotes.select(
        F.lit("BLG").alias("source"), F.col("id").alias("codesource"), D.parse_date("priceDate", D.MONTH_FIRST).alias("date"),
        updated.alias("timestamp"), D.shift_hours(updated, 7).alias("timestampvn"), F.col("price").alias("close"),
        F.col("priceChange1Day").alias("change"), (F.col("percentChange1Day") / F.lit(100.0)).alias("var"),
    )


def comparison_series(raw: DataFrame, frequency: str = "1_DAY", day_change: bool = True) -> DataFrame:
    """Series k belongs to code k of the request ("securities" in params).

    Within a day the points have times; otherwise they are daily closes with change and return.
    """
    docs = parsed(raw, "body", COMPARISON, "_doc")
    paired = pair_series(docs, F.split(F.col("params")["securities"], ","), F.col("_doc.timeSeriesCollection.price"), ["page"])
    points = paired.select("page", "codesource", F.posexplode("series").alias("pos", "p")).select(
        "page", "codesource", "pos", "p.*"
    )
    if frequency == "1_DAY":
        clock = F.translate(F.translate("dateTime", "Z", ""), "T", " ")
        return points.select(
            "codesource", F.to_timestamp(clock).cast("timestamp_ntz").alias("timestamp"),
            D.first_ten("dateTime").alias("date"), F.col("value").alias("close"),
        )
    daily = points.select("page", "pos", "codesource", F.to_date("date").alias("date"), F.col("value").alias("close"))
    if not day_change:
        return daily.drop("page", "pos")
    order = ["date", "page", "pos"]
    points_once = staged(daily, "points")  # parsed once; dealing by ranges looks at the rows twice
    return series_changes(points_once, ["codesource"], order).drop("page", "pos")


def chart_data(raw: DataFrame) -> DataFrame:
    """Bars of a symbol; a symbol without bars keeps one row with its names."""
    docs = _section(raw, "chart data").withColumnRenamed("_doc", "c").where(F.col("c").isNotNull())
    first = F.get("c.allSymbols", F.lit(0))
    bars = docs.select(
        F.coalesce("c.symbol", F.lit("")).alias("codesource"), F.coalesce(first["name"], F.lit("")).alias("name"),
        F.coalesce(first["shortName"], F.lit("")).alias("short_name"), F.lit("CNBC").alias("source"),
        F.col("params")["timeRange"].alias("timeRange"), F.explode_outer("c.priceBars").alias("b"),
    )
    return bars.select(
        "codesource", "name", "short_name", "source", "timeRange",
        *[N.plain_number(f"b.{name}").alias(name) for name in ("open", "high", "low", "close", "volume")],
        D.parse_time("b.tradeTime", D.PACKED).alias("tradeTime"),
    )


# The fields of a listing entry and of its first quote.
LISTING_FIELDS = {
    "id": "bigint", "name": "string", "symbol": "string", "cmcRank": "int", "circulatingSupply": "double",
    "totalSupply": "double", "maxSupply": "double", "ath": "double", "atl": "double", "high24h": "double",
    "low24h": "double", "lastUpdated": "string",
}
QUOTE_FIELDS = (
    "price", "volume24h", "marketCap", "percentChange1h", "percentChange24h", "percentChange7d", "percentChange30d",
    "percentChange60d", "percentChange90d", "fullyDilluttedMarketCap", "dominance", "turnover", "ytdPriceChangePercentage",
    "percentChange1y",
)
_QUOTE = ", ".join(f"{name}: double" for name in QUOTE_FIELDS)
_ENTRY = ", ".join(f"{name}: {kind}" for name, kind in LISTING_FIELDS.items())
SECTIONS["crypto listing"] = ("$.data.cryptoCurrencyList", f"array<struct<{_ENTRY}, quotes: array<struct<{_QUOTE}>>>>")


def crypto_listing(raw: DataFrame) -> DataFrame:
    """Listing entries with their first quote flattened; entries without quotes keep nulls."""
    entries = _section(raw, "crypto listing").select(F.explode("_doc").alias("e"))
    first = F.get("e.quotes", F.lit(0))
    return entries.select(
        *[F.col(f"e.{name}").alias(name) for name in LISTING_FIELDS], *[first[name].alias(name) for name in QUOTE_FIELDS]
    )

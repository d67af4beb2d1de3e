"""Schemas of stored tables and of landed payloads. Jobs declare schemas; they never infer them."""

from __future__ import annotations

from pyspark.sql import types as T

_t = T.StringType()
_d = T.DoubleType()
_ntz = T.TimestampNTZType()


def struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def array_of(kind: T.DataType) -> T.ArrayType:
    return T.ArrayType(kind)


# What every fetch lands as; the normalisers start here.
LANDING = struct(
    source=_t, dataset=_t, symbol=_t, url=_t, title=_t, params=T.MapType(_t, _t),
    page=T.IntegerType(), fetched_at=_ntz, body=_t,
)

# Rows that could not be stored, with what they held.
REJECTS = struct(source=_t, reason=_t, body=_t, fetched_at=_ntz)

# Stored tables: schema, key, partition columns. Prices are doubles, clock times are text.
_PRICES = dict(
    ticker=_t, date=_ntz, open=_d, high=_d, low=_d, close=_d, volume=_d, source=_t, adjclose=_d, updated=_ntz
)
_METRICS = dict(marketcap=_d, rt=_d, volume=_d)
_LINKS = dict(stocks=_t, component_url=_t, country=_t, cur=_t, divyield_percent=_d, timestamp=_ntz)

STORED = {
    "web_crawl": struct(url=_t, title=_t, content=_t, crawl_date=_ntz, data_crawled=_t),
    "exchanges": struct(exchange_name=_t, exchange_desc_name=_t, country=_t, types=array_of(_t), timestamp=_ntz),
    "countries": struct(region=_t, country=_t, data_market=_t, country_flag=_t, timestamp=_ntz),
    "holidays": struct(
        exchange=_t, timezone=_t, open_time=_t, close_time=_t, regular_duration_hours=_d, holidays=array_of(_t),
        total_trading_days=T.IntegerType(), period_start_date=T.DateType(), period_end_date=T.DateType(),
        timestamp=_ntz,
    ),
    "sectors": struct(icb_code=_t, sector=_t, **_METRICS, industries=_t, **_LINKS),
    "industries": struct(icb_code=_t, industry=_t, **_METRICS, sector=_t, **_LINKS),
    "icb_components": struct(
        component_url=_t, codesource=_t, marketcap=_d, price=_d, rt=_d, volume=_d, relvolume=_t, pe=_t,
        epsdilttm=_t, epsdilgrowthttmyoy=_t, divyieldttm=_t, analystrating=_t, stock_url=_t, ticker=_t, name=_t,
        cur=_t, country=_t, dataset=_t, timestamp=_ntz,
    ),
    "all_source_prices": struct(**_PRICES),
    "day_prices": struct(**_PRICES),
    "intraday_prices": struct(
        ticker=_t, datetime=_ntz, timestamp=_ntz, date=_ntz, open=_d, high=_d, low=_d, close=_d, volume=_d,
        source=_t, adjclose=_d, updated=_ntz,
    ),
}
KEYS = {
    "web_crawl": ("url", "crawl_date"),
    "exchanges": ("exchange_name",),
    "countries": ("region", "country"),
    "holidays": ("exchange",),
    "sectors": ("country", "icb_code"),
    "industries": ("country", "icb_code"),
    "icb_components": ("codesource", "component_url"),
    "all_source_prices": ("ticker", "date"),
    "day_prices": ("ticker", "date"),
    "intraday_prices": ("ticker", "datetime"),
}

# Payload bodies, as DDL for from_json.
CHART = """
chart struct<result: array<struct<
  meta: struct<symbol: string, gmtoffset: double>,
  timestamp: array<bigint>,
  indicators: struct<
    quote: array<struct<open: array<double>, high: array<double>, low: array<double>,
                        close: array<double>, volume: array<double>>>,
    adjclose: array<struct<adjclose: array<double>>>>>>>
"""
FLAT_ARRAYS = (
    "t array<bigint>, o array<double>, h array<double>, l array<double>, c array<double>, v array<double>, s string"
)
COUNTRIES_DOC = "array<struct<region: string, countries: array<struct<country: string, data_market: string, country_flag: string>>>>"
EXCHANGES_DOC = (
    "array<struct<exchange_type: string, exchanges: array<struct<exchangeName: string, exchangeDescName: string, "
    "country: string, is_world: boolean, types: array<string>, tab: string>>>>"
)
CALENDAR_DOC = (
    "exchange string, timezone string, regular_trading_hours struct<open_time: string, close_time: string>, "
    "regular_duration_hours double, holidays array<string>, partial_trading_days array<struct<date: string, "
    "open_time: string, close_time: string, duration_hours: double>>, total_trading_days int, "
    "period struct<start_date: string, end_date: string>"
)

"""Changes, returns, first and last rows, bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotemill.operators import latest as L
from quotemill.operators import series as S
from quotemill.queries.registry import DAILY, DAILY_ORDER, TICKS, query

RANGES = 64

ORDER_SQL = "date, o, n, s, volume, close"


CHANGE_SQL = f"SELECT ticker, date, o, n, s, close, close - lag(close) OVER (PARTITION BY ticker ORDER BY {ORDER_SQL}) AS change FROM {DAILY}"


@query("day_change", CHANGE_SQL)
def day_change(t):
    known = S.difference(t.daily, ["ticker"], DAILY_ORDER)
    return known.select("ticker", "date", "o", "n", "s", "close", "change")


@query("day_change_sliced", CHANGE_SQL)
def day_change_sliced(t):
    """In many ranges, so that most of them begin within a ticker and need what earlier ranges hand on."""
    known = S.difference(t.daily, ["ticker"], DAILY_ORDER, partitions=RANGES)
    return known.select("ticker", "date", "o", "n", "s", "close", "change")


HOLED_SQL = f"(SELECT * REPLACE (CASE WHEN o % 5 > 0 THEN close END AS close) FROM {DAILY})"


PERCENT_SQL = (
    "SELECT ticker, date, o, n, s, close, f / nullif(lag(f) OVER (PARTITION BY ticker ORDER BY date, o, n, s, volume, close NULLS FIRST), 0) - 1 AS var FROM ("
    "SELECT *, last_value(close IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date, o, n, s, volume, close NULLS FIRST ROWS UNBOUNDED PRECEDING) AS f "
    f"FROM {HOLED_SQL})"
)


def _percent(t, partitions=None):
    holed = t.daily.withColumn("close", F.when(F.col("o") % 5 > 0, F.col("close")))
    known = S.percent_change(holed, ["ticker"], DAILY_ORDER, partitions=partitions)
    return known.select("ticker", "date", "o", "n", "s", "close", "var")


@query("pct_change", PERCENT_SQL)
def pct_change(t):
    return _percent(t)


@query("pct_change_sliced", PERCENT_SQL)
def pct_change_sliced(t):
    return _percent(t, RANGES)


FIRST_SQL = (
    "SELECT ticker, date, ts, price, size FROM (SELECT *, CAST(ts AS DATE) AS date, row_number() OVER "
    "(PARTITION BY ticker, CAST(ts AS DATE) ORDER BY ts{0}, event_id{0}) AS rn FROM " + TICKS + ") WHERE rn = 1"
)


@query("first_bar_per_day", FIRST_SQL.format(""))
def first_bar_per_day(t):
    bars = t.ticks.select("ticker", F.to_date("ts").alias("date"), "ts", "price", "size", "event_id")
    return L.keep_first(bars, ["ticker", "date"], ["ts", "event_id"]).drop("event_id")


@query("last_bar_per_day", FIRST_SQL.format(" DESC"))
def last_bar_per_day(t):
    bars = t.ticks.select("ticker", F.to_date("ts").alias("date"), "ts", "price", "size", "event_id")
    return L.keep_last(bars, ["ticker", "date"], ["ts", "event_id"]).drop("event_id")


@query(
    "last_per_pair",
    "SELECT o_custkey, o_orderpriority, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY o_custkey, o_orderpriority",
)
def last_per_pair(t):
    rows = t.orders.select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice")
    return L.keep_last(rows, ["o_custkey", "o_orderpriority"], ["o_orderkey"])


@query(
    "old_wins_union",
    "SELECT market, date, status, id FROM (SELECT *, row_number() OVER (PARTITION BY market, date ORDER BY side, id) AS rn FROM ("
    "SELECT o_custkey AS market, CAST(o_orderdate AS DATE) AS date, o_orderstatus AS status, o_orderkey AS id, "
    "CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS side FROM orders)) WHERE rn = 1",
)
def old_wins_union(t):
    rows = t.orders.select(
        F.col("o_custkey").alias("market"), F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("id"),
    )
    return L.old_wins(rows.where("status = 'F'"), rows.where("status <> 'F'"), ["market", "date"], ["id"])


@query(
    "first_in_tab",
    "SELECT tab, name, pos, s_suppkey FROM (SELECT s_nationkey % 5 AS tab, concat('X', s_suppkey % 40) AS name, s_suppkey AS pos, s_suppkey, "
    "row_number() OVER (PARTITION BY s_nationkey % 5, s_suppkey % 40 ORDER BY s_suppkey) AS rn FROM supplier) WHERE rn = 1",
)
def first_in_tab(t):
    rows = t.supplier.select(
        (F.col("s_nationkey") % 5).alias("tab"),
        F.concat(F.lit("X"), F.col("s_suppkey") % 40).alias("name"),
        F.col("s_suppkey").alias("pos"),
        "s_suppkey",
    )
    return L.keep_first(rows, ["tab", "name"], ["pos"])


@query(
    "reference_rt",
    f"SELECT ticker, date, o, n, s, close - change AS reference, change / nullif(close - change, 0) AS rt FROM (SELECT *, CASE WHEN o % 9 = 0 THEN close ELSE volume END AS change FROM {DAILY})",
)
def reference_rt(t):
    moved = t.daily.withColumn("change", F.when(F.col("o") % 9 == 0, F.col("close")).otherwise(F.col("volume")))
    return S.reference_return(moved).select("ticker", "date", "o", "n", "s", "reference", "rt")


@query(
    "reference_nullif",
    f"SELECT ticker, date, o, n, s, reference, close - reference AS change, 100.0::DOUBLE * (close - reference) / reference AS varpc, "
    "100.0::DOUBLE * (close - reference) / reference / 100.0::DOUBLE AS rt "
    f"FROM (SELECT *, nullif(CASE WHEN o % 4 = 0 THEN 0.0 ELSE volume END, 0) AS reference FROM {DAILY})",
)
def reference_nullif(t):
    moved = t.daily.withColumn("reference", F.when(F.col("o") % 4 == 0, F.lit(0.0)).otherwise(F.col("volume")))
    return S.return_from_reference(moved).select("ticker", "date", "o", "n", "s", "reference", "change", "varpc", "rt")


BARS_SQL = (
    "SELECT ticker, time_bucket(INTERVAL '{0}', ts) AS start, arg_min(price, (ts, event_id)) AS open, max(price) AS high, min(price) AS low, "
    "arg_max(price, (ts, event_id)) AS close, CAST(sum(size) AS BIGINT) AS volume, count(*) AS trades FROM " + TICKS + " GROUP BY ALL"
)


@query("ohlc_5m", BARS_SQL.format("5 minutes"))
def ohlc_5m(t):
    return S.ohlc(t.ticks, ["ticker"], "ts", "5 minutes", ["event_id"])


@query("ohlc_day", BARS_SQL.format("1 day"))
def ohlc_day(t):
    return S.ohlc(t.ticks, ["ticker"], "ts", "1 day", ["event_id"])


@query("sorted_bars", f"SELECT ticker, date, close, o, n, s, volume FROM {DAILY}")
def sorted_bars(t):
    return S.sorted_bars(t.daily, "ticker", *DAILY_ORDER).select("ticker", "date", "close", "o", "n", "s", "volume")


@query("range_layout", f"SELECT ticker, date, close, volume FROM {DAILY}")
def range_layout(t):
    return S.range_layout(t.daily.select("ticker", "date", "close", "volume"), "ticker", "date")

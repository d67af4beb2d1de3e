"""Pairing, lookups and existence tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotemill.operators import joins as J
from quotemill.queries.registry import TICKS, query


@query(
    "zip_bars",
    "SELECT ticker, page, pos, date_trunc('second', ts) AS time, price AS open, price AS close, size::DOUBLE AS volume FROM ("
    "SELECT *, event_id // 1000 AS page, CAST(row_number() OVER (PARTITION BY ticker, event_id // 1000 ORDER BY ts, event_id) - 1 AS INT) AS pos, "
    f"count(*) OVER (PARTITION BY ticker, event_id // 1000) AS rows FROM {TICKS}) "
    "WHERE pos < rows - CASE WHEN page % 2 = 0 THEN 1 ELSE 0 END",
)
def zip_bars(t):
    """Chart bodies with parallel arrays; on even pages the volume array is one short."""
    from quotemill.functions.times import epoch_seconds
    from quotemill.render import chart_bodies
    from quotemill.schemas import CHART

    bodies = chart_bodies(t.ticks)
    doc = bodies.select("symbol", "page", F.from_json("body", CHART)["chart"]["result"][0].alias("r"))
    quote = F.col("r.indicators.quote")[0]
    bars = J.zip_arrays(
        doc,
        {"timestamp": F.col("r.timestamp"), "open": quote["open"], "close": quote["close"], "volume": quote["volume"]},
        [F.col("symbol").alias("ticker"), F.col("page").cast("bigint").alias("page")],
    )
    return bars.select(
        "ticker", "page", "pos", epoch_seconds("timestamp").alias("time"), "open", "close", "volume"
    )


@query(
    "pair_series",
    f"SELECT event_id // 100 AS page, ticker AS codesource, ts, price FROM {TICKS}",
)
def pair_series(t):
    """Bodies with a list of codes and, at the same positions, their series."""
    page = F.floor(F.col("event_id") / 100).alias("page")
    series = t.ticks.groupBy(page, "ticker").agg(
        F.array_sort(F.collect_list(F.struct("event_id", "ts", "price"))).alias("points")
    )
    body = series.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("ticker", "points"))).alias("all"))
    paired = J.pair_series(body, F.col("all.ticker"), F.col("all.points"), ["page"])
    return paired.select("page", "codesource", F.inline("series")).drop("event_id")


@query(
    "stale_tickers",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01')",
)
def stale_tickers(t):
    fresh = t.orders.where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    return J.missing(t.customer, fresh.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey").select(
        "c_custkey", "c_name"
    )


@query(
    "missing_markets",
    "SELECT n_nationkey, n_name FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)",
)
def missing_markets(t):
    stored = t.supplier.where("s_acctbal > 9000").withColumnRenamed("s_nationkey", "n_nationkey")
    return J.missing(t.nation, stored, "n_nationkey").select("n_nationkey", "n_name")


@query(
    "skip_existing",
    "SELECT n_nationkey, n_name, CASE WHEN n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900) "
    "THEN 'skip' ELSE 'fetch' END AS action FROM nation",
)
def skip_existing(t):
    stored = t.customer.where("c_acctbal > 9900").withColumnRenamed("c_nationkey", "n_nationkey")
    skip = J.existing(t.nation, stored, "n_nationkey").withColumn("action", F.lit("skip"))
    fetch = J.missing(t.nation, stored, "n_nationkey").withColumn("action", F.lit("fetch"))
    return skip.unionByName(fetch).select("n_nationkey", "n_name", "action")


@query(
    "lookup_first",
    "SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, link FROM lineitem LEFT JOIN "
    "(SELECT p_partkey % 500 AS code, arg_min(p_name, p_partkey) AS link FROM part WHERE p_type <> 'PROMO' GROUP BY 1) ON l_partkey % 500 = code",
)
def lookup_first(t):
    dim = t.part.where("p_type <> 'PROMO'").select(
        (F.col("p_partkey") % 500).alias("code"), F.col("p_name").alias("link"), "p_partkey"
    )
    wanted = t.lineitem.withColumn("code", F.col("l_partkey") % 500)
    return J.lookup_first(wanted, dim, ["code"], ["p_partkey"]).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "link"
    )


@query(
    "vendor_codes",
    "SELECT code, source, codesource FROM (SELECT concat('STK', p_partkey) AS code, p_brand AS \"YAH\", "
    "CASE WHEN p_size % 2 = 0 THEN p_name END AS \"INV\", CASE WHEN p_size % 3 = 0 THEN '' ELSE p_type END AS \"BLG\" FROM part) "
    "UNPIVOT (codesource FOR source IN (\"YAH\", \"INV\", \"BLG\")) WHERE codesource <> ''",
)
def vendor_codes(t):
    ticker_map = t.part.select(
        F.concat(F.lit("STK"), F.col("p_partkey")).alias("code"),
        F.col("p_brand").alias("yah"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_name")).alias("inv"),
        F.when(F.col("p_size") % 3 == 0, F.lit("")).otherwise(F.col("p_type")).alias("blg"),
    )
    return J.vendor_codes(ticker_map, "code", {"YAH": "yah", "INV": "inv", "BLG": "blg"})


def _sectors_and_components(t):
    sectors = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.when(F.col("s_suppkey") % 7 == 0, F.lit("/unread/")).otherwise(F.lit("/s/")), F.col("s_suppkey")).alias("component_url"),
        F.col("n_name").alias("country"),
    )
    parsed = t.lineitem.select(
        F.concat(F.lit("/s/"), F.col("l_suppkey")).alias("component_url"),
        F.concat(F.lit("P"), F.col("l_partkey")).alias("codesource"),
        F.col("l_extendedprice").alias("price"),
    )
    return sectors, parsed


PARSED_SQL = "SELECT concat('/s/', l_suppkey) AS component_url, concat('P', l_partkey) AS codesource, l_extendedprice AS price FROM lineitem"
SECTORS_SQL = "SELECT concat(CASE WHEN s_suppkey % 7 = 0 THEN '/unread/' ELSE '/s/' END, s_suppkey) AS component_url, n_name AS country FROM supplier JOIN nation ON s_nationkey = n_nationkey"


@query(
    "expand_components",
    f"SELECT component_url, codesource, price, country FROM ({PARSED_SQL}) JOIN ({SECTORS_SQL}) USING (component_url)",
)
def expand_components(t):
    return J.expand_components(*_sectors_and_components(t))[0]


@query(
    "failed_links",
    f"SELECT component_url, country FROM ({SECTORS_SQL}) WHERE component_url NOT IN (SELECT component_url FROM ({PARSED_SQL}))",
)
def failed_links(t):
    return J.expand_components(*_sectors_and_components(t))[1]

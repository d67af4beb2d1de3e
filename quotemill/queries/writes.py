"""Appends, upserts, exports and snapshots. Tables that are written go to the shared folder and are read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.functions.times import STAMP
from quotemill.operators import stored
from quotemill.operators.latest import append_if_absent as append_absent
from quotemill.operators.bucketed import BucketedTable
from quotemill.operators.merge import KeyedTable, merge_rows, merge_sparse
from quotemill.operators.quality import cast_prices, split_rejects
from quotemill.queries.registry import DAILY, TICKS, query
from quotemill.session import scratch
from quotemill.sources.files import export_csv, read_csv_text, read_snapshot, write_snapshot
from quotemill.sources.tables import append_raw, landing, read_landing


@query(
    "raw_append",
    "SELECT concat('/o/', o_orderkey) AS url, concat('order ', o_orderkey) AS title, o_orderpriority AS body, "
    "CASE o_orderstatus WHEN 'F' THEN TIMESTAMP '2025-01-02 16:00:00' ELSE TIMESTAMP '2025-01-03 16:00:00' END AS fetched_at, "
    "CASE o_orderstatus WHEN 'F' THEN DATE '2025-01-02' ELSE DATE '2025-01-03' END AS crawl_day FROM orders",
)
def raw_append(t):
    raw = landing(
        t.orders, "TEST", F.col("o_orderstatus"), F.col("o_orderpriority"),
        url=F.concat(F.lit("/o/"), F.col("o_orderkey")), title=F.concat(F.lit("order "), F.col("o_orderkey")),
    )
    path = scratch(t.spark, "raw")
    append_raw(raw.where("dataset = 'F'"), path, "2025-01-02 16:00:00")
    append_raw(raw.where("dataset <> 'F'"), path, "2025-01-03 16:00:00")
    return read_landing(t.spark, path).select("url", "title", "body", "fetched_at", "crawl_day")


# Upserts as pure merges ---------------------------------------------------------------------------


def _exchanges(t, flag):
    return t.supplier.select(
        F.concat(F.lit("X"), F.col("s_suppkey") % 30).alias("exchange_name"),
        F.col("s_name").alias("exchange_desc_name"),
        F.col("s_nationkey").cast("string").alias("country"),
        "s_suppkey",
    ).where(flag)


@query(
    "upsert_exchanges",
    "SELECT concat('X', s_suppkey % 30) AS exchange_name, arg_max(s_name, (s_acctbal > 5000, s_suppkey)) AS exchange_desc_name, "
    "CAST(arg_max(s_nationkey, (s_acctbal > 5000, s_suppkey)) AS VARCHAR) AS country FROM supplier GROUP BY 1",
)
def upsert_exchanges(t):
    empty = _exchanges(t, F.lit(False)).drop("s_suppkey")
    first = merge_rows(empty, _exchanges(t, F.col("s_acctbal") <= 5000), ["exchange_name"], ["s_suppkey"])
    return merge_rows(first, _exchanges(t, F.col("s_acctbal") > 5000), ["exchange_name"], ["s_suppkey"])


@query(
    "upsert_countries",
    "SELECT r_name AS region, c_name AS country, CASE WHEN c_acctbal > 5000 THEN lower(n_name) ELSE n_name END AS data_market, "
    "concat('/flag/', c_custkey) AS country_flag FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)
def upsert_countries(t):
    """Customers stand for countries, keyed by region and name."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("r_name").alias("region"), F.col("c_name").alias("country"), F.col("n_name").alias("data_market"),
        F.concat(F.lit("/flag/"), F.col("c_custkey")).alias("country_flag"), "c_acctbal",
    )
    delta = rows.where("c_acctbal > 5000").withColumn("data_market", F.lower("data_market")).drop("c_acctbal")
    return merge_rows(rows.drop("c_acctbal"), delta, ["region", "country"])


PARTIAL_SQL = (
    "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'O' THEN o_totalprice WHEN o_orderkey % 4 > 0 THEN o_totalprice * 2 END AS o_totalprice, "
    "CASE WHEN o_orderstatus = 'O' THEN o_custkey END AS source FROM orders "
    "UNION ALL SELECT -1 - o_orderkey, NULL, o_totalprice, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'"
)


@query("upsert_partial", PARTIAL_SQL)
def upsert_partial(t):
    """The delta has no status column (it stays), writes nulls (they count) and adds a column and keys."""
    base = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    price = F.when(F.col("o_orderkey") % 4 > 0, F.col("o_totalprice") * 2)
    changed = t.orders.where("o_orderstatus = 'O'").select("o_orderkey", price.alias("o_totalprice"), F.col("o_custkey").alias("source"))
    added = t.orders.where("o_orderpriority = '1-URGENT'").select(
        (-1 - F.col("o_orderkey")).alias("o_orderkey"), "o_totalprice", F.col("o_custkey").alias("source")
    )
    return merge_rows(base, changed.unionByName(added), ["o_orderkey"])


@query(
    "upsert_sparse",
    "SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'X' ELSE o_orderstatus END AS o_orderstatus, "
    "CASE WHEN o_orderstatus = 'O' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice FROM orders",
)
def upsert_sparse(t):
    base = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    prices = t.orders.where("o_orderstatus = 'O'").select("o_orderkey", (-F.col("o_totalprice")).alias("o_totalprice"))
    status = t.orders.where("o_orderpriority = '5-LOW'").select("o_orderkey", F.lit("X").alias("o_orderstatus"))
    return merge_sparse(base, [prices, status], ["o_orderkey"])


LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
LWW_SQL = (
    "SELECT o_orderkey, o_orderstatus, CASE WHEN l_orderkey IS NULL THEN o_totalprice ELSE price END AS o_totalprice, o_orderdate "
    "FROM orders LEFT JOIN (SELECT l_orderkey, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_extendedprice END AS price, "
    "row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) "
    "ON l_orderkey = o_orderkey AND rn = 1"
)


def _line_delta(t):
    price = F.when(F.col("l_linenumber") != 1, F.col("l_extendedprice"))
    return t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), price.alias("o_totalprice"), *LINE_ORDER)


@query("upsert_lww", LWW_SQL)
def upsert_lww(t):
    """Many writes per key in one delta; the last one wins, null writes included."""
    base = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return merge_rows(base, _line_delta(t), ["o_orderkey"], LINE_ORDER)


@query("upsert_table", LWW_SQL.replace("o_orderdate FROM", "o_orderdate, CAST(o_orderkey // 4096 AS INT) AS bucket FROM"))
def upsert_table(t):
    """The same through a stored table: created, changed, and the same delta sent twice."""
    bucket = F.floor(F.col("o_orderkey") / 4096).cast("int").alias("bucket")
    base = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", bucket)
    table = KeyedTable(t.spark, scratch(t.spark, "orders"), base.schema, ["o_orderkey"], ["bucket"])
    table.upsert(base)
    delta = _line_delta(t).select("*", bucket)
    table.upsert(delta, LINE_ORDER)
    table.upsert(delta, LINE_ORDER)
    return table.read()


@query("upsert_bucketed", LWW_SQL)
def upsert_bucketed(t):
    """The same through a table bucketed by the key, whose stored rows no upsert shuffles."""
    base = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    table = BucketedTable(t.spark, scratch(t.spark, "orders"), base.schema, ["o_orderkey"])
    table.upsert(base)
    table.upsert(_line_delta(t), LINE_ORDER)
    table.upsert(_line_delta(t), LINE_ORDER)
    return table.read()


@query(
    "append_if_absent",
    "SELECT c_nationkey AS code, arg_max(url, (side, c_custkey)) AS url, arg_max(c_custkey, (side, c_custkey)) AS c_custkey FROM ("
    "SELECT c_nationkey, c_mktsegment AS url, c_custkey, 0 AS side FROM customer WHERE c_nationkey < 20 UNION ALL "
    "SELECT c_nationkey, c_mktsegment, c_custkey, 1 FROM customer WHERE c_nationkey >= 20) GROUP BY c_nationkey, url",
)
def append_if_absent(t):
    rows = t.customer.select(F.col("c_nationkey").alias("code"), F.col("c_mktsegment").alias("url"), "c_custkey")
    return append_absent(rows.where("code < 20"), rows, "code", ["code", "url"], ["c_custkey"])


# Casting batches ----------------------------------------------------------------------------------


def _quotes(t):
    day = F.date_format("o_orderdate", STAMP)
    return t.orders.select(
        F.concat(F.lit("C"), F.col("o_custkey")).alias("ticker"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit("not a date")).when(F.col("o_orderkey") % 10 == 1, None).otherwise(day).alias("date"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("close"),
        F.lit("YAH").alias("source"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("yesterday")).when(F.col("o_orderkey") % 7 == 1, None).otherwise(day).alias("updated"),
        "o_orderkey",
    )


@query(
    "batch_cast",
    "SELECT concat('C', o_custkey) AS ticker, o_orderdate AS date, CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS close, 'YAH' AS source, "
    "CASE WHEN o_orderkey % 7 > 1 THEN o_orderdate END AS updated, o_orderkey FROM orders WHERE o_orderkey % 10 > 1 AND o_orderkey % 7 > 0",
)
def batch_cast(t):
    return split_rejects(cast_prices(_quotes(t)))[0]


@query(
    "batch_cast_rejects",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'not a date' WHEN o_orderkey % 10 = 1 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS date, "
    "CASE WHEN o_orderkey % 10 <= 1 THEN 'bad date' ELSE 'bad updated' END AS reason FROM orders WHERE o_orderkey % 10 <= 1 OR o_orderkey % 7 = 0",
)
def batch_cast_rejects(t):
    return split_rejects(cast_prices(_quotes(t)))[1].select("o_orderkey", "date", "reason")


@query(
    "batch_cast_intraday",
    f"SELECT ticker, date_trunc('second', ts) AS datetime, date_trunc('second', ts) AS timestamp, date_trunc('day', ts) AS date, price AS close, event_id FROM {TICKS} WHERE event_id % 11 > 0",
)
def batch_cast_intraday(t):
    clock = F.date_format("ts", STAMP)
    texts = t.ticks.select(
        "ticker",
        F.when(F.col("event_id") % 11 == 0, F.lit("")).otherwise(clock).alias("datetime"),
        clock.alias("timestamp"),
        F.date_format(F.date_trunc("day", "ts"), STAMP).alias("date"),
        F.col("price").alias("close"),
        "event_id",
    )
    return split_rejects(cast_prices(texts, ("datetime", "timestamp", "date")))[0]


@query(
    "store_prices",
    "SELECT ticker, date, close, updated, (SELECT count(*) FILTER (o_orderkey % 10 > 1 AND o_orderkey % 7 > 0) FROM orders) AS ok, "
    "(SELECT count(*) FILTER (o_orderkey % 10 <= 1 OR o_orderkey % 7 = 0) FROM orders) AS failed, "
    "(SELECT count(*) FILTER (o_orderkey % 10 <= 1 OR o_orderkey % 7 = 0) FROM orders) AS rejects FROM ("
    "SELECT concat('C', o_custkey) AS ticker, o_orderdate AS date, CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS close, "
    "CASE WHEN o_orderkey % 7 > 1 THEN o_orderdate END AS updated, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn "
    "FROM orders WHERE o_orderkey % 10 > 1 AND o_orderkey % 7 > 0) WHERE rn = 1",
)
def store_prices(t):
    """Texts into the stored table, the rejects and the counts; every row carries the counts."""
    root = scratch(t.spark, "stored")
    ok, failed = stored.store_prices(t.spark, root, "all_source_prices", _quotes(t), "2025-01-02 16:00:00", ("o_orderkey",))
    rejects = stored.read_rejects(t.spark, root).count()
    return stored.read_stored(t.spark, root, "all_source_prices").select(
        "ticker", "date", "close", "updated",
        *[F.lit(n).cast("bigint").alias(name) for name, n in (("ok", ok), ("failed", failed), ("rejects", rejects))],
    )


# Files --------------------------------------------------------------------------------------------


@query("csv_export", f"SELECT ticker, date, close, volume FROM {DAILY}")
def csv_export(t):
    path = scratch(t.spark, "csv")
    export_csv(t.daily.select("ticker", "date", "close", "volume"), path)
    text = read_csv_text(t.spark, path, ["ticker", "date", "close", "volume"])
    return text.select(
        F.col("ticker").cast("bigint").alias("ticker"), F.col("date").cast("date").alias("date"),
        F.col("close").cast("double").alias("close"), F.col("volume").cast("double").alias("volume"),
    )


@query("snapshot_current", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def snapshot_current(t):
    path = scratch(t.spark, "snapshot")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    write_snapshot(rows.where("o_orderstatus IN ('O', 'P')"), path, "20250102_160000")
    write_snapshot(rows.where("o_orderstatus = 'F'"), path, "20250103_160000")
    write_snapshot(rows.where("o_orderstatus = 'nobody'"), path, "20250104_160000")
    schema = T.StructType(rows.schema.fields)
    return read_snapshot(t.spark, path, schema).select("o_orderkey", "o_totalprice")

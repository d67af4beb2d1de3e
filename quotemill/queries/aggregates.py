"""Aggregates per key, counts and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotemill.functions.numbers import clean_number
from quotemill.operators import unions as U
from quotemill.operators.aggregates import describe_numbers
from quotemill.operators.latest import latest_with_smallest
from quotemill.operators.quality import load_report as report
from quotemill.queries.registry import DAILY, query
from quotemill.sources.files import distinct_values


@query("max_date", f"SELECT ticker, max(date) AS max_date FROM {DAILY} GROUP BY ticker")
def max_date(t):
    return t.daily.groupBy("ticker").agg(F.max("date").alias("max_date"))


@query(
    "count_by_country",
    "SELECT n_name AS country, count(*) AS rows FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
)
def count_by_country(t):
    counts = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("rows"))
    return counts.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("country"), "rows"
    )


@query(
    "latest_by_title",
    "SELECT o_custkey AS title, o_orderdate AS crawl_date, concat('/o/', o_orderkey) AS url, o_orderpriority AS content FROM ("
    "SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, concat('/o/', o_orderkey)) AS rn FROM orders) WHERE rn = 1",
)
def latest_by_title(t):
    documents = t.orders.select(
        F.col("o_custkey").alias("title"),
        F.col("o_orderdate").alias("crawl_date"),
        F.concat(F.lit("/o/"), F.col("o_orderkey")).alias("url"),
        F.col("o_orderpriority").alias("content"),
    )
    return latest_with_smallest(documents, ["title"], "crawl_date", "url")


@query("distinct_tickers", "SELECT DISTINCT l_partkey AS ticker FROM lineitem WHERE l_linenumber <> 2")
def distinct_tickers(t):
    holed = t.lineitem.select(F.when(F.col("l_linenumber") != 2, F.col("l_partkey")).alias("ticker"))
    return distinct_values(holed, "ticker")


DESCRIBE_SQL = """
WITH v AS (
  SELECT 'o_totalprice' AS name, o_totalprice AS x FROM orders
  UNION ALL SELECT 'half', CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END FROM orders
), r AS (
  SELECT name, x, row_number() OVER (PARTITION BY name ORDER BY x) - 1 AS i, count(*) OVER (PARTITION BY name) AS n
  FROM v WHERE x IS NOT NULL
)
SELECT name, max(n) AS count, (SELECT count(*) FROM orders) - max(n) AS null_count, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std, min(x) AS min,
  max(CASE WHEN i = CAST(floor((n - 1) * 0.25 + 0.5) AS BIGINT) THEN x END) AS q25,
  max(CASE WHEN i = CAST(floor((n - 1) * 0.5 + 0.5) AS BIGINT) THEN x END) AS q50,
  max(CASE WHEN i = CAST(floor((n - 1) * 0.75 + 0.5) AS BIGINT) THEN x END) AS q75,
  max(x) AS max
FROM r GROUP BY name
"""


@query("describe_cols", DESCRIBE_SQL)
def describe_cols(t):
    numbers = t.orders.select("o_totalprice", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice")).alias("half"))
    return describe_numbers(numbers, ["o_totalprice", "half"])


KINDS = {"view": "view", "signup": "signup", "purchase": "purchase", "error": "error"}


@query(
    "kv_pivot",
    "SELECT user_id, "
    + ", ".join(f"arg_max(value, event_id) FILTER (event_type = '{k}') AS \"{k}\"" for k in KINDS)
    + " FROM events GROUP BY user_id",
)
def kv_pivot(t):
    return U.widen(t.events, ["user_id"], "event_type", "value", "event_id", KINDS)


@query(
    "kv_pivot_first",
    "SELECT user_id, "
    + ", ".join(f"arg_min(value, event_id) FILTER (event_type = '{k}') AS \"{k}\"" for k in KINDS)
    + " FROM events GROUP BY user_id",
)
def kv_pivot_first(t):
    return U.widen(t.events, ["user_id"], "event_type", "value", "event_id", KINDS, first=True)


@query(
    "load_report",
    "SELECT o_orderkey // 1000 AS batch, count(*) FILTER (o_orderkey % 4 <> 0) AS ok, count(*) FILTER (o_orderkey % 4 = 0) AS failed FROM orders GROUP BY 1",
)
def load_report(t):
    text = F.when(F.col("o_orderkey") % 4 == 0, F.lit("1f")).otherwise(F.format_number("o_totalprice", 2))
    cast = t.orders.select(
        F.floor(F.col("o_orderkey") / 1000).alias("batch"),
        F.when(clean_number(text).isNull(), F.lit("bad price")).alias("reason"),
    )
    return report(cast, "batch")


@query("page_max_date", f"SELECT ticker, o // 5000 AS page, max(date) AS max_date FROM {DAILY} GROUP BY ALL")
def page_max_date(t):
    return t.daily.groupBy("ticker", F.floor(F.col("o") / 5000).alias("page")).agg(F.max("date").alias("max_date"))


PRICE_ORDER = ["ticker", "date", "open", "high", "low", "close", "volume", "source", "adjclose", "updated"]


@query(
    "union_common_cols",
    "SELECT o_custkey AS ticker, CAST(o_orderdate AS DATE) AS date, o_totalprice AS close FROM orders UNION ALL "
    "SELECT l_partkey, CAST(l_shipdate AS DATE), l_extendedprice FROM lineitem",
)
def union_common_cols(t):
    a = t.orders.select(
        F.col("o_totalprice").alias("close"), F.col("o_custkey").alias("ticker"),
        F.col("o_orderdate").cast("date").alias("date"), F.col("o_orderstatus").alias("source"),
    )
    b = t.lineitem.select(
        F.col("l_partkey").alias("ticker"), F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").alias("close"), F.col("l_quantity").alias("volume"),
    )
    return U.union_common([a, b], PRICE_ORDER)


@query(
    "union_pages",
    "SELECT 1 AS page, o_orderkey AS id, o_totalprice AS price FROM orders WHERE o_orderkey % 2 = 0 UNION ALL "
    "SELECT 2, o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 2 = 1",
)
def union_pages(t):
    """Pages are rows of one landing table: one plan reads them all."""
    pages = t.orders.select(
        (F.col("o_orderkey") % 2 + 1).cast("int").alias("page"),
        F.to_json(F.array(F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price")))).alias("body"),
    )
    return pages.select("page", F.inline(F.from_json("body", "array<struct<id: bigint, price: double>>")))


STATEMENTS_SQL = (
    "SELECT 'BALANCE_SHEET' AS dataset, o_orderkey AS id, 'total' AS item, o_totalprice AS value FROM orders "
    "UNION ALL SELECT 'CASH_FLOW', l_orderkey * 10 + l_linenumber, 'price', l_extendedprice FROM lineitem "
    "UNION ALL SELECT 'CASH_FLOW', l_orderkey * 10 + l_linenumber, 'quantity', l_quantity FROM lineitem "
    "UNION ALL SELECT 'INCOME_STATEMENT', p_partkey, 'retail', p_retailprice FROM part"
)


@query("financials_union", STATEMENTS_SQL)
def financials_union(t):
    """Three statements whose columns differ, as one long table."""
    balance = t.orders.select(
        F.lit("BALANCE_SHEET").alias("dataset"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("total")
    )
    cash = t.lineitem.select(
        F.lit("CASH_FLOW").alias("dataset"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"),
    )
    income = t.part.select(
        F.lit("INCOME_STATEMENT").alias("dataset"), F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("retail")
    )
    wide = U.union_all([balance, cash, income])
    return U.to_long(wide, ["dataset", "id"]).where(F.col("value").isNotNull())


@query("flatten_codes", "SELECT event_id, 0 AS pos, user_id::VARCHAR AS code FROM events UNION ALL SELECT event_id, 1, event_type FROM events UNION ALL SELECT event_id, 2, user_id::VARCHAR FROM events")
def flatten_codes(t):
    user = F.col("user_id").cast("string")
    nested = F.array(F.array(user, F.col("event_type")), F.array(user))
    return t.events.select("event_id", F.posexplode(U.flatten_codes(nested)).alias("pos", "code"))

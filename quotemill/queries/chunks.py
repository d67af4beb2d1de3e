"""Numbering, chunks, pages and previews."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotemill.operators import chunks as K
from quotemill.queries.registry import DAILY, DAILY_ORDER, query

INDEXED_SQL = "(SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS idx, count(*) OVER () AS total FROM orders)"


def _indexed(t):
    return K.dense_index(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"])


@query("chunk_contiguous", f"SELECT o_orderkey, idx, CAST(idx // CAST(ceil(total / 3.0) AS BIGINT) AS INT) AS chunk FROM {INDEXED_SQL}")
def chunk_contiguous(t):
    indexed, total = _indexed(t)
    return K.contiguous(indexed, 3, total).select("o_orderkey", "idx", "chunk")


@query("chunk_fixed", f"SELECT o_orderkey, idx, CAST(idx // 100 AS INT) AS chunk FROM {INDEXED_SQL}")
def chunk_fixed(t):
    return K.fixed(_indexed(t)[0], 100).select("o_orderkey", "idx", "chunk")


@query("chunk_stride", f"SELECT o_orderkey, idx, CAST(idx % 3 AS INT) AS chunk FROM {INDEXED_SQL}")
def chunk_stride(t):
    return K.stride(_indexed(t)[0], 3).select("o_orderkey", "idx", "chunk")


@query(
    "page_plan",
    "SELECT n_name AS country, count(c_custkey) AS rows, CAST(ceil(count(c_custkey) / 25.0) AS INT) AS pages FROM nation "
    "LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name",
)
def page_plan(t):
    counts = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    rows = F.coalesce("n", F.lit(0).cast("bigint"))
    return t.nation.join(counts, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("n_name").alias("country"), rows.alias("rows"), K.pages_needed(rows).alias("pages")
    )


@query(
    "head_tail",
    "SELECT ticker, date, o, n, s, volume, close FROM ("
    "SELECT *, row_number() OVER (ORDER BY ticker, date, o, n, s, volume, close) AS i, count(*) OVER () AS rows FROM " + DAILY + ") "
    "WHERE rows <= 10 OR i <= 5 OR i > rows - 5",
)
def head_tail(t):
    """The preview of a table: it reads everything but returns ten rows by design."""
    return K.head_and_tail(t.daily, ["ticker", *DAILY_ORDER]).select("ticker", "date", "o", "n", "s", "volume", "close")


@query("head_tail_small", "SELECT o_orderpriority, count(*) AS orders FROM orders GROUP BY o_orderpriority")
def head_tail_small(t):
    """Five rows are no more than ten: the preview is the whole result."""
    counts = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"))
    return K.head_and_tail(counts, ["o_orderpriority"])


@query("first_quote", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice END AS price FROM orders")
def first_quote(t):
    quotes = F.when(
        F.col("o_orderkey") % 5 > 0, F.array(F.col("o_totalprice"), F.col("o_totalprice") * 2)
    ).otherwise(F.array().cast("array<double>"))
    return t.orders.select("o_orderkey", F.get(quotes, F.lit(0)).alias("price"))

"""Row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotemill.functions.numbers import clean_number
from quotemill.functions.texts import stoplist_blank
from quotemill.operators import filters as R
from quotemill.queries.registry import DAILY, TICKS, query


@query("status_ok", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def status_ok(t):
    return R.status_is(t.orders, "o_orderstatus", "O").select("o_orderkey", "o_totalprice")


@query("drop_null_date", f"SELECT ticker, date, close, o, n FROM {DAILY} WHERE n <> 3")
def drop_null_date(t):
    holed = t.daily.withColumn("date", F.when(F.col("n") != 3, F.col("date")))
    return R.drop_null(holed, "date").select("ticker", "date", "close", "o", "n")


@query(
    "parsed_only",
    "SELECT o_orderkey, o_totalprice AS last FROM orders WHERE o_orderkey % 4 <> 0",
)
def parsed_only(t):
    text = F.when(F.col("o_orderkey") % 4 == 0, F.lit("1f")).otherwise(F.format_number("o_totalprice", 2))
    parsed = t.orders.select("o_orderkey", clean_number(text).alias("last"))
    return R.drop_null(parsed, "last")


@query(
    "len3",
    "SELECT p_partkey, split_part(p_name, ' ', 1) AS word FROM part WHERE length(split_part(p_name, ' ', 1)) = 3",
)
def len3(t):
    words = t.part.select("p_partkey", F.split_part("p_name", F.lit(" "), F.lit(1)).alias("word"))
    return R.text_length(words, "word", 3)


@query(
    "sentinel_ne",
    "SELECT p_partkey, CASE WHEN p_size % 5 > 0 THEN p_type END AS theme FROM part WHERE p_size % 5 = 0 OR p_type <> 'PROMO'",
)
def sentinel_ne(t):
    themes = t.part.select("p_partkey", F.when(F.col("p_size") % 5 > 0, F.col("p_type")).alias("theme"))
    return R.not_sentinel(themes, "theme", "PROMO")


@query(
    "any_cell_contains",
    "SELECT doc_id, n_chars FROM documents WHERE NOT (contains(lower(text), 'the') OR contains(lower(lang), 'the') OR contains(lower(source), 'the'))",
)
def any_cell_contains(t):
    return R.without_phrase(t.documents, ["text", "lang", "source"], "The").select("doc_id", "n_chars")


@query(
    "fresh_tickers",
    f"SELECT DISTINCT ticker FROM {TICKS} WHERE CAST(ts AS DATE) = DATE '2024-01-15' AND kind = 'view' AND ts + INTERVAL 1 HOUR >= TIMESTAMP '2024-01-15'",
)
def fresh_tickers(t):
    stored = t.ticks.select(
        "ticker", F.col("ts").alias("date"), (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("updated"),
        F.col("kind").alias("source"),
    )
    return R.fresh(stored, "2024-01-15 18:30:00", source="view").select("ticker").distinct()


@query(
    "stoplist_blank",
    "SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'PROMO') THEN '' ELSE p_type END AS country FROM part",
)
def stoplist(t):
    names = {"SMALL": "SPOT", "PROMO": "FUTURES"}
    text = F.col("p_type")
    for kind, label in names.items():
        text = F.when(F.col("p_type") == kind, F.lit(label)).otherwise(text)
    return t.part.select("p_partkey", stoplist_blank(text).alias("country"))


@query(
    "min_payload",
    f"SELECT ticker, page, count(*) AS bars, CASE WHEN count(*) > 2 THEN 'kept' ELSE 'too short' END AS reason "
    f"FROM (SELECT ticker, event_id // 1000 AS page FROM {TICKS}) GROUP BY ALL",
)
def min_payload(t):
    pages = (
        t.ticks.groupBy("ticker", F.floor(F.col("event_id") / 1000).alias("page"))
        .agg(F.to_json(F.collect_list("price")).alias("body"))
        .withColumn("bars", F.from_json("body", "array<double>"))
    )
    kept, short = R.at_least(pages, F.size("bars"), 3, "too short")
    both = kept.withColumn("reason", F.lit("kept")).unionByName(short)
    return both.select("ticker", "page", F.size("bars").cast("bigint").alias("bars"), "reason")

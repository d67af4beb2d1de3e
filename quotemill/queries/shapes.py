"""Column names and column sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotemill.functions.times import MONTH_FIRST, parse_date
from quotemill.operators import columns as C
from quotemill.queries.registry import DAILY, query


def _odd_names(t):
    return t.orders.select(
        F.col("o_orderkey").alias("Order Key"),
        F.col("o_totalprice").alias("*Total-Price %"),
        F.col("o_orderstatus").alias("  Status "),
    )


@query(
    "clean_names",
    "SELECT o_orderkey AS orderkey, o_totalprice AS total_pricepercent_, o_orderstatus AS status FROM orders",
)
def clean_names(t):
    return C.clean_columns(_odd_names(t))


@query(
    "clean_names_drop_pct",
    "SELECT o_orderkey AS orderkey, o_totalprice AS total_price, o_orderstatus AS status FROM orders",
)
def clean_names_drop_pct(t):
    return C.clean_columns(_odd_names(t), percent="")


@query(
    "clean_names_variants",
    'SELECT o_orderkey AS "order key", o_totalprice AS "*total_price_%", o_orderstatus AS status, o_custkey AS custkey FROM orders',
)
def clean_names_variants(t):
    lower = C.lower_names(t.orders.select("o_orderkey", F.col("o_orderkey").alias(" Order Key "))).select("order key")
    snake = C.snake_names(t.orders.select(F.col("o_totalprice").alias("*Total Price %")))
    packed = C.packed_names(t.orders.select(F.col("o_custkey").alias("Cust-Key")))
    return t.orders.select(
        F.col("o_orderkey").alias(lower.columns[0]),
        F.col("o_totalprice").alias(snake.columns[0]),
        F.col("o_orderstatus").alias("status"),
        F.col("o_custkey").alias(packed.columns[0]),
    )


@query("col_order", f"SELECT ticker, date, close, volume, o, n, s FROM {DAILY}")
def col_order(t):
    return C.keys_first(t.daily, "ticker", "date")


@query("renames", f"SELECT ticker, date, close AS adjclose, volume AS turnover, o, n, s FROM {DAILY}")
def renames(t):
    return C.rename(t.daily, {"close": "adjclose", "volume": "turnover", "p/e": "pe"})


@query("tolerant_drop", f"SELECT ticker, date, close FROM {DAILY}")
def tolerant_drop(t):
    return C.drop_present(t.daily, "volume", "o", "n", "s", "index", "nextTime")


@query("dedupe_columns", "SELECT o_orderkey AS key, o_custkey AS cust, o_orderstatus AS status, o_totalprice AS price FROM orders")
def dedupe_columns(t):
    nested = t.orders.select(
        F.struct(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("cust")).alias("ids"),
        F.struct(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price")).alias("rest"),
    )
    flat = C.flatten_structs(nested)
    repeated = flat.select("*", flat["status"].alias("cust"), flat["price"].cast("string").alias("key"))
    return C.first_of_same_name(repeated)


@query(
    "code_tags",
    "SELECT p_partkey, 'VND' AS source, concat('P', p_partkey) AS codesource, concat('STKVNP', p_partkey) AS code FROM part",
)
def code_tags(t):
    named = t.part.select("p_partkey", F.concat(F.lit("P"), F.col("p_partkey")).alias("codesource"))
    return C.tag(named, source="VND", code=C.code_of("STKVN", "codesource"))


@query("audit_stamp", f"SELECT ticker, date, close, '2025-01-02 16:00:00' AS updated FROM {DAILY}")
def audit_stamp(t):
    return C.stamp(t.daily.select("ticker", "date", "close"), "2025-01-02 16:00:00")


@query(
    "ref_attrs",
    "SELECT c_custkey, c_name, n_name AS country, r_name AS continent FROM customer "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)
def ref_attrs(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"), F.col("r_name").alias("continent")
    )
    return t.customer.join(places, "c_nationkey").select("c_custkey", "c_name", "country", "continent")


@query(
    "scaled_prices",
    f"SELECT ticker, date, o, n, s, close * 1000.0::DOUBLE AS close, volume * (n * 10) AS volume FROM {DAILY}",
)
def scaled_prices(t):
    thousand = C.scale(t.daily, ["close"], 1000)
    return C.scale(thousand, ["volume"], F.col("n") * 10)


@query(
    "typed_dates",
    f"SELECT ticker, o, n, s, date, strftime(date, '%Y-%m-%d') AS day FROM {DAILY}",
)
def typed_dates(t):
    texts = t.daily.withColumn("text", F.date_format("date", "M/d/yyyy"))
    dated = texts.withColumn("date", parse_date("text", MONTH_FIRST))
    return dated.select("ticker", "o", "n", "s", "date", F.date_format("date", "yyyy-MM-dd").alias("day"))

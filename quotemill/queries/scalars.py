"""Column functions on texts rendered from whole tables; the SQL twins read the typed columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotemill.functions import numbers as N
from quotemill.functions import texts as X
from quotemill.functions import times as D
from quotemill.functions.sqlnames import register_sql_functions
from quotemill.operators.quality import clean_table, clean_to_store
from quotemill.queries.registry import query
from quotemill.session import scratch


def _key():
    return F.col("o_orderkey")


def _price():
    return F.col("o_totalprice")


def _as_text():
    return _price().cast("string")


def _commas():
    return F.format_number(_price(), 2)


def _day():
    return F.col("o_orderdate")


def variant(count: int, cases: dict[int, object], otherwise):
    """A text per row, its form chosen by the order key."""
    result = otherwise if not isinstance(otherwise, (str, type(None))) else F.lit(otherwise)
    for number, value in cases.items():
        value = F.lit(value) if isinstance(value, (str, type(None))) else value
        result = F.when(_key() % count == number, value).otherwise(result)
    return result


def texts(t, **columns):
    return t.orders.withColumns(columns)


# C1, C2, C3 ---------------------------------------------------------------------------------------

def _number_text():
    return variant(
        10,
        {0: None, 1: "", 2: "—", 3: "1d", 4: "nan", 5: F.concat(F.lit(" "), _as_text(), F.lit(" ")), 6: "1e5", 7: " 5. "},
        _commas(),
    )


NUMBER_SQL = "CASE WHEN o_orderkey % 10 <= 4 THEN NULL WHEN o_orderkey % 10 = 6 THEN 100000.0 WHEN o_orderkey % 10 = 7 THEN 5.0 ELSE o_totalprice END"


@query("clean_number", f"SELECT o_orderkey, CAST({NUMBER_SQL} AS DOUBLE) AS value FROM orders")
def clean_number(t):
    return texts(t, text=_number_text()).select("o_orderkey", N.clean_number("text").alias("value"))


@query("clean_numeric", f"SELECT o_orderkey, 1000.0::DOUBLE * CAST({NUMBER_SQL} AS DOUBLE) AS value FROM orders")
def clean_numeric(t):
    return texts(t, text=_number_text()).select("o_orderkey", N.clean_numeric("text", 1000).alias("value"))


@query(
    "clean_varpc",
    "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN -o_totalprice ELSE o_totalprice END AS varpc "
    "FROM orders",
)
def clean_varpc(t):
    text = variant(
        4,
        {0: "(n/a%)", 1: F.concat(F.lit("(-"), _commas(), F.lit("%)")), 2: F.concat(F.lit("("), _commas(), F.lit("%)"))},
        F.concat(_as_text(), F.lit("%")),
    )
    return texts(t, text=text).select("o_orderkey", N.clean_varpc("text").alias("varpc"))


# C4 -----------------------------------------------------------------------------------------------


@query(
    "extract_word",
    "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS first, o_orderstatus AS second, "
    "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS last, "
    "CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderstatus END AS starred, CAST(NULL AS VARCHAR) AS beyond FROM orders",
)
def extract_word(t):
    # An em space and a no-break space count as blanks; "*" is taken literally.
    words = F.concat(F.lit("  "), F.col("o_custkey"), F.lit("  "), F.col("o_orderstatus"), F.lit("\t"))
    tail = F.when(_key() % 3 == 0, F.lit("")).otherwise(F.translate("o_orderpriority", " ", "_"))
    starred = F.concat(F.lit("x*"), F.when(_key() % 5 == 0, F.lit("")).otherwise(F.col("o_orderstatus")), F.lit("*z"))
    return texts(t, text=F.concat(words, tail), stars=starred).select(
        "o_orderkey",
        X.extract_word("text", 1).alias("first"),
        X.extract_word("text", 2).alias("second"),
        F.translate(X.extract_word("text", 3), "_", " ").alias("last"),
        X.extract_word("stars", 2, "*").alias("starred"),
        X.extract_word("stars", 4, "*").alias("beyond"),
    )


# C5 -----------------------------------------------------------------------------------------------


@query(
    "suffix_number",
    "SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN o_totalprice * 1e3::DOUBLE WHEN 1 THEN o_totalprice * 1e6::DOUBLE "
    "WHEN 2 THEN o_totalprice * 1e9::DOUBLE WHEN 3 THEN o_totalprice * 1e12::DOUBLE WHEN 4 THEN NULL WHEN 5 THEN NULL "
    "ELSE o_totalprice END AS value FROM orders",
)
def suffix_number(t):
    units = {i: F.concat(_commas(), F.lit(unit)) for i, unit in enumerate("KMBT")}
    text = variant(7, {**units, 4: None, 5: F.concat(F.lit("B"), _as_text())}, _commas())
    return texts(t, text=text).select("o_orderkey", N.suffix_number("text").alias("value"))


# C6 -----------------------------------------------------------------------------------------------


@query(
    "money_text",
    "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN o_totalprice * 1e12::DOUBLE WHEN 1 THEN 100.0 WHEN 2 THEN -o_totalprice "
    "WHEN 3 THEN o_totalprice * 1e6::DOUBLE WHEN 4 THEN NULL ELSE o_totalprice END AS value, "
    "CASE o_orderkey % 6 WHEN 0 THEN 'USD' WHEN 1 THEN 'TWD' WHEN 2 THEN 'EUR' WHEN 3 THEN '' WHEN 4 THEN NULL ELSE '' END AS currency "
    "FROM orders",
)
def money_text(t):
    text = variant(
        6,
        {
            0: F.concat(_as_text(), F.lit(" T USD")),
            1: "100 TWD",
            2: F.concat(F.lit("−"), _commas(), F.lit(" EUR")),
            3: F.concat(_commas(), F.lit(" M")),
            4: "—",
        },
        _as_text(),
    )
    return texts(t, text=text).select("o_orderkey", N.money_text("text").alias("m")).select("o_orderkey", "m.*")


# C7–C10 -------------------------------------------------------------------------------------------


@query(
    "clean_dash",
    "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN concat('-', o_custkey) "
    "ELSE concat('—', o_custkey) END AS cleaned FROM orders",
)
def clean_dash(t):
    text = variant(
        3, {0: "—", 1: F.concat(F.lit("−"), F.col("o_custkey"))}, F.concat(F.lit("—"), F.col("o_custkey"))
    )
    return texts(t, text=text).select("o_orderkey", X.clean_dash("text").alias("cleaned"))


@query(
    "percent_fraction",
    "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN -o_totalprice / 100.0::DOUBLE ELSE o_totalprice / 100.0::DOUBLE END AS fraction, "
    "CASE o_orderkey % 3 WHEN 0 THEN 0.0 WHEN 1 THEN -o_totalprice / 100.0::DOUBLE ELSE o_totalprice / 100.0::DOUBLE END AS fraction_or_zero "
    "FROM orders",
)
def percent_fraction(t):
    text = variant(3, {0: "—", 1: F.concat(F.lit("−"), _as_text(), F.lit("%"))}, F.concat(_commas(), F.lit("%")))
    return texts(t, text=text).select(
        "o_orderkey",
        N.percent_fraction("text").alias("fraction"),
        N.percent_fraction("text", default=0).alias("fraction_or_zero"),
    )


@query(
    "price_ccy",
    "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN -o_totalprice ELSE o_totalprice END AS price, "
    "CASE o_orderkey % 4 WHEN 1 THEN 'JPY' WHEN 2 THEN 'USD' END AS currency FROM orders",
)
def price_ccy(t):
    text = variant(
        4,
        {0: "n/a", 1: F.concat(F.lit("−"), _commas(), F.lit(" JPY")), 2: F.concat(_commas(), F.lit("USD"))},
        F.concat(F.lit("~"), _commas()),
    )
    return texts(t, text=text).select("o_orderkey", N.price_ccy("text").alias("p")).select("o_orderkey", "p.*")


@query(
    "change_pct",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE -o_totalprice END AS change, "
    "CASE WHEN o_orderkey % 5 <= 1 THEN NULL ELSE o_custkey::DOUBLE END AS varpc FROM orders",
)
def change_pct(t):
    text = variant(
        5,
        {0: "n/a", 1: F.concat(F.lit("-"), _as_text())},
        F.concat(F.lit("-"), _as_text(), F.lit(" ("), F.col("o_custkey"), F.lit("%)")),
    )
    return texts(t, text=text).select("o_orderkey", N.change_pct("text").alias("c")).select("o_orderkey", "c.*")


# C11–C15 ------------------------------------------------------------------------------------------


@query(
    "first_token",
    "SELECT o_orderkey, o_orderstatus AS before_slash, o_orderpriority AS before_newline FROM orders",
)
def first_token(t):
    return texts(
        t,
        a=F.concat("o_orderstatus", F.lit("/"), "o_custkey", F.lit("/x")),
        b=F.concat("o_orderpriority", F.lit("\nmore\nlines")),
    ).select("o_orderkey", X.first_token("a", "/").alias("before_slash"), X.first_token("b", "\n").alias("before_newline"))


@query("dollar_text", "SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice END AS value FROM orders")
def dollar_text(t):
    text = variant(6, {0: "N/A"}, F.concat(F.lit("$"), _commas()))
    return texts(t, text=text).select("o_orderkey", N.dollar_number("text").alias("value"))


@query(
    "int_or_zero",
    "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 0 ELSE CAST(trunc(o_totalprice) AS BIGINT) END AS value FROM orders",
)
def int_or_zero(t):
    text = variant(4, {0: None, 1: "n/a"}, _as_text())
    return texts(t, text=text).select("o_orderkey", N.int_or_zero("text").alias("value"))


@query(
    "fixed_decimals",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 THEN printf('%.2f', o_totalprice) END AS text FROM orders",
)
def fixed_decimals(t):
    number = F.when(_key() % 4 > 0, _price())
    return t.orders.select("o_orderkey", N.fixed_decimals(number, 2).alias("text"))


@query(
    "symbol_split",
    "SELECT o_orderkey, concat('T', o_custkey) AS ticker, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END AS name FROM orders",
)
def symbol_split(t):
    ticker = F.concat(F.lit("T"), F.col("o_custkey"))
    text = variant(3, {0: ticker}, F.concat(ticker, F.lit("\n"), F.col("o_orderpriority")))
    return texts(t, text=text).select("o_orderkey", X.symbol_split("text").alias("s")).select("o_orderkey", "s.*")


# C16–C18 ------------------------------------------------------------------------------------------


@query(
    "country_key",
    "SELECT c_custkey, concat('nation_', c_nationkey, '_', lower(c_mktsegment), '_new_area') AS country_key, "
    "concat('nation_', c_nationkey, '-(', lower(c_mktsegment), ')-new-area') AS slug FROM customer",
)
def country_key(t):
    label = F.concat(F.lit("NATION_"), F.col("c_nationkey"), F.lit(" ("), F.col("c_mktsegment"), F.lit(") New-Area"))
    return t.customer.select("c_custkey", X.country_key(label).alias("country_key"), X.country_slug(label).alias("slug"))


@query(
    "code_map",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'UPC' ELSE 'HNX' END AS board, "
    "CASE o_orderstatus WHEN 'P' THEN 'HSX' WHEN 'F' THEN 'HNX' ELSE 'UPC' END AS exchange, "
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'World Indices' WHEN '2-HIGH' THEN 'S&P 500' ELSE 'Unknown' END AS tab FROM orders",
)
def code_map(t):
    board = F.when(F.col("o_orderstatus") == "P", F.lit("UPCOM")).otherwise(F.lit("HNX"))
    market = F.when(F.col("o_orderstatus") == "P", F.lit("hose")).when(F.col("o_orderstatus") == "F", F.lit("hnx"))
    tab = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("major")).when(
        F.col("o_orderpriority") == "2-HIGH", F.lit("snp")
    ).otherwise(F.col("o_orderpriority"))
    return texts(t, b=board, m=F.coalesce(market, F.lit("upcom")), q=tab).select(
        "o_orderkey",
        X.code_map("b", X.BOARD_CODES).alias("board"),
        X.code_map("m", X.EXCHANGE_CODES, X.EXCHANGE_CODE_ELSE).alias("exchange"),
        X.code_map("q", X.TAB_TITLES, "Unknown").alias("tab"),
    )


@query("ascii_only", r"SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]+', '', 'g') AS text FROM documents")
def ascii_only(t):
    return t.documents.select("doc_id", X.ascii_only("text").alias("text"))


# C19–C23 ------------------------------------------------------------------------------------------


@query(
    "epoch_time",
    "SELECT event_id, date_trunc('second', ts) AS from_seconds, date_trunc('millisecond', ts) AS from_millis FROM events",
)
def epoch_time(t):
    zoned = F.col("ts").cast("timestamp")
    return t.events.select("event_id", F.unix_seconds(zoned).alias("s"), F.unix_millis(zoned).alias("ms")).select(
        "event_id", D.epoch_seconds("s").alias("from_seconds"), D.epoch_millis("ms").alias("from_millis")
    )


OFFSETS = {"view": 19800, "signup": -18000, "purchase": 0, "error": 25200}


@query(
    "zone_shift",
    "SELECT event_id, ts + CASE event_type WHEN 'view' THEN INTERVAL 19800 SECOND WHEN 'error' THEN INTERVAL 25200 SECOND "
    "ELSE INTERVAL 0 SECOND END AS local, "
    "ts + CASE event_type WHEN 'view' THEN INTERVAL 19800 SECOND WHEN 'error' THEN INTERVAL 25200 SECOND "
    "WHEN 'signup' THEN -INTERVAL 18000 SECOND ELSE INTERVAL 0 SECOND END AS local_signed, ts + INTERVAL 7 HOUR AS plus_seven FROM events",
)
def zone_shift(t):
    offset = F.lit(None).cast("double")
    for kind, seconds in OFFSETS.items():
        offset = F.when(F.col("event_type") == kind, F.lit(float(seconds))).otherwise(offset)
    return t.events.withColumn("offset", offset).select(
        "event_id",
        D.zone_shift("ts", "offset").alias("local"),
        D.zone_shift("ts", "offset", signed=True).alias("local_signed"),
        D.shift_hours("ts", 7).alias("plus_seven"),
    )


@query(
    "std_datetime",
    "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') END AS text, "
    "CASE WHEN event_id % 7 = 0 THEN NULL ELSE date_trunc('second', ts) END AS time FROM events",
)
def std_datetime(t):
    text = F.when(F.col("event_id") % 7 == 0, F.lit("not a date")).otherwise(F.date_format("ts", D.STAMP))
    return t.events.withColumn("text", text).select(
        "event_id",
        D.standardize_datetime("text", zone="Asia/Ho_Chi_Minh").alias("text"),
        D.standardize_datetime("text", pattern=None).alias("time"),
    )


@query(
    "std_date",
    "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-01') WHEN 1 THEN 'not a date' "
    "ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date FROM orders",
)
def std_date(t):
    day = F.date_format(_day(), D.ISO_DAY)
    text = variant(
        4, {0: F.date_format(_day(), "yyyy-MM"), 1: "not a date", 2: F.concat(F.lit("  "), day, F.lit(" "))}, day
    )
    return texts(t, text=text).select("o_orderkey", D.standardize_date("text").alias("date"))


@query(
    "date_patterns",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day_first, CAST(o_orderdate AS DATE) AS month_first, "
    "CASE WHEN o_orderkey % 9 > 0 THEN CAST(o_orderdate AS DATE) END AS month_name, "
    "o_orderdate + INTERVAL 34200 SECOND AS packed, o_orderdate AS stamp FROM orders",
)
def date_patterns(t):
    name = F.when(_key() % 9 == 0, F.lit("not a date")).otherwise(F.date_format(_day(), "MMM d, yyyy"))
    short = F.when(_key() % 2 == 0, F.date_format(_day(), "M/d/yyyy")).otherwise(F.date_format(_day(), "MM/dd/yyyy"))
    return texts(
        t, a=F.date_format(_day(), "dd/MM/yyyy"), b=short, c=name,
        d=F.date_format(D.shift_seconds(_day(), F.lit(34200)), D.PACKED), e=F.date_format(_day(), D.STAMP),
    ).select(
        "o_orderkey",
        D.parse_date("a", D.DAY_FIRST).alias("day_first"),
        D.parse_date("b", D.MONTH_FIRST).alias("month_first"),
        D.parse_date("c", D.MONTH_NAME).alias("month_name"),
        D.parse_time("d", D.PACKED).alias("packed"),
        D.parse_time("e", D.STAMP).alias("stamp"),
    )


# C24–C28 ------------------------------------------------------------------------------------------


@query(
    "long_date",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 8 > 0 THEN CAST(o_orderdate AS DATE) END AS date FROM orders",
)
def long_date(t):
    text = variant(8, {0: "to be announced"}, F.date_format(_day(), "EEEE, MMMM d, yyyy"))
    return texts(t, text=text).select("o_orderkey", D.long_date("text").alias("date"))


@query("clock24", "SELECT event_id, strftime(ts, '%H:%M') AS upper_text, strftime(ts, '%H:%M') AS lower_text FROM events")
def clock24(t):
    twelve = F.date_format("ts", "h:mm a")
    return t.events.withColumns({"u": F.upper(twelve), "l": F.lower(twelve)}).select(
        "event_id", D.clock24("u").alias("upper_text"), D.clock24("l").alias("lower_text")
    )


@query(
    "session_text",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE strftime(ts, '%H:%M') END AS open_local, "
    "CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN '16:00' ELSE '11:30' END AS close_local, "
    "CASE WHEN event_type = 'error' THEN NULL ELSE concat('Zone/', user_id) END AS timezone FROM events",
)
def session_text(t):
    opening = F.lower(F.date_format("ts", "h:mm a"))
    zone = F.concat(F.lit(" (Zone/"), F.col("user_id"), F.lit(")"))
    text = (
        F.when(F.col("event_type") == "error", F.lit("closed"))
        .when(F.col("event_type") == "view", F.concat(opening, F.lit(" - 11:30 am, 1:00 pm - 4:00 pm"), zone))
        .otherwise(F.concat(opening, F.lit(" - 11:30 am"), zone))
    )
    return t.events.withColumn("text", text).select("event_id", D.session_text("text").alias("s")).select("event_id", "s.*")


@query(
    "date_parts",
    "SELECT event_id, CAST(ts AS DATE) AS date, strftime(ts, '%H:%M') AS hhmm, strftime(ts, '%Y-%m-%d') AS ten FROM events",
)
def date_parts(t):
    return t.events.select(
        "event_id", F.to_date("ts").alias("date"), D.hhmm("ts").alias("hhmm"), D.first_ten("ts").alias("ten")
    )


LAST_DAY_SQL = (
    "CASE WHEN 15 < hour(ts) THEN CAST(ts AS DATE) - 1 - CASE isodow(CAST(ts AS DATE) - 1) WHEN 6 THEN 1 WHEN 7 THEN 2 ELSE 0 END "
    "ELSE CAST(ts AS DATE) + CASE isodow(ts) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END END"
)


@query("last_trading_day", f"SELECT event_id, CAST({LAST_DAY_SQL} AS DATE) AS trading_day FROM events")
def last_trading_day(t):
    return t.events.select("event_id", D.last_trading_day("ts", 15).alias("trading_day"))


# C29–C35 ------------------------------------------------------------------------------------------

PERIOD_SQL = (
    "CASE WHEN max_date IS NULL THEN 'max' WHEN days <= 0 THEN NULL WHEN days <= 1 THEN '1d' WHEN days <= 5 THEN '5d' "
    "WHEN days <= 30 THEN '1mo' WHEN days <= 90 THEN '3mo' WHEN days <= 180 THEN '6mo' WHEN days <= 365 THEN '1y' "
    "WHEN days <= 730 THEN '2y' WHEN days <= 1825 THEN '5y' WHEN days <= 3650 THEN '10y' ELSE 'max' END"
)


@query(
    "fetch_period",
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {PERIOD_SQL} AS period FROM (SELECT *, CAST(CASE WHEN l_linenumber = 7 "
    "THEN NULL ELSE l_shipdate END AS DATE) AS max_date, date_diff('day', CAST(l_shipdate AS DATE), DATE '2001-06-30') AS days FROM lineitem)",
)
def fetch_period(t):
    stored = F.when(F.col("l_linenumber") != 7, F.col("l_shipdate").cast("date"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        D.fetch_period(F.lit("2001-06-30"), stored).alias("period"),
    )


@query("asset_flag", "SELECT event_id, CASE event_type WHEN 'view' THEN 'IND' ELSE 'STK' END AS type FROM events")
def asset_flag(t):
    kind = F.when(F.col("event_type") == "view", F.lit("index")).otherwise(F.lit("stock"))
    return t.events.select("event_id", X.asset_flag(kind).alias("type"))


BOARD_SQL = (
    "SELECT o_orderkey, o_totalprice AS last, CASE WHEN o_custkey % 2 = 0 THEN o_totalprice ELSE o_totalprice + 1 END AS reference, "
    "CASE WHEN o_custkey % 3 > 0 THEN o_custkey::DOUBLE END AS volume, "
    "o_orderdate + to_seconds(o_orderkey % 24 * 3600 + 2700) AS now FROM orders"
)


@query(
    "after_close",
    "SELECT o_orderkey, CASE WHEN done THEN last END AS close, CASE WHEN done AND volume IS NULL AND last = reference THEN 0.0 ELSE volume END AS volume "
    "FROM (SELECT *, strftime(now, '%H:%M') >= '15:45' OR CAST(now AS DATE) > CAST("
    + LAST_DAY_SQL.replace("ts", "now").replace("15 < hour", "hour(now) < hour")
    + f" AS DATE) AS done FROM ({BOARD_SQL}))",
)
def after_close(t):
    board = t.orders.select(
        "o_orderkey",
        _price().alias("last"),
        F.when(F.col("o_custkey") % 2 == 0, _price()).otherwise(_price() + 1).alias("reference"),
        F.when(F.col("o_custkey") % 3 > 0, F.col("o_custkey").cast("double")).alias("volume"),
        D.shift_seconds(_day(), _key() % 24 * 3600 + 2700).alias("now"),
    )
    done = D.after_close("now", D.last_trading_day("now", F.hour("now")))
    closed = board.withColumn("close", F.when(done, F.col("last")))
    idle = F.col("volume").isNull() & F.coalesce(F.col("close") == F.col("reference"), F.lit(False))
    return closed.select("o_orderkey", "close", F.when(idle, F.lit(0.0)).otherwise(F.col("volume")).alias("volume"))


@query(
    "nested_default",
    "SELECT event_id, value AS close, CASE WHEN event_id % 3 = 0 THEN value ELSE value * 2 END AS adjclose, "
    "CASE WHEN event_id % 4 = 0 THEN '' ELSE event_type END AS name FROM events",
)
def nested_default(t):
    body = F.to_json(
        F.struct(
            F.when(F.col("event_id") % 4 > 0, F.struct(F.col("event_type").alias("name"))).alias("meta"),
            F.struct(
                F.col("value").alias("close"),
                F.when(F.col("event_id") % 3 > 0, F.struct((F.col("value") * 2).alias("v"))).alias("adj"),
            ).alias("quote"),
        )
    )
    doc = F.from_json("body", "meta struct<name: string>, quote struct<close: double, adj: struct<v: double>>")
    return t.events.select("event_id", body.alias("body")).withColumn("doc", doc).select(
        "event_id",
        F.col("doc.quote.close").alias("close"),
        F.coalesce("doc.quote.adj.v", "doc.quote.close").alias("adjclose"),
        F.coalesce("doc.meta.name", F.lit("")).alias("name"),
    )


@query("json_roundtrip", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def json_roundtrip(t):
    exact = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    packed = t.events.select(F.to_json(F.struct("*"), exact).alias("body"))
    return packed.select(F.from_json("body", t.events.schema, exact).alias("doc")).select("doc.*")


@query(
    "digits_only",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(concat(o_custkey, 25) AS BIGINT) END AS value FROM orders",
)
def digits_only(t):
    text = variant(5, {0: "n/a"}, F.concat(F.lit("~ "), F.col("o_custkey"), F.lit(".25 %")))
    return texts(t, text=text).select("o_orderkey", N.digits_only("text").alias("value"))


@query(
    "kv_lines",
    "SELECT o_orderkey, o_orderstatus AS key, CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN o_orderpriority "
    "ELSE concat(o_orderpriority, ' ', o_custkey) END AS value, concat(o_orderstatus, ' ', o_custkey) AS one_line FROM orders",
)
def kv_lines(t):
    text = variant(
        3,
        {0: F.col("o_orderstatus"), 1: F.concat_ws("\n", "o_orderstatus", "o_orderpriority")},
        F.concat_ws("\n", "o_orderstatus", "o_orderpriority", F.col("o_custkey").cast("string")),
    )
    address = F.concat_ws("\r\n", "o_orderstatus", F.col("o_custkey").cast("string"))
    return texts(t, text=text, address=address).select(
        "o_orderkey", X.key_and_rest("text").alias("kv"), X.one_line("address").alias("one_line")
    ).select("o_orderkey", "kv.*", "one_line")


# The functions as one job, and under SQL names ----------------------------------------------------

RULES = {
    "total": N.clean_number,
    "pct": N.percent_fraction,
    "day": lambda c: D.parse_date(c, D.MONTH_NAME),
    "cap": N.suffix_number,
}


def _quotes(t):
    return texts(
        t,
        total=variant(6, {0: "1d", 1: None}, _commas()),
        pct=variant(5, {0: "(x%)"}, F.concat(_as_text(), F.lit("%"))),
        day=variant(7, {0: "not a date"}, F.date_format(_day(), D.MONTH_NAME)),
        cap=F.concat(_commas(), F.lit("M")),
    ).select("o_orderkey", "total", "pct", "day", "cap")


@query(
    "clean_table_rows",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 1 THEN NULL ELSE o_totalprice END AS total, o_totalprice / 100.0::DOUBLE AS pct, "
    "CAST(o_orderdate AS DATE) AS day, o_totalprice * 1e6::DOUBLE AS cap FROM orders "
    "WHERE o_orderkey % 6 <> 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0",
)
def clean_table_rows(t):
    return clean_table(_quotes(t), RULES)[0]


@query(
    "clean_table_rejects",
    "SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderkey % 6 = 0 THEN 'total' END, CASE WHEN o_orderkey % 5 = 0 THEN 'pct' END, "
    "CASE WHEN o_orderkey % 7 = 0 THEN 'day' END) AS failed FROM orders "
    "WHERE o_orderkey % 6 = 0 OR o_orderkey % 5 = 0 OR o_orderkey % 7 = 0",
)
def clean_table_rejects(t):
    return clean_table(_quotes(t), RULES)[1].select("o_orderkey", "failed")


@query(
    "clean_table_report",
    "SELECT 'total' AS rule, count(*) FILTER (o_orderkey % 6 > 1) AS kept, count(*) FILTER (o_orderkey % 6 = 0) AS lost FROM orders UNION ALL "
    "SELECT 'pct', count(*) FILTER (o_orderkey % 5 > 0), count(*) FILTER (o_orderkey % 5 = 0) FROM orders UNION ALL "
    "SELECT 'day', count(*) FILTER (o_orderkey % 7 > 0), count(*) FILTER (o_orderkey % 7 = 0) FROM orders UNION ALL "
    "SELECT 'cap', count(*), 0 FROM orders",
)
def clean_table_report(t):
    return clean_table(_quotes(t), RULES)[2]


STORE_SQL = (
    "SELECT o_orderkey, CASE WHEN o_orderkey % 6 <= 1 THEN NULL ELSE o_totalprice END AS total, "
    "o_orderkey % 6 = 0 OR o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 AS rejected, "
    "(SELECT count(*) FILTER (o_orderkey % 6 = 0) FROM orders) AS lost_total FROM orders"
)


@query("clean_to_store", STORE_SQL)
def clean_store(t):
    """One pass writes both kinds of rows and counts; every row carries the count of lost totals."""
    path = scratch(t.spark, "cleaned")
    counts = clean_to_store(_quotes(t), RULES, path)
    stored = t.spark.read.parquet(path)
    rejected = (F.col("rejected") == "true").alias("rejected")
    return stored.select("o_orderkey", "total", rejected, F.lit(counts["lost_total"]).cast("bigint").alias("lost_total"))


@query(
    "sql_functions",
    f"SELECT o_orderkey, CAST({NUMBER_SQL} AS DOUBLE) AS number, o_totalprice / 100.0::DOUBLE AS fraction, o_totalprice * 1e6::DOUBLE AS cap, "
    "CAST(o_orderdate AS DATE) AS day, '14:44' AS clock, o_custkey AS digits FROM orders",
)
def sql_functions(t):
    register_sql_functions(t.spark)
    texts(
        t, text=_number_text(), pct=F.concat(_as_text(), F.lit("%")), cap=F.concat(_commas(), F.lit("M")),
        day=F.date_format(_day(), "M/d/yyyy"), clock=F.lit("2:44 PM"), mixed=F.concat(F.lit("n "), F.col("o_custkey")),
    ).createOrReplaceTempView("qm_texts")
    return t.spark.sql(
        "SELECT o_orderkey, qm_clean_number(text) AS number, qm_percent_fraction(pct) AS fraction, qm_suffix_number(cap) AS cap, "
        "qm_parse_date(day, 'M/d/yyyy') AS day, qm_clock24(clock) AS clock, qm_digits_only(mixed) AS digits FROM qm_texts"
    )


@query(
    "sql_functions_texts",
    "SELECT o_orderkey, round(o_totalprice * 1e6::DOUBLE, 0) AS value, 'USD' AS currency, o_totalprice AS price, o_custkey::DOUBLE AS change, "
    "round(o_totalprice / 100.0::DOUBLE, 6) AS varpc, concat('T', o_custkey) AS ticker, CAST(o_orderdate AS DATE) AS day, '09:00' AS open_local, '14:45' AS close_local, "
    "'+07' AS timezone, CASE WHEN o_orderstatus = 'F' THEN 'HSX' WHEN o_orderstatus = 'O' THEN 'HNX' ELSE 'UPC' END AS board, "
    "split_part(o_orderpriority, '-', 1) AS token, o_orderstatus AS status FROM orders",
)
def sql_functions_texts(t):
    """The functions that return several fields, in SQL."""
    register_sql_functions(t.spark)
    key, total = F.col("o_custkey").cast("string"), F.format_string("%.2f", "o_totalprice")
    texts(
        t, money=F.concat(total, F.lit(" M USD")), price=F.concat(total, F.lit(" USD")), day=F.date_format(_day(), "EEEE, MMMM d, yyyy"),
        moved=F.concat(key, F.lit("("), F.format_string("%.6f", F.col("o_totalprice") / 100), F.lit("%)")), name=F.concat(F.lit("T"), key, F.lit("\nName")),
        hours=F.lit("9:00 am - 11:30 am, 1:00 pm - 2:45 pm (+07)"), status=F.col("o_orderstatus"), priority=F.col("o_orderpriority"),
        body=F.to_json(F.struct(F.struct(F.col("o_orderstatus").alias("b")).alias("a"))),
    ).createOrReplaceTempView("qm_more_texts")
    rows = t.spark.sql(
        "SELECT o_orderkey, qm_money_text(money) AS m, qm_price_ccy(price).price AS price, qm_change_pct(moved) AS c, qm_symbol_split(name).ticker AS ticker, "
        "qm_long_date(day) AS day, qm_session_text(hours) AS h, qm_code_map(status, map('F', 'HSX', 'O', 'HNX'), 'UPC') AS board, "
        "qm_first_token(priority, '-') AS token, qm_json_default(body, '$.a.b', '-') AS status FROM qm_more_texts"
    )
    return rows.select(
        "o_orderkey", F.round(F.col("m.value"), 0).alias("value"), "m.currency", "price", "c.change", F.round("c.varpc", 6).alias("varpc"), "ticker", "day", "h.*",
        "board", "token", "status",
    )

"""JSON, CSV and delimited payloads through their normalisers, back to the tables they were rendered from."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotemill.normalise import charts, coverage, records
from quotemill.queries.registry import DAILY, TICKS, query
from quotemill.render import chart_bodies, flat_bodies, landing, page_of, paged, record_bodies, seconds
from quotemill.sources import variants

AS_OF = "2025-01-02 16:00:00"  # a Thursday, after the session
DAY_SQL = "DATE '2025-01-02'"

# Parallel arrays ----------------------------------------------------------------

CHART_SQL = (
    "(SELECT *, dt AS datetime, CAST(dt AS DATE) AS date, CASE WHEN usr % 3 > 0 THEN price / 2 ELSE price END AS adj FROM ("
    "SELECT *, date_trunc('second', ts) + CASE WHEN usr % 4 = 0 THEN INTERVAL 7 HOUR ELSE INTERVAL 0 HOUR END AS dt, "
    "row_number() OVER (PARTITION BY ticker, page ORDER BY ts, event_id) - 1 AS pos, count(*) OVER (PARTITION BY ticker, page) AS rows FROM ("
    f"SELECT *, event_id // 1000 AS page, CAST(substr(ticker, 2) AS BIGINT) AS usr FROM {TICKS})) "
    "WHERE rows > 2 AND pos < rows - CASE WHEN page % 2 = 0 THEN 1 ELSE 0 END)"
)


@query(
    "n01",
    "SELECT ticker AS codesource, datetime, price AS open, price + 1 AS high, price - 1 AS low, price AS close, adj AS close_adj, "
    f"size::DOUBLE AS volume, 'YAH' AS source, date, datetime AS timestamp, '{AS_OF}' AS updated FROM {CHART_SQL}",
)
def n01(t):
    return charts.chart_bars(chart_bodies(t.ticks), AS_OF)


@query(
    "n01_rejects",
    f"SELECT ticker AS symbol, CAST(event_id // 1000 AS INT) AS page, 'too few bars' AS reason FROM {TICKS} GROUP BY ALL HAVING count(*) <= 2",
)
def n01_rejects(t):
    return charts.chart_rejects(chart_bodies(t.ticks)).select("symbol", "page", "reason")


@query(
    "n02",
    "SELECT ticker, price AS open, price + 1 AS high, price - 1 AS low, price AS close, adj AS adjclose, size::DOUBLE AS volume, "
    f"CAST(date AS TIMESTAMP) AS date, datetime, datetime AS timestamp, '{AS_OF}' AS updated FROM {CHART_SQL}",
)
def n02(t):
    return charts.intraday_bars(chart_bodies(t.ticks), AS_OF)


@query(
    "n03",
    "SELECT ticker, CAST(date AS TIMESTAMP) AS date, price AS open, price + 1 AS high, price - 1 AS low, price AS close, size::DOUBLE AS volume, "
    f"'YAH' AS source, adj AS adjclose, '{AS_OF}' AS updated FROM (SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY datetime, page, pos) AS rn FROM {CHART_SQL}) WHERE rn = 1",
)
def n03(t):
    return charts.daily_bars(chart_bodies(t.ticks), AS_OF)


FLAT_SQL = (
    "(SELECT *, date_trunc('second', ts) AS utc, date_trunc('second', ts) + INTERVAL 7 HOUR AS vn, event_id // 1000 AS page, "
    f"CAST(substr(ticker, 2) AS BIGINT) % 2 = 0 AS is_index FROM {TICKS})"
)
LOCAL_SQL = (
    "SELECT ticker AS codesource, concat(CASE WHEN is_index THEN 'IND' ELSE 'STKVN' END, ticker) AS code, ticker, 'ENT' AS source, "
    "CASE WHEN is_index THEN 'IND' ELSE 'STK' END AS type, CAST(vn AS DATE) AS date, strftime(vn, '%H:%M') AS hhmmss, vn AS timestamp_vn, "
    "strftime(vn, '%Y-%m-%d %H:%M:%S') AS timestamp, price * 1000.0::DOUBLE AS open, (price + 1) * 1000.0::DOUBLE AS high, (price - 1) * 1000.0::DOUBLE AS low, "
    f"price * 1000.0::DOUBLE AS close, size::DOUBLE AS volume, 'VN' AS iso2, 'VNM' AS iso3, 'VIETNAM' AS country, 'ASIA' AS continent, '{AS_OF}' AS updated "
)


@query("n10", LOCAL_SQL + f"FROM {FLAT_SQL}")
def n10(t):
    return charts.minute_bars_local(flat_bodies(t.ticks), AS_OF)


@query(
    "n11",
    "SELECT 'VND' AS source, ticker, ticker AS codesource, concat('STKVN', ticker) AS code, CAST(utc AS DATE) AS date, strftime(utc, '%Y-%m-%d %H:%M:%S') AS timestamp, "
    "price * 1000.0::DOUBLE AS open, (price + 1) * 1000.0::DOUBLE AS high, (price - 1) * 1000.0::DOUBLE AS low, price * 1000.0::DOUBLE AS last, "
    f"size::DOUBLE AS volume, '{AS_OF}' AS updated FROM {FLAT_SQL} WHERE page % 5 > 0",
)
def n11(t):
    return charts.minute_bars_status(flat_bodies(t.ticks), AS_OF)


@query(
    "n14",
    LOCAL_SQL + "FROM (SELECT *, row_number() OVER (PARTITION BY ticker, CAST(vn AS DATE) ORDER BY vn DESC, price DESC, size DESC) AS rn "
    f"FROM {FLAT_SQL}) WHERE rn = 1",
)
def n14(t):
    return charts.last_minute_of_day(flat_bodies(t.ticks), AS_OF)


# Info, statements, shares ----------------------------------------------------------------------


@query(
    "n04",
    "SELECT c_name AS symbol, 'shortname' AS key, c_name AS value FROM customer UNION ALL "
    "SELECT c_name, 'mkt_segmentpercent_', c_mktsegment FROM customer UNION ALL SELECT c_name, 'nation', c_nationkey::VARCHAR FROM customer",
)
def n04(t):
    return records.company_info(_info_bodies(t))


def _info_bodies(t):
    body = F.to_json(
        F.struct(
            F.col("c_name").alias("shortName"), F.col("c_mktsegment").alias("Mkt-Segment %"), F.col("c_nationkey").alias("*Nation")
        )
    )
    return landing(t.customer, "YAH", "info", body, symbol=F.col("c_name"), page=F.col("c_custkey").cast("int"))


STATEMENT_SQL = " UNION ALL ".join(
    f"SELECT {ticker} AS ticker, '{dataset}' AS dataset, {item} AS index, '{period}' AS period, {value} AS value FROM {table}"
    for dataset, table, ticker, item, periods in (
        ("BALANCE_SHEET", "orders", "concat('C', o_custkey % 50)", "concat('o', o_orderkey)",
         {"2024-12-31": "o_totalprice", "2023-12-31": "o_totalprice / 2"}),
        ("CASH_FLOW", "lineitem", "concat('C', l_partkey % 50)", "concat('l', l_orderkey)",
         {"2024-12-31": "l_extendedprice", "2022-12-31": "l_quantity"}),
        ("INCOME_STATEMENT", "part", "concat('C', p_partkey % 50)", "concat('p', p_partkey)", {"2024-09-30": "p_retailprice"}),
    )
    for period, value in periods.items()
)


def _statement(df, dataset, ticker, item, page, periods):
    pairs = [F.lit("index"), item]
    for period, value in periods.items():
        pairs += [F.lit(period), value.cast("string")]
    line = df.select((F.concat(F.lit("C"), F.col(ticker) % 50)).alias("symbol"), page.alias("page"), F.create_map(*pairs).alias("line"))
    docs = line.groupBy("symbol", "page").agg(F.to_json(F.collect_list("line")).alias("body"))
    return landing(docs, "YAH", dataset, F.col("body"), symbol=F.col("symbol"), page=F.col("page").cast("int"))


@query("n05", STATEMENT_SQL)
def n05(t):
    return records.statements(_statement_bodies(t))


def _statement_bodies(t):
    key = lambda letter, name: F.concat(F.lit(letter), F.col(name))
    docs = [
        _statement(t.orders, "BALANCE_SHEET", "o_custkey", key("o", "o_orderkey"), page_of("o_orderkey", 5000),
                   {"2024-12-31": F.col("o_totalprice"), "2023-12-31": F.col("o_totalprice") / 2}),
        _statement(t.lineitem, "CASH_FLOW", "l_partkey", key("l", "l_orderkey"), page_of("l_orderkey", 5000),
                   {"2024-12-31": F.col("l_extendedprice"), "2022-12-31": F.col("l_quantity")}),
        _statement(t.part, "INCOME_STATEMENT", "p_partkey", key("p", "p_partkey"), page_of("p_partkey", 5000),
                   {"2024-09-30": F.col("p_retailprice")}),
    ]
    return docs[0].unionByName(docs[1]).unionByName(docs[2])


GROUPED_DAILY = f"(SELECT *, concat('P', ticker % 50) AS symbol FROM {DAILY})"
DAILY_KEY = "(o, n, s, volume, close)"


def _daily_symbol():
    return F.concat(F.lit("P"), F.col("ticker") % 50)


@query(
    "n06",
    f"SELECT symbol AS ticker, date, arg_max(volume, (o, n, s, ticker, volume, close)) AS sharesout FROM {GROUPED_DAILY} GROUP BY symbol, date",
)
def n06(t):
    return records.shares_history(_shares_bodies(t))


def _shares_bodies(t):
    pair = lambda c: F.array(c("date").cast("string"), c("volume").cast("string"))
    raw = record_bodies(t.daily, _daily_symbol(), page_of("o"), ["o", "n", "s", "ticker", "volume", "close"], pair, fields=("date",))
    return raw


# Daily rows and points -----------------------------------------------------

DAY_ORDER = ["date", "o", "n", "s", "volume", "close"]


@query(
    "n12",
    "SELECT 'CAF' AS source, symbol AS codesource, symbol AS ticker, date, close AS open, close + 1 AS high, close - 1 AS low, close / 2 AS close_adj, close, "
    "volume AS change, CASE WHEN n = 1 THEN NULL ELSE n::DOUBLE END AS varpc, volume * 1000 AS volume, o::DOUBLE AS turnover, concat('STKVN', symbol) AS code, "
    f"close - volume AS reference, volume / nullif(close - volume, 0) AS rt, '{AS_OF}' AS updated FROM {GROUPED_DAILY}",
)
def n12(t):
    return records.paged_daily_text(_text_bodies(t), AS_OF)


def _text_bodies(t):
    def record(c):
        close = c("close")
        percent = F.when(c("n") == 1, F.lit("")).otherwise(F.concat(F.lit("("), c("n"), F.lit("%)")))
        return F.struct(
            F.date_format(c("date"), "dd/MM/yyyy").alias("Ngay"), close.cast("string").alias("GiaMoCua"),
            (close + 1).cast("string").alias("GiaCaoNhat"), (close - 1).cast("string").alias("GiaThapNhat"),
            (close / 2).cast("string").alias("GiaDieuChinh"), close.cast("string").alias("GiaDongCua"),
            F.concat(c("volume"), percent).alias("ThayDoi"),
            F.format_number(c("volume") * 1000, 0).alias("KhoiLuongKhopLenh"), F.format_number(c("o"), 0).alias("GiaTriKhopLenh"),
        )

    wrap = lambda a: F.struct(F.struct(a.alias("Data")).alias("Data"))
    raw = record_bodies(t.daily, F.lower(_daily_symbol()), page_of("o"), DAY_ORDER, record, wrap)
    return raw


@query(
    "n13",
    "SELECT 'VND' AS source, symbol AS codesource, symbol AS ticker, date, close AS open, close + 1 AS high, close - 1 AS low, close, volume AS change, "
    "volume * 10 AS volume, o::DOUBLE AS turnover, concat('IND', symbol) AS code, close - volume AS reference, volume / nullif(close - volume, 0) AS rt, "
    f"'{AS_OF}' AS updated FROM {GROUPED_DAILY}",
)
def n13(t):
    return records.paged_daily_numbers(_number_bodies(t), AS_OF)


def _number_bodies(t):
    def record(c):
        close = c("close")
        return F.struct(
            c("date").cast("string").alias("date"), close.alias("open"), (close + 1).alias("high"), (close - 1).alias("low"),
            close.alias("close"), c("volume").alias("change"), F.lit(99.0).alias("pctChange"),
            (c("volume") * 10).alias("nmVolume"), c("o").alias("nmValue"),
        )

    raw = record_bodies(t.daily, _daily_symbol(), page_of("o"), DAY_ORDER, record, lambda a: F.struct(a.alias("data")))
    return raw


UNIT_SQL = (
    "(SELECT *, CASE WHEN n % 2 = 0 THEN 1000.0::DOUBLE ELSE 1.0::DOUBLE END AS unit, CASE WHEN n = 3 THEN 0.0 ELSE volume END AS basic, "
    f"count(*) OVER (PARTITION BY ticker % 200, o // 250) AS rows FROM {DAILY})"
)


def _unit_bodies(t):
    def record(c):
        close = c("close")
        return F.struct(
            c("ticker").cast("string").alias("symbol"), F.concat(c("date"), F.lit("T00:00:00")).alias("date"),
            F.when(c("n") % 2 == 0, F.lit(1000.0)).otherwise(F.lit(1.0)).alias("unit"), close.alias("priceOpen"),
            (close + 1).alias("priceHigh"), (close - 1).alias("priceLow"), close.alias("priceClose"), (close / 2).alias("priceAverage"),
            F.when(c("n") == 3, F.lit(0.0)).otherwise(c("volume")).alias("priceBasic"),
            c("volume").alias("totalVolume"), c("o").cast("double").alias("totalValue"),
        )

    return record_bodies(t.daily, (F.col("ticker") % 200).cast("string"), page_of("o", 250), DAY_ORDER, record, fields=("ticker",))


@query(
    "n16",
    "SELECT 'FANT' AS source, ticker::VARCHAR AS ticker, (ticker % 200)::VARCHAR AS codesource, concat('STKVN', ticker % 200) AS code, date, unit * close AS open, "
    "unit * close AS close_adj, unit * (close + 1) AS high, unit * (close - 1) AS low, unit * (close / 2) AS average, unit * close AS close, "
    "nullif(unit * basic, 0) AS reference, unit * close AS close_unadj, volume, o::DOUBLE AS turnover, unit * close - nullif(unit * basic, 0) AS change, "
    "100.0::DOUBLE * (unit * close - nullif(unit * basic, 0)) / nullif(unit * basic, 0) AS varpc, "
    "100.0::DOUBLE * (unit * close - nullif(unit * basic, 0)) / nullif(unit * basic, 0) / 100.0::DOUBLE AS rt, "
    f"'{AS_OF}' AS updated FROM {UNIT_SQL} WHERE rows > 5",
)
def n16(t):
    return records.daily_with_unit(_unit_bodies(t), AS_OF)


@query(
    "n16_rejects",
    f"SELECT (ticker % 200)::VARCHAR AS symbol, CAST(o // 250 AS INT) AS page, 'too few rows' AS reason FROM {DAILY} GROUP BY ALL HAVING count(*) <= 5",
)
def n16_rejects(t):
    return records.unit_rejects(_unit_bodies(t)).select("symbol", "page", "reason")


@query(
    "n26",
    "SELECT symbol AS codesource, 'NASDAQ' AS source, date, round(o / 4.0, 2)::DOUBLE AS open, round(o / 4.0, 2)::DOUBLE AS high, (n * 1000)::DOUBLE AS low, "
    f"round(o / 4.0, 2)::DOUBLE AS close, volume * 1000 AS volume FROM {GROUPED_DAILY}",
)
def n26(t):
    return records.historical_rows(_historical_bodies(t))


def _historical_bodies(t):
    def record(c):
        price = F.concat(F.lit("$"), F.format_number(c("o") / 4, 2))
        return F.struct(
            F.date_format(c("date"), "MM/dd/yyyy").alias("date"), price.alias("close"), F.format_number(c("volume") * 1000, 0).alias("volume"),
            price.alias("open"), price.alias("high"), F.concat(F.lit("$"), F.format_number(c("n") * 1000, 2)).alias("low"),
        )

    wrap = lambda a: F.struct(F.struct(F.struct(a.alias("rows")).alias("tradesTable")).alias("data"))
    raw = record_bodies(t.daily, _daily_symbol(), page_of("o"), DAY_ORDER, record, wrap)
    return raw


@query(
    "n27",
    "SELECT ticker, date_trunc('millisecond', ts) AS timestamp, strftime(ts, '%H:%M') AS time, size * 100 AS shares_traded, price AS close, price + 1 AS prev_close "
    f"FROM {TICKS}",
)
def n27(t):
    return records.real_time_chart(_real_time_bodies(t))


def _real_time_bodies(t):
    def point(c):
        detail = F.struct(
            F.date_format(c("ts"), "HH:mm").alias("time"), F.format_number(c("size") * 100, 0).alias("shares"),
            F.concat(F.lit("$"), c("price")).alias("price"), F.concat(F.lit("$"), c("price") + 1).alias("prevCls"),
        )
        return F.struct(F.unix_millis(c("ts").cast("timestamp")).alias("x"), detail.alias("z"))

    wrap = lambda a: F.struct(F.struct(a.alias("chart")).alias("data"))
    raw = record_bodies(t.ticks, F.col("ticker"), page_of("event_id"), ["ts", "event_id"], point, wrap, ("price", "size"))
    return raw


@query(
    "n33",
    "SELECT symbol AS codesource, date, close AS open, close + 1 AS high, close - 1 AS low, close, volume, 'ETFDB' AS source "
    f"FROM {GROUPED_DAILY}",
)
def n33(t):
    def line(c):
        close = c("close")
        numbers = [x.cast("string") for x in (close, close + 1, close - 1, close, c("volume"))]
        return F.concat_ws(",", c("symbol"), c("date").cast("string"), *numbers)

    rows = paged(t.daily.withColumn("symbol", _daily_symbol()), ["symbol"], page_of("o"), DAY_ORDER, ["symbol"], line)
    other = F.concat(F.lit("error\nX"), F.array_join(F.slice("rows", 1, 2), "\nX"), F.lit("\n"))
    body = F.concat(other, F.array_join("rows", "\n"), F.lit("\n"))
    return records.eod_lines(landing(rows, "ETFDB", "eod", body, symbol=F.col("symbol")))


# Ratios ---------------------------------------------------------------------------------------

RATIO_SQL = (
    "SELECT CAST(event_id // 100 AS INT) AS page, 'VND' AS source, concat('T', user_id % 3) AS codesource, concat('T', user_id % 3) AS ticker, "
    f"{DAY_SQL} AS date, concat('STKVNT', user_id % 3) AS code, {{0}}, '{AS_OF}' AS updated FROM events WHERE event_type = '{{1}}' GROUP BY event_id // 100, user_id % 3"
)


def _ratio_bodies(t):
    def record(c):
        code = (
            F.when(c("event_type") == "purchase", F.lit("OUTSTANDING_SHARES"))
            .when(c("event_type") == "view", F.lit("FREEFLOAT"))
            .otherwise(F.upper(c("event_type")))
        )
        return F.struct(code.alias("ratioCode"), c("value").alias("value"))

    symbol = F.concat(F.lit("T"), F.col("user_id") % 3)
    wrap = lambda a: F.struct(a.alias("data"))
    return record_bodies(t.events, symbol, page_of("event_id", 100), ["event_id"], record, wrap, ("event_type", "value"))


@query("n17", RATIO_SQL.format("arg_min(value, event_id) AS sharesout, arg_min(value, event_id) AS shareslis", "purchase"))
def n17(t):
    return records.shares_outstanding(_ratio_bodies(t), AS_OF[:10], AS_OF)


@query("n21", RATIO_SQL.format("arg_min(value, event_id) AS free_float", "view"))
def n21(t):
    return records.free_float(_ratio_bodies(t), AS_OF[:10], AS_OF)


# Boards and screeners ---------------------------------------------------------------------------


@query(
    "n19",
    "SELECT 'TVSI' AS source, ticker, CASE o_orderstatus WHEN 'P' THEN 'UPC' WHEN 'F' THEN 'HSX' ELSE 'HNX' END AS market, reference, "
    "1000.0::DOUBLE * o_custkey AS change, last, CASE WHEN volume IS NULL AND last = reference THEN 0.0 ELSE volume END AS volume, last AS close, "
    f"{DAY_SQL} AS date, concat('STKVN', ticker) AS code, '{AS_OF}' AS updated FROM ("
    "SELECT *, lpad((o_orderkey % 1000)::VARCHAR, 3, '0') AS ticker, 1000.0::DOUBLE * CASE WHEN o_custkey % 2 = 0 THEN o_totalprice ELSE o_totalprice + 1 END AS reference, "
    "1000.0::DOUBLE * o_totalprice AS last, CASE WHEN o_orderkey % 3 > 0 THEN 10.0::DOUBLE * o_custkey END AS volume FROM orders) WHERE o_orderkey % 4 > 0",
)
def n19(t):
    ticker = F.lpad(F.col("o_orderkey") % 1000, 3, "0")
    long_or_short = F.when(F.col("o_orderkey") % 4 == 0, F.concat(ticker, F.lit("X"))).otherwise(ticker)
    star = lambda v: F.concat(F.lit("x*"), v)
    price = F.col("o_totalprice")
    reference = F.when(F.col("o_custkey") % 2 == 0, price).otherwise(price + 1)
    volume = F.when(F.col("o_orderkey") % 3 > 0, star(F.format_number("o_custkey", 0))).otherwise(F.lit("x"))
    fields = [F.lit(f"f{i}") for i in range(21)]
    fields[0] = F.concat(F.lit('"'), long_or_short, F.lit('"'))
    fields[6], fields[15], fields[17], fields[19] = (
        star(F.format_number(reference, 2)), star(F.col("o_custkey")), star(F.format_number(price, 2)), volume,
    )
    market = F.when(F.col("o_orderstatus") == "P", F.lit("UPCOM")).when(F.col("o_orderstatus") == "F", F.lit("HSX")).otherwise(F.lit("HNX"))
    rows = t.orders.select(market.alias("market"), page_of("o_orderkey").alias("page"), F.concat_ws("|", *fields).alias("r"))
    docs = rows.groupBy("market", "page").agg(F.to_json(F.struct(F.collect_list("r").alias("arrDetailStock"))).alias("body"))
    return records.pipe_board(landing(docs, "TVSI", F.col("market"), F.col("body")), AS_OF)


@query(
    "n23",
    "SELECT concat('S', o_orderkey) AS symbol, concat('Co, ', o_custkey) AS name, o_totalprice AS close, -o_custkey::DOUBLE AS change, o_custkey / 100.0::DOUBLE AS rt, "
    "CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_custkey * 1000 END AS market_cap, CAST(trunc(o_totalprice) AS BIGINT) AS volume, "
    "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INT) END AS ipo_year, o_orderstatus AS country, o_orderpriority AS sector, 'x' AS industry, "
    "DATE '2025-03-13' AS date FROM orders",
)
def n23(t):
    name = F.concat(F.lit('"Co, '), F.col("o_custkey"), F.lit('"'))
    return records.screener(_screener_bodies(t, name))


@query(
    "n23_quoted",
    "SELECT concat('S', o_orderkey) AS symbol, concat('Co, ', o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN chr(10) || 'second line' ELSE ' \"AG\"' END) AS name, o_totalprice AS close, -o_custkey::DOUBLE AS change, o_custkey / 100.0::DOUBLE AS rt, "
    "CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_custkey * 1000 END AS market_cap, CAST(trunc(o_totalprice) AS BIGINT) AS volume, "
    "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INT) END AS ipo_year, o_orderstatus AS country, o_orderpriority AS sector, 'x' AS industry, "
    "DATE '2025-03-13' AS date FROM orders",
)
def n23_quoted(t):
    """Names with a line break, or with quotes, inside their quotes."""
    more = F.when(F.col("o_orderkey") % 2 == 0, F.lit("\nsecond line")).otherwise(F.lit(' ""AG""'))
    return records.screener(_screener_bodies(t, F.concat(F.lit('"Co, '), F.col("o_custkey"), more, F.lit('"'))))


def _screener_bodies(t, name):
    price = F.col("o_totalprice")
    text = lambda c: c.cast("string")
    line = F.concat_ws(
        ",", F.concat(F.lit("S"), F.col("o_orderkey")), name,
        F.concat(F.lit("$"), text(price)), F.concat(F.lit("-"), F.col("o_custkey")), F.concat(F.col("o_custkey"), F.lit("%")),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit("")).otherwise(text(F.col("o_custkey") * 1000)), F.col("o_orderstatus"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("")).otherwise(text(F.year("o_orderdate"))), text(price), F.col("o_orderpriority"), F.lit("x"),
    )
    rows = paged(t.orders.withColumn("line", line), [], page_of("o_orderkey"), ["o_orderkey"], ["line"])
    header = "Symbol,Name,Last Sale,Net Change,% Change,Market Cap,Country,IPO Year,Volume,Sector,Industry\r\n"
    body = F.concat(F.lit(header), F.array_join("rows.line", "\r\n"), F.lit("\r\n"))
    return landing(rows, "NASDAQ", "screener", body, title=F.lit("Mar 13, 2025"))


# Comparison --------------------------------------------------------------------------------------------


def _comparison_bodies(t):
    """Per page of 100 ticks: a quote per tick, and one series per ticker in ticker order."""
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    quote = F.struct(
        F.col("ticker").alias("id"), F.col("price").alias("price"), (F.col("price") / 2).alias("priceChange1Day"),
        F.col("size").alias("percentChange1Day"), F.date_format("ts", "MM/dd/yyyy").alias("priceDate"), iso.alias("lastUpdateISO"),
    )
    point = F.struct(
        F.col("event_id"), iso.alias("dateTime"), F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.when(F.col("size") % 7 > 0, F.col("price")).alias("value"),
    )
    rows = t.ticks.select("ticker", page_of("event_id", 100).alias("page"), quote.alias("quote"), point.alias("point"))
    per_code = rows.groupBy("page", "ticker").agg(F.collect_list("quote").alias("quotes"), F.array_sort(F.collect_list("point")).alias("points"))
    docs = per_code.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("ticker", "points", "quotes"))).alias("all"))
    body = F.to_json(
        F.struct(
            F.flatten("all.quotes").alias("fieldDataCollection"),
            F.struct(F.col("all.points").alias("price")).alias("timeSeriesCollection"),
        )
    )
    return landing(
        docs, "BLG", "comparison", body, page=F.col("page").cast("int"),
        params=F.create_map(F.lit("securities"), F.array_join("all.ticker", ",")),
    )


@query(
    "n24",
    "SELECT 'BLG' AS source, ticker AS codesource, CAST(ts AS DATE) AS date, date_trunc('second', ts) AS timestamp, date_trunc('second', ts) + INTERVAL 7 HOUR AS timestampvn, "
    f"price AS close, price / 2 AS change, size / 100.0::DOUBLE AS var FROM {TICKS}",
)
def n24(t):
    return records.comparison_quotes(_comparison_bodies(t))


VALUE_SQL = f"(SELECT *, CASE WHEN size % 7 > 0 THEN price END AS value, CAST(ts AS DATE) AS date FROM {TICKS})"


@query(
    "n24_day",
    f"SELECT ticker AS codesource, date_trunc('second', ts) AS timestamp, strftime(ts, '%Y-%m-%d') AS date, value AS close FROM {VALUE_SQL}",
)
def n24_day(t):
    return records.comparison_series(_comparison_bodies(t))


@query(
    "n24_history",
    "SELECT ticker AS codesource, date, value AS close, value - lag(value) OVER w AS change, f / nullif(lag(f) OVER w, 0) - 1 AS var FROM ("
    f"SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date, event_id ROWS UNBOUNDED PRECEDING) AS f FROM {VALUE_SQL}) "
    "WINDOW w AS (PARTITION BY ticker ORDER BY date, event_id)",
)
def n24_history(t):
    return records.comparison_series(_comparison_bodies(t), "1_MONTH")


# Chart data and listings ----------------------------------------------------------------------------


@query(
    "n25",
    "SELECT ticker AS codesource, concat('Name ', ticker) AS name, lower(ticker) AS short_name, 'CNBC' AS source, '1D' AS \"timeRange\", price AS open, price + 1 AS high, "
    "price - 1 AS low, price AS close, CASE WHEN size % 5 > 0 THEN size::DOUBLE END AS volume, date_trunc('second', ts) AS \"tradeTime\" "
    f"FROM {TICKS} WHERE CAST(substr(ticker, 2) AS BIGINT) % 10 > 0 UNION ALL "
    "SELECT ticker, concat('Name ', ticker), lower(ticker), 'CNBC', '1D', NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::TIMESTAMP "
    f"FROM (SELECT DISTINCT ticker, event_id // 1000 AS page FROM {TICKS} WHERE CAST(substr(ticker, 2) AS BIGINT) % 10 = 0)",
)
def n25(t):
    return records.chart_data(_chart_data_bodies(t))


def _chart_data_bodies(t):
    def bar(c):
        price = c("price")
        return F.struct(
            price.cast("string").alias("open"), (price + 1).cast("string").alias("high"), (price - 1).cast("string").alias("low"),
            price.cast("string").alias("close"), F.when(c("size") % 5 > 0, c("size").cast("string")).otherwise(F.lit("")).alias("volume"),
            F.date_format(c("ts"), "yyyyMMddHHmmss").alias("tradeTime"), F.lit(0).alias("tradeTimeinMills"),
        )

    rows = paged(t.ticks, ["ticker"], page_of("event_id"), ["ts", "event_id"], ["price", "size"], bar)
    empty = F.substring("ticker", 2, 20).cast("bigint") % 10 == 0
    names = F.array(F.struct(F.concat(F.lit("Name "), F.col("ticker")).alias("name"), F.lower("ticker").alias("shortName")))
    chart = F.struct(
        F.col("ticker").alias("symbol"), names.alias("allSymbols"),
        F.when(empty, F.slice("rows", 1, 0)).otherwise(F.col("rows")).alias("priceBars"),
    )
    body = F.to_json(F.struct(F.struct(chart.alias("chartData")).alias("data")))
    raw = landing(rows, "CNBC", "chart", body, symbol=F.col("ticker"), params=F.create_map(F.lit("timeRange"), F.lit("1D")), page=F.col("page").cast("int"))
    return raw


LISTING_NULLS = ("circulatingSupply", "totalSupply", "maxSupply", "ath", "atl", "high24h", "low24h")
QUOTE_NULLS = tuple(f for f in records.QUOTE_FIELDS if f not in ("price", "volume24h", "marketCap"))


@query(
    "n35",
    "SELECT o_orderkey AS id, concat('Coin ', o_custkey) AS name, concat('C', o_custkey) AS symbol, CAST(o_orderkey % 1000 AS INT) AS \"cmcRank\", "
    + ", ".join(f'NULL::DOUBLE AS "{c}"' for c in LISTING_NULLS[1:] + QUOTE_NULLS)
    + ", o_custkey::DOUBLE AS \"circulatingSupply\", strftime(o_orderdate, '%Y-%m-%d') AS \"lastUpdated\", "
    "CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice * 2 END AS volume24h, "
    "CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice * 4 END AS \"marketCap\" FROM orders",
)
def n35(t):
    return records.crypto_listing(_listing_bodies(t)).orderBy("cmcRank", "id")


def _listing_bodies(t):
    def record(c):
        key, customer, price = c("o_orderkey"), c("o_custkey"), c("o_totalprice")
        quote = lambda k: F.struct((price * k).alias("price"), (price * 2 * k).alias("volume24h"), (price * 4 * k).alias("marketCap"))
        quotes = F.array(quote(1), quote(3))
        return F.struct(
            key.alias("id"), F.concat(F.lit("Coin "), customer).alias("name"),
            F.concat(F.lit("C"), customer).alias("symbol"), (key % 1000).alias("cmcRank"),
            customer.cast("double").alias("circulatingSupply"), F.date_format(c("o_orderdate"), "yyyy-MM-dd").alias("lastUpdated"),
            F.when(key % 7 > 0, quotes).otherwise(F.slice(quotes, 1, 0)).alias("quotes"),
        )

    wrap = lambda a: F.struct(F.struct(a.alias("cryptoCurrencyList")).alias("data"))
    fields = ("o_custkey", "o_totalprice", "o_orderdate")
    raw = record_bodies(t.orders, F.lit("all"), page_of("o_orderkey"), ["o_orderkey"], record, wrap, fields)
    return raw


# Bodies that cannot be read ---------------------------------------------------------------------------------------


def _damaged(raw, path):
    """Of four pages one is as it was; the others are cut off, missing, or hold something else."""
    page, other = F.col("page") % 4, F.lit("[1]" if path != "$" else '"a text"')
    body = F.when(page == 1, F.substring("body", 1, 5)).when(page == 3, other).when(page != 2, F.col("body"))
    return raw.withColumn("body", body)


def _rejects(name, family, bodies, symbol, page, source):
    """A query of the unreadable bodies of a family, and of what is read of the others."""
    path = records.SECTIONS[family][0]
    reason = f"CASE page % 4 WHEN 1 THEN 'not JSON' WHEN 2 THEN 'no body' ELSE 'nothing to read at {path}' END"

    @query(f"{name}_rejects", f"SELECT symbol, page, {reason} AS reason FROM (SELECT DISTINCT {symbol} AS symbol, CAST({page} AS INT) AS page FROM {source}) WHERE page % 4 > 0")
    def run(t):
        return records.body_rejects(_damaged(bodies(t), path), family).select("symbol", "page", "reason")


_rejects("n04", "company info", _info_bodies, "c_name", "c_custkey", "customer")
_rejects("n06", "shares history", _shares_bodies, "symbol", "o // 1000", GROUPED_DAILY)
_rejects("n12", "paged texts", _text_bodies, "lower(symbol)", "o // 1000", GROUPED_DAILY)
_rejects("n13", "paged numbers", _number_bodies, "symbol", "o // 1000", GROUPED_DAILY)
_rejects("n17", "ratios", _ratio_bodies, "concat('T', user_id % 3)", "event_id // 100", "events")
_rejects("n25", "chart data", _chart_data_bodies, "ticker", "event_id // 1000", TICKS)
_rejects("n26", "historical rows", _historical_bodies, "symbol", "o // 1000", GROUPED_DAILY)
_rejects("n27", "real time", _real_time_bodies, "ticker", "event_id // 1000", TICKS)
_rejects("n35", "crypto listing", _listing_bodies, "'all'", "o_orderkey // 1000", "orders")


@query(
    "n05_rejects",
    "SELECT symbol, dataset, page, CASE page % 4 WHEN 1 THEN 'not JSON' WHEN 2 THEN 'no body' ELSE 'nothing to read at $' END AS reason FROM ("
    "SELECT DISTINCT concat('C', o_custkey % 50) AS symbol, 'BALANCE_SHEET' AS dataset, CAST(o_orderkey // 5000 AS INT) AS page FROM orders UNION ALL "
    "SELECT DISTINCT concat('C', l_partkey % 50), 'CASH_FLOW', CAST(l_orderkey // 5000 AS INT) FROM lineitem UNION ALL "
    "SELECT DISTINCT concat('C', p_partkey % 50), 'INCOME_STATEMENT', CAST(p_partkey // 5000 AS INT) FROM part) WHERE page % 4 > 0",
)
def n05_rejects(t):
    raw = _damaged(_statement_bodies(t), "$").withColumn("source", F.col("dataset"))
    return records.body_rejects(raw, "statements").select("symbol", F.col("source").alias("dataset"), "page", "reason")


@query(
    "body_drift",
    "SELECT CASE WHEN page % 2 = 0 THEN 'even' ELSE 'odd' END AS pages, 'OBJECT<data: ARRAY<OBJECT<ratioCode: STRING, value: ' || "
    "CASE WHEN page % 2 = 0 THEN 'DOUBLE' ELSE 'STRING' END || '>>>' AS schema, count(*) AS bodies FROM ("
    "SELECT DISTINCT user_id % 3 AS u, event_id // 100 AS page FROM events) GROUP BY page % 2 = 0",
)
def body_drift(t):
    """What schema the readable bodies share; on odd pages the numbers come as texts."""
    body = F.when(F.col("page") % 2 == 0, F.regexp_replace("body", '"value":([-0-9.E]+)', '"value":1.5E0')).otherwise(
        F.regexp_replace("body", '"value":([-0-9.E]+)', '"value":"$1"')
    )
    raw = _ratio_bodies(t).withColumn("body", body)
    pages = F.when(F.col("page") % 2 == 0, F.lit("even")).otherwise(F.lit("odd"))
    return variants.drift(raw.withColumn("pages", pages), "body", "pages")


# Coverage documents ------------------------------------------------------------------------------------


COUNTRY_SQL = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


def _countries_raw(t):
    """Customers as countries, a page per thousand: an old empty document, the newest one, and one with an
    unknown title. One region has no name."""
    country = F.struct(
        F.col("c_custkey"), F.col("c_name").alias("country"), F.lower("n_name").alias("data_market"),
        F.concat(F.lit("/f/"), F.col("c_custkey")).alias("country_flag"),
    )
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    regions = (
        t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(page_of("c_custkey").alias("page"), F.when(F.col("r_regionkey") > 0, F.col("r_name")).alias("region"))
        .agg(F.array_sort(F.collect_list(country)).alias("countries"))
    )
    documents = regions.groupBy("page").agg(F.to_json(F.collect_list(F.struct("region", "countries"))).alias("body"))
    versions = documents.select("page", "body", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("v"))
    title = F.when(F.col("v") == 2, F.lit("Other Coverage")).otherwise(F.lit(coverage.COUNTRIES_TITLE))
    body = F.when(F.col("v") == 0, F.lit("[]")).otherwise(F.col("body"))
    return landing(
        versions, "TV", "countries", body, title=title, url=F.concat(F.lit("/c/"), F.col("v")), page=F.col("page").cast("int"),
        fetched_at=F.when(F.col("v") == 0, F.lit("2025-01-01 00:00:00")).otherwise(F.lit("2025-01-02 00:00:00")),
    )


@query(
    "n40",
    "SELECT CASE WHEN r_regionkey > 0 THEN r_name ELSE 'Unknown' END AS region, c_name AS country, lower(n_name) AS data_market, "
    f"concat('/f/', c_custkey) AS country_flag FROM {COUNTRY_SQL}",
)
def n40(t):
    return coverage.countries(_countries_raw(t))


@query("n40_rejects", "SELECT DISTINCT 'Other Coverage' AS title, CAST(c_custkey // 1000 AS INT) AS page, '/c/2' AS url, 'unknown title' AS reason FROM customer")
def n40_rejects(t):
    return coverage.unknown_titles(_countries_raw(t))


EXCHANGE_SQL = (
    "(SELECT *, s_nationkey % 5 AS tab, s_suppkey % 40 AS x, row_number() OVER (PARTITION BY s_nationkey % 5, s_suppkey % 40 ORDER BY s_suppkey) AS rn FROM supplier)"
)


@query(
    "n41",
    "SELECT concat('X', x) AS exchange_name, s_name AS exchange_desc_name, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE concat('N', s_nationkey) END AS country, "
    f"concat('T', tab) AS types FROM (SELECT *, row_number() OVER (PARTITION BY x ORDER BY tab DESC) AS last FROM {EXCHANGE_SQL} WHERE rn = 1) WHERE last = 1",
)
def n41(t):
    return coverage.exchanges(_exchanges_raw(t)).withColumn("types", F.array_join("types", ","))


def _exchanges_raw(t):
    """Suppliers as exchanges, a page per hundred, each with five tabs and one empty one."""
    entry = F.struct(
        F.col("s_suppkey"), F.col("tab").alias("tab_no"),
        F.concat(F.lit("X"), F.col("s_suppkey") % 40).alias("exchangeName"), F.col("s_name").alias("exchangeDescName"),
        F.when(F.col("s_suppkey") % 3 == 0, F.lit("SPOT")).otherwise(F.concat(F.lit("N"), F.col("s_nationkey"))).alias("country"),
        F.lit(False).alias("is_world"), F.array(F.concat(F.lit("T"), F.col("tab"))).alias("types"),
    )
    pages = (
        t.supplier.withColumn("tab", F.col("s_nationkey") % 5)
        .groupBy(page_of("s_suppkey", 100).alias("page")).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    )
    tabs = F.transform(
        F.sequence(F.lit(0), F.lit(5)),
        lambda i: F.struct(
            F.concat(F.lit("exchanges_"), i).alias("exchange_type"), F.filter("entries", lambda e: e["tab_no"] == i).alias("exchanges")
        ),
    )
    return landing(
        pages, "TV", "exchanges", F.to_json(tabs), title=F.lit(coverage.EXCHANGES_TITLE), url=F.lit("/x"), page=F.col("page").cast("int")
    )


@query("n42", "SELECT lower(c_name) AS country FROM customer")
def n42(t):
    return coverage.country_names(_countries_raw(t))

"""Exchange calendars: nations are the exchanges, rules are derived from customers' orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotemill.normalise.coverage import calendar_rows, holiday_pages as parse_holiday_pages, holiday_rows as parse_holidays, trading_hours as parse_hours
from quotemill.operators import calendar as C
from quotemill.operators.merge import merge_rows
from quotemill.queries.registry import query
from quotemill.sources.tables import landing

FIRST, LAST = 1995, 2001


def _exchanges(t):
    late = F.col("n_nationkey") % 2 == 0
    return t.nation.select(
        F.col("n_name").alias("exchange"),
        F.concat(F.lit("Zone/"), F.col("n_regionkey")).alias("timezone"),
        F.when(late, F.lit("09:30:00")).otherwise(F.lit("09:00:00")).alias("open_time"),
        F.lit("16:00:00").alias("close_time"),
        F.when(F.col("n_nationkey") % 5 == 0, F.array(F.lit(4), F.lit(5))).otherwise(F.array(F.lit(5), F.lit(6))).alias("weekend"),
    )


def _days(t):
    """Order dates per nation."""
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    ).select(F.col("n_name").alias("exchange"), F.col("o_orderdate").cast("date").alias("date"), "o_orderkey", "o_totalprice")


def _holidays(t):
    return _days(t).where("o_totalprice > 475000").select("exchange", "date")


def _sessions(t):
    odd = _days(t).where("o_totalprice < 25000").groupBy("exchange", "date").agg(F.min("o_orderkey").alias("k"))
    return odd.select(
        "exchange", "date",
        F.when(F.col("k") % 3 > 0, F.lit("10:00:00")).alias("open_time"),
        F.when(F.col("k") % 3 > 0, F.lit("13:30:00")).alias("close_time"),
    )


RULES_SQL = """
WITH ex AS (
  SELECT n_name AS exchange, concat('Zone/', n_regionkey) AS timezone, CASE WHEN n_nationkey % 2 = 0 THEN '09:30:00' ELSE '09:00:00' END AS o,
    CASE WHEN n_nationkey % 5 = 0 THEN [5, 6] ELSE [6, 7] END AS weekend FROM nation
), od AS (
  SELECT n_name AS exchange, CAST(o_orderdate AS DATE) AS date, o_orderkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
), hol AS (SELECT DISTINCT exchange, date FROM od WHERE o_totalprice > 475000
), ses AS (SELECT exchange, date, min(o_orderkey) AS k FROM od WHERE o_totalprice < 25000 GROUP BY ALL
), spine AS (
  SELECT ex.*, CAST(d AS DATE) AS date, CAST(year(d) AS INT) AS year FROM ex, range(TIMESTAMP '1995-01-01', TIMESTAMP '2002-01-01', INTERVAL 1 DAY) r(d)
), days AS (
  SELECT s.exchange, s.timezone, s.year, s.date,
    CASE WHEN k IS NULL THEN o WHEN k % 3 > 0 THEN '10:00:00' END AS open_time,
    CASE WHEN k IS NULL THEN '16:00:00' WHEN k % 3 > 0 THEN '13:30:00' END AS close_time
  FROM spine s LEFT JOIN ses USING (exchange, date)
  WHERE NOT list_contains(weekend, isodow(s.date)) AND NOT EXISTS (SELECT 1 FROM hol WHERE hol.exchange = s.exchange AND hol.date = s.date)
), reg AS (
  SELECT exchange, year, any_value(timezone) AS timezone, arg_min(open_time, date) FILTER (open_time IS NOT NULL) AS open_time,
    arg_min(close_time, date) FILTER (close_time IS NOT NULL) AS close_time, CAST(count(*) AS INT) AS total_trading_days
  FROM days GROUP BY ALL
), hours AS (SELECT *, date_diff('second', CAST(open_time AS TIME), CAST(close_time AS TIME)) / 3600.0::DOUBLE AS regular_duration_hours FROM reg)
"""
CALENDAR_SQL = RULES_SQL + """
SELECT h.exchange, h.year, timezone, open_time, close_time, regular_duration_hours,
  coalesce((SELECT string_agg(strftime(date, '%Y-%m-%d'), ',' ORDER BY date) FROM hol WHERE hol.exchange = h.exchange AND year(date) = h.year), '') AS holidays,
  total_trading_days, make_date(h.year, 1, 1) AS period_start_date, make_date(h.year, 12, 31) AS period_end_date FROM hours h
"""


def _calendar(t):
    return C.market_calendar(_exchanges(t), _holidays(t), _sessions(t), FIRST, LAST)


@query("market_calendar", CALENDAR_SQL)
def market_calendar(t):
    return _calendar(t).withColumn("holidays", F.array_join("holidays", ","))


@query(
    "market_calendar_all",
    RULES_SQL + ", whole AS (SELECT exchange, any_value(timezone) AS timezone, arg_min(open_time, date) FILTER (open_time IS NOT NULL) AS open_time, "
    "arg_min(close_time, date) FILTER (close_time IS NOT NULL) AS close_time, CAST(count(*) AS INT) AS total_trading_days, min(date) AS period_start_date, "
    "max(date) AS period_end_date FROM days GROUP BY exchange) "
    "SELECT w.*, date_diff('second', CAST(open_time AS TIME), CAST(close_time AS TIME)) / 3600.0::DOUBLE AS regular_duration_hours, "
    "coalesce((SELECT string_agg(strftime(date, '%Y-%m-%d'), ',' ORDER BY date) FROM hol WHERE hol.exchange = w.exchange AND date BETWEEN period_start_date AND period_end_date), '') AS holidays FROM whole w",
)
def market_calendar_all(t):
    rows = C.whole_calendar(_exchanges(t), _holidays(t), _sessions(t), FIRST, LAST)
    return rows.withColumn("holidays", F.array_join("holidays", ","))


@query(
    "partial_days",
    RULES_SQL + "SELECT d.exchange, d.date, d.open_time, d.close_time, 3.5::DOUBLE AS duration_hours FROM days d JOIN hours h USING (exchange, year) "
    "WHERE d.open_time = '10:00:00' AND regular_duration_hours <> 3.5 "
    "UNION ALL SELECT d.exchange, d.date, d.open_time, d.close_time, date_diff('second', CAST(d.open_time AS TIME), CAST(d.close_time AS TIME)) / 3600.0::DOUBLE "
    "FROM days d JOIN hours h USING (exchange, year) WHERE d.open_time <> '10:00:00' AND "
    "date_diff('second', CAST(d.open_time AS TIME), CAST(d.close_time AS TIME)) / 3600.0::DOUBLE <> regular_duration_hours",
)
def partial_days(t):
    return C.partial_days(C.schedule(_exchanges(t), _holidays(t), _sessions(t), FIRST, LAST))


CALENDAR_BODY_SQL = (
    "SELECT o_orderkey, concat('X', o_custkey) AS exchange, concat('Zone/', o_orderstatus) AS timezone, '09:00:00' AS open_time, '15:00:00' AS close_time, "
    "6.0::DOUBLE AS regular_duration_hours, strftime(o_orderdate, '%Y-%m-%d') AS holidays, CAST(o_orderkey % 250 AS INT) AS total_trading_days, "
    "make_date(CAST(year(o_orderdate) AS INT), 1, 1) AS period_start_date, make_date(CAST(year(o_orderdate) AS INT), 12, 31) AS period_end_date FROM orders "
)


def _calendar_bodies(t):
    hours = F.when(
        F.col("o_orderkey") % 6 > 0, F.struct(F.lit("09:00:00").alias("open_time"), F.lit("15:00:00").alias("close_time"))
    )
    year = F.year("o_orderdate")
    body = F.to_json(
        F.struct(
            F.concat(F.lit("X"), F.col("o_custkey")).alias("exchange"),
            F.concat(F.lit("Zone/"), F.col("o_orderstatus")).alias("timezone"),
            hours.alias("regular_trading_hours"),
            F.lit(6.0).alias("regular_duration_hours"),
            F.array(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("holidays"),
            (F.col("o_orderkey") % 250).alias("total_trading_days"),
            F.struct(F.concat(year, F.lit("-01-01")).alias("start_date"), F.concat(year, F.lit("-12-31")).alias("end_date")).alias("period"),
        )
    )
    return landing(t.orders, "CAL", "calendar", body, symbol=F.col("o_orderkey"))


@query("calendar_flatten", CALENDAR_BODY_SQL + "WHERE o_orderkey % 6 > 0")
def calendar_flatten(t):
    rows, _ = calendar_rows(_calendar_bodies(t))
    return rows.withColumn("holidays", F.array_join("holidays", ",")).withColumn(
        "o_orderkey", F.col("symbol").cast("bigint")
    ).drop("symbol")


@query("calendar_rejects", "SELECT o_orderkey, 'no regular hours' AS reason FROM orders WHERE o_orderkey % 6 = 0")
def calendar_rejects(t):
    _, rejects = calendar_rows(_calendar_bodies(t))
    return rejects.select(F.col("symbol").cast("bigint").alias("o_orderkey"), "reason")


@query(
    "upsert_calendar",
    CALENDAR_SQL.replace("SELECT h.exchange, h.year, timezone", "SELECT h.exchange, CASE WHEN h.year = 2001 THEN 'moved' ELSE timezone END AS timezone, h.year").replace(
        "FROM hours h\n", "FROM hours h WHERE h.year = 2001\n"
    ),
)
def upsert_calendar(t):
    """Stored by exchange: of several years written, the last one stays."""
    rows = _calendar(t).withColumn("holidays", F.array_join("holidays", ","))
    moved = rows.where("year = 2001").withColumn("timezone", F.lit("moved"))
    old = rows.where("year < 2001")
    empty = rows.where(F.lit(False))
    return merge_rows(merge_rows(empty, old, ["exchange"], ["year"]), moved, ["exchange"], ["year"])


@query(
    "holiday_rows",
    "SELECT o_orderkey, 'MKT' AS market, concat('Holiday ', o_custkey) AS holiday, CAST(o_orderdate AS DATE) AS date, "
    "concat(strftime(o_orderdate, '%A, %B '), CAST(day(o_orderdate) AS VARCHAR), ', ', CAST(year(o_orderdate) AS VARCHAR)) AS long_date, "
    "CASE WHEN o_orderkey % 4 = 0 THEN 'Open, 9:30 AM - 1:05 PM, early' ELSE 'Closed' END AS status, "
    "CASE WHEN o_orderkey % 4 = 0 THEN '09:30' END AS open_local, CASE WHEN o_orderkey % 4 = 0 THEN '13:05' END AS close_local FROM orders",
)
def holiday_rows(t):
    """Bodies with a list of holiday names and a list of (date, status) rows, names one longer than rows."""
    status = F.when(F.col("o_orderkey") % 4 == 0, F.lit("Open, 9:30 AM - 1:05 PM\nearly✓")).otherwise(F.lit("Closed✗"))
    day = F.date_format("o_orderdate", "EEEE, MMMM d, yyyy")
    body = F.to_json(
        F.struct(
            F.array(F.concat(F.lit("Holiday "), F.col("o_custkey")), F.lit("beyond")).alias("holidays"),
            F.array(F.struct(F.concat(F.lit("✓"), day).alias("date"), status.alias("status"))).alias("rows"),
        )
    )
    raw = landing(t.orders, "TH", "holidays", body, symbol=F.lit("mkt"), url=F.col("o_orderkey"))
    rows = parse_holidays(raw)
    return rows.withColumn("o_orderkey", F.col("url").cast("bigint")).select(
        "o_orderkey", "market", "holiday", "date", "long_date", "status", "open_local", "close_local"
    )


def _holiday_pages(t):
    """A market page per order with a tab of other numbers and a tab of holidays; every ninth has no holidays tab."""
    status = F.when(F.col("o_orderkey") % 4 == 0, F.lit("Open, 9:30 AM - 1:05 PM<br>early✓")).otherwise(F.lit("Closed✗"))
    day = F.date_format("o_orderdate", "EEEE, MMMM d, yyyy")
    line = F.concat(
        F.lit("<tr><th>Holiday "), F.col("o_custkey"), F.lit("</th><td>✓"), day, F.lit("</td><td>"), status, F.lit("</td><td>more</td></tr>")
    )
    tab = F.concat(
        F.lit('<div class="tab" id="holidays-nav-list"><table><thead><tr><th>Holiday</th><th>Date</th><th>Status</th></tr></thead><tbody>'), line,
        F.lit("<tr><td>a note</td></tr><tr><th>beyond</th></tr></tbody></table></div>"),
    )
    body = F.concat(
        F.lit('<html><body><div id="hours-nav-list"><table><tr><th>Day</th><td>Monday</td><td>9:00</td></tr></table></div>'),
        F.when(F.col("o_orderkey") % 9 > 0, tab).otherwise(F.lit("<p>no holidays</p>")), F.lit("</body></html>"),
    )
    return landing(t.orders, "TH", "holidays", body, symbol=F.lit("mkt"), url=F.col("o_orderkey"))


@query(
    "holiday_pages",
    "SELECT o_orderkey, 'MKT' AS market, concat('Holiday ', o_custkey) AS holiday, CAST(o_orderdate AS DATE) AS date, "
    "CASE WHEN o_orderkey % 4 = 0 THEN 'Open, 9:30 AM - 1:05 PM, early' ELSE 'Closed' END AS status, "
    "CASE WHEN o_orderkey % 4 = 0 THEN '09:30' END AS open_local, CASE WHEN o_orderkey % 4 = 0 THEN '13:05' END AS close_local "
    "FROM orders WHERE o_orderkey % 9 > 0",
)
def holiday_pages(t):
    """The table of the market page itself."""
    rows, _ = parse_holiday_pages(_holiday_pages(t))
    return rows.select(F.col("url").cast("bigint").alias("o_orderkey"), "market", "holiday", "date", "status", "open_local", "close_local")


@query("holiday_page_rejects", "SELECT o_orderkey, 'no holidays table' AS reason FROM orders WHERE o_orderkey % 9 = 0")
def holiday_page_rejects(t):
    _, rejects = parse_holiday_pages(_holiday_pages(t))
    return rejects.select(F.col("url").cast("bigint").alias("o_orderkey"), "reason")


@query(
    "trading_hours",
    "SELECT concat('I', o_custkey % 90) AS iso2, o_orderkey::VARCHAR AS market_symbol, concat('Ex ', o_orderpriority) AS market_exchange, "
    "CASE WHEN o_orderkey % 7 > 0 THEN '09:00' END AS open_local, CASE WHEN o_orderkey % 7 > 0 THEN '14:45' END AS close_local, "
    "CASE WHEN o_orderkey % 7 > 0 THEN '+07' END AS timezone FROM orders",
)
def trading_hours(t):
    times = F.when(F.col("o_orderkey") % 7 > 0, F.lit("9:00 am - 11:30 am, 1:00 pm - 2:45 pm (+07)")).otherwise(F.lit("see site"))
    row = F.concat(
        F.lit("<tr><td>i"), F.col("o_custkey") % 90, F.lit("<br>Ex "), F.col("o_orderpriority"), F.lit("<br>"), F.col("o_orderkey"),
        F.lit("</td><td>"), times, F.lit("</td><td>x</td></tr>"),
    )
    body = F.concat(F.lit("<table><tr><th>Market</th><th>Hours</th><th>More</th></tr>"), row, F.lit("</table>"))
    return parse_hours(landing(t.orders, "TH", "hours", body, url=F.col("o_orderkey")))

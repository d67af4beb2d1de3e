"""Refresh planning, repeat suppression and streams; the SQL twins are plain batch queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotemill.normalise.charts import daily_bars
from quotemill.operators import stored
from quotemill.operators.merge import KeyedTable
from quotemill.operators.series import ohlc
from quotemill.operators.stored import folder_column, open_stored, read_stored
from quotemill.plans.refresh import page_coverage, refresh_periods, refresh_plan as plan
from quotemill.queries.payloads import AS_OF, CHART_SQL
from quotemill.queries.registry import DAILY, query
from quotemill.queries.scalars import PERIOD_SQL
from quotemill.queries.series import BARS_SQL
from quotemill.render import chart_bodies, record_bodies
from quotemill.session import scratch
from quotemill.sources.tables import append_raw
from quotemill.streaming.bars import stream_bars, stream_daily_bars
from quotemill.streaming.stores import latest_stream, upsert_stream
from quotemill.streaming.reports import BatchReports
from quotemill.streaming.repeats import suppress_stream, use_rocksdb
from quotemill.streaming.suppress import suppress_repeats

# Plans -------------------------------------------------------------------------------------------

NOW = "2001-10-01 18:00:00"


def _listed_and_stored(t):
    """Parts are the ticker list, repeats and blanks included; a negative one was never stored. Order
    lines are the stored prices."""
    listed = t.part.select(F.when(F.col("p_size") > 5, F.col("p_partkey")).otherwise(None).alias("ticker"))
    never = t.part.select((-1 - F.col("p_partkey")).alias("ticker"))
    stored = t.daily.select(
        "ticker", F.col("date").cast("timestamp_ntz").alias("date"),
        (F.col("date").cast("timestamp_ntz") + F.expr("INTERVAL 10 HOUR")).alias("updated"),
        F.when(F.col("n") % 2 == 0, F.lit("YAH")).otherwise(F.lit("INV")).alias("source"),
    )
    return listed.unionByName(listed).unionByName(never), stored


PERIODS_SQL = (
    f"(SELECT ticker, max_date, {PERIOD_SQL} AS period FROM (SELECT p_partkey AS ticker FROM part WHERE p_size > 5 UNION ALL SELECT -1 - p_partkey FROM part) "
    f"LEFT JOIN (SELECT ticker, max(date) AS max_date, date_diff('day', max(date), DATE '2001-10-01') AS days FROM {DAILY} GROUP BY ticker) USING (ticker) "
    f"WHERE ticker NOT IN (SELECT ticker FROM {DAILY} WHERE date = DATE '2001-10-01' AND n % 2 = 0))"
)


@query("refresh_periods", f"SELECT ticker, max_date, period FROM {PERIODS_SQL} WHERE period IS NOT NULL")
def periods(t):
    return refresh_periods(*_listed_and_stored(t), NOW)


@query(
    "refresh_plan",
    "SELECT ticker, max_date, period, CAST((row_number() OVER (ORDER BY ticker) - 1) // CAST(ceil(count(*) OVER () / 3.0) AS BIGINT) AS INT) AS chunk "
    f"FROM {PERIODS_SQL} WHERE period IS NOT NULL",
)
def refresh_plan(t):
    return plan(*_listed_and_stored(t), NOW)


@query(
    "page_gaps",
    "SELECT ticker, count(*) AS pages, max(page) AS last_page, max(page) - min(page) + 1 - count(*) AS missing_pages, max(d) AS max_date, "
    "CAST(date_diff('day', max(d), DATE '2001-10-01') AS INT) AS remaining_days, "
    "date_diff('day', max(d), DATE '2001-10-01') > 5 OR max(page) - min(page) + 1 - count(*) > 0 AS wanted FROM "
    f"(SELECT ticker, o // 1000 AS page, max(date) AS d FROM {DAILY} GROUP BY ALL) GROUP BY ticker",
)
def page_gaps(t):
    pages = t.daily.select("ticker", F.floor(F.col("o") / 1000).alias("page"), "date")
    return page_coverage(pages, NOW[:10])


# Repeats within a time to live --------------------------------------------------------------------------

TTL_SQL = """
WITH RECURSIVE f AS (
  SELECT user_id, ts, min(event_id) AS event_id FROM events GROUP BY ALL
), a(user_id, ts) AS (
  SELECT user_id, min(ts) FROM f GROUP BY user_id
  UNION ALL
  SELECT a.user_id, (SELECT min(f.ts) FROM f WHERE f.user_id = a.user_id AND f.ts >= a.ts + INTERVAL {0} SECOND) FROM a WHERE a.ts IS NOT NULL
)
SELECT a.user_id, a.ts, f.event_id FROM a JOIN f USING (user_id, ts)
"""


def _repeats(t):
    return t.events.select("user_id", "ts", "event_id")


@query("ttl_suppress", TTL_SQL.format(86400))
def ttl_suppress(t):
    return suppress_repeats(_repeats(t), "user_id", "ts", ["event_id"], 86400)


@query("ttl_suppress_sliced", TTL_SQL.format(7200))
def ttl_suppress_sliced(t):
    """A short time to live: slices of two days, several of them for every user."""
    return suppress_repeats(_repeats(t), "user_id", "ts", ["event_id"], 7200)


# Streams: each reads a table or a landing folder to its end and leaves its result in a keyed table ------------


def _stream(t, name):
    """A table as a stream; the pattern matches a single file as well as a folder of files."""
    return t.spark.readStream.schema(getattr(t, name).schema).parquet(f"{t.folder}/{name}.parque[t]")


def _finish(query_):
    query_.awaitTermination()


def _shuffled_feed(t):
    """The events in three files by id, so that times go back and forth from file to file, and a last one that closes the feed."""
    path, rows = scratch(t.spark, "feed"), t.events.select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id")
    for k in range(3):
        rows.where(F.pmod("event_id", F.lit(3)) == k).coalesce(1).write.mode("append").parquet(path)
    end = F.make_dt_interval(F.lit(2 * FEED_DAYS))
    closing = rows.groupBy().agg((F.max("ts") + end).alias("ts")).select(F.lit(None).cast("bigint").alias("user_id"), "ts", F.lit(-1).cast("bigint").alias("event_id"))
    closing.write.mode("append").parquet(path)
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


FEED_DAYS = 400  # the events of all files are of one year: none is late


@query("ttl_stream", TTL_SQL.format(86400))
def ttl_stream(t):
    """Each file's rows are out of order with those of the others; nothing is decided before the watermark has passed it."""
    use_rocksdb(t.spark)
    sink, rejects = scratch(t.spark, "accepted"), scratch(t.spark, "late")
    _finish(suppress_stream(_shuffled_feed(t), sink, rejects, scratch(t.spark, "offsets"), "user_id", "ts", ["event_id"], 86400, f"{FEED_DAYS} days"))
    found = t.spark.read.parquet(sink)
    return found.select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id")


ROW_KEY = "(o, n, s, volume, close)"


def _bar_table(t, bars):
    """Daily bars by ticker and day, in folders by month."""
    schema = bars.withColumn("month", F.date_format("date", "yyyy-MM")).schema
    return KeyedTable(t.spark, scratch(t.spark, "bars"), schema, ["ticker", "date"], ["month"])


def _landed_days(t):
    """Daily bars of the ticks, and their landed bodies: records per ticker, a page per month."""
    days = ohlc(t.ticks, ["ticker"], "ts", "1 day", ["event_id"]).withColumn("date", F.to_date("start"))
    names = ("ticker", "date", "open", "high", "low", "close", "volume")
    record = lambda c: F.struct(*[c(name).alias(name) for name in names])
    bodies = lambda rows, sent: record_bodies(
        rows, F.col("ticker"), F.year("date") * 12 + F.month("date"), ["date"], record, fields=names
    ).withColumn("title", F.lit(sent))
    return days, bodies


DAY_SQL = BARS_SQL.format("1 day")
RECORD = "array<struct<ticker: string, date: date, open: double, high: double, low: double, close: double, volume: bigint>>"


def _parse_days(raw):
    rows = raw.select(F.inline(F.from_json("body", RECORD)))
    return rows.withColumn("month", F.date_format("date", "yyyy-MM"))


STORED_SQL = (
    "SELECT ticker, CAST(date AS TIMESTAMP) AS date, price AS open, price + 1 AS high, price - 1 AS low, price AS close, size::DOUBLE AS volume, 'YAH' AS source, "
    f"adj AS adjclose, TIMESTAMP '{AS_OF}' AS updated FROM (SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY datetime, page, pos) AS rn FROM {CHART_SQL}) WHERE rn = 1"
)


@query("stream_upsert", STORED_SQL)
def stream_upsert(t):
    """Landed chart bodies, streamed through their normaliser into the stored daily prices."""
    folder, root = scratch(t.spark, "landing"), scratch(t.spark, "stored")
    append_raw(chart_bodies(t.ticks), folder, AS_OF)
    landed = t.spark.read.parquet(folder).schema
    stream = t.spark.readStream.schema(landed).parquet(folder)
    month, derived = folder_column("day_prices")

    def normalise(raw):
        bars = daily_bars(raw, AS_OF)
        return bars.withColumns({"updated": F.col("updated").cast("timestamp_ntz"), month: derived})

    _finish(upsert_stream(stream, open_stored(t.spark, root, "day_prices"), scratch(t.spark, "offsets"), normalise=normalise))
    return read_stored(t.spark, root, "day_prices")


@query(
    "insert_frame",
    STORED_SQL.replace("price AS close", "CASE WHEN day(date) > 15 THEN -price ELSE price END AS close")
    .replace("'YAH' AS source", "CASE WHEN day(date) > 15 THEN NULL ELSE 'YAH' END AS source"),
)
def insert_frame(t):
    """Prices stored, then a frame with some columns of some keys: its nulls count, its missing columns stay."""
    root = scratch(t.spark, "stored")
    bars = daily_bars(chart_bodies(t.ticks), AS_OF)
    stored.insert_frame(t.spark, root, "day_prices", bars)
    changed = bars.where(F.dayofmonth("date") > 15).select(
        "ticker", "date", (-F.col("close")).alias("close"), F.lit(None).cast("string").alias("source")
    )
    stored.insert_frame(t.spark, root, "day_prices", changed)
    return read_stored(t.spark, root, "day_prices")


@query(
    "insert_frame_repeats",
    f"SELECT ticker, CAST(date AS TIMESTAMP) AS date, arg_max(close, {ROW_KEY}) AS close, arg_max(volume, {ROW_KEY}) AS volume FROM {DAILY} GROUP BY ticker, date",
)
def insert_frame_repeats(t):
    """A frame with many rows of one ticker and day: in the order of lines the last one stays."""
    root = scratch(t.spark, "stored")
    rows = t.daily.select("ticker", "date", "close", "volume", "o", "n", "s").withColumn("ticker", F.col("ticker").cast("string"))
    stored.insert_frame(t.spark, root, "day_prices", rows, ("o", "n", "s", "volume", "close"))
    return read_stored(t.spark, root, "day_prices").select(F.col("ticker").cast("bigint").alias("ticker"), "date", "close", "volume")


@query(
    "stored_null_keys",
    f"SELECT count(*) FILTER (ticker % 5 > 0 AND o % 7 > 0) AS stored, count(*) FILTER (ticker % 5 = 0 OR o % 7 = 0) AS rejected, "
    "count(*) FILTER (ticker % 5 = 0 AND o % 7 = 0) AS without_both FROM (SELECT DISTINCT ticker, date, o, n, s, volume, close FROM " + DAILY + ")",
)
def stored_null_keys(t):
    """Rows without a ticker or a date are rejects, each of them, and the others are stored."""
    root = scratch(t.spark, "stored")
    rows = t.daily.distinct().select(
        F.when(F.col("ticker") % 5 > 0, F.concat_ws("/", "ticker", "o", "n", "s", "volume", "close")).alias("ticker"),
        F.when(F.col("o") % 7 > 0, F.col("date")).alias("date"), "close",
    )
    stored.insert_frame(t.spark, root, "day_prices", rows, (), AS_OF)
    rejects = stored.read_rejects(t.spark, root)
    kept = read_stored(t.spark, root, "day_prices").agg(F.count(F.lit(1)).alias("stored"))
    lost = rejects.agg(F.count(F.lit(1)).alias("rejected"), F.count_if(F.col("reason") == "no key: ticker, date").alias("without_both"))
    return kept.withColumn("_k", F.lit(1)).join(lost.withColumn("_k", F.lit(1)), "_k").drop("_k")


@query(
    "late_bars",
    "SELECT ticker, CAST(start AS DATE) AS date, open, high, low, CASE WHEN day(start) > 20 THEN close * 2 ELSE close END AS close, volume, "
    f"strftime(start, '%Y-%m') AS month FROM ({DAY_SQL})",
)
def late_bars(t):
    """Bars of the end of the month are sent again, corrected, long after: the stream goes on from its
    checkpoint, and the corrected bars replace the old ones."""
    days, bodies = _landed_days(t)
    folder, offsets = scratch(t.spark, "landing"), scratch(t.spark, "offsets")
    append_raw(bodies(days, "first"), folder, "2025-01-02 16:00:00")
    landed = t.spark.read.parquet(folder).schema
    table = _bar_table(t, days.select("ticker", "date", "open", "high", "low", "close", "volume"))
    stream = t.spark.readStream.schema(landed).parquet(folder)
    _finish(upsert_stream(stream, table, offsets, normalise=_parse_days))
    corrected = days.where(F.dayofmonth("date") > 20).withColumn("close", F.col("close") * 2)
    append_raw(bodies(corrected, "second"), folder, "2025-01-03 16:00:00")
    _finish(upsert_stream(stream, table, offsets, normalise=_parse_days))
    return table.read()


@query(
    "stream_latest",
    "SELECT o_custkey AS title, o_orderdate AS fetched_at, concat('/o/', o_orderkey) AS url, o_orderpriority AS body, CAST(o_custkey % 4 AS BIGINT) AS bucket FROM ("
    "SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, concat('/o/', o_orderkey)) AS rn FROM orders) WHERE rn = 1",
)
def stream_latest(t):
    documents = _stream(t, "orders").select(
        F.col("o_custkey").alias("title"), F.col("o_orderdate").alias("fetched_at"),
        F.concat(F.lit("/o/"), F.col("o_orderkey")).alias("url"), F.col("o_orderpriority").alias("body"),
    )
    newest = latest_stream(documents).withColumn("bucket", F.col("title") % 4)
    table = KeyedTable(t.spark, scratch(t.spark, "latest"), newest.schema, ["title"], ["bucket"])
    _finish(upsert_stream(newest, table, scratch(t.spark, "offsets"), mode="update"))
    return table.read()


@query("stream_ohlc", BARS_SQL.format("5 minutes").replace("count(*) AS trades", "count(*) AS trades, CAST(time_bucket(INTERVAL '5 minutes', ts) AS DATE) AS day"))
def stream_ohlc(t):
    ticks = _stream(t, "events").select(
        F.concat(F.lit("T"), F.col("user_id")).alias("ticker"), F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"), F.get_json_object("props", "$.k").cast("bigint").alias("size"), "event_id",
    )
    bars = stream_bars(ticks, ["ticker"], "ts", "5 minutes", "1 hour", ["event_id"])
    bars = bars.withColumns({"start": F.col("start").cast("timestamp_ntz"), "day": F.to_date("start")})
    table = KeyedTable(t.spark, scratch(t.spark, "bars"), bars.schema, ["ticker", "start"], ["day"])
    _finish(upsert_stream(bars, table, scratch(t.spark, "offsets"), mode="update"))
    return table.read()


def _tick_feed(t, parts):
    """Ticks in a file for each condition, in this order, and a last file with one tick long after all others."""
    path = scratch(t.spark, "ticks")
    rows = t.ticks.select("ticker", F.col("ts").cast("timestamp").alias("ts"), "price", "size", "event_id")
    for part in parts:
        rows.where(part).coalesce(1).write.mode("append").parquet(path)
    last = rows.groupBy().agg((F.max("ts") + F.make_dt_interval(F.lit(100))).alias("ts"))
    last.select(F.lit("END").alias("ticker"), "ts", F.lit(0.0).alias("price"), F.lit(0).cast(rows.schema["size"].dataType).alias("size"), F.lit(-1).cast("bigint").alias("event_id")).write.mode("append").parquet(path)
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _daily_bars_stream(t, feed, delay):
    """(closed daily bars, reports of the batches)."""
    path, reports = scratch(t.spark, "days"), BatchReports()
    t.spark.streams.addListener(reports)
    try:
        bars = stream_daily_bars(feed, ["ticker"], "ts", delay, ["event_id"])
        query_ = bars.writeStream.format("parquet").option("path", path).option("checkpointLocation", scratch(t.spark, "offsets")).trigger(availableNow=True).start()
        _finish(query_)
        return t.spark.read.schema(bars.schema).parquet(path), reports.report(t.spark, query_)
    finally:
        t.spark.streams.removeListener(reports)


@query("stream_ohlc_day", BARS_SQL.format("1 day"))
def stream_ohlc_day(t):
    """Daily bars out of five-minute bars in one stream, every tick sent twice, in files out of order."""
    feed = _tick_feed(t, [F.pmod("event_id", F.lit(2)) == 0, F.pmod("event_id", F.lit(2)) == 1, F.lit(True)])
    days, _ = _daily_bars_stream(t, feed, "60 days")
    return days.withColumn("start", F.col("start").cast("timestamp_ntz"))


# The watermark has whole milliseconds.
LATE = "event_id % 10 = 3 AND ts <= (SELECT date_trunc('millisecond', max(ts)) FROM events WHERE event_id % 10 <> 3) - INTERVAL 2 HOUR"


@query(
    "stream_late_ticks",
    f"SELECT (SELECT count(*) FROM events WHERE {LATE}) AS rows_late, (SELECT count(*) + 1 FROM events) AS rows_in, "
    f"(SELECT count(*) FROM events WHERE NOT ({LATE})) AS in_bars",
)
def stream_late_ticks(t):
    """A tenth of the ticks comes last: those more than two hours old by then are dropped, and the reports say how many.

    A batch drops by the watermark the batch before it ran with, so an empty file comes between.
    """
    tenth = F.pmod("event_id", F.lit(10)) == 3
    days, reports = _daily_bars_stream(t, _tick_feed(t, [~tenth, F.lit(False), tenth]), "2 hours")
    kept = days.agg(F.sum("trades").alias("in_bars"))
    counted = reports.agg(F.sum("rows_late").alias("rows_late"), F.sum("rows_in").alias("rows_in"))
    return counted.withColumn("_k", F.lit(1)).join(kept.withColumn("_k", F.lit(1)), "_k").drop("_k")

"""Streams over many small files end where the batch ends."""

from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from quotemill.operators.latest import latest_with_smallest
from quotemill.operators.merge import KeyedTable
from quotemill.operators.series import ohlc
from quotemill.session import scratch
from quotemill.streaming.bars import stream_bars
from quotemill.streaming.stores import latest_stream, upsert_stream
from quotemill.streaming.repeats import suppress_stream, use_rocksdb
from quotemill.streaming.suppress import suppress_repeats


def in_files(spark, df, order, files=4):
    """The rows in time order, one file after the other, so that each is a micro-batch."""
    path = scratch(spark, "feed")
    total = df.count()
    marked = df.orderBy(order).limit(total).coalesce(1).withColumn("_n", F.monotonically_increasing_id())
    for i in range(files):
        part = marked.where((F.col("_n") >= i * total // files) & (F.col("_n") < (i + 1) * total // files))
        part.drop("_n").write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def ticks(tables):
    return tables.ticks.withColumn("ts", F.col("ts").cast("timestamp")).where("event_id < 400")


def test_bars(spark, tables):
    source = ticks(tables)
    bars = stream_bars(in_files(spark, source, "ts"), ["ticker"], "ts", "1 day", "1 hour", ["event_id"]).withColumn("p", F.lit(0))
    table = KeyedTable(spark, scratch(spark, "bars"), bars.schema, ["ticker", "start"], ["p"])
    upsert_stream(bars, table, scratch(spark, "offsets"), mode="update").awaitTermination()
    batch = ohlc(source, ["ticker"], "ts", "1 day", ["event_id"])
    assert rows(table.read().drop("p")) == rows(batch)


def test_closed_bars_come_once(spark, tables):
    """In append mode a bar comes when the watermark has passed it, and it is the batch's bar."""
    source = ticks(tables)
    bars = stream_bars(in_files(spark, source, "ts"), ["ticker"], "ts", "1 hour", "1 hour", ["event_id"])
    path = scratch(spark, "closed")
    bars.writeStream.format("parquet").option("path", path).option("checkpointLocation", scratch(spark, "offsets")).trigger(
        availableNow=True
    ).start().awaitTermination()
    closed = rows(spark.read.schema(bars.schema).parquet(path))
    batch = set(rows(ohlc(source, ["ticker"], "ts", "1 hour", ["event_id"])))
    assert closed and len(closed) == len(set(closed)) and set(closed) <= batch and len(closed) > len(batch) / 2


def test_latest(spark, tables):
    documents = tables.orders.select(
        F.col("o_custkey").alias("title"), F.col("o_orderdate").alias("fetched_at"), F.col("o_orderkey").cast("string").alias("url")
    )
    newest = latest_stream(in_files(spark, documents, "url")).withColumn("p", F.lit(0))
    table = KeyedTable(spark, scratch(spark, "latest"), newest.schema, ["title"], ["p"])
    upsert_stream(newest, table, scratch(spark, "offsets"), mode="update").awaitTermination()
    assert rows(table.read().drop("p")) == rows(latest_with_smallest(documents, ["title"], "fetched_at", "url"))


def closing(df, days):
    """A row without a key, far behind all others: the watermark then passes them."""
    end = F.max("ts") + F.make_dt_interval(F.lit(days))
    return df.groupBy().agg(end.alias("ts")).select(F.lit(None).cast("string").alias("ticker"), "ts", F.lit(-1).cast("bigint").alias("event_id"))


def suppressed(spark, files, delay, ttl=86400):
    path, sink, late = scratch(spark, "feed"), scratch(spark, "accepted"), scratch(spark, "late")
    for part in files:
        part.coalesce(1).write.mode("append").parquet(path)
    use_rocksdb(spark)
    feed = spark.readStream.schema(files[0].schema).option("maxFilesPerTrigger", 1).parquet(path)
    suppress_stream(feed, sink, late, scratch(spark, "offsets"), "ticker", "ts", ["event_id"], ttl, delay).awaitTermination()
    return spark.read.parquet(sink), spark.read.parquet(late)


def test_suppression_of_files_out_of_order(spark, tables):
    """Three files whose times go back and forth within the delay: accepted is what the batch form accepts."""
    source = ticks(tables).select("ticker", "ts", "event_id")
    parts = [source.where(F.pmod("event_id", F.lit(3)) == k) for k in range(3)]
    found, late = suppressed(spark, [*parts, closing(source, 100)], "40 days")
    batch = suppress_repeats(source, "ticker", "ts", ["event_id"], 86400)
    assert rows(found, "ticker", "ts", "event_id") == rows(batch, "ticker", "ts", "event_id")
    assert found.select("batch").distinct().count() >= 1 and late.count() == 0


def test_late_rows_are_kept_apart(spark):
    """Rows more than the delay behind the newest one are rejects, each of them, and block nothing."""
    at = lambda ticker, hour, ident: (ticker, f"2024-01-{1 + hour // 24:02d} {hour % 24:02d}:00:00.123456", ident)
    frame = lambda data: spark.createDataFrame(data, "ticker string, ts string, event_id long").withColumn("ts", F.col("ts").cast("timestamp"))
    first = frame([at("a", 10, 1), at("a", 12, 2), at("b", 30, 3), at("a", 100, 4)])
    second = frame([at("a", 11, 5), at("c", 20, 6), at("a", 99, 7), at("c", 101, 8), at("b", 97, 9)])
    third = frame([at("b", 150, 10), at("a", 122, 11)])
    found, late = suppressed(spark, [first, second, third, closing(third, 30)], "5 hours", 24 * 3600)
    assert sorted(r["event_id"] for r in late.collect()) == [5, 6]  # 11 is in the file that moves the watermark
    assert sorted(r["event_id"] for r in found.collect()) == [1, 3, 7, 8, 9, 10]
    assert found.where("event_id = 1").first()["ts"].microsecond == 123456

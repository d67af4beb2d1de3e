"""Keyed tables: cells, repeats, touched partitions, and a run that dies between stage and swap."""

from __future__ import annotations

import glob

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quotemill.operators.merge import KeyedTable, merge_rows
from quotemill.session import scratch


def frame(spark, data, schema="k int, p int, a string, b string"):
    return spark.createDataFrame(data, schema)


def test_null_overwrites_and_absent_column_stays(spark):
    base = frame(spark, [(1, 0, "a", "b"), (2, 0, "c", "d")])
    delta = spark.createDataFrame([(1, 0, None), (3, 0, "new")], "k int, p int, a string")
    assert rows(merge_rows(base, delta, ["k", "p"])) == [(1, 0, None, "b"), (2, 0, "c", "d"), (3, 0, "new", None)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_last_write_wins_inside_a_delta(spark, partitions):
    base = frame(spark, [(1, 0, "a", "b")])
    delta = spark.range(500).select(F.lit(1).alias("k"), F.lit(0).alias("p"), F.col("id").cast("string").alias("a"), "id").repartition(partitions)
    assert rows(merge_rows(base, delta, ["k", "p"], ["id"])) == [(1, 0, "499", "b")]


def table(spark):
    return KeyedTable(spark, scratch(spark, "table"), frame(spark, []).schema, ["k"], ["p"])


def test_repeated_batch_changes_nothing(spark):
    stored = table(spark)
    stored.upsert(frame(spark, [(1, 0, "a", "b"), (2, 1, "c", "d")]))
    delta = frame(spark, [(1, 0, "z", None), (3, 1, "e", "f")])
    stored.upsert(delta)
    once = rows(stored.read(), "k", "p", "a", "b")
    stored.upsert(delta)
    assert rows(stored.read(), "k", "p", "a", "b") == once == [(1, 0, "z", None), (2, 1, "c", "d"), (3, 1, "e", "f")]


def test_untouched_partitions_are_not_rewritten(spark):
    stored = table(spark)
    stored.upsert(frame(spark, [(1, 0, "a", "b"), (2, 1, "c", "d")]))
    path = stored.path.replace("file:", "")
    before = set(glob.glob(f"{path}/p=1/*.parquet"))
    stored.upsert(frame(spark, [(1, 0, "x", "y")]))
    assert before and set(glob.glob(f"{path}/p=1/*.parquet")) == before


def test_a_null_key_is_an_error(spark):
    with pytest.raises(Exception, match="null in key k"):
        merge_rows(frame(spark, [(1, 0, "a", "b")]), frame(spark, [(None, 0, "x", "y")]), ["k", "p"]).collect()


def test_empty_delta_is_no_write(spark):
    stored = table(spark)
    stored.upsert(frame(spark, []))
    assert stored.read().count() == 0


def test_a_run_that_dies_before_the_swap_is_finished_by_the_next(spark):
    stored = table(spark)
    stored.upsert(frame(spark, [(1, 0, "a", "b"), (2, 1, "c", "d")]))
    swap = stored._swap

    def die():
        raise RuntimeError("executor lost")

    stored._swap = die
    with pytest.raises(RuntimeError):
        stored.upsert(frame(spark, [(1, 0, "x", "y")]))
    assert rows(stored.read(), "k", "a") == [(1, "a"), (2, "c")]
    stored._swap = swap
    stored.upsert(frame(spark, [(3, 1, "n", "n")]))
    assert rows(stored.read(), "k", "a") == [(1, "x"), (2, "c"), (3, "n")]


def test_a_lost_partition_comes_back_from_the_stage(spark):
    """As if the swap had removed a partition and died before writing it again."""
    stored = table(spark)
    stored.upsert(frame(spark, [(1, 0, "a", "b"), (2, 0, "c", "d"), (3, 1, "e", "f")]))
    swap = stored._swap

    def half():
        frame(spark, [(99, 0, "torn", None)]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("p").parquet(stored.path)
        raise RuntimeError("driver lost")

    stored._swap = half
    with pytest.raises(RuntimeError):
        stored.upsert(frame(spark, [(1, 0, "x", "y")]))
    stored._swap = swap
    stored.recover()
    assert rows(stored.read(), "k", "a") == [(1, "x"), (2, "c"), (3, "e")]


def test_a_repeated_key_without_an_order_is_an_error(spark):
    from quotemill.operators.merge import merge_rows

    base, delta = frame(spark, [(1, 0, "a", "b")]), frame(spark, [(2, 0, "c", "d"), (2, 0, "e", "f")])
    with pytest.raises(Exception, match="repeats and no order"):
        merge_rows(base, delta, ["k"]).collect()
    assert rows(merge_rows(base, delta, ["k"], ["a"]), "k", "a") == [(1, "a"), (2, "e")]


def test_unkeyed_rows_and_bodies_are_rejects_once(spark):
    from quotemill.operators import stored

    root = scratch(spark, "stored")
    prices = spark.sql("SELECT * FROM VALUES ('a', timestamp_ntz'2025-01-02', 1.0D), ('b', NULL, 2.0D), (NULL, NULL, 3.0D) AS t(ticker, date, close)")
    for _ in range(2):
        stored.insert_frame(spark, root, "day_prices", prices, as_of="2025-01-02 16:00:00")
    assert rows(stored.read_stored(spark, root, "day_prices"), "ticker", "close") == [("a", 1.0)]
    assert sorted(r["reason"] for r in stored.read_rejects(spark, root).collect()) == ["no key: date", "no key: ticker, date"]


def test_a_stream_goes_on_past_rows_without_a_key(spark):
    from quotemill.streaming.stores import upsert_stream

    path, late = scratch(spark, "feed"), scratch(spark, "rejects")
    frame(spark, [(1, 0, "a", "b"), (None, 0, "c", "d")]).write.parquet(path)
    kept = table(spark)
    feed = spark.readStream.schema(kept.schema).parquet(path)
    upsert_stream(feed, kept, scratch(spark, "offsets"), rejects=late).awaitTermination()
    assert rows(kept.read(), "k", "a") == [(1, "a")] and rows(spark.read.parquet(late), "a") == [("c",)]


def test_a_merge_into_a_table_not_yet_written_joins_nothing(spark):
    stored = table(spark)
    merged = merge_rows(stored._rows(stored.path).where("p IN (0, 1)"), frame(spark, [(1, 0, "a", "b"), (1, 0, "c", None)]), ["k", "p"], ["a"])
    text = merged._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.count("ExistingRDD") + text.count("LocalTableScan") == 1
    assert rows(merged, "k", "p", "a", "b") == [(1, 0, "c", None)] and stored.read().schema == stored.schema


def test_reading_writes_nothing(spark, tmp_path):
    stored = KeyedTable(spark, str(tmp_path / "none"), frame(spark, []).schema, ["k"], ["p"])
    assert stored.read().collect() == [] and list(tmp_path.iterdir()) == []


def test_a_reader_during_a_swap_sees_the_whole_write(spark):
    """As if the swap had replaced one of two partitions so far."""
    stored = table(spark)
    stored.upsert(frame(spark, [(1, 0, "a", "b"), (2, 1, "c", "d"), (3, 2, "e", "f")]))
    swap = stored._swap

    def half():
        stored._note("swapping")
        frame(spark, [(1, 0, "x", "b")]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("p").parquet(stored.path)
        raise RuntimeError("driver lost")

    stored._swap = half
    with pytest.raises(RuntimeError):
        stored.upsert(spark.createDataFrame([(1, 0, "x"), (2, 1, "y")], "k int, p int, a string"))
    after = [(1, 0, "x", "b"), (2, 1, "y", "d"), (3, 2, "e", "f")]
    assert rows(stored.read(), "k", "p", "a", "b") == after
    stored._swap = swap
    stored.recover()
    assert rows(stored.read(), "k", "p", "a", "b") == after


def bucketed(spark, path=None, **options):
    from quotemill.operators.bucketed import BucketedTable

    return BucketedTable(spark, path or scratch(spark, "bucketed"), frame(spark, []).schema, ["k"], 4, **options)


def test_an_upsert_does_not_shuffle_the_stored_rows(spark):
    stored = bucketed(spark)
    assert stored.read().collect() == []
    stored.upsert(spark.range(2000).select(F.col("id").cast("int").alias("k"), F.lit(0).alias("p"), F.lit("a").alias("a"), F.lit("b").alias("b")))
    delta = spark.createDataFrame([(5, "x", 1), (5, "y", 2), (9000, "z", 1)], "k int, a string, n int")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = stored.merged(delta, ["n"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    scan = next(i for i, line in enumerate(plan.splitlines()) if "FileScan parquet" in line and "Bucketed: true" in line)
    depth = [len(line) - len(line.lstrip(" :+-*|")) for line in plan.splitlines()]
    above, level = [], depth[scan]
    for i in range(scan, -1, -1):  # the nodes between the scan and the root
        if depth[i] < level:
            above.append(plan.splitlines()[i])
            level = depth[i]
    assert any("Join" in line for line in above) and not any("Exchange" in line for line in above)
    for _ in range(3):
        stored.upsert(delta, ["n"])
    found = {r["k"]: tuple(r) for r in stored.read().where("k IN (5, 6, 9000)").collect()}
    assert found == {5: (5, 0, "y", "b"), 6: (6, 0, "a", "b"), 9000: (9000, None, "z", None)} and stored.read().count() == 2001


def test_a_write_that_dies_leaves_the_bucketed_table(spark):
    stored = bucketed(spark)
    stored.upsert(frame(spark, [(1, 0, "a", "b"), (2, 0, "c", "d")]))
    with pytest.raises(Exception, match="null in key k"):
        stored.upsert(frame(spark, [(None, 0, "x", "y")]))
    with pytest.raises(Exception, match="repeats and no order"):
        stored.upsert(frame(spark, [(2, 0, "x", "y"), (2, 0, "z", "y")]))
    again = bucketed(spark, stored.path)
    spark.sql(f"DROP TABLE IF EXISTS {again._name('a')}")  # as a new session would find it
    assert rows(again.read(), "k", "a") == [(1, "a"), (2, "c")] and again.current()["version"] == 1
    again.upsert(frame(spark, []))
    again.upsert(frame(spark, [(2, 0, "n", None)]))
    assert rows(again.read(), "k", "a", "b") == [(1, "a", "b"), (2, "n", None)] and again.current()["version"] == 2


def test_buckets_grow_with_the_files(spark):
    stored = bucketed(spark, bucket_bytes=100)
    stored.upsert(frame(spark, [(i, 0, f"a{i}", "b") for i in range(50)]))
    stored.upsert(frame(spark, [(7, 0, "x", "y")]))
    assert stored.current()["buckets"] > 4 and stored.read().count() == 50
    assert rows(stored.read().where("k = 7"), "k", "a") == [(7, "x")]

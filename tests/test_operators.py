"""Operators: order does not matter, long keys are cut, plans stay parallel."""

from __future__ import annotations

import itertools
import math
import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from quotemill.operators import chunks, filters, joins, latest, series, unions
from quotemill.operators import aggregates
from quotemill.operators.aggregates import exact_quantiles
from quotemill.operators.quality import cast_prices, clean_to_store, load_report, split_rejects
from quotemill.functions import numbers as N
from quotemill.session import scratch


def skewed(spark, count=600):
    """One key holds most rows; dates and values repeat; some values are null."""
    rng = random.Random(7)
    data = [
        ("hot" if i % 3 else f"k{i % 5}", f"2024-{1 + rng.randrange(12):02d}-{1 + rng.randrange(3):02d}", i,
         None if rng.random() < 0.2 else float(rng.randrange(50)))
        for i in range(count)
    ]
    return spark.createDataFrame(data, "k string, d string, i int, v double").withColumn("d", F.col("d").cast("date"))


@pytest.mark.parametrize("partitions", [1, 4, 50])
def test_first_and_last_do_not_depend_on_partitions(spark, partitions):
    df = skewed(spark).repartition(partitions)
    first, last = latest.keep_first(df, ["k", "d"], ["i"]), latest.keep_last(df, ["k", "d"], ["i"])
    by_key = {}
    for r in df.collect():
        by_key.setdefault((r.k, r.d), []).append(tuple(r))
    assert rows(first) == sorted((min(v, key=lambda r: r[2]) for v in by_key.values()), key=repr)
    assert rows(last) == sorted((max(v, key=lambda r: r[2]) for v in by_key.values()), key=repr)


def test_first_and_last_of_odd_frames(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'b', map('x', 1)), (1, 'a', map('y', 2)) AS t(k, o, m)")
    assert latest.keep_first(df, ["k"], ["o"]).first().m == {"y": 2}  # maps have no order of their own
    assert latest.keep_last(df.drop("m"), ["k", "o"], ["o"]).count() == 2  # an order column that is a key
    assert latest.keep_last(df.select("k"), ["k"], ["k"]).count() == 1  # nothing but the key


def test_newest_with_smallest(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('a', timestamp_ntz'2024-01-01', 'z'), ('a', timestamp_ntz'2024-01-02', 'y'), ('a', timestamp_ntz'2024-01-02', 'x'), ('b', timestamp_ntz'2023-01-01', 'q') AS t(k, at, u)"
    )
    assert [(r.k, r.u) for r in latest.latest_with_smallest(df, ["k"], "at", "u").orderBy("k").collect()] == [("a", "x"), ("b", "q")]


@pytest.mark.parametrize("skip_nulls", [False, True])
@pytest.mark.parametrize("partitions, batch", [(None, 10000), (1, 7), (23, 3), (200, 10000)])
def test_previous_value_of_long_keys(spark, skip_nulls, partitions, batch):
    df = skewed(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    found = series.previous_values(df, ["k"], ["d", "i"], {"p": ("v", skip_nulls)}, partitions)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    window = Window.partitionBy("k").orderBy("d", "i")
    plain = F.last("v", ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1)) if skip_nulls else F.lag("v").over(window)
    assert rows(found) == rows(df.withColumn("p", plain))


def test_previous_value_with_nulls_and_several_keys(spark):
    """Null keys are one key, a key may span many ranges without any value, and several columns are looked up at once."""
    rng = random.Random(3)
    data = [(rng.choice([None, "a", "b"]), rng.choice([None, 1]), i // 40, i, rng.random() if rng.random() < 0.05 else None, f"s{i}" if i % 3 else None) for i in range(900)]
    df = spark.createDataFrame(data, "k string, l int, d int, i int, v double, s string")
    wanted = {"p": ("v", True), "q": ("s", True), "r": ("s", False)}
    window = Window.partitionBy("k", "l").orderBy("d", "i")
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    plain = df.withColumns({"p": F.last("v", ignorenulls=True).over(before), "q": F.last("s", ignorenulls=True).over(before), "r": F.lag("s").over(window)})
    for partitions in (1, 60):
        assert rows(series.previous_values(df, ["k", "l"], ["d", "i"], wanted, partitions)) == rows(plain)
    assert series.previous_values(df.where("false"), ["k", "l"], ["d", "i"], wanted).collect() == []


def test_a_hot_key_is_split_and_scanned_once(spark, monkeypatch):
    """One key with half of all rows, all of one day: no task of the scan holds more than a few ranges' share."""
    kept = []
    monkeypatch.setattr(series, "staged", lambda df, name, staged=series.staged: kept.append(staged(df, name)) or kept[-1])
    df = spark.range(20_000).selectExpr("if(id % 2 = 0, 'hot', concat('k', id % 500)) AS k", "date'2024-01-02' AS d", "id AS i", "id * 1.0 AS v")
    found = series.difference(df, ["k"], ["d", "i"], "v", partitions=20)
    sizes = [r["count"] for r in kept[0].groupBy("_part").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 4000
    assert found.where("k = 'hot' AND change <> 2").count() == 0 and found.where("k = 'hot' AND change IS NULL").count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan.split("BroadcastExchange")[0]


def test_changes_match_pandas(spark):
    pdf = skewed(spark).toPandas().sort_values(["k", "d", "i"])
    pdf["change"] = pdf.groupby("k")["v"].diff()
    filled = pdf.groupby("k")["v"].ffill()
    before = filled.groupby(pdf["k"]).shift(1)
    pdf["var"] = (filled / before - 1).where(before != 0)
    found = series.series_changes(skewed(spark), ["k"], ["d", "i"], "v").toPandas().sort_values(["k", "d", "i"])
    for name in ("change", "var"):
        mine, theirs = found[name].tolist(), pdf[name].tolist()
        assert all((a != a and b != b) or a == pytest.approx(b) for a, b in zip(mine, theirs)), name


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_dense_index(spark, partitions):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"), (F.col("id") % 3).alias("dup"))
    indexed, total = chunks.dense_index(df, ["dup", "x"], partitions=partitions)
    found = indexed.orderBy("dup", "x").collect()
    assert total == 1000 and [r.idx for r in found] == list(range(1000))
    assert sorted(r.n for r in chunks.contiguous(indexed, 3, total).groupBy("chunk").agg(F.count("*").alias("n")).collect()) == [332, 334, 334]
    assert chunks.fixed(indexed, 100).select("chunk").distinct().count() == 10
    assert [r.chunk for r in chunks.stride(indexed, 3).orderBy("idx").limit(4).collect()] == [0, 1, 2, 0]


def test_dense_index_of_nothing(spark):
    indexed, total = chunks.dense_index(spark.range(0).select("id"), ["id"])
    assert total == 0 and indexed.count() == 0 and "idx" in indexed.columns


def test_quantiles_are_exact(spark):
    values = [random.Random(3).randrange(10000) for _ in range(501)]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    ordered = sorted(map(float, values))
    assert exact_quantiles(df, "v") == {"q25": ordered[125], "q50": ordered[250], "q75": ordered[375]}


def test_quantiles_of_many_columns_take_few_passes(spark, monkeypatch):
    """Skewed, equal, whole, infinite and missing values; passes do not depend on the number of columns."""
    rng = random.Random(4)
    data = [
        (rng.lognormvariate(0, 4), 7.0, rng.choice([2**62, 2**62 + 1, 2**62 + 2, 5, -(2**63)]), rng.choice([math.inf, -math.inf, 1.0, math.nan, 2.5]), None, rng.random())
        for _ in range(3000)
    ]
    df = spark.createDataFrame(data, "a double, b double, c bigint, d double, e double, f double")
    calls = []
    monkeypatch.setattr(aggregates, "_refined", lambda *a, real=aggregates._refined: calls.append(1) or real(*a))
    found = {r["name"]: r for r in aggregates.describe_numbers(df, df.columns).collect()}
    assert len(calls) <= 4
    for k, name in enumerate(df.columns):
        values = sorted((r[k] for r in data if r[k] is not None), key=lambda v: (v != v, v if v == v else 0))
        for q, share in aggregates.QUANTILES.items():
            wanted = values[math.floor((len(values) - 1) * share + 0.5)] if values else None
            assert repr(found[name][q]) == repr(None if wanted is None else float(wanted)), (name, q)
    monkeypatch.setattr(aggregates, "BUCKETS", 2)
    assert aggregates.exact_quantiles(df, "c") == {q: sorted(r[2] for r in data)[math.floor(2999 * share + 0.5)] for q, share in aggregates.QUANTILES.items()}


def test_csv_records(spark):
    from quotemill.sources.lines import csv_body

    bodies = [("h\r\n1,\"a\nb\",x\r\n2,\"say \"\"hi\"\"\r\nthere\",y\r\n\r\n3,plain,z",), ("h\n",), (None,), ("h\n4,\"\",w\n",)]
    raw = spark.createDataFrame(bodies, "body string")
    found = csv_body(raw, [], "n int, t string, u string").orderBy("n").collect()
    assert [tuple(r) for r in found] == [(1, "a\nb", "x"), (2, 'say "hi"\r\nthere', "y"), (3, "plain", "z"), (4, None, "w")]


def test_head_and_tail(spark):
    ids = lambda df: [r.id for r in df.collect()]
    assert sorted(ids(chunks.head_and_tail(spark.range(100).toDF("id"), ["id"]))) == [0, 1, 2, 3, 4, 95, 96, 97, 98, 99]
    assert sorted(ids(chunks.head_and_tail(spark.range(10).toDF("id"), ["id"]))) == list(range(10))
    assert [chunks.pages_needed(F.lit(n)) is not None for n in (0, 25)] == [True, True]
    assert spark.range(1).select(chunks.pages_needed(F.lit(25)), chunks.pages_needed(F.lit(26)), chunks.pages_needed(F.lit(0))).first()[:] == (1, 2, 0)


def test_zip_stops_at_the_shortest(spark):
    df = spark.sql("SELECT 1 AS id, array(1, 2, 3) AS a, array('x', 'y') AS b UNION ALL SELECT 2, array(), array('z') UNION ALL SELECT 3, NULL, array('z')")
    zipped = joins.zip_arrays(df, {"a": F.col("a"), "b": F.col("b")}, ["id"])
    assert rows(zipped) == [(1, 0, 1, "x"), (1, 1, 2, "y")]


def test_joins_by_key(spark):
    wanted = spark.range(5).toDF("k")
    stored = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k bigint")
    assert rows(joins.missing(wanted, stored, "k")) == [(0,), (2,), (4,)]
    assert rows(joins.existing(wanted, stored, "k")) == [(1,), (3,)]


def test_unions(spark):
    a, b = spark.sql("SELECT 1 AS x, 2 AS y"), spark.sql("SELECT 3 AS y, 4 AS z")
    assert unions.union_common([a, b], ["x", "y", "z"]).columns == ["y"]
    assert rows(unions.union_all([a, b]), "x", "y", "z") == [(1, 2, None), (None, 3, 4)]
    kv = spark.sql("SELECT * FROM VALUES (1, 'a', 'x', 0), (1, 'a', NULL, 1), (1, 'b', 'y', 2) AS t(id, l, v, p)")
    assert rows(unions.widen(kv, ["id"], "l", "v", "p", {"a": "a", "b": "b", "c": "c"})) == [(1, None, "y", None)]
    assert rows(unions.widen(kv, ["id"], "l", "v", "p", {"a": "a"}, first=True)) == [(1, "x")]


def test_filters(spark):
    df = spark.createDataFrame([("None",), (None,), ("x",)], "t string")
    assert rows(filters.not_sentinel(df, "t", "None")) == [("x",), (None,)]
    kept, short = filters.at_least(spark.sql("SELECT array(1,2) a UNION ALL SELECT NULL"), F.size("a"), 2, "short")
    assert kept.count() == 1 and [r.reason for r in short.collect()] == ["short"]


def test_bad_times_are_rejected(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01 00:00:00", 1.0, None), ("b", "x", 1.0, None), ("c", None, 1.0, None), ("d", "2024-01-01 00:00:00", float("nan"), "y"), (None, "2024-01-01 00:00:00", 1.0, None)],
        "ticker string, date string, close double, updated string",
    )
    cast = cast_prices(df)
    good, bad = split_rejects(cast)
    assert [r.ticker for r in good.collect()] == ["a"]
    assert rows(bad, "ticker", "date", "reason") == [
        ("b", "x", "bad date"), ("c", None, "bad date"), ("d", "2024-01-01 00:00:00", "bad updated"), (None, "2024-01-01 00:00:00", "bad ticker")
    ]
    assert load_report(cast.withColumn("batch", F.lit(1)), "batch").first()[:] == (1, 1, 4)


def test_clean_to_store_counts_while_writing(spark):
    df = spark.createDataFrame([(1, "1,0"), (2, "x"), (3, None)], "id int, n string")
    path = scratch(spark, "clean")
    assert clean_to_store(df, {"n": N.clean_number}, path) == {"kept_n": 1, "lost_n": 1}
    assert rows(spark.read.parquet(path), "id", "n", "failed") == [(1, 10.0, ""), (2, None, "n"), (3, None, "")]


def test_bars_break_ties_by_id(spark):
    ticks = spark.sql(
        "SELECT 'a' AS t, timestamp_ntz'2024-01-01 00:00:01' AS ts, id, CAST(id AS DOUBLE) AS price, 1L AS size FROM VALUES (5L), (-3L), (9L) AS v(id)"
    )
    for tie in (["id"], ["id", "price"]):
        bar = series.ohlc(ticks, ["t"], "ts", "5 minutes", tie).first()
        assert (bar.open, bar.high, bar.low, bar.close, bar.volume, bar.trades) == (-3.0, 9.0, -3.0, 9.0, 3, 3)


def test_column_names():
    from quotemill.operators.columns import clean_name

    assert clean_name("Div yield % (TTM)") == "divyieldpercent_(ttm)" and clean_name("Div yield % (TTM)", "") == "divyield(ttm)"
    assert clean_name("*Adj-Close ") == "adj_close"


def test_every_pair_of_widths_covers_the_list():
    for total, groups in itertools.product((1, 2, 7, 10), (1, 2, 3)):
        size = max(1, -(-total // groups))
        assert sum(1 for _ in range(0, total, size)) <= groups


def test_pages_of_an_older_document_are_gone(spark):
    from quotemill.normalise.coverage import COUNTRIES_TITLE, country_names, latest_documents

    body = '[{"region": "R", "countries": [{"country": "%s"}]}]'
    rows = [(COUNTRIES_TITLE, p, f"2025-01-0{v} 00:00:00", f"/c/{v}", body % f"V{v}P{p}") for v, pages in ((1, 2), (2, 1)) for p in range(pages)]
    raw = spark.createDataFrame(rows, "title string, page int, fetched_at string, url string, body string")
    assert [(r["page"], r["url"]) for r in latest_documents(raw).collect()] == [(0, "/c/2")]
    assert [r["country"] for r in country_names(raw).collect()] == ["v2p0"]


def versions(spark, *pages):
    """(page, seconds after the start, url) of the countries document, landed."""
    from quotemill.normalise.coverage import COUNTRIES_TITLE

    rows = [(COUNTRIES_TITLE, p, s, u, "[]") for p, s, u in pages]
    df = spark.createDataFrame(rows, "title string, page int, s long, url string, body string")
    return df.withColumn("fetched_at", F.timestamp_seconds(F.lit(1_735_700_000) + F.col("s")).cast("timestamp_ntz"))


def test_pages_that_land_one_after_the_other_are_one_version(spark):
    from quotemill.normalise.coverage import latest_documents

    shown = lambda raw: sorted((r["page"], r["url"]) for r in latest_documents(raw).collect())
    day = 86400
    old = [(p, p, f"/old/{p}") for p in range(4)]  # one page more than the newer version has
    new = [(p, day + p, f"/new/{p}") for p in range(3)]
    assert shown(versions(spark, *old, *new)) == [(0, "/new/0"), (1, "/new/1"), (2, "/new/2")]
    holed = [(p, 2 * day + p, f"/holed/{p}") for p in (0, 2)]  # page 1 did not land
    assert shown(versions(spark, *old, *new, *holed)) == [(0, "/new/0"), (1, "/new/1"), (2, "/new/2")]
    assert shown(versions(spark, *holed)) == [(0, "/holed/0"), (2, "/holed/2")]
    again = [(1, day + 60, "/new/1b")]  # sent twice within the version
    assert shown(versions(spark, *new, *again)) == [(0, "/new/0"), (1, "/new/1b"), (2, "/new/2")]
    timeless = versions(spark, *new).withColumn("fetched_at", F.lit(None).cast("timestamp_ntz"))
    assert shown(timeless) == [(0, "/new/0"), (1, "/new/1"), (2, "/new/2")]


def test_sessions_run_from_first_opening_to_last_closing(spark):
    from quotemill.operators.calendar import schedule

    exchanges = spark.createDataFrame([("X", "UTC", "08:00:00", "16:00:00", [5, 6])], "exchange string, timezone string, open_time string, close_time string, weekend array<int>")
    holidays = spark.createDataFrame([], "exchange string, date date")
    sessions = spark.sql(
        "SELECT 'X' AS exchange, d AS date, o AS open_time, c AS close_time FROM VALUES (DATE'2025-01-02', '13:00:00', '14:45:00'), "
        "(DATE'2025-01-02', NULL, NULL), (DATE'2025-01-02', '09:00:00', '11:30:00'), (DATE'2025-01-03', NULL, NULL) AS t(d, o, c)"
    )
    days = {str(r["date"]): (r["open_time"], r["close_time"]) for r in schedule(exchanges, holidays, sessions, 2025, 2025).collect()}
    assert days["2025-01-02"] == ("09:00:00", "14:45:00") and days["2025-01-03"] == (None, None) and days["2025-01-06"] == ("08:00:00", "16:00:00")


def test_two_sessions_of_a_day_are_one_trading_day(spark):
    from quotemill.operators.calendar import schedule

    exchanges = spark.createDataFrame([("X", "UTC", "09:00", "16:00", [5, 6])], "exchange string, timezone string, open_time string, close_time string, weekend array<int>")
    holidays = spark.createDataFrame([], "exchange string, date date")
    sessions = spark.sql(
        "SELECT 'X' AS exchange, DATE'2025-01-02' AS date, o AS open_time, '13:00' AS close_time FROM VALUES ('10:00'), ('11:00') AS t(o)"
    )
    days = schedule(exchanges, holidays, sessions, 2025, 2025)
    assert days.count() == days.select("date").distinct().count()
    assert days.where("date = DATE'2025-01-02'").first()["open_time"] == "10:00"


def test_newest_version_of_a_folder(spark, tmp_path):
    from quotemill.sources import files

    folder = tmp_path / "landed"
    folder.mkdir()
    assert files.newest_file(spark, str(folder), "a int, b string").collect() == []
    (folder / "list_20250102.csv").write_text("1,old\n")
    (folder / "list_20250103_a.csv").write_text("2,new\n")
    (folder / "list_20250103_b.csv").write_text("3,new\n")
    (folder / "list_20250101.csv").write_text("9,written last\n")
    (folder / "notes.txt").write_text("no list")
    newest = files.newest_file(spark, str(folder), "a int, b string", version=r"list_([0-9]+)")
    assert sorted(tuple(r) for r in newest.collect()) == [(2, "new"), (3, "new")]
    assert len(files.newest_file(spark, str(folder), "a int, b string", version="version=(x)").collect()) == 4


def test_snapshot_of_nothing_leaves_the_folder_alone(spark, tmp_path):
    from quotemill.sources import files

    rows = spark.range(3)
    path = str(tmp_path / "snapshots")
    assert not files.write_snapshot(rows.where("id > 5"), path, "20250101")
    assert files.write_snapshot(rows, path, "20250102")
    assert files.write_snapshot(rows.where("id = 1"), path, "20250103")
    assert not files.write_snapshot(rows.limit(0), path, "20250103")
    assert [r[0] for r in files.read_snapshot(spark, path, rows.schema).collect()] == [1]
    assert files.read_snapshot(spark, path, rows.schema, "20250102").count() == 3

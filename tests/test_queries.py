"""Every registered query against its SQL twin, and the shape of the plans."""

from __future__ import annotations

import os
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

from conftest import SMALL  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

from quotemill import queries as library  # noqa: E402

QUERIES, ORACLES = library.queries(), library.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    pytest.importorskip("duckdb")
    from compare import connect

    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, tables, duck, name):
    from compare import compare

    problem, _ = compare(QUERIES[name](spark, SMALL), duck, ORACLES[name])
    assert not problem, problem


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry_imports_without_a_session():
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_entry(spark, tables):
    df = entry.entry(spark)
    assert df.columns == ["ticker", "start", "open", "high", "low", "close", "volume", "trades"] and df.count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


NATIVE = [
    "ohlc_5m", "day_change", "day_change_sliced", "pct_change", "latest_by_title", "upsert_lww", "n01", "n12", "n16", "n24_day", "n35",
    "clean_table_rows", "refresh_periods", "market_calendar", "partial_days", "page_gaps", "lookup_first", "expand_components",
]


@pytest.mark.parametrize("name", NATIVE)
def test_plans_stay_native_and_parallel(spark, tables, name):
    text = plan(QUERIES[name](spark, SMALL))
    for bad in ("Python", "Pandas", "CartesianProduct", "NestedLoop", "Exchange SinglePartition"):
        assert bad not in text, bad


@pytest.mark.parametrize("name", ["n12", "n12_rejects", "n26", "n27"])
def test_bodies_are_rendered_behind_the_shuffle(spark, tables, name):
    """The typed columns are shuffled, not the texts made of them."""
    _, _, below = plan(QUERIES[name](spark, SMALL)).partition("Exchange hashpartitioning(_symbol")
    assert below and "date_format" not in below and "format_number" not in below


@pytest.mark.parametrize("name", ["n15", "n28"])
def test_header_names_are_looked_up_once_a_table(spark, tables, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "MapInArrow" in text and "array_position" not in text and "transform(" not in text


def code_size(spark, df) -> int:
    """Bytes of the longest method generated for a frame; the JVM does not compile methods above 8,000."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan has no code before it runs
    try:
        text = df.select("*")._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    return max(int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text))


@pytest.mark.parametrize("name", ["n37", "n38", "n39", "n43"])
def test_component_pages_are_typed_by_compiled_code(spark, tables, name):
    df = QUERIES[name](spark, SMALL)
    text = plan(df)
    assert "MapInArrow" in text and "array_position" not in text and "transform(" not in text
    assert code_size(spark, df) < 8000


def test_stored_components_are_typed_by_compiled_code(spark, tables):
    from quotemill.plans.loads import LOADS
    from quotemill.queries.documents import _component_raw
    from quotemill.queries.payloads import AS_OF

    rows = LOADS["icb_components"][0](_component_raw(tables), AS_OF).withColumn("timestamp", F.lit(AS_OF).cast("timestamp_ntz"))
    assert code_size(spark, rows) < 8000


@pytest.mark.parametrize("name, pushed", [("status_ok", "EqualTo(o_orderstatus,O)"), ("param_sql", "EqualTo(o_orderstatus,F), GreaterThanOrEqual(")])
def test_filters_reach_the_scan(spark, tables, name, pushed):
    assert pushed in plan(QUERIES[name](spark, SMALL))


def test_unused_columns_are_not_read(spark, tables):
    text = plan(QUERIES["max_date"](spark, SMALL))
    assert "ReadSchema: struct<l_partkey:bigint,l_shipdate:timestamp_ntz>" in text


def test_country_scan_reads_one_folder(spark, tables):
    assert "PartitionFilters: [isnotnull(country" in plan(QUERIES["scan_country"](spark, SMALL))

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small(spark):
    if not os.path.isdir(SMALL):
        pytest.skip("no test tables")
    return SMALL


@pytest.fixture(scope="session")
def real(spark, small):
    return [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names an operator may want for itself."""
    long_line = "This line is shared by many documents."
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, f"{long_line}\nown line of four"), (5, f"  {long_line.upper()} \nÉcole\nécole"),
        (6, "call +1 (509) 555-6973 or a.b@c.example.com"), (6, "call +1 (509) 555-6973 or a.b@c.example.com"), (6, "another text of six"),
        (None, long_line), (7, "word " * 20_000), (8, "x" * 50_000), (9, "one two"), (10, "one two"), (11, "\n".join([long_line] * 200)),
    ]
    values = [(i, t, 1, "k", 2, "s", 0.5, 3, "b") for i, t in rows]
    return spark.createDataFrame(values, "doc_id long, text string, pos int, key string, rev int, shard string, score double, n int, bits string")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")

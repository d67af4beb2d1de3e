"""One local session for all tests."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quotemill.session import build_session

    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from quotemill.queries.registry import Tables

    if not os.path.isdir(SMALL):
        pytest.skip("no test tables")
    return Tables(spark, SMALL)


def rows(df, *order):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*(order or df.columns)).collect()), key=repr)

"""The list of queries: a callable over the test tables and, where SQL can say it, its SQL twin."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.session import configure

MODULES = ("scans", "writes", "scalars", "shapes", "filters", "joins", "aggregates", "series", "chunks", "calendars", "payloads", "documents", "incremental", "loads")


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


class Tables:
    """The test tables of one folder and the views built on them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def ticks(self) -> DataFrame:
        """Events as trades: ticker, time, price, size, kind."""
        return self.events.select(
            F.concat(F.lit("T"), F.col("user_id")).alias("ticker"),
            "ts",
            F.col("value").alias("price"),
            F.get_json_object("props", "$.k").cast("bigint").alias("size"),
            F.col("event_type").alias("kind"),
            "event_id",
        )

    @property
    def daily(self) -> DataFrame:
        """Order lines as daily prices; (o, n, s, volume, close) orders lines of one day."""
        return self.lineitem.select(
            F.col("l_partkey").alias("ticker"),
            F.col("l_shipdate").cast("date").alias("date"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("close"),
            F.col("l_quantity").alias("volume"),
            F.col("l_orderkey").alias("o"),
            F.col("l_linenumber").alias("n"),
            F.col("l_suppkey").alias("s"),
        )


TICKS = (
    "(SELECT concat('T', user_id) AS ticker, ts, value AS price, "
    "CAST(json_extract_string(props, '$.k') AS BIGINT) AS size, event_type AS kind, event_id FROM events)"
)
DAILY = (
    "(SELECT l_partkey AS ticker, CAST(l_shipdate AS DATE) AS date, "
    "l_extendedprice / l_quantity AS close, l_quantity AS volume, "
    "l_orderkey AS o, l_linenumber AS n, l_suppkey AS s FROM lineitem)"
)
DAILY_ORDER = ["date", "o", "n", "s", "volume", "close"]


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(configure(spark), folder))

        run.__doc__ = fn.__doc__
        REGISTRY[name] = Query(name, run, sql)
        return fn

    return register


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"quotemill.queries.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: q.run for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}

"""Landed documents and stored tables: reads, parameterised queries, raw appends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.schemas import LANDING


def read_landing(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """Stored documents; a day reads only its folder."""
    from pyspark.sql import types as T

    schema = T.StructType([*LANDING.fields, T.StructField("crawl_day", T.DateType())])
    raw = spark.read.schema(schema).parquet(path)
    return raw if day is None else raw.where(F.col("crawl_day") == F.lit(day).cast("date"))


def landing(
    df: DataFrame,
    source: str,
    dataset: str | Column,
    body: Column,
    symbol: Column | None = None,
    url: Column | None = None,
    title: Column | None = None,
    params: Column | None = None,
    page: Column | None = None,
    fetched_at: str | Column = "2025-01-02 16:00:00",
) -> DataFrame:
    """Rows in the landing schema, one per document."""
    given = {
        "source": F.lit(source),
        "dataset": dataset if isinstance(dataset, Column) else F.lit(dataset),
        "symbol": symbol,
        "url": url,
        "title": title,
        "params": params,
        "page": page,
        "fetched_at": fetched_at if isinstance(fetched_at, Column) else F.lit(fetched_at),
        "body": body,
    }
    return df.select(
        *[
            (F.lit(None) if given[f.name] is None else given[f.name]).cast(f.dataType).alias(f.name)
            for f in LANDING.fields
        ]
    )


def append_raw(raw: DataFrame, path: str, as_of: str) -> None:
    """Documents stamped with the time of the run, appended to the folder of its day."""
    now = F.lit(as_of).cast("timestamp_ntz")
    stamped = raw.withColumns({"fetched_at": now, "crawl_day": now.cast("date")})
    stamped.write.mode("append").partitionBy("crawl_day").parquet(path)


def scan_where(df: DataFrame, **equal) -> DataFrame:
    """A filtered scan; equalities on partition columns prune folders."""
    for name, value in equal.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def query_frame(spark: SparkSession, text: str, views: dict[str, DataFrame], **args) -> DataFrame:
    """A SQL text with named parameters over the given frames; no match gives an empty frame."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args=args)

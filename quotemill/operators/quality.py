"""Cleaning by rules, rejected rows and load counts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quotemill.functions.numbers import nan_to_null
from quotemill.functions.times import STAMP, parse_time

Rule = Callable[[Column], Column]


def apply_rules(df: DataFrame, rules: dict[str, Rule]) -> DataFrame:
    """All rules in one projection. A rule names a column and how to clean it.

    Adds ``_raw_<column>`` with what was there and ``failed`` with the names of the columns whose text
    was lost, that is, cells that held text and became null.
    """
    raw = df.withColumns({f"_raw_{name}": F.col(name) for name in rules}).drop(*rules)
    # The generator keeps later filters on the cleaned columns from running the rules a second time.
    cleaned = F.struct(*[rule(F.col(f"_raw_{name}")).alias(name) for name, rule in rules.items()])
    lost = [F.when(_lost(name), F.lit(name)) for name in rules]
    return (
        raw.select("*", F.inline(F.array(cleaned)))
        .withColumn("failed", F.concat_ws(",", *lost))
        .select(*df.columns, *[f"_raw_{name}" for name in rules], "failed")
    )


def _lost(name: str) -> Column:
    text = F.coalesce(F.trim(F.col(f"_raw_{name}").cast("string")), F.lit(""))
    return F.col(name).isNull() & (text != "")


def _counts(rules: dict[str, Rule]) -> list[Column]:
    return [F.count(name).alias(f"kept_{name}") for name in rules] + [
        F.count_if(_lost(name)).alias(f"lost_{name}") for name in rules
    ]


def clean_table(df: DataFrame, rules: dict[str, Rule]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The cleaned rows, the rejected rows with their texts, and counts per rule."""
    marked = apply_rules(df, rules)
    clean = marked.where(F.col("failed") == "").select(*df.columns)
    rejects = marked.where(F.col("failed") != "").select(
        *[F.col(f"_raw_{c}").alias(c) if c in rules else F.col(c) for c in df.columns], "failed"
    )
    pairs = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"kept_{name}").alias("kept"), F.col(f"lost_{name}").alias("lost"))
        for name in rules
    ])
    return clean, rejects, marked.agg(*_counts(rules)).select(F.inline(pairs))


def clean_to_store(df: DataFrame, rules: dict[str, Rule], path: str) -> dict[str, int]:
    """Cleaned and rejected rows written in one pass, under ``path/rejected=false`` and ``=true``; the
    counts per rule are observed while writing."""
    seen = Observation("clean_to_store")
    marked = apply_rules(df, rules).observe(seen, *_counts(rules))
    marked.withColumn("rejected", F.col("failed") != "").write.mode("overwrite").partitionBy("rejected").parquet(path)
    return seen.get


PRICE_COLUMNS = ("open", "high", "low", "close", "volume", "adjclose")


def cast_prices(df: DataFrame, times: Sequence[str] = ("date", "updated")) -> DataFrame:
    """Times from text, NaN to null; ``reason`` names the first time that could not be read.

    A missing ``updated`` is fine; a missing ticker and a missing or unreadable key time are not.
    """
    raw = {f"_raw_{name}": F.col(name) for name in times}
    numbers = {name: nan_to_null(F.col(name)) for name in PRICE_COLUMNS if name in df.columns}
    parsed = df.withColumns(raw).withColumns(
        {**{name: parse_time(F.col(f"_raw_{name}").cast("string"), STAMP) for name in times}, **numbers}
    )
    reason = F.lit(None).cast("string")
    for name in reversed(times):
        bad = F.col(name).isNull() & (F.col(f"_raw_{name}").isNotNull() | F.lit(name != "updated"))
        reason = F.when(bad, F.lit(f"bad {name}")).otherwise(reason)
    if "ticker" in df.columns:
        reason = F.when(F.col("ticker").isNull(), F.lit("bad ticker")).otherwise(reason)
    return parsed.withColumn("reason", reason)


def split_rejects(cast: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to store, and rejected rows with their original texts."""
    raw = [name for name in cast.columns if name.startswith("_raw_")]
    good = cast.where(F.col("reason").isNull()).drop("reason", *raw)
    names = {name[len("_raw_"):] for name in raw}
    bad = cast.where(F.col("reason").isNotNull()).select(
        *[F.col(f"_raw_{c}").alias(c) if c in names else F.col(c) for c in cast.columns if c not in raw]
    )
    return good, bad


def load_report(cast: DataFrame, *batch: str) -> DataFrame:
    """Stored and rejected rows per batch, in one aggregate."""
    return cast.groupBy(*batch).agg(
        F.count_if(F.col("reason").isNull()).alias("ok"),
        F.count_if(F.col("reason").isNotNull()).alias("failed"),
    )

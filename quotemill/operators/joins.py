"""Joins and existence tests. One join answers for all keys; there is no query per key.

No side is marked for broadcast: today's small dimension may grow, and the adaptive planner sees
the real size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.operators.latest import keep_first


def zip_arrays(df: DataFrame, arrays: dict[str, Column], keep: Sequence[str | Column]) -> DataFrame:
    """Parallel arrays as rows, as many as the shortest array has; stays inside the row, no shuffle."""
    shortest = F.least(*[F.size(a) for a in arrays.values()]) if len(arrays) > 1 else F.size(
        next(iter(arrays.values()))
    )
    zipped = F.arrays_zip(*[a.alias(name) for name, a in arrays.items()])
    named = F.transform(
        F.slice(zipped, F.lit(1), F.greatest(shortest, F.lit(0))),
        lambda z: F.struct(*[z[name].alias(name) for name in arrays]),
    )
    return df.select(*keep, F.posexplode(named).alias("pos", "_z")).select("*", "_z.*").drop("_z")


def pair_series(df: DataFrame, codes: Column, series: Column, keep: Sequence[str | Column]) -> DataFrame:
    """Series k belongs to code k."""
    return df.select(*keep, codes.alias("_codes"), F.posexplode(series).alias("k", "series")).select(
        "*", F.get(F.col("_codes"), F.col("k")).alias("codesource")
    ).drop("_codes")


def _key_set(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The stored keys once each: they combine before the shuffle, however often a key repeats."""
    return stored.select(*keys).distinct()


def missing(wanted: DataFrame, stored: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key is not stored."""
    return wanted.join(_key_set(stored, keys), list(keys), "left_anti")


def existing(wanted: DataFrame, stored: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key is stored."""
    return wanted.join(_key_set(stored, keys), list(keys), "left_semi")


def lookup_first(df: DataFrame, dim: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Left join to the first entry of each key."""
    return df.join(keep_first(dim, keys, order), list(keys), "left")


def vendor_codes(ticker_map: DataFrame, code: str, vendors: dict[str, str]) -> DataFrame:
    """One column per vendor as rows (code, source, codesource); empty cells are left out."""
    return (
        ticker_map.select(code, *[F.col(column).alias(source) for source, column in vendors.items()])
        .unpivot([code], list(vendors), "source", "codesource")
        .where(F.col("codesource").isNotNull() & (F.col("codesource") != ""))
    )


def expand_components(sectors: DataFrame, components: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Component rows of the sectors' pages, tagged with page and country; and pages that gave none."""
    pages = sectors.select("component_url", "country").distinct()
    found = components.join(pages, "component_url")
    failed = missing(pages, components, "component_url")
    return found, failed

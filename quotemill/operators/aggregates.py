"""Summary statistics of number columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUANTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
BUCKETS = 4096


def _finite(column: str) -> Column:
    """The column's value, null where it is not a number or infinite."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(math.inf)), F.col(column))


def _measures(column: str, digits: int) -> dict[str, Column]:
    value = F.col(column).cast("double")
    return {
        "count": F.count(column), "null_count": F.count_if(F.col(column).isNull()), "mean": F.round(F.avg(column), digits),
        "std": F.round(F.stddev_samp(column), digits), "min": F.min(column), "max": F.max(column),
        "low": F.min(_finite(column)), "high": F.max(_finite(column)),
        "below": F.count_if(value == F.lit(-math.inf)), "finite": F.count(_finite(column)), "above": F.count_if(value == F.lit(math.inf)),
    }


def _measured(df: DataFrame, columns: Sequence[str], digits: int) -> dict[str, dict]:
    """All measures of all columns, in one pass."""
    row = df.agg(*[m.alias(f"{i}/{name}") for i, c in enumerate(columns) for name, m in _measures(c, digits).items()]).first()
    return {c: {name: row[f"{i}/{name}"] for name in _measures(c, digits)} for i, c in enumerate(columns)}


def _refined(df: DataFrame, ranges: dict[tuple[str, object, object], None]) -> dict:
    """For each range (column, low, high): its buckets (number, rows, least, largest), in one pass over all of them."""
    numbered = list(ranges)
    entries = []
    for k, (column, low, high) in enumerate(numbered):
        kind = df.schema[column].dataType
        first, last = F.lit(low).cast(kind), F.lit(high).cast(kind)
        wide = "decimal(20,0)" if isinstance(kind, T.IntegralType) else kind  # differences of whole numbers may need another bit
        start = first.cast(wide)
        share = (F.col(column).cast(wide) - start).cast("double") / (last.cast(wide) - start).cast("double")
        bucket = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
        entries.append(F.when(_finite(column).between(first, last), F.struct(F.lit(k).alias("k"), bucket.alias("b"))))
    found: dict = {}
    # One row a range and bucket: at most BUCKETS of them for each wanted quantile.
    for kinds in {df.schema[c].dataType for c, _, _ in numbered}:
        mine = [k for k, (c, _, _) in enumerate(numbered) if df.schema[c].dataType == kinds]
        cells = F.array(*[F.struct(entries[k].alias("e"), F.col(numbered[k][0]).alias("x")) for k in mine])
        rows = df.select(F.explode(F.filter(cells, lambda c: c["e"].isNotNull())).alias("c"))
        counted = rows.groupBy("c.e.k", "c.e.b").agg(F.count(F.lit(1)).alias("n"), F.min("c.x").alias("low"), F.max("c.x").alias("high"))
        for row in counted.collect():
            found.setdefault(numbered[row["k"]], []).append((row["b"], row["n"], row["low"], row["high"]))
    return {r: sorted(buckets) for r, buckets in found.items()}


def _ranked(df: DataFrame, measured: dict[str, dict], quantiles: dict[str, float]) -> dict[str, dict]:
    """The values at the nearest ranks. A range of values that holds a wanted rank is cut into buckets, of which the one that
    holds it is the next range, until all its values are equal; ranges of all columns are counted together."""
    out = {column: dict.fromkeys(quantiles) for column in measured}
    open_ranges = []
    for column, m in measured.items():
        for name, q in quantiles.items():
            if not m["count"]:
                continue
            rank = math.floor((m["count"] - 1) * q + 0.5) - m["below"]
            if rank < 0:
                out[column][name] = -math.inf
            elif rank >= m["finite"]:
                out[column][name] = math.inf if rank - m["finite"] < m["above"] else math.nan
            else:
                open_ranges.append((column, name, m["low"], m["high"], rank))
    while open_ranges:
        waiting = []
        for column, name, low, high, rank in open_ranges:
            if low == high:
                out[column][name] = low
            else:
                waiting.append((column, name, low, high, rank))
        buckets = _refined(df, dict.fromkeys((c, low, high) for c, _, low, high, _ in waiting)) if waiting else {}
        open_ranges = []
        for column, name, low, high, rank in waiting:
            for _, n, least, largest in buckets[column, low, high]:
                if rank < n:
                    open_ranges.append((column, name, least, largest, rank))
                    break
                rank -= n
    return out


def exact_quantiles(df: DataFrame, column: str, quantiles: dict[str, float] = QUANTILES) -> dict[str, float]:
    """Values at the nearest rank, exact; infinities and not-a-number, in this order, are the largest values."""
    return _ranked(df, _measured(df, [column], 4), quantiles)[column]


def describe_numbers(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Count, nulls, mean, deviation, extremes and quartiles, one row per column.

    One pass measures all columns; each further one, usually two, counts the buckets of all ranges that still hold a
    wanted rank. Nothing is sorted or shuffled but counts, and the driver sees counts only.
    """
    measured = _measured(df, columns, digits)
    quartiles = _ranked(df, measured, QUANTILES)
    number = lambda v: None if v is None else float(v)
    rows = [
        (c, m["count"], m["null_count"], number(m["mean"]), number(m["std"]), number(m["min"]), *[number(quartiles[c][q]) for q in QUANTILES], number(m["max"]))
        for c, m in measured.items()
    ]
    quarters = ", ".join(f"{q} double" for q in QUANTILES)
    return df.sparkSession.createDataFrame(rows, f"name string, count bigint, null_count bigint, mean double, std double, min double, {quarters}, max double")

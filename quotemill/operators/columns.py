"""Column names and column sets. These only change the schema; none of them moves data."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.shipping import ship_by_value


def clean_name(name: str, percent: str = "percent_") -> str:
    """Lower case; no "*"; "%" as ``percent``; "-" as "_"; blanks removed."""
    name = name.lower().replace("*", "").replace("%", percent).replace("-", "_")
    return re.sub(r"\s+", "", name)


def clean_key(name: Column, percent: str = "percent_") -> Column:
    """:func:`clean_name` for names that are data."""
    name = F.translate(F.lower(name), "-*", "_")
    return F.regexp_replace(F.replace(name, F.lit("%"), F.lit(percent)), r"\s+", "")


def clean_key_text(name: str, percent: str = "percent_") -> str:
    """:func:`clean_key` of one text: it removes ASCII blanks only."""
    return re.sub(r"\s+", "", name.lower().replace("*", "").replace("-", "_").replace("%", percent), flags=re.ASCII)


def clean_columns(df: DataFrame, percent: str = "percent_") -> DataFrame:
    return df.toDF(*[clean_name(name, percent) for name in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    """Trimmed and lower case."""
    return df.toDF(*[name.strip().lower() for name in df.columns])


def snake_names(df: DataFrame) -> DataFrame:
    """Trimmed, lower case, spaces as underscores."""
    return df.toDF(*[name.strip().lower().replace(" ", "_") for name in df.columns])


def packed_names(df: DataFrame) -> DataFrame:
    """Lower case without spaces and hyphens."""
    return df.toDF(*[re.sub(r" |-", "", name.lower()) for name in df.columns])


def keys_first(df: DataFrame, *keys: str) -> DataFrame:
    """The named columns first, the others behind in their old order."""
    return df.select(*keys, *[name for name in df.columns if name not in keys])


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Renames the columns that are there."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def drop_present(df: DataFrame, *names: str) -> DataFrame:
    """Drops the columns that are there; the others are no error."""
    return df.drop(*names)


def first_of_same_name(df: DataFrame) -> DataFrame:
    """Of columns that share a name, the first."""
    unique = [f"c{i}" for i in range(len(df.columns))]
    seen: dict[str, str] = {}
    for name, alias in zip(df.columns, unique):
        seen.setdefault(name, alias)
    return df.toDF(*unique).select(*[F.col(alias).alias(name) for name, alias in seen.items()])


def flatten_structs(df: DataFrame) -> DataFrame:
    """Struct columns replaced by their fields."""
    names = []
    for field in df.schema.fields:
        names.append(f"`{field.name}`.*" if field.dataType.typeName() == "struct" else f"`{field.name}`")
    return df.select(*names)


def tag(df: DataFrame, **values) -> DataFrame:
    """Constant columns, or columns given as expressions."""
    columns = {k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()}
    return df.withColumns(columns)


def code_of(prefix: str, code: Column | str) -> Column:
    """"STKVN" and "VNM" as "STKVNVNM"."""
    return F.concat(F.lit(prefix), F.col(code) if isinstance(code, str) else code)


def stamp(df: DataFrame, as_of: str) -> DataFrame:
    """The time of the run as text. It is a parameter, so that two runs agree."""
    return df.withColumn("updated", F.lit(as_of))


def scale(df: DataFrame, columns: Iterable[str], factor) -> DataFrame:
    """The columns times a factor (a number, or a column for a unit per row)."""
    factor = factor if isinstance(factor, Column) else F.lit(float(factor))
    return df.withColumns({name: F.col(name) * factor for name in columns})


ship_by_value(__name__)

"""JSON texts as variants: parsed once, read by path, and told apart where they cannot be read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def section(df: DataFrame, column: str, path: str, schema: str, out: str) -> DataFrame:
    """``out`` = what the JSON text holds at ``path``, by its schema, and ``reason`` why it is null.

    The text is parsed once a row. A text that ends too early or is no JSON is "not JSON"; one that holds nothing of the
    wanted kind at the path says so. Fields that are missing or of another kind are nulls.
    """
    documents = df.select("*", F.explode(F.array(F.try_parse_json(column))).alias("_json"))
    found = documents.select("*", F.explode(F.array(F.try_variant_get("_json", path, schema))).alias(out))
    reason = (
        F.when(F.col(column).isNull(), F.lit("no body")).when(F.col("_json").isNull(), F.lit("not JSON"))
        .when(F.col(out).isNull(), F.lit(f"nothing to read at {path}"))
    )
    return found.withColumn("reason", reason).drop("_json")


def drift(df: DataFrame, column: str, *keys: str) -> DataFrame:
    """The schema that all readable texts of each ``keys`` share, as one text: what a later load compares with an earlier one."""
    return df.groupBy(*keys).agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("schema"), F.count(F.try_parse_json(column)).alias("bodies"))


def field(document: str | Column, path: str, kind: str) -> Column:
    """One value of a JSON text, null where it is missing or of another kind."""
    return F.try_variant_get(F.try_parse_json(document), path, kind)

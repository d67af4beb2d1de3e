"""Delimited text inside landed bodies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def coded_lines(raw: DataFrame, keep: Sequence[str], schema: str, symbol: str = "symbol", body: str = "body") -> DataFrame:
    """The lines of a body that start with its own symbol and a comma, parsed as CSV."""
    lines = raw.select(*keep, F.col(symbol).alias("_symbol"), F.explode(F.split(body, "\n")).alias("_line"))
    mine = lines.where(F.startswith("_line", F.concat("_symbol", F.lit(","))))
    return mine.withColumn("_row", F.from_csv("_line", schema)).select(*keep, "_row.*")


RECORD_END = "\x1e"  # the control character that separates records
QUOTED = {"escape": '"', "multiLine": "true"}  # a quote within quotes is written twice


def csv_records(body: Column) -> Column:
    """The records of a CSV text: it is cut at line breaks outside quotes.

    Between two quotes every second stretch is inside them, a doubled quote being an empty stretch; line breaks of the others
    end a record. One pass over the text, whatever its number of lines.
    """
    stretches = F.transform(
        F.split(F.translate(body, RECORD_END, ""), '"', -1),
        lambda text, k: F.when(k % 2 == 0, F.regexp_replace(text, "\r?\n", RECORD_END)).otherwise(text),
    )
    return F.split(F.array_join(stretches, '"'), RECORD_END, -1)


def csv_body(raw: DataFrame, keep: Sequence[str], schema: str, body: str = "body") -> DataFrame:
    """The records of a CSV body below its header; a record may hold line breaks and quotes within quotes."""
    records = raw.select(*keep, F.posexplode(csv_records(F.col(body))).alias("_no", "_record"))
    data = records.where((F.col("_no") > 0) & (F.col("_record") != ""))
    return data.withColumn("_row", F.from_csv("_record", schema, QUOTED)).select(*keep, "_row.*")


def pipe_records(raw: DataFrame, keep: Sequence[str], records: str) -> DataFrame:
    """One row per record of an array of "a|b|c" texts, with its fields as an array."""
    return raw.select(*keep, F.explode(records).alias("_record")).select(
        *keep, F.split("_record", r"\|").alias("fields")
    )

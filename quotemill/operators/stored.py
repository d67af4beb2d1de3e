"""The stored tables by name: schema, key and folders, opened and written by frames of any columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.operators.merge import KeyedTable
from quotemill.operators.quality import cast_prices, load_report, split_rejects
from quotemill.schemas import KEYS, REJECTS, STORED
from quotemill.session import written_once

# Folders: prices by month, intraday prices by day, documents by day of crawl. The folder follows from
# the key, so that a key never moves. The small tables have one folder.
_FOLDERS = {
    "all_source_prices": ("month", "date", "yyyy-MM"),
    "day_prices": ("month", "date", "yyyy-MM"),
    "intraday_prices": ("day", "datetime", "yyyy-MM-dd"),
    "web_crawl": ("day", "crawl_date", "yyyy-MM-dd"),
}
_BY_COUNTRY = ("sectors", "industries")


def folder_column(name: str) -> tuple[str, Column | None]:
    """The partition column of a stored table and how it follows from the key."""
    if name in _FOLDERS:
        folder, time, pattern = _FOLDERS[name]
        return folder, F.date_format(time, pattern)
    if name in _BY_COUNTRY:
        return "country", None
    return "part", F.lit("all")


def open_stored(spark: SparkSession, root: str, name: str) -> KeyedTable:
    folder, derived = folder_column(name)
    schema = STORED[name]
    if derived is not None:
        schema = T.StructType([*schema.fields, T.StructField(folder, T.StringType())])
    return KeyedTable(spark, f"{root.rstrip('/')}/{name}", schema, KEYS[name], [folder])


def read_stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    return open_stored(spark, root, name).read().select(*STORED[name].names)


def write_rejects(spark: SparkSession, root: str, name: str, rows: DataFrame, as_of: str, step: str = "bodies") -> None:
    """Rows that could not be stored, with their reason, in a folder of the table, the step and the run: a rerun writes it again."""
    source = F.col("source") if "source" in rows.columns else F.lit(name)
    others = [c for c in rows.columns if c != "reason"]
    found = rows.select(
        source.cast("string").alias("source"), "reason", F.to_json(F.struct(*others)).alias("body"),
        F.lit(as_of).cast("timestamp_ntz").alias("fetched_at"),
    )
    load = "".join(c if c.isalnum() else "-" for c in as_of)
    found.write.mode("overwrite").parquet(f"{root.rstrip('/')}/rejects/stored={name}/step={step}/load={load}")


def insert_frame(
    spark: SparkSession, root: str, name: str, df: DataFrame, order: tuple[str, ...] = (), as_of: str = "1970-01-01 00:00:00"
) -> None:
    """Insert a frame by column names: same keys are overwritten in the columns the frame has, columns it
    does not have stay. ``order`` says which row of a repeated key is the last; without it a repeated key is an
    error. Rows without a whole key are rejects of the run ``as_of``, the others are stored all the same."""
    unknown = set(df.columns) - set(STORED[name].names) - set(order)
    if unknown:
        raise ValueError(f"{name} has no column {', '.join(sorted(unknown))}")
    folder, derived = folder_column(name)
    typed = df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in STORED[name].fields if f.name in df.columns],
        *[o for o in order if o not in STORED[name].names],
    )
    table = open_stored(spark, root, name)
    rows = written_once(typed, table.side("frame"))  # read for its folders, its keys and its cells
    whole = F.lit(True)
    for key in KEYS[name]:
        whole = whole & F.col(key).isNotNull()
    missing = F.concat_ws(", ", *[F.when(F.col(key).isNull(), F.lit(key)) for key in KEYS[name]])
    unkeyed = rows.where(~whole).withColumn("reason", F.concat(F.lit("no key: "), missing))
    if not unkeyed.isEmpty():
        write_rejects(spark, root, name, unkeyed, as_of, "keys")
    keyed = rows.where(whole)
    table.upsert(keyed if derived is None else keyed.withColumn(folder, derived), order)


def store_prices(
    spark: SparkSession, root: str, name: str, df: DataFrame, as_of: str, order: tuple[str, ...] = ()
) -> tuple[int, int]:
    """Prices with times as texts: the readable rows are upserted, the others go to the rejects; the counts
    of both come back. The rows are cast once and written next to the table for all three."""
    times = [c for c in ("date", "datetime", "timestamp", "updated") if c in df.columns]
    cast = written_once(cast_prices(df, times), open_stored(spark, root, name).side("cast"))
    good, bad = split_rejects(cast)
    insert_frame(spark, root, name, good, order, as_of)
    write_rejects(spark, root, name, bad, as_of, "times")
    counts = load_report(cast).first()
    return counts["ok"], counts["failed"]


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(REJECTS).parquet(f"{root.rstrip('/')}/rejects").select(*REJECTS.names)

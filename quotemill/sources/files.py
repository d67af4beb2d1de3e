"""CSV and JSON files, newest-file reads and versioned snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_text(spark: SparkSession, path: str, columns: Sequence[str], keep: Sequence[str] | None = None) -> DataFrame:
    """A CSV file with a header, every column as text, only the wanted ones read."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    return spark.read.schema(schema).csv(path, header=True).select(*(keep or columns))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The values of a column without nulls and repeats."""
    return df.where(F.col(column).isNotNull()).select(column).distinct()


def read_json_documents(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Files that hold one JSON array (or object) each, by a declared schema."""
    return spark.read.schema(schema).json(path, multiLine=True)


def parsed(df: DataFrame, column: str, schema: str, out: str) -> DataFrame:
    """``out`` = the JSON text by its schema, parsed once per row.

    As a plain column the parse would be copied into every later filter and field access; a
    generator of one row is not copied.
    """
    return df.select("*", F.explode(F.array(F.from_json(column, schema))).alias(out))


def newest_file(
    spark: SparkSession, path: str, schema: T.StructType | str, version: str = r"version=([^/]+)/", **options
) -> DataFrame:
    """The rows of the newest version of the CSV files under a folder, however many files it came in.

    The version is what the first group of ``version`` finds in a file's path: a folder or a part of the file's name, set by
    whoever landed it, so that copying files changes nothing; versions are compared as texts. Files without one are the
    oldest. Only the listing is read to find the newest (the binary source does not open files whose content nobody
    selects), one text comes to the driver, and the scan lists the files of that version alone.
    """
    found = F.regexp_extract(F.col("_metadata.file_path"), version, 1)
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").load(path)
    newest = listing.agg(F.max(F.regexp_extract("path", version, 1))).first()[0]
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if newest is None:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").csv(path, **options)
    return rows.where(found == newest)


def newest_stream(
    spark: SparkSession, path: str, schema: T.StructType, files: int, version: str = r"version=([^/]+)/", **options
) -> DataFrame:
    """The files under a folder as a stream with the version of each row, the latest landed files first, ``files`` at a time.

    A backlog is thus read from its new end: the newest version is complete before old ones are looked at.
    """
    stream = spark.readStream.schema(schema).option("latestFirst", "true").option("maxFilesPerTrigger", files)
    rows = stream.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").csv(path, **options)
    return rows.select("*", F.regexp_extract(F.col("_metadata.file_path"), version, 1).alias("version"))


def export_csv(df: DataFrame, path: str) -> None:
    """Many part files with a header each."""
    df.write.mode("overwrite").csv(path, header=True)


def write_snapshot(df: DataFrame, path: str, version: str) -> bool:
    """A JSON snapshot under its version; nothing is written when there are no rows.

    One pass: a dynamic partition write makes no folder without rows, and the rows are counted as they are written.
    """
    seen = Observation()
    rows = df.withColumn("version", F.lit(version)).observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").json(path)
    return seen.get["rows"] > 0


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType, version: str | None = None) -> DataFrame:
    """A snapshot by version, by default the newest. Versions are folder names: the newest is found
    from the listing, and only its folder is read."""
    if version is None:
        listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path)
        newest = listing.agg(F.max(F.regexp_extract("path", "/version=([^/]+)/", 1))).first()[0]
        version = newest or "none"
    full = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    return spark.read.schema(full).json(path).where(F.col("version") == version).drop("version")

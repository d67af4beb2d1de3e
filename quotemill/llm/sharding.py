"""Extendible hashing: a directory of hash prefixes in which only oversized buckets take another bit.

The bits of a row are those of md5(id), then those of a hash of (id, text), so that rows of one id part further down.
Each round adds up bytes for the next ``step`` bits of the rows that are still in an oversized bucket and settles
every bucket that fits. Only sums of bytes are shuffled, combined before the shuffle; texts never move.

Equal rows have equal bits. Once the bits are used up, what is left of a bucket is equal rows; they get overflow pages
in the order of a salted counter: rows are numbered within (bucket, salt), and each salt has its own pages, so no task
meets a whole group.

Defined cases: a null text has 0 bytes, a null id the hash of the empty string; one row above the limit is a page of
its own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotemill.llm.common import clear_of, texts
from quotemill.session import staged

LIMIT_BYTES = 4 << 20
STEP = 8
SALTS = 64
MAX_DEPTH = 96


def hash_bits(id_col: Column, text_col: Column) -> Column:
    """``MAX_DEPTH`` bits as a string of 0 and 1: 32 of md5(id), then 64 of (id, text)."""
    front = F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit(""))), 1, 8), 16, 2)
    return F.concat(F.lpad(front, 32, "0"), F.lpad(F.bin(F.xxhash64(id_col, text_col)), 64, "0"))


def _settled(histogram: DataFrame, depth: int, step: int, limit: int) -> DataFrame:
    """(fine, shard): the shortest prefix longer than ``depth - step`` that fits, null if none does."""
    levels = F.explode(F.sequence(F.lit(depth - step + 1 if depth > step else 0), F.lit(depth))).alias("d")
    prefixes = histogram.select("fine", "n_bytes", levels).withColumn("prefix", F.expr("left(fine, d)"))
    sums = prefixes.groupBy("prefix").agg(F.sum("n_bytes").alias("total")).where(F.col("total") <= limit)
    fits = prefixes.select("fine", "prefix").join(sums, "prefix")
    shortest = fits.groupBy("fine").agg(F.min_by("prefix", F.length("prefix")).alias("shard"))
    return histogram.select("fine").join(shortest, "fine", "left")


def settled_rounds(bits: DataFrame, limit: int = LIMIT_BYTES, step: int = STEP) -> list[tuple[int, DataFrame]]:
    """Per round its depth and (fine, shard): ``shard`` is the directory entry for rows that start with ``fine``.

    Only what is still oversized goes on to the next round; after the last one ``shard`` is null for buckets whose
    rows agree in all bits.
    """
    rounds, rest, depth = [], bits, step
    while True:
        histogram = staged(
            rest.groupBy(F.expr(f"left(bits, {depth})").alias("fine")).agg(F.sum("n_bytes").alias("n_bytes")), "shard-histogram"
        )
        found = staged(_settled(histogram, depth, step, limit), "shard-found")
        rounds.append((depth, found))
        oversized = found.where("shard IS NULL").select("fine")
        if depth >= MAX_DEPTH or oversized.isEmpty():
            return rounds
        rest = rest.join(oversized, F.expr(f"left(bits, {depth})") == F.col("fine"), "left_semi")
        depth = min(depth + step, MAX_DEPTH)


def assign_shards(
    docs: DataFrame, limit: int = LIMIT_BYTES, id_col: str = "doc_id", text_col: str = "text", step: int = STEP, salts: int = SALTS
) -> DataFrame:
    """(doc_id, n_bytes, shard, page) for each row; the rows of a (shard, page) stay within ``limit`` bytes."""
    narrow = texts(docs, id_col, text_col).select(
        "doc_id", hash_bits(F.col("doc_id"), F.col("text")).alias("bits"), F.octet_length("text").cast("bigint").alias("n_bytes")
    )
    return _assigned(staged(narrow, "shard-bits"), limit, step, salts).drop("bits")


def _assigned(rows: DataFrame, limit: int, step: int, salts: int) -> DataFrame:
    """(shard, page) of rows that have at least (doc_id, bits, n_bytes)."""
    kept = rows.columns
    out = rows.withColumn("shard", F.lit(None).cast("string"))
    for depth, found in settled_rounds(rows, limit, step):
        entry = found.where("shard IS NOT NULL").select("fine", F.col("shard").alias("found"))
        joined = out.join(entry, F.expr(f"left(bits, {depth})") == F.col("fine"), "left")
        out = joined.select(*kept, F.coalesce("shard", "found").alias("shard"))
    fitting = out.where("shard IS NOT NULL").select(*kept, "shard", F.lit("").alias("page"))
    equal = out.where("shard IS NULL").withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    number = F.row_number().over(W.partitionBy("bits", "salt").orderBy("doc_id")) - 1
    per_page = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.lit(1), F.col("n_bytes"))))
    paged = equal.withColumn("page", F.concat_ws(".", F.col("salt").cast("string"), F.floor(number / per_page).cast("string")))
    return fitting.unionByName(paged.select(*kept, F.col("bits").alias("shard"), "page"))


def shard_report(assigned: DataFrame) -> DataFrame:
    """(shard, page, depth, n_docs, n_bytes) of what ``assign_shards`` gave."""
    return assigned.groupBy("shard", "page").agg(
        F.length("shard").alias("depth"), F.count(F.lit(1)).alias("n_docs"), F.sum("n_bytes").alias("n_bytes")
    )


def write_shards(
    docs: DataFrame, path: str, limit: int = LIMIT_BYTES, id_col: str = "doc_id", text_col: str = "text", step: int = STEP, salts: int = SALTS
) -> None:
    """Documents with all their columns, in one folder for each shard and page, none of them above ``limit`` bytes of text.

    Rows are written once with a number of their own, by which they meet their shard again; the folder's column has a
    name that no column of ``docs`` has, and its values begin with a letter, so they are not read back as numbers.
    """
    number, folder = clear_of(docs, "shard_row", "shard")
    numbered = staged(docs.withColumn(number, F.monotonically_increasing_id()), "shard-rows")
    body = F.coalesce(F.col(text_col), F.lit(""))
    narrow = numbered.select(
        F.col(id_col).alias("doc_id"), hash_bits(F.col(id_col), body).alias("bits"), F.octet_length(body).cast("bigint").alias("n_bytes"),
        F.col(number).alias("row"),
    )
    assigned = _assigned(staged(narrow, "shard-bits"), limit, step, salts)
    name = F.concat(F.lit("s"), F.col("shard"), F.when(F.col("page") != "", F.concat(F.lit("-"), F.col("page"))).otherwise(F.lit("")))
    assigned = staged(assigned.select(F.col("row").alias(number), name.alias(folder)), "shard-assigned")
    placed = numbered.join(assigned, number).drop(number)
    # A folder has at most ``limit`` bytes of text, so it is one task's work.
    placed.repartition(folder).write.partitionBy(folder).mode("overwrite").parquet(path)

"""Line dedup: lines that an earlier document holds are dropped; what is returned are bitmaps, not texts.

Every line becomes (hash of its key, document, position), about 40 bytes. The rows are dealt by ranges of the hash and
sorted by (hash, document, position), so that first occurrences stream past. A line that a third of all documents
share would be one range; hence a range is (hash, salt of the document). Within a salt everything behind the first
document is a repeat for certain. Only the first document of each salt is still open: it meets the firsts of the other
salts in a second, small window of at most ``salts`` documents per key. The rows are written once, as range borders,
both windows and a lost executor would each compute them from the texts again.

Defined cases: a null text is one empty line; rows with a null id keep all lines and make no other line a repeat;
rows of one id are one document (its lines are never repeats of each other); equal rows get equal bitmaps; an empty
table gives an empty result; columns other than id and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotemill.llm.common import BLANKS, clear_of, lower_ascii
from quotemill.session import staged

BREAK = "\n"
MIN_CHARS = 10
SALTS = 64


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def line_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc_id, rev, pos) of all lines that can be repeats. ``rev`` tells rows of one id apart."""
    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("rev"),
        F.posexplode(F.split(F.col(text_col), BREAK, -1)).alias("pos", "line"),
    )
    keyed = rows.select("doc_id", "rev", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "rev", "pos"
    )


def repeated_lines(lines: DataFrame, salts: int = SALTS) -> DataFrame:
    """(doc_id, rev, pos) of the lines that a document with a smaller id holds as well."""
    salted = lines.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    dealt = salted.repartitionByRange(F.col("h1"), F.col("salt"))
    streamed = dealt.withColumn(
        "first_doc", F.first("doc_id").over(W.partitionBy("h1", "h2", "salt").orderBy("doc_id", "rev", "pos"))
    )
    certain = streamed.where(F.col("doc_id") > F.col("first_doc"))
    still_open = streamed.where(F.col("doc_id") == F.col("first_doc")).drop("first_doc", "salt")
    across = still_open.withColumn("first_doc", F.first("doc_id").over(W.partitionBy("h1", "h2").orderBy("doc_id", "rev", "pos")))
    late = across.where(F.col("doc_id") > F.col("first_doc"))
    return certain.select("doc_id", "rev", "pos").unionByName(late.select("doc_id", "rev", "pos"))


def keep_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, salts: int = SALTS
) -> DataFrame:
    """(doc_id, rev, keep) of the documents that lose lines.

    ``keep`` is a compressed bitmap: word number -> 64 bits, bit i % 64 of word i // 64 set where line i stays. Words
    without a dropped line are left out.
    """
    lines = staged(line_rows(docs, id_col, text_col, min_chars), "line-hashes")
    gone = repeated_lines(lines, salts)
    words = gone.groupBy("doc_id", "rev", F.shiftright("pos", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("dropped")
    )
    return words.groupBy("doc_id", "rev").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("dropped").alias("bits"))))).alias("keep")
    )


def with_bitmaps(docs: DataFrame, keep: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All rows and columns of ``docs`` and the bitmap, null where every line stays."""
    doc, rev, mine = clear_of(docs, "kb_doc", "kb_rev", "kb_mine")
    bitmaps = keep_bitmaps(docs, id_col, text_col, **options).select(
        F.col("doc_id").alias(doc), F.col("rev").alias(rev), F.col("keep").alias(keep)
    )
    marked = docs.withColumn(mine, F.xxhash64(F.col(text_col)))
    joined = marked.join(bitmaps, (marked[id_col] == bitmaps[doc]) & (marked[mine] == bitmaps[rev]), "left")
    return joined.drop(doc, rev, mine)


def dropped_lines(keep: Column) -> Column:
    """How many lines a bitmap drops."""
    return F.coalesce(
        F.aggregate(F.map_values(keep), F.lit(0).cast("bigint"), lambda n, bits: n + F.bit_count(F.bitwise_not(bits))),
        F.lit(0).cast("bigint"),
    )


def kept_text(text: Column, keep: Column) -> Column:
    """The lines that a bitmap keeps, joined again."""
    lines = F.split(F.coalesce(text, F.lit("")), BREAK, -1)
    last = F.array_max(F.map_keys(keep))
    # A dense copy of the words: looked up by index, once per line.
    dense = F.transform(F.sequence(F.lit(0), last), lambda k: F.coalesce(F.element_at(keep, k), F.lit(-1).cast("bigint")))
    bit = lambda words, i: F.coalesce(F.get(words, F.shiftright(i, 6)), F.lit(-1).cast("bigint"))
    one = F.transform(F.array(dense), lambda words: F.filter(lines, lambda _, i: F.getbit(bit(words, i), F.pmod(i, F.lit(64))) == 1))
    return F.when(keep.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(one[0], BREAK))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows and columns of ``docs``, their texts without repeated lines."""
    (keep,) = clear_of(docs, "keep")
    marked = with_bitmaps(docs, keep, id_col, text_col, **options)
    text = F.when(F.col(keep).isNull(), F.col(text_col)).otherwise(kept_text(F.col(text_col), F.col(keep)))
    return marked.withColumn(text_col, text).select(*docs.columns)

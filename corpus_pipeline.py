"""A corpus pipeline: five stages over the documents, each written as Parquet and read again before the next.

Low quality goes, then repeated lines, then near copies, then documents that hold benchmark passages; what is left is
encoded. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.llm import bpe, decontam, line_dedup, quality, simhash
from quotemill.llm.common import table
from quotemill.llm.queries import fold_of, tokenizer_file
from quotemill.session import staged


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality.drop_rejected(docs, labels, fold_of(F.col("doc_id")) != 1)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier one holds; the length column follows the text."""
    kept = line_dedup.drop_repeated_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and digests of them and of what they decode to."""
    import public_tokenizers

    coded = bpe.encode(docs, tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decoded=True)
    return coded.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "ids",
    )


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("byte-level BPE", encode),
]
# The classifier, the fingerprints and the encoder are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

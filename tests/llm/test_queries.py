"""Registered queries against their SQL twins, and the pipeline against plain Python."""

from __future__ import annotations

import os
import sys

import brute
import numpy as np
import public_tokenizers
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

from quotemill.llm import queries  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_agrees_with_sql(spark, small, name):
    from compare import compare, connect

    problem, _ = compare(queries.queries()[name](spark, small), connect(small), queries.oracle_sql()[name])
    assert not problem, problem


@pytest.mark.parametrize("name", ["op1_pii", "op3_decontamination", "op4_sharding", "op10_line_dedup"])
def test_plans_are_native(spark, small, name):
    plan = queries.queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    for bad in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert bad not in plan, bad


def test_pipeline(spark, small):
    import tiktoken

    import corpus_pipeline as pipeline
    from quotemill.llm import bpe

    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = pipeline.keep_quality(spark, docs, small)
    assert kept.columns == docs.columns
    rows = sorted((r["doc_id"], r["text"]) for r in kept.collect())
    rows = [(i, text) for i, _, _, text in brute.kept_lines(rows)]
    roots = brute.near_components(rows)
    rows = [(i, t) for i, t in rows if roots[i] == i]
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {r[0] for r in brute.contaminated(rows, items) if r[-1]}
    ranks = bpe.read_ranks(open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = sorted((i, brute.sha(np.array(library.encode_ordinary(t), "<u4").tobytes()), brute.sha(t)) for i, t in rows if i not in bad)
    assert sorted((r["doc_id"], r["ids_sha256"], r["decoded_sha256"]) for r in pipeline.run(spark, small).collect()) == wanted

"""The manifest against a tree built in plain Python, leaf by leaf."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from quotemill.llm import merkle, queries


def sha(text):
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][a : a + 16])) for a in range(0, len(out[-1]), 16)])
    return out


def siblings(tree, k):
    """[(before, after)] from node k of the lowest level up to the root."""
    out = []
    for nodes in tree[:-1]:
        run = nodes[k // 16 * 16 : k // 16 * 16 + 16]
        out.append(("".join(run[: k % 16]), "".join(run[k % 16 + 1 :])))
        k //= 16
    return out


def manifest(rows):
    """rows of (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for g, s in enumerate(order):
        for k, (_, _, own, row) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            steps = siblings(trees[s], k) + siblings(top, g)
            shown = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                shown = leaf([*row[:4], "".join(c.lower() if c.isascii() else c for c in row[4])])
            node = shown
            for before, after in steps:
                node = sha(before + node + after)
            proof = sha("".join(a + b for a, b in steps))
            out.append((row[0], own, trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=repr)


def proofs(docs):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return merkle.proofs(docs, tampered=merkle.lower_text(), where=tampered)


def agrees(docs):
    rows = [tuple(r) for r in docs.select(*merkle.COLUMNS).collect()]
    found = proofs(docs)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == manifest(rows)


def test_odd_rows(spark, odd):
    extra = [(5, None, None, None, None), (5, None, None, None, None), (None, "s", "é", 3, "A"), (10, "S", "", 0, "Ab"), (15, "", "x", 1, "ÉA")]
    rows = odd.select("doc_id", F.lit("s").alias("source"), F.lit(None).cast("string").alias("lang"), F.length("text").cast("long").alias("n_chars"), "text")
    more = spark.createDataFrame(extra, "doc_id long, source string, lang string, n_chars long, text string")
    agrees(rows.unionByName(more).selectExpr("*", "1 AS idx", "2 AS n", "'x' AS tree", "'y' AS leaf", "0 AS block", "'z' AS root"))


def test_empty_table(spark, small):
    assert proofs(spark.read.parquet(f"{small}/documents.parquet").where("false")).collect() == []


@pytest.mark.parametrize("block_levels, span", [(1, 2), (3, 4096)])
def test_many_levels(spark, monkeypatch, block_levels, span):
    """One source with most rows over several blocks and levels, many small ones, sizes at the edges of a level."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", block_levels)
    monkeypatch.setattr(merkle, "SPAN", span)
    sizes = {"big": 4500, "a": 1, "b": 16, "c": 17, "d": 256, "e": 257, **{f"t{k}": 1 for k in range(30)}}
    rows = [(1000 * g + k if s != "big" else 10**6 + k, s, "en", k, f"Text {k} of {s}") for g, (s, n) in enumerate(sizes.items()) for k in range(n)]
    agrees(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7))


def test_query_verifies_what_is_not_tampered(spark, small):
    rows = queries.op13_manifest(spark, small).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    changed = lambda i: zlib.crc32(str(i).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in texts[i] or "")
    assert len(rows) == len(texts) and len({r["root"] for r in rows}) == 1
    assert all(r["verified"] != changed(r["doc_id"]) for r in rows)

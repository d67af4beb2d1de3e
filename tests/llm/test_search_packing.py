"""Ranked search and packing against plain Python."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quotemill.llm import lexical, packing
from quotemill.llm.words import WordEncoder

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def best(docs, items, top=50):
    """(item, rank, doc, score) by scoring every document for every item."""
    counted = [(i, Counter(TERM.findall(lowered(t)))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms, df = len(counted), sum(sum(c.values()) for _, c in counted), Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall(lowered(t)))
    out = []
    for item, terms in asked.items():
        scores = []
        for i, c in counted:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
                for t in terms if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scores, key=lambda s: s[:3])[:top])]
    return sorted(out, key=repr)


def pairs(df, *names):
    return [tuple(r) for r in df.select(*names).collect()]


@pytest.mark.parametrize(
    "name, segments, blocks",
    [("real", (1 << 16, 512, 1 / 4, 16), 1 << 20), ("real", (7, 4, 1 / 2, 1), 1 << 20), ("odd", (2, 1, 0, 0), 800), ("empty", (7, 4, 1, 1), 1 << 20)],
)
def test_search(request, spark, small, monkeypatch, name, segments, blocks):
    for key, value in zip(("SEGMENT_DOCS", "WINDOW", "SHORT", "SEED_PARTS"), segments):
        monkeypatch.setattr(lexical, key, value)
    docs = spark.read.parquet(f"{small}/documents.parquet").repartition(5) if name == "real" else request.getfixturevalue(name)
    odd = [(None, "word one"), (None, "two"), (900, None), (901, "?!"), (902, "line documents LINE École"), (902, "shared"), (903, "of " * 50)]
    items = spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text", F.lit(1).alias("rank"), F.lit("x").alias("score"))
    items = items.unionByName(spark.createDataFrame(odd, "item_id long, text string").select("item_id", "text", F.lit(1).alias("rank"), F.lit("x").alias("score")))
    wanted = best(pairs(docs, "doc_id", "text"), pairs(items, "item_id", "text"), 7)
    found = lexical.search(docs, items, top=7, block_pairs=blocks)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(pairs(found, *found.columns), key=repr) == wanted


def test_search_with_no_items(spark, odd):
    assert lexical.search(odd, spark.createDataFrame([], "item_id long, text string")).collect() == []


def test_windows_and_bounds_lose_nothing():
    """Random lists: the hybrid walk names the same documents and scores as adding everything up, ties included."""
    rng = np.random.default_rng(3)
    for seed in range(60):
        n, size = int(rng.integers(1, 3000)), int(rng.integers(1, 12))
        lists = [np.sort(rng.choice(n, int(rng.integers(1, n + 1)), replace=False)) for _ in range(size)]
        docs, impacts = np.concatenate(lists), rng.integers(0, 6, sum(map(len, lists)))
        segment = lexical.Segment(n, range(size), [len(x) for x in lists], docs, impacts)
        total = np.bincount(docs, impacts, n).astype(int)
        wanted = sorted((-s, d) for d, s in enumerate(total.tolist()) if s > 0)[:50]
        found, scores = segment.best(range(size), 50, 0)
        assert list(zip((-scores).tolist(), found.tolist())) == wanted
        if len(wanted) == 50:
            assert segment.best(range(size), 50, -wanted[-1][0])[1].tolist() == scores.tolist()


def library(path, end, texts):
    from tokenizers import Tokenizer

    return [e.ids + [end] for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path, lead, apart", [(WORDS, "", packing.APART), (BYTES, " ", "\x0b"), (WORDS, "", "§")])
def test_words_encode_like_the_library(monkeypatch, real, path, lead, apart):
    import pyarrow as pa

    from quotemill.llm import words

    rng = random.Random(6)
    pool = [*" \t\n\x0b\x0c\r\x1c\x85\xa0 　'’s.,-ab1éß字ั", "<|endoftext|>", "'re", "  ", "the ", f" {apart} ", "é", "İ", "Σ"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + [t or "" for _, t in real]
    with open(path, encoding="utf-8") as file:
        encoder = WordEncoder(file.read(), lead, apart, 1)
    wanted = library(path, 1, texts)
    for portion, gather in ((24 << 20, 1 << 20), (500, 30)):
        monkeypatch.setattr(words, "PORTION_BYTES", portion)
        monkeypatch.setattr(words, "GATHER_WORDS", gather)
        found = [x.tolist() for n, ids, sizes in encoder.portions(pa.array(texts, pa.string())) for x in np.split(ids, np.cumsum(sizes)[:-1])]
        assert found == wanted


def test_words_at_ends_of_lines_go_to_the_model(monkeypatch):
    """Two words with ends of lines between them are pieces like others: the pattern of the library does not see them."""
    import pyarrow as pa

    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abeinrstéßÀZ") for _ in range(rng.randint(1, 9))) + rng.choice(["", "", ".", ",", "'", '."', "<|", "_"])
    between = [" ", " ", "\n", "\n\n", "\n\n\n"]
    texts = ["".join(f"{word()} {word()}{rng.choice(between)}" for _ in range(30)) + word() for _ in range(400)]
    wanted = library(BYTES, 1, texts)
    with open(BYTES, encoding="utf-8") as file:
        encoder = WordEncoder(file.read(), " ", "\x0b", 1)
    others = []
    monkeypatch.setattr(encoder, "others", lambda words, whole=encoder.others: others.extend(words) or whole(words))
    for _ in range(2):  # the second time all words are known
        found = [x.tolist() for n, ids, sizes in encoder.portions(pa.array(texts, pa.string())) for x in np.split(ids, np.cumsum(sizes)[:-1])]
        assert found == wanted
    assert not others


def fit(counts, capacity):
    """Sequences that large-item matching and best fit need, one piece after the other."""
    pieces = sorted((x for x, n in counts.items() for _ in range(n)), reverse=True)
    large, gaps = [x for x in pieces if 3 * x > capacity], []
    while large:
        a = large.pop(0)
        k = next((k for k, b in enumerate(large) if a + b <= capacity), None)
        gaps.append(capacity - a - (large.pop(k) if k is not None else 0))
    for x in (x for x in pieces if 3 * x <= capacity):
        k = min((k for k, g in enumerate(gaps) if g >= x), key=lambda k: gaps[k], default=None)
        if k is None:
            gaps.append(capacity)
            k = len(gaps) - 1
        gaps[k] -= x
    return sorted(gaps)


def test_plan_is_best_fit():
    for seed in range(150):
        rng = random.Random(seed)
        capacity = rng.choice([10, 60, 4096])
        counts = {rng.randint(1, capacity): rng.randint(1, rng.choice([1, 3, 30])) for _ in range(rng.randint(0, 25))}
        plan = packing.Plan(counts, capacity)
        runs, held = packing.lookup(plan.runs), {}
        for length, n in counts.items():
            for s, o in zip(*(x.tolist() for x in packing.place_of(runs, np.full(n, length), np.arange(n)))):
                held.setdefault(s, []).append((o, length))
        assert sorted(held) == list(range(plan.sequences))
        for inside in held.values():
            inside.sort()
            assert [o for o, _ in inside] == [sum(x for _, x in inside[:k]) for k in range(len(inside))]
            assert sum(3 * x > capacity for _, x in inside) <= 2
        assert sorted(capacity - sum(x for _, x in inside) for inside in held.values()) == fit(counts, capacity)
        assert len(plan.runs) <= 20 * (len(counts) + 1)


def check_packed(rows, docs, capacity, lengths_of):
    """Every piece is there once, digests and places are right, and as few sequences are used as the plan needs."""
    wanted = []
    for (i, _), ids in zip(docs, lengths_of):
        for k in range(0, len(ids), capacity):
            some = ids[k : k + capacity]
            wanted.append((str(i), k // capacity, k, len(some), zlib.crc32(np.array(some, "<u4").tobytes())))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(wanted)
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for inside in held.values():
        inside.sort()
        assert [o for o, _ in inside] == [sum(x for _, x in inside[:k]) for k in range(len(inside))]
        assert sum(x for _, x in inside) <= capacity
    assert len(held) == len(fit(Counter(w[3] for w in wanted), capacity))


@pytest.mark.parametrize("name, capacity", [("real", 4096), ("odd", 100), ("empty", 100)])
def test_packing(request, spark, small, name, capacity):
    docs = spark.read.parquet(f"{small}/documents.parquet").repartition(3) if name == "real" else request.getfixturevalue(name)
    held = pairs(docs, "doc_id", "text")
    rows = packing.packed(docs, WORDS, 1, capacity)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check_packed(rows.collect(), held, capacity, library(WORDS, 1, [t or "" for _, t in held]))

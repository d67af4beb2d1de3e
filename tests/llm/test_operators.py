"""The operators against plain Python versions, on the small tables and on odd rows."""

from __future__ import annotations

import random

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quotemill.llm import ann, bpe, chat, decontam, line_dedup, pii, quality, queries, repair, sharding, simhash
from quotemill.llm.graph import components
from quotemill.session import scratch

RANKS, LIBRARY = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def encoder():
    import tiktoken

    ranks = bpe.read_ranks(open(RANKS, "rb").read())
    return bpe.PrefixBPE(ranks), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module", params=["real", "odd", "empty"])
def docs(request, spark, small):
    return spark.read.parquet(f"{small}/documents.parquet") if request.param == "real" else request.getfixturevalue(request.param)


def test_pii(docs):
    found = pii.with_spans(docs).collect()
    assert len(found) == docs.count()
    base = lambda spans: ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans if s["is_base"])
    mine = sorted((str(r["doc_id"]), base(r["spans"])) for r in found)
    assert mine == sorted((str(i), ",".join(f"{k}:{a}:{b}" for a, _, k, b in brute.base_spans(t or ""))) for i, t in pairs(docs))


def test_pii_finds_secrets_and_redacts(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    spans = pii.with_spans(df).withColumnRenamed("doc_id", "d")
    out = df.join(spans, F.col("doc_id") == F.col("d")).select("doc_id", "text", "spans", pii.redact(F.col("text"), F.col("spans")).alias("r")).collect()
    secret = [row for row in out if "token = " in row["text"]]
    assert secret
    assert all(any(s["kind"] == "secret" for s in row["spans"]) and "<secret>" in row["r"] for row in secret)


def test_pii_finds_rare_kinds_in_a_small_sample(spark):
    account = "GB82 WEST 1234 5698 7654 32"
    rows = [(k, " and ".join(f"call ({100 + (7 * k + j) % 800}) 555-{k:04d}" for j in range(5))) for k in range(400)]
    rows += [(1000 + k, f"pay to {account} now") for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for sample in (10, 40, 20_000):
        found = pii.find_spans(df, sample=sample).where("kind = 'account'").select("doc_id", "start", "end").collect()
        assert sorted(tuple(r) for r in found) == [(1000 + k, 7, 7 + len(account)) for k in range(3)], sample
    assert pii.shares({"a": 3, "b": 10_000, "c": 50}, 100) == {"a": 3, "c": 48, "b": 49}


def test_pii_keeps_both_ends_of_a_chain(spark):
    rng = random.Random(5)
    chains = {1: [(0, 10, 0.9), (8, 20, 0.5), (18, 30, 0.6)], 2: [(0, 10, 0.6), (8, 20, 0.7), (18, 30, 0.9), (29, 40, 0.8), (39, 45, 0.7)]}
    for k in [*range(3, 40), None]:
        starts = sorted(rng.randrange(200) for _ in range(rng.randint(1, 40)))
        chains[k] = [(a, a + rng.randint(1, 30), rng.choice([0.5, 0.6, 0.7, 0.8])) for a in starts]
    rows = [(k, 7, "secret", a, b, False, p, float(j)) for k, spans in chains.items() for j, (a, b, p) in enumerate(spans)]
    df = spark.createDataFrame(rows, "doc_id long, rev long, kind string, start int, end int, is_base boolean, probability double, kind_no double")
    wanted = []
    for k, spans in chains.items():
        kept = []
        for a, b, _ in sorted(spans, key=lambda s: (-s[2], s[0] - s[1], s[0])):
            if all(b <= x or y <= a for x, y in kept):
                kept.append((a, b))
        wanted += [(str(k), a, b) for a, b in kept]
    assert {("1", 0, 10), ("1", 18, 30)} <= set(wanted)
    assert sorted((str(r["doc_id"]), r["start"], r["end"]) for r in pii._free(df).collect()) == sorted(wanted)


def test_line_dedup(docs):
    mine = sorted((str(r["doc_id"]), r["text"]) for r in line_dedup.drop_repeated_lines(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect())
    assert mine == sorted((str(i), t) for i, _, _, t in brute.kept_lines(pairs(docs)))
    assert line_dedup.drop_repeated_lines(docs).columns == docs.columns


def test_simhash(docs):
    rows = simhash.near_components(docs).collect()
    known = [(i, t) for i, t in pairs(docs)]
    prints = sorted((str(i), f"{brute.fingerprint(t):016x}") for i, t in known)
    assert sorted((str(r["doc_id"]), f"{r['fingerprint'] & (2**64 - 1):016x}") for r in rows) == prints
    ids = [i for i, _ in known if i is not None]
    if len(ids) == len(set(ids)):
        assert {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None} == brute.near_components(known)
    assert simhash.one_of_each(docs).columns == docs.columns


def test_simhash_keeps_texts_that_share_an_id(spark):
    same = "the very same words in two documents"
    rows = [(5, f"a text of its own, number {k}", k, 0) for k in range(20)] + [(5, same, 20, j) for j in (3, 1, 2)]
    rows += [(3, same, 21, 0), (3, "another one under three", 22, 0), (8, "a text of its own, number 4", 23, 0), (None, same, 24, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int, m int")
    assert len({brute.fingerprint(r[1]) for r in rows}) == 22
    kept = sorted(r["n"] for r in simhash.one_of_each(docs.repartition(4)).collect())
    assert kept == [*range(20), 21, 22, 24]
    for parts in (1, 3):
        own = simhash.one_of_each(docs.where("doc_id = 5").repartition(parts, "m"))
        assert sorted(r["n"] for r in own.collect()) == [*range(21)]
        assert own.where("n = 20").count() == 1


def test_simhash_links_in_a_dense_group(spark):
    rng = random.Random(4)
    prints = {rng.getrandbits(64) for _ in range(300)}
    middle = rng.getrandbits(64)
    while len(prints) < 1200:  # far more neighbours than a group may have
        prints.add(middle ^ sum(1 << b for b in rng.sample(range(12), rng.randint(0, 6))) ^ (1 << rng.randrange(64) if rng.random() < 0.3 else 0))
    prints = sorted(prints)
    signed = [(k, p - (1 << 64) if p >> 63 else p) for k, p in enumerate(prints)]
    nodes = spark.createDataFrame(signed, "node long, fingerprint long")
    mine = {tuple(sorted(r)) for r in simhash.near_links(nodes, group=16).collect()}
    assert mine == {(a, b) for a in range(len(prints)) for b in range(a + 1, len(prints)) if (prints[a] ^ prints[b]).bit_count() <= 2}


def test_simhash_rounds_are_bounded(spark, monkeypatch):
    """5,000 fingerprints that differ in 14 bits only: the rounds stay below the bound and the rows do not multiply."""
    rng, middle, kept = random.Random(8), 0x1234_5678_9ABC_DEF0, []
    space = rng.sample(range(64), 14)
    prints = set()
    while len(prints) < 5000:
        prints.add(middle ^ sum(1 << b for b in space if rng.random() < 0.5))
    prints = sorted(prints)
    nodes = spark.createDataFrame([(k, p - (1 << 64) if p >> 63 else p) for k, p in enumerate(prints)], "node long, fingerprint long")

    def noted(df, name):
        kept.append(simhash_staged(df, name))
        return kept[-1]

    simhash_staged = simhash.staged
    monkeypatch.setattr(simhash, "staged", noted)
    mine = {tuple(sorted(r)) for r in simhash.near_links(nodes, group=16).collect()}
    at, flips = {p: k for k, p in enumerate(prints)}, [1 << a | (1 << b if b != a else 0) for a in space for b in space if a <= b]
    assert mine == {tuple(sorted((k, at[p ^ f]))) for p, k in at.items() for f in flips if p ^ f in at}
    assert 1 < len(kept) <= simhash.most_rounds() and max(k.count() for k in kept) <= 40 * len(prints)
    assert simhash.most_rounds() <= 12


def test_components(spark):
    rng = random.Random(7)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 560)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    wanted = brute.groups(sorted({x for link in links for x in link}), links)
    assert found == {k: v for k, v in wanted.items() if k != v}


@pytest.mark.parametrize("limit", [None, 0])
def test_decontamination(spark, docs, small, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(decontam, "BROADCAST_BYTES", limit - 1)
    items = spark.read.parquet(f"{small}/benchmark.parquet").unionByName(
        spark.createDataFrame([(900, "One, TWO"), (901, None), (902, ""), (None, "x y"), (903, "This line is shared by many documents own line")], "item_id long, text string")
    )
    rows = decontam.judged(docs, items, ("nw", "nh", "its", "bad")).collect()
    mine = sorted((str(r["doc_id"]), r["nw"], r["nh"], ",".join(r["its"]), r["bad"]) for r in rows)
    assert mine == sorted((str(i), *rest) for i, *rest in brute.contaminated(pairs(docs), [tuple(r) for r in items.collect()]))


@pytest.mark.parametrize("limit", [None, -1])
def test_decontamination_without_ids(spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(decontam, "BROADCAST_BYTES", limit)
    docs = spark.createDataFrame([(None, "see one two three"), (None, "nothing here"), (1, "one two three"), (2, "a blue moon")], "doc_id long, text string")
    items = spark.createDataFrame([(5, "One two three"), (None, "blue moon"), (None, "two three")], "item_id long, text string")
    rows = decontam.judged(docs, items, ("nw", "nh", "its", "bad")).collect()
    assert sorted((str(r["doc_id"]), r["text"], r["nh"], r["its"], r["bad"]) for r in rows) == [
        ("1", "one two three", 3, ["5", None], True), ("2", "a blue moon", 2, [None], True),
        ("None", "nothing here", 0, [], False), ("None", "see one two three", 3, ["5", None], True),
    ]
    assert pairs(decontam.drop_contaminated(docs, items)) == [(None, "nothing here")]


def test_no_benchmark(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.drop_contaminated(docs, none).count() == docs.count()


def test_byte_bpe(docs):
    _, library = encoder()
    rows = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    mine = sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist(), bytes(r["decoded"])) for r in rows)
    assert mine == sorted((str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t in pairs(docs))


def test_bpe_under_change():
    own, library = encoder()
    rng = random.Random(3)
    bits = ["a", " ", "  ", "\n", "'s", "'ll", "é", "日本", "😀", "22", "!", "...", "_", "\x0b", "\xa0", "the", "ing", "--------", "\r\n", "Z"]
    words = lambda n: "".join(rng.choice(bits) for _ in range(rng.randint(0, n)))
    texts = [words(30) for _ in range(500)]
    for text, ids in zip(texts, bpe.text_encoder(own, public_tokenizers.PATTERN)(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
    for text in texts[:150]:
        live = bpe.LiveText(own, public_tokenizers.PATTERN, text)
        for _ in range(3):
            a = rng.randint(0, len(text))
            b, new = rng.randint(a, len(text)), words(5)
            live.replace(a, b, new)
            live.append(" more")
            text = text[:a] + new + text[b:] + " more"
            assert live.ids() == library.encode_ordinary(text)


def test_token_file(spark, docs):
    from tokenizers import Tokenizer

    path, library = scratch(spark, "tests-token-file"), Tokenizer.from_file(LIBRARY)
    repair.write_ids(docs, path, LIBRARY, 2, block_tokens=5_000)
    rows = repair.read_ids(spark, path).join(repair.block_starts(spark, path), ["part", "block"]).collect()
    mine = sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in rows)
    assert mine == sorted((str(i), library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in pairs(docs))
    at = 0
    for r in sorted(rows, key=lambda r: r["base"] + r["place"]):
        assert r["base"] + r["place"] == at
        at += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: r["base"] + r["place"]) if r["doc_id"] is not None]
    assert order == sorted(order)


def test_blocks_are_read_at_random():
    rng = np.random.default_rng(1)
    parts = [np.concatenate([rng.integers(0, 30, n), np.tile([5, 6, 7], n)]) for n in (0, 1, 50, 400, 3)]
    block = repair.Block(repair.write_block(np.concatenate(parts), [len(p) for p in parts], 40))
    assert len(block.seq) < sum(map(len, parts)) / 2
    for k, part in enumerate(parts):
        assert block.document(k).tolist() == part.tolist()
        for a, b in ((0, 1), (3, 90), (len(part) - 2, len(part) + 5)):
            assert block.range(k, a, b).tolist() == part[max(0, a) : b].tolist()


def test_grammar_goes_on_until_no_pair_is_frequent():
    rng = np.random.default_rng(2)
    phrases = [rng.integers(0, 40, 12) for _ in range(6)]
    ids = np.concatenate([phrases[k] for k in rng.integers(0, 6, 300)])
    sizes = [len(repair.compress(ids, [0, 600], 40, rounds)[2]) for rounds in (1, 2, 3, None)]
    assert sizes == sorted(set(sizes), reverse=True) and sizes[-1] < 600


def test_grammar_takes_a_buckets_most_frequent_pair(monkeypatch):
    monkeypatch.setattr(repair, "BUCKET_BITS", 1)  # all pairs meet in two buckets
    ids = np.array([1, 2] * 3 + [9] + [3, 4] * 50 + [7] + [5, 6] * 40)
    rules, _, _, _ = repair.compress(ids, [0], 10, 1, 2, 2)
    assert [3, 4] in rules.tolist() and [1, 2] not in rules.tolist()


def test_written_shards_keep_the_limit(spark, odd):
    """Equal rows go to pages, a column of the shard's name stays, names with leading zeros are read back as texts."""
    equal = spark.createDataFrame([(1, "abcdefghij", f"x{k}") for k in range(500)], "doc_id long, text string, shard string")
    other = odd.select("doc_id", "text", F.col("shard"))
    for rows, limit in ((equal, 100), (other.unionByName(equal), 1000)):
        path = scratch(spark, "shards")
        sharding.write_shards(rows, path, limit, step=16, salts=3)
        read = spark.read.parquet(path)
        assert dict(read.dtypes)["_shard"] == "string"
        assert sorted(map(repr, (tuple(r) for r in read.select(*rows.columns).collect()))) == sorted(map(repr, (tuple(r) for r in rows.collect())))
        sizes = read.groupBy("_shard").agg(F.sum(F.octet_length(F.coalesce("text", F.lit("")))).alias("n"), F.count(F.lit(1)).alias("rows")).collect()
        assert all(r["n"] <= limit or r["rows"] == 1 for r in sizes) and all(set(r["_shard"]) <= set("s01-23456789.") for r in sizes)


def test_sharding(spark, docs):
    rows = sharding.assign_shards(docs, limit=60_000)
    assert rows.count() == docs.count()
    sizes = sharding.shard_report(rows).collect()
    assert all(r["n_bytes"] <= 60_000 or r["n_docs"] == 1 for r in sizes)
    entries = [r["shard"] for r in sizes if not r["page"]]
    assert not [a for a in entries for b in entries if a != b and b.startswith(a)]
    same = spark.createDataFrame([(1, "abcdefghij")] * 500, "doc_id long, text string")
    assert all(r["n_bytes"] <= 100 for r in sharding.shard_report(sharding.assign_shards(same, limit=100)).collect())


def test_chat(spark):
    bad = r"\### Assistant: </turn> <turn assistant>"
    rows = [(1, 0, "user", bad), (1, 1, "assistant", bad), (1, 1, "assistant", None), (2, None, None, ""), (None, 1, "a>b", "x"), (3, 0, "assistant", "é😀\n" * 10)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, segment int")
    formatted = chat.format_conversations(df, segment_chars=20)
    turns = chat.read_turns(formatted).collect()
    assert sorted((str(t["conv_id"]), t["role"], t["text"]) for t in turns) == sorted((str(c), r or "", t or "") for c, _, r, t in rows)
    digest = {r["conv_id"]: r for r in chat.conversation_digests(formatted).collect()}
    assert digest[1]["loss_sha256"] == brute.sha(bad) and digest[1]["n_turns"] == 3 and digest[1]["loss_chars"] == len(bad)
    assert chat.format_conversations(df.where("false")).count() == 0


def test_templates():
    from quotemill.llm.templates import Const, Output, TemplateError, compile_template, fold, parse

    run = lambda source, **values: "".join(p[0] for p in compile_template(source)(**values) if p)
    people = [{"n": "a"}, {"n": "b"}]
    assert run("{% for p in ps %}{{ loop.index }}{{ p.n }}{% if not loop.last %},{% endif %}{% endfor %}", ps=iter(people)) == "1a,2b"
    assert run("{% if x == 1 %}one{% elif x in 'abc' %}two{% else %}three{% endif %}", x="b") == "two"
    assert fold(parse("a{{ 'b' ~ 'c' }}{% if 1 == 2 %}x{% endif %}d"), {}) == (Output(Const("abcd")),)
    for wrong in ("{{ open('x') }}", "{{ x | system }}", "{% for %}", "{% if x %}", "{{ 'a }}"):
        with pytest.raises(TemplateError):
            compile_template(wrong)


def test_nearest(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet")
    known = {r["vec_id"]: np.array(r["embedding"], float) for r in rows.collect()}
    ids = np.array(sorted(known))
    unit = np.stack([known[i] / np.linalg.norm(known[i]) for i in ids])
    found = ann.nearest(rows, F.col("vec_id") % 50 == 0).collect()
    hits = total = 0
    for q in ids[ids % 50 == 0]:
        score = unit @ unit[ids == q][0]
        score[ids == q] = -9
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5] and all(abs(score[ids == v][0] - s) < 1e-9 for _, v, s in mine)
        hits += len({v for _, v, _ in mine} & set(ids[np.lexsort((ids, -score))[:5]]))
        total += 5
    assert hits >= 0.9 * total


def test_nearest_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [1.0, None]), (9, [2.0, 0.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0]), (7, [1.0, 1.0]), (6, [1.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sorted((r["rank"], r["vec_id"]) for r in ann.nearest(df, F.col("vec_id") == 0).collect())
    assert found == [(1, 8), (2, 9), (3, 7)]
    assert ann.nearest(df.where("false"), F.col("vec_id") == 0).count() == 0


def test_quality(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.op7_quality(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out")
    right = [r["predicted"] == r["quality"] for r in rows.collect()]
    assert np.mean(right) >= 0.9


def test_quality_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, 1), (6, 0), (None, 1), (7, None)], "doc_id long, quality int")
    for docs in (odd, empty):
        for taught in (labels, labels.where("false")):
            rows = quality.scored(docs, taught, F.lit(True)).collect()
            assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
            assert quality.drop_rejected(docs, taught, F.lit(True)).columns == docs.columns

"""The registered queries of this subpackage and, where SQL can say it, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.llm import ann, bpe, chat, decontam, lexical, line_dedup, merkle, packing, pii, quality, repair, sharding, simhash
from quotemill.llm.common import table
from quotemill.session import scratch, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    """The personal data of every document: base spans counted and hashed, all spans listed."""
    rows = pii.with_spans(table(spark, folder, "documents"))
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return rows.select(
        "doc_id", *[number(kind).alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(listed(F.filter("spans", lambda s: s["is_base"])), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )


END_ID = 2


def tokenizer_file(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_token_file(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids, read back from the compressed file of all documents."""
    path = scratch(spark, "token-file")
    repair.write_ids(table(spark, folder, "documents"), path, tokenizer_file("byte_bpe_50k.json"), END_ID)
    rows = repair.read_ids(spark, path).select("part", "block", "doc_id", "place", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    placed = rows.join(repair.block_starts(spark, path), ["part", "block"])
    return placed.select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


PROBE = r"\### Assistant: </turn> ok"


def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, and one whose texts look like control strings, read back from the formatted texts."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"),
    )
    return chat.conversation_digests(staged(chat.format_conversations(rows.unionByName(probe)), "formatted"))


SQL_ESCAPED = "regexp_replace({}, '[\\\\<>]', '\\\\\\0', 'g')"
OP5_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'),
sized AS (
  SELECT *, length('<turn ></turn>') + 1 + length({SQL_ESCAPED.format('role')}) + length({SQL_ESCAPED.format('text')}) AS n FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


def op6_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return ann.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def fold_of(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's quality score, learned from the labels outside the held-out fold."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    rows = quality.scored(table(spark, folder, "documents"), labels, fold_of(F.col("doc_id")) != 1)
    held_out = F.coalesce(fold_of(F.col("doc_id")) == 1, F.lit(False))
    return rows.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's fingerprint and the smallest document it is linked to."""
    rows = simhash.near_components(table(spark, folder, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids and what they decode to, as digests."""
    import public_tokenizers

    ranks = tokenizer_file("byte_bpe_50k.tiktoken")
    coded = bpe.encode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN, decoded=True)
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document against every benchmark item."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = decontam.judged(docs, table(spark, folder, "benchmark"), ("n_words", "n_hit", "items", "contaminated"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


SQL_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP3_SQL = f"""
WITH docs AS (SELECT doc_id, {SQL_WORDS} AS words FROM documents),
items AS (SELECT item_id, {SQL_WORDS} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(words), {decontam.WINDOW}) AS n,
         array_to_string(list_slice(words, i, i + {decontam.WINDOW} - 1), ' ') AS window
  FROM (SELECT item_id, words, unnest(range(1, greatest(1, len(words) - {decontam.WINDOW} + 1) + 1)) AS i FROM items WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM docs),
hits AS (
  SELECT doc_id, i, p.n, item_id
  FROM (SELECT doc_id, i, n, array_to_string(list_slice(words, i, i + n - 1), ' ') AS window
        FROM places, sizes WHERE i + n - 1 <= len(words)) p JOIN windows w ON w.window = p.window AND w.n = p.n),
hit_words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {decontam.SHARE} * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN found USING (doc_id)
"""


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """The shard of every document: its directory entry, the entry's depth and bytes."""
    rows = sharding.assign_shards(table(spark, folder, "documents"))
    report = sharding.shard_report(rows).select("shard", "page", "depth", F.col("n_bytes").alias("shard_bytes"))
    return rows.join(report, ["shard", "page"]).select("doc_id", "n_bytes", "shard", "page", "depth", "shard_bytes")


OP4_SQL = f"""
WITH rows AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
         lpad(bin(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS UBIGINT)), 32, '0') AS bits
  FROM documents),
entries AS (
  SELECT left(bits, d) AS shard, d, sum(n_bytes) AS total
  FROM rows, (SELECT unnest(generate_series(0, 32)) AS d) GROUP BY ALL HAVING sum(n_bytes) <= {sharding.LIMIT_BYTES}),
placed AS (
  SELECT r.doc_id, r.n_bytes, min(d) AS depth FROM rows r JOIN entries e ON left(r.bits, e.d) = e.shard GROUP BY ALL)
SELECT p.doc_id, p.n_bytes, e.shard, '' AS page, CAST(p.depth AS INTEGER) AS depth, CAST(e.total AS BIGINT) AS shard_bytes
FROM placed p JOIN rows r USING (doc_id) JOIN entries e ON e.d = p.depth AND e.shard = left(r.bits, p.depth)
"""


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that an earlier document holds."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    marked = line_dedup.with_bitmaps(docs, "keep")
    return marked.select(
        "doc_id",
        F.size(F.split(F.coalesce("text", F.lit("")), line_dedup.BREAK, -1)).cast("bigint").alias("n_lines"),
        line_dedup.dropped_lines(F.col("keep")).alias("n_dropped"),
        F.sha2(line_dedup.kept_text(F.col("text"), F.col("keep")), 256).alias("kept_sha256"),
    )


OP10_SQL = f"""
WITH lines AS (
  SELECT doc_id, i, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
firsts AS (SELECT key, min(doc_id) AS first_doc FROM lines WHERE length(key) >= {line_dedup.MIN_CHARS} GROUP BY key),
marked AS (
  SELECT doc_id, i, line, coalesce(doc_id > first_doc, false) AS dropped FROM lines LEFT JOIN firsts USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op11_lexical(spark: SparkSession, folder: str) -> DataFrame:
    """The fifty documents that score highest for each benchmark item."""
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SQL_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11_SQL = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS d, {SQL_TERMS} AS terms FROM documents),
sizes AS (SELECT doc_id, d, len(terms) AS n FROM docs WHERE len(terms) > 0),
totals AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
asked AS (SELECT DISTINCT item_id, unnest({SQL_TERMS}) AS term FROM benchmark),
counted AS (
  SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM docs) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), totals),
scored AS (
  SELECT item_id, doc_id, d, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN counted USING (term) JOIN weights USING (term) JOIN sizes USING (d), totals GROUP BY ALL),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, d) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= {lexical.TOP}
"""


PACKING_END = 1


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document and its place in a sequence of 4096 tokens."""
    return packing.packed(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"), PACKING_END)


TAMPERED_ONE_IN = 5


def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's leaf and proof; a fifth of the leaves are shown with tampered texts."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % TAMPERED_ONE_IN == 0
    return merkle.proofs(table(spark, folder, "documents"), tampered=merkle.lower_text(), where=tampered)


def _manifest_sql(levels: int = 5, root_levels: int = 3) -> str:
    """The trees level by level: ``levels`` above the leaves of a source (16**5 of them), ``root_levels`` above the sources."""
    said = lambda v: f"coalesce(CAST(strlen(CAST({v} AS VARCHAR)) AS VARCHAR) || ':' || {v}, '-')"
    leaf = lambda text: f"sha256({' || '.join(map(said, ['doc_id', 'source', 'lang', 'n_chars', text]))})"
    # crc32 bit by bit over the bytes of the decimal number.
    crc = (
        "xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT)), lambda r, b: "
        "list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(r, b)), 4294967295))"
    )
    parts = [f"""
leaves AS (
  SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN {crc} % {TAMPERED_ONE_IN} = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS shown
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM leaves),
s0 AS (SELECT source, i, leaf AS h, n FROM placed),
p0 AS (SELECT source, i AS leaf_i, i, coalesce(shown, leaf) AS h, '' AS proof FROM placed)"""]

    def tree(node: str, path: str, k: int) -> str:
        """Level ``k + 1`` of nodes and paths; a level of one node is the root and stays as it is."""
        siblings = "array_to_string(hs[1 : {p}.i % 16], '') || {m} || array_to_string(hs[{p}.i % 16 + 2 :], '')"
        p = f"{path}{k}"
        return f"""
{node}r{k} AS (SELECT source, i // 16 AS run, list(h ORDER BY i) AS hs, any_value(n) AS n FROM {node}{k} GROUP BY ALL),
{node}{k + 1} AS (
  SELECT source, run AS i, CASE WHEN n = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h, (n + 15) // 16 AS n FROM {node}r{k}),
{path}{k + 1} AS (
  SELECT {p}.source, leaf_i, {p}.i // 16 AS i, CASE WHEN n = 1 THEN h ELSE sha256({siblings.format(p=p, m='h')}) END AS h,
         CASE WHEN n = 1 THEN proof ELSE proof || {siblings.format(p=p, m="''")} END AS proof
  FROM {p} JOIN {node}r{k} r ON {p}.source IS NOT DISTINCT FROM r.source AND {p}.i // 16 = r.run)"""

    parts += [tree("s", "p", k) for k in range(levels)]
    parts.append(f"""
subroots AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS g, count(*) OVER () AS n FROM s{levels}),
t0 AS (SELECT NULL AS source, g AS i, subroot AS h, n FROM subroots),
q0 AS (SELECT NULL AS source, struct_pack(g := g, i := leaf_i) AS leaf_i, g AS i, h, proof FROM p{levels} p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source)""")
    parts += [tree("t", "q", k) for k in range(root_levels)]
    return f"""
WITH {','.join(parts)}
SELECT doc_id, leaf, subroot, t.h AS root, sha256(q.proof) AS proof_sha256, q.h AS folded_root, q.h = t.h AS verified
FROM placed l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
JOIN q{root_levels} q ON q.leaf_i.g = s.g AND q.leaf_i.i = l.i, t{root_levels} t
"""


OP13_SQL = _manifest_sql()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_token_file": op2_token_file,
    "op3_decontamination": op3_decontamination,
    "op4_sharding": op4_sharding,
    "op5_chat_format": op5_chat_format,
    "op6_nearest": op6_nearest,
    "op7_quality": op7_quality,
    "op8_simhash": op8_simhash,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_line_dedup": op10_line_dedup,
    "op11_lexical": op11_lexical,
    "op12_packing": op12_packing,
    "op13_manifest": op13_manifest,
}
ORACLES: dict[str, str] = {
    "op3_decontamination": OP3_SQL, "op4_sharding": OP4_SQL, "op5_chat_format": OP5_SQL, "op10_line_dedup": OP10_SQL,
    "op11_lexical": OP11_SQL, "op13_manifest": OP13_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)

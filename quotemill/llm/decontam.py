"""Benchmark decontamination as a prefix-filtered set join on windows of words.

A window of a benchmark item occurs in a document only if all shingles of the window do, so one shingle per window is
enough to find candidates: the necessary prefix of the window's shingles in the order of rarity is its rarest one.
Rarity is counted over all documents. The rarest shingles are joined with the documents' shingles; the shingle's place
in the window gives the only possible start, length and position bounds drop windows that would stick out, and the
words are compared one by one. Documents are read twice: once to count, once to join; neither pass shuffles texts.

The prefix table is broadcast only while its measured size is below ``BROADCAST_BYTES``. A larger one is joined by a
shuffle of (document, position, hash) rows, and the words of the candidates' documents are compared afterwards.

Defined cases: a null text has no words; documents and items without words match nothing; items without id hit
words like others and stand as one null at the end of the list of items; a null document id is an id like others; rows of
one document id are judged each by its own text; equal rows get equal results; an empty benchmark gives zeros; columns
other than id and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import clear_of, lower_ascii
from quotemill.session import staged

WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
WINDOW = 13
SHINGLE = 5
BROADCAST_BYTES = 16 << 20
SHARE = 20  # contaminated from one word in so many


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(item_id, window): all windows of all items; an item of fewer words is one window."""
    worded = items.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (window - 1)))
    return worded.where(F.size("words") > 0).select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, window))).alias("window")).distinct()


def _shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """(window, k, offset, h): the shingles of ``k`` words of each window; a window of fewer words is one shingle."""
    k = F.least(F.lit(shingle), F.size("window"))
    sized = windows.select("window", k.alias("k"))
    places = sized.select("window", "k", F.explode(F.sequence(F.lit(0), F.size("window") - F.col("k"))).alias("offset"))
    return places.withColumn("h", F.xxhash64(F.lit(0), F.slice("window", F.col("offset") + 1, F.col("k"))))


def _positions(docs: DataFrame, id_col: str, text_col: str, lengths: list[int], carry: bool) -> DataFrame:
    """(doc_id, rev, [words], pos, h): the hash of the ``k`` words at each position, for each length."""
    worded = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("rev"), words_of(F.col(text_col)).alias("words")
    )
    placed = worded.select("doc_id", "rev", "words", F.posexplode("words").alias("pos", "word"))
    # The same hash as that of a slice, without making one: the hash of an array runs through its elements. All lengths
    # come out of one generator: a union would end the generated code, and rows with their words would pile up before it.
    hashes = [F.when(F.col("pos") + k <= F.size("words"), F.xxhash64(F.lit(0), *[F.get("words", F.col("pos") + j) for j in range(k)])) for k in lengths]
    h = hashes[0] if len(hashes) == 1 else F.explode(F.array(*hashes))
    return placed.select("doc_id", "rev", *(["words"] if carry else []), "pos", h.alias("h")).where("h IS NOT NULL")


def prefixes(docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> tuple[DataFrame, list[int], bool]:
    """((window, offset, h): each window's rarest shingle, the shingles' lengths, whether the table is small)."""
    shingles = staged(_shingles(windows, shingle), "decontam-shingles")
    lengths = sorted(r[0] for r in shingles.select("k").distinct().collect())  # ``shingle`` numbers at most
    size = shingles.agg(F.sum(F.octet_length(F.concat_ws(" ", "window")) + 64)).first()[0] or 0
    small = size <= BROADCAST_BYTES
    if not lengths:
        return shingles.select("window", "offset", "h"), [], small
    known = shingles.select("h").distinct()
    known = F.broadcast(known) if small else known
    counted = _positions(docs, id_col, text_col, lengths, False).select("h").join(known, "h").groupBy("h").count()
    ranked = shingles.join(staged(counted, "decontam-rarity"), "h", "left")
    order = F.struct(F.coalesce("count", F.lit(0)), "offset")
    rarest = ranked.groupBy("window").agg(F.min_by(F.struct("offset", "h", F.coalesce("count", F.lit(0)).alias("n")), order).alias("best"))
    # A window whose rarest shingle is in no document is in none.
    return staged(rarest.where("best.n > 0").select("window", "best.offset", "best.h"), "decontam-prefixes"), lengths, small


def occurrences(
    docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """(doc_id, rev, start, window): every place where a window stands in a document."""
    table, lengths, small = prefixes(docs, windows, id_col, text_col, shingle)
    start, length = F.col("pos") - F.col("offset"), F.size("window")
    # Of a shingle shorter than the others the length is that of its window, so the hash alone decides.
    if small:
        found = _positions(docs, id_col, text_col, lengths or [shingle], True).join(F.broadcast(table), "h")
        inside = found.where((start >= 0) & (start + length <= F.size("words")))
        return inside.where(F.slice("words", start + 1, length) == F.col("window")).select("doc_id", "rev", start.alias("start"), "window")
    found = _positions(docs, id_col, text_col, lengths or [shingle], False).join(table, "h").where(start >= 0)
    candidates = found.select("doc_id", "rev", start.alias("start"), "window")
    worded = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("rev"), words_of(F.col(text_col)).alias("words"))
    same = F.col("c.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("c.rev") == F.col("w.rev"))
    wanted = candidates.select("doc_id", "rev").distinct()
    worded = worded.alias("w").join(wanted.alias("c"), same, "left_semi").dropDuplicates(["doc_id", "rev"])
    joined = candidates.alias("c").join(worded.alias("w"), same).where(F.slice("words", F.col("start") + 1, length) == F.col("window"))
    return joined.select("c.doc_id", "c.rev", "start", "window")


def covered(spans: Column) -> Column:
    """How many positions sorted spans (a, b) cover."""
    begin = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(s["a"], acc["end"]))).alias("n"), F.greatest(acc["end"], s["b"]).alias("end")
    )
    return F.aggregate(spans, begin, step, lambda acc: acc["n"])


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
) -> DataFrame:
    """(doc_id, rev, n_hit, items) of the documents that hold a window; items as sorted texts, one null last for those without id."""
    owned = staged(item_windows(items, item_id_col, item_text_col, window), "decontam-windows")
    found = staged(occurrences(docs, owned.select("window").distinct(), id_col, text_col, shingle).distinct(), "decontam-found")
    spans = found.groupBy("doc_id", "rev").agg(
        covered(F.sort_array(F.collect_set(F.struct(F.col("start").alias("a"), (F.col("start") + F.size("window")).alias("b"))))).alias("n_hit")
    )
    owners = found.select("doc_id", "rev", "window").distinct().join(owned, "window")
    nameless = F.when(F.bool_or(F.col("item_id").isNull()), F.array(F.lit(None).cast("string"))).otherwise(F.array().cast("array<string>"))
    named = owners.groupBy("doc_id", "rev").agg(F.concat(F.sort_array(F.collect_set(F.col("item_id").cast("string"))), nameless).alias("items"))
    doc, rev = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")), F.col("l.rev") == F.col("r.rev")
    return spans.alias("l").join(named.alias("r"), doc & rev).select("l.doc_id", "l.rev", "n_hit", "items")


def judged(
    docs: DataFrame, items: DataFrame, names: tuple[str, str, str, str], id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """All rows and columns of ``docs`` and, under the given names, words, hit words, items, contaminated."""
    n_words, n_hit, found, bad = names
    doc, rev, mine, hits, held = clear_of(docs, "dc_doc", "dc_rev", "dc_mine", "dc_hits", "dc_items")
    table = contamination(docs, items, id_col, text_col, **options).toDF(doc, rev, hits, held)
    marked = docs.withColumn(mine, F.xxhash64(F.col(text_col)))
    joined = marked.join(table, marked[id_col].eqNullSafe(table[doc]) & (marked[mine] == table[rev]), "left")
    words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("bigint")
    out = joined.withColumns({
        n_words: words,
        n_hit: F.coalesce(F.col(hits), F.lit(0)).cast("bigint"),
        found: F.coalesce(F.col(held), F.array().cast("array<string>")),
    })
    return out.withColumn(bad, (F.col(n_hit) > 0) & (F.col(n_hit) * SHARE >= F.col(n_words))).drop(doc, rev, mine, hits, held)


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows and columns of ``docs`` that are not contaminated."""
    names = clear_of(docs, "dc_n_words", "dc_n_hit", "dc_found", "dc_bad")
    return judged(docs, items, tuple(names), id_col, text_col, **options).where(~F.col(names[3])).select(*docs.columns)

"""Personal data by candidate gradient boosting, in DataFrame functions only.

Generators propose spans with high recall: four base kinds, whose matches are checked by rules and always stay, and
further kinds (secrets, local phone numbers, identity and account numbers, masked mail addresses) that may overlap each
other and the base. Boosted trees give each further candidate a probability from its format and its context; thresholds
calibrated per kind decide. Of accepted candidates, the likeliest first, those stay that overlap none that stays; what
overlaps a base span goes.

The trees learn from votes of precise rules on at most ``SAMPLE`` candidates of the corpus, a share of them for each kind
(those with the smallest hashes), so that a rare kind is learned too. They are applied as a column expression. The
thresholds are read off the votes of all candidates, counted per kind and level of probability. Only the sample and the
counts reach the driver.

A pattern's places come from the lengths of the pieces between its matches: pieces and matches are cut in one task, and
their lengths are summed by a window over the matches of a document. Texts are read, never shuffled. Patterns use
possessive repetition, so a text of any length and kind needs time in proportion and no stack.

Defined cases: a null text is empty and has no spans; a null id is an id like others; rows of one id are judged each by
its own text; equal rows get equal results; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotemill.llm.boosting import LEVELS, Boosted, boost, threshold
from quotemill.llm.common import texts
from quotemill.session import staged

SAMPLE = 20_000
CONTEXT = 32
LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])(?=(?:[0-9][ -]?){14})[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
MORE = {
    "secret": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]{0,64}[0-9])[A-Za-z0-9+/_=-]{16,}+",
    "local_phone": r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "identity": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}+(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "masked_email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[(\[]at[)\]] ?[A-Za-z0-9-]++(?: ?[(\[]dot[)\]] ?[A-Za-z0-9-]++|\.[A-Za-z0-9-]++)++",
}
KINDS = [*BASE, *MORE]
#: What a text must hold before a pattern is tried.
NEEDS = {"email": "@", "phone": "+", "masked_email": "at"}
KEYS = r"(?i)(?:token|secret|passw(?:or)?d|api[_ -]?key|auth|bearer|credential)"
CALLS = r"(?i)(?:tel|phone|mobile|call|fax|cell)"


def _matches(text: Column, kind: str, pattern: str, has_digit: Column) -> Column:
    """An array of (kind, idx, skip, match, before, after) of a pattern in a text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.transform(
        F.split(text, pattern, -1),
        lambda p: F.struct(F.char_length(p).alias("n"), F.right(p, F.lit(CONTEXT)).alias("last"), F.left(p, F.lit(CONTEXT)).alias("first")),
    )
    # Both arrays stand once in an inner array, so that neither pattern pass is repeated per match.
    both = F.array(F.struct(found.alias("found"), pieces.alias("pieces")))
    rows = F.flatten(F.transform(both, lambda b: F.transform(b["found"], lambda m, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("idx"), F.get(b["pieces"], i)["n"].alias("skip"), m.alias("match"),
        F.get(b["pieces"], i)["last"].alias("before"), F.get(b["pieces"], i + 1)["first"].alias("after"),
    ))))
    needed = text.contains(NEEDS[kind]) if kind in NEEDS else has_digit
    return F.when(needed, rows)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, rev, kind, start, end, match, before, after) of every proposal; ``rev`` tells texts of one id apart."""
    rows = texts(docs, id_col, text_col)
    text, has_digit = F.col("text"), F.col("text").rlike("[0-9]")
    arrays = [F.coalesce(_matches(text, k, p, has_digit), F.array()) for k, p in (BASE | MORE).items()]
    keyed = rows.select("doc_id", F.xxhash64("text").alias("rev"), F.explode(F.concat(*arrays)).alias("m")).select("doc_id", "rev", "m.*")
    once = staged(keyed.dropDuplicates(["doc_id", "rev", "kind", "idx"]), "pii-candidates")
    length = F.char_length("match")
    along = W.partitionBy("doc_id", "rev", "kind").orderBy("idx")
    end = F.sum(F.col("skip") + length).over(along)
    return once.withColumn("end", end.cast("int")).withColumn("start", F.col("end") - length).drop("skip", "idx")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits has the check digit of payment cards."""
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0))) % 10 == 0


def _small_parts(address: Column) -> Column:
    parts = F.transform(F.split(address, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(parts, lambda p: (F.char_length(p) < 3) | ((F.char_length(p) == 3) & (p <= "255")))


def valid_base(kind: Column, match: Column) -> Column:
    """The rules that a base match must pass."""
    digits = _digits(match)
    n = F.char_length(digits)
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", _small_parts(match))
        .when(kind == "card", n.between(14, 19) & F.when(n <= 19, _luhn(digits)))
        .when(kind == "phone", n.between(10, 15))
        .otherwise(False)
    )


def _remainder97(account: Column) -> Column:
    """An account number as a number modulo 97: the first four characters go last, letters count 10 to 35."""
    plain = F.regexp_replace(account, " ", "")
    turned = F.filter(F.split(F.concat(F.expr("substring(replace(match, ' ', ''), 5)"), F.left(plain, F.lit(4))), ""), lambda c: c != "")
    value = lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(turned, F.lit(0), lambda a, c: (a * F.when(c.between("0", "9"), 10).otherwise(100) + value(c)) % 97)


FEATURES = [
    "kind_no", "n_chars", "n_digits", "n_distinct", "n_upper", "n_lower", "n_signs", "is_hex", "key_before", "call_before", "assigned",
    "quoted", "passes_check", "closed_left", "closed_right",
]


def with_features(rows: DataFrame) -> DataFrame:
    """Format and context of further candidates as numbers."""
    match, before, after, kind = (F.col(c) for c in ("match", "before", "after", "kind"))
    count = lambda pattern: F.regexp_count(match, F.lit(pattern))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    identity = match.rlike("^(?!000|666|9)") & match.rlike("^...-(?!00)") & match.rlike("-(?!0000)[0-9]{4}$")
    check = (
        F.when(kind == "account", _remainder97(match) == 1)
        .when(kind == "identity", identity)
        .when(kind == "local_phone", match.rlike(r"^\(?[2-9][0-9]{2}\)?[ .-][2-9]"))
        .otherwise(False)
    )
    number = F.lit(0)
    for k, name in enumerate(MORE):
        number = F.when(kind == name, k).otherwise(number)
    return rows.withColumns({
        "kind_no": number.cast("double"),
        "n_chars": F.char_length(match).cast("double"),
        "n_digits": count("[0-9]").cast("double"),
        "n_distinct": F.size(F.array_distinct(F.split(F.left(match, F.lit(256)), ""))).cast("double"),
        "n_upper": count("[A-Z]").cast("double"),
        "n_lower": count("[a-z]").cast("double"),
        "n_signs": count("[^A-Za-z0-9]").cast("double"),
        "is_hex": flag(match.rlike("^(?:[0-9a-f]++|[0-9A-F]++)$")),
        "key_before": flag(before.rlike(KEYS)),
        "call_before": flag(before.rlike(CALLS)),
        "assigned": flag(before.rlike(r"[=:][ \t]*[\"']?$")),
        "quoted": flag(before.rlike("[\"']$") & after.rlike("^[\"']")),
        "passes_check": flag(check),
        "closed_left": flag(before.rlike(r"(?:^|\s|[(\"'=:,;])$")),
        "closed_right": flag(after.rlike(r"^(?:$|\s|[)\"',;.])")),
    })


def votes(rows: DataFrame) -> DataFrame:
    """A weak label per candidate, by precise rules."""
    kind = F.col("kind")
    secret = (F.col("key_before") > 0) & (F.col("assigned") > 0) & (F.col("n_digits") >= 4) & (F.col("n_distinct") >= 8)
    label = (
        F.when(kind == "secret", secret)
        .when(kind == "masked_email", (F.col("closed_left") > 0) & (F.col("closed_right") > 0))
        .when(kind == "local_phone", (F.col("passes_check") > 0) & ((F.col("call_before") > 0) | (F.col("closed_right") > 0)))
        .otherwise(F.col("passes_check") > 0)
    )
    return rows.withColumn("label", label.cast("int"))


def shares(counts: dict[str, int], sample: int) -> dict[str, int]:
    """How many rows of each kind a sample takes: equal shares, what a rare kind leaves going to the others; one at least."""
    out, left = {}, sample
    for k, (kind, n) in enumerate(sorted(counts.items(), key=lambda c: (c[1], c[0]))):
        out[kind] = min(n, max(1, left // (len(counts) - k)))
        left -= out[kind]
    return out


def _sampled(rows: DataFrame, sample: int) -> DataFrame:
    """Of each kind its share of the sample: the rows with the smallest hashes ``h``, sorted only below a border."""
    counts = {r["kind"]: r["count"] for r in rows.groupBy("kind").count().collect()}  # one row per kind
    border, most = F.lit(None).cast("bigint"), F.lit(0)
    for kind, n in shares(counts, sample).items():
        below = min(2**63 - 1, int(-(2**63) + min(1.0, (2 * n + 32) / counts[kind]) * 2**64))
        border, most = F.when(F.col("kind") == kind, F.lit(below)).otherwise(border), F.when(F.col("kind") == kind, n).otherwise(most)
    place = F.row_number().over(W.partitionBy("kind").orderBy("h", *FEATURES, "label"))
    return rows.where(F.col("h") <= border).withColumn("place", place).where(F.col("place") <= most)


def train(further: DataFrame, sample: int = SAMPLE) -> Boosted | None:
    """Trees from a bounded sample of candidates with their votes, without thresholds; None if there are none."""
    hashed = further.select("kind", *FEATURES, "label", F.xxhash64("doc_id", "rev", "kind", "start").alias("h"))
    known = sorted(_sampled(hashed, sample).collect(), key=lambda r: (r["h"], r["kind"], r["place"]))  # at most ``sample`` rows
    if not known:
        return None
    x = np.array([[row[f] for f in FEATURES] for row in known], float)
    return boost(x, np.array([row["label"] for row in known]), [row["kind"] for row in known])


def calibrate(rated: DataFrame) -> dict[str, float]:
    """The threshold of every kind, by the votes of all candidates (kind, probability, label)."""
    level = sum(((F.col("probability") >= t).cast("int") for t in LEVELS), F.lit(0))
    counted = rated.groupBy("kind", level.alias("level")).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("n_right")).collect()
    kinds = {r["kind"] for r in counted}
    return {kind: threshold({r["level"]: (r["n"], r["n_right"]) for r in counted if r["kind"] == kind}) for kind in sorted(kinds)}


def _islands(rows: DataFrame) -> DataFrame:
    """Spans with the number of the run of overlapping spans that they are in."""
    order = W.partitionBy("doc_id", "rev").orderBy("start", "end", "kind_no")
    reach = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    opened = rows.withColumn("new", (F.coalesce(reach, F.lit(-1)) <= F.col("start")).cast("int"))
    return opened.withColumn("island", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))).drop("new")


def _free(rows: DataFrame) -> DataFrame:
    """Base spans, and of the further ones, the likeliest first, those that overlap neither a base span nor one that stays."""
    doc = W.partitionBy("doc_id", "rev").orderBy("start")
    back = doc.rangeBetween(W.unboundedPreceding, W.currentRow)
    ahead = doc.rangeBetween(W.currentRow, W.unboundedFollowing)
    is_base = F.col("is_base")
    touched = rows.withColumn("left_end", F.max(F.when(is_base, F.col("end"))).over(back)).withColumn(
        "right_start", F.min(F.when(is_base, F.col("start"))).over(ahead)
    )
    clear = touched.where(is_base | (F.coalesce(F.col("left_end") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("right_start") >= F.col("end"), F.lit(True))))
    base, further = clear.where("is_base"), clear.where("NOT is_base")
    # The likeliest of an island stays, and what overlaps it goes; most islands end here.
    likeliest = W.partitionBy("doc_id", "rev", "island").orderBy(F.desc("probability"), F.desc(F.col("end") - F.col("start")), "start", "kind_no")
    top = F.first(F.struct("start", "end")).over(likeliest)
    ranked = _islands(further).withColumns({"place": F.row_number().over(likeliest), "top": top})
    ranked = ranked.where((F.col("place") == 1) | (F.col("end") <= F.col("top.start")) | (F.col("start") >= F.col("top.end")))
    first, rest = ranked.where("place = 1"), ranked.where("place > 1")
    # What is left falls into smaller islands; there each span in turn stays unless it overlaps one that does.
    span = F.struct((-F.col("probability")).alias("p"), (F.col("start") - F.col("end")).alias("n"), "start", "kind_no", "end", "kind")
    grouped = _islands(rest).groupBy("doc_id", "rev", "island").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    apart = lambda s, kept: ~F.exists(kept, lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"]))
    none = F.filter("spans", lambda s: F.lit(False))
    kept = F.aggregate("spans", none, lambda kept, s: F.when(apart(s, kept), F.concat(kept, F.array(s))).otherwise(kept))
    others = grouped.select("doc_id", "rev", F.explode(kept).alias("s")).select("doc_id", "rev", "s.kind", "s.start", "s.end", F.lit(False).alias("is_base"))
    columns = ["doc_id", "rev", "kind", "start", "end", "is_base"]
    return base.select(*columns).unionByName(first.select(*columns)).unionByName(others)


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, rev, kind, start, end, is_base): the spans to redact, in code points, the end exclusive."""
    found = candidates(docs, id_col, text_col)
    is_base = F.col("kind").isin(*BASE)
    base = found.where(is_base).where(valid_base(F.col("kind"), F.col("match"))).select("doc_id", "rev", "kind", "start", "end")
    further = staged(votes(with_features(found.where(~is_base))).drop("match", "before", "after"), "pii-further")
    base = base.withColumns({"is_base": F.lit(True), "probability": F.lit(1.0), "kind_no": F.lit(-1.0)})
    model = train(further, sample)
    if model is None:
        return base.select("doc_id", "rev", "kind", "start", "end", "is_base")
    rated = further.withColumn("probability", model.column([F.col(f) for f in FEATURES]))
    rated = staged(rated.select("doc_id", "rev", "kind", "start", "end", "kind_no", "probability", "label"), "pii-rated")
    least = F.lit(None).cast("double")
    for kind, level in calibrate(rated).items():
        least = F.when(F.col("kind") == kind, level).otherwise(least)
    accepted = rated.where(F.col("probability") >= least)
    accepted = accepted.select("doc_id", "rev", "kind", "start", "end", F.lit(False).alias("is_base"), "probability", "kind_no")
    return _free(base.unionByName(accepted))


def spans_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, rev, spans) of the documents that have any; spans sorted by start, then kind."""
    number = F.lit(len(KINDS))
    for k, kind in enumerate(KINDS):
        number = F.when(F.col("kind") == kind, k).otherwise(number)
    span = F.struct("start", number.alias("kind_no"), "kind", "end", "is_base")
    return find_spans(docs, id_col, text_col, sample).groupBy("doc_id", "rev").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def with_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, spans) of every row of ``docs``, an empty array where there are none."""
    rows = texts(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("rev"))
    found = spans_of(docs, id_col, text_col, sample).select(F.col("doc_id").alias("d"), F.col("rev").alias("r"), "spans")
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("rev") == F.col("r")), "left")
    return joined.select("doc_id", "rev", F.coalesce("spans", F.array()).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """The text with every span, where spans overlap their union, replaced by its first kind in angle brackets."""
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    step = lambda acc, s: F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["parts"].alias("parts"))).otherwise(
        F.struct(
            s["end"].alias("at"),
            F.concat(acc["parts"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("<"), s["kind"], F.lit(">")))).alias("parts"),
        )
    )
    done = F.aggregate(spans, begin, step, lambda acc: F.concat(acc["parts"], F.array(F.substring(text, acc["at"] + 1, F.char_length(text)))))
    return F.array_join(done, "")

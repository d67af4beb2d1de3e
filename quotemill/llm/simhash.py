"""SimHash near-dedup: documents whose 64-bit fingerprints differ in few bits, linked without comparing all pairs.

Equal fingerprints are one node from the start, so a thousand copies are one row. A fingerprint is cut into ``PIECES``
pieces of bits. Two fingerprints that differ in at most ``max_bits`` bits agree in all but ``max_bits`` pieces, so each
choice of the agreeing pieces is a block key; fingerprints are joined on it, and the Hamming distance decides. Where
more than ``group`` fingerprints share a key, they are not paired: the bits outside the key are cut once more into
``max_bits + 1`` pieces, one of which must agree, and the longer keys are looked at instead, until every group is small.
Different choices lead to the same longer key, so repeats of (fingerprint, key) and of keys go in every round. A round
lengthens each key by a third of its other bits at least; once ``max_bits`` bits are left, a group holds
``2 ** max_bits`` fingerprints at most, which counts as small. So it ends after ``most_rounds`` rounds; nothing is left out.

Defined cases: a null or blank text has fingerprint zero and is linked like any other; fewer words than a shingle are
one shingle; a null id links nothing and gets a null component; repeated rows are exact copies; an empty table gives an
empty result; columns other than id and text are not looked at.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.llm.common import clear_of, texts
from quotemill.llm.graph import components
from quotemill.session import staged
from quotemill.shipping import ship_by_value

SHINGLE, SEED, MAX_BITS = 3, 42, 2
PIECES = 5
GROUP = 64
OUT_ROWS = 50_000


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a UTF-8 text: a bit is 1 if it is set in over half of the shingles' hashes."""
    import numpy as np
    import xxhash

    words = text.lower().split()  # of bytes: A-Z only, and white space \x20 \x09-\x0D
    if not words:
        return 0
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < shingle:
        return hashed(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    count = np.zeros(64, np.int64)
    total = len(words) - shingle + 1
    while True:
        some = [hashed(joined[a:b], SEED) for a, b in itertools.islice(spans, 1 << 17)]
        if not some:
            break
        bits = np.unpackbits(np.array(some, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << k for k in np.flatnonzero(2 * count > total).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, carry: bool = False) -> DataFrame:
    """(doc_id, [rev], fingerprint): the fingerprint's 64 bits as a signed number; ``rev`` tells texts of one id apart."""
    rows = texts(docs, id_col, text_col)
    rows = rows.select("doc_id", *([F.xxhash64("text").alias("rev")] if carry else []), F.col("text").cast("binary").alias("text"))
    fields = rows.schema.fields[:-1]
    names = [f.name for f in fields] + ["fingerprint"]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            *others, bodies = batch.columns
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in bodies), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*others, pa.array(found.view(np.int64))], names=names)

    return rows.mapInArrow(run, T.StructType([*fields, T.StructField("fingerprint", T.LongType())]))


def _pieces(bits: list[int], n: int) -> list[int]:
    """Masks of ``n`` runs of the given bit positions, as even as can be."""
    cuts = [round(k * len(bits) / n) for k in range(n + 1)]
    return [sum(1 << b for b in bits[i:j]) for i, j in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def first_masks(max_bits: int = MAX_BITS, pieces: int = PIECES) -> list[int]:
    """The keys' masks: all choices of ``pieces - max_bits`` pieces."""
    runs = _pieces(list(range(64)), pieces)
    return [sum(chosen) for chosen in itertools.combinations(runs, pieces - max_bits)]


def longer_masks(mask: int, max_bits: int = MAX_BITS) -> list[int]:
    """The mask with each of ``max_bits + 1`` pieces of its other bits, of which there must be more than ``max_bits``."""
    rest = [b for b in range(64) if not mask >> b & 1]
    if len(rest) <= max_bits:
        raise ValueError("all fingerprints that share this mask are links")
    return [mask | piece for piece in _pieces(rest, max_bits + 1)]


def most_rounds(max_bits: int = MAX_BITS, pieces: int = PIECES) -> int:
    """How many rounds ``near_links`` takes at most: until no key has more than ``max_bits`` other bits."""
    rounds, rest = 1, 64 - min(m.bit_count() for m in first_masks(max_bits, pieces))
    while rest > max_bits:
        rounds, rest = rounds + 1, rest - min(p.bit_count() for p in _pieces(list(range(rest)), max_bits + 1))
    return rounds


def near_links(nodes: DataFrame, max_bits: int = MAX_BITS, pieces: int = PIECES, group: int = GROUP) -> DataFrame:
    """(a, b) for all pairs of rows (node, fingerprint), fingerprints distinct, that differ in ``max_bits`` bits at most."""
    masks = first_masks(max_bits, pieces)
    group = max(group, 1 << max_bits)
    rows = nodes.select("node", "fingerprint", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    found = []
    for _ in range(most_rounds(max_bits, pieces)):
        keyed = rows.select("node", "fingerprint", "mask", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("key"))
        sizes = keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        shared = staged(keyed.join(sizes, ["mask", "key"]), "simhash-keys")
        small = shared.where(F.col("n") <= group).drop("n")
        other = small.select("mask", "key", F.col("node").alias("b"), F.col("fingerprint").alias("other"))
        close = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other"))) <= max_bits
        pairs = small.join(other, (small["mask"] == other["mask"]) & (small["key"] == other["key"]) & (F.col("fingerprint") < F.col("other")) & close)
        found.append(pairs.select(F.col("node").alias("a"), "b"))
        large = shared.where(F.col("n") > group)
        used = [r[0] for r in large.select("mask").distinct().collect()]  # some of the masks made here
        if not used:
            break
        split = {_signed(m): [_signed(x) for x in longer_masks(m, max_bits)] for m in masks if _signed(m) in used}
        choices = F.create_map(*[x for m, more in split.items() for x in (F.lit(m), F.array(*map(F.lit, more)))])
        rows = large.select("node", "fingerprint", F.explode(choices[F.col("mask")]).alias("mask")).dropDuplicates(["node", "mask"])
        masks = sorted({x for m in masks if _signed(m) in used for x in longer_masks(m, max_bits)})
    else:
        raise AssertionError("keys did not lengthen")
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links.distinct()


def near_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, fingerprint, component_id): the smallest id that is reachable over links, one row per document."""
    rows = staged(fingerprints(docs, id_col, text_col, shingle), "simhash-fingerprints")
    nodes = staged(
        rows.where("doc_id IS NOT NULL").groupBy("fingerprint").agg(F.min("doc_id").alias("node")), "simhash-nodes"
    )
    roots = components(near_links(nodes, max_bits))
    named = nodes.join(roots, "node", "left").select("fingerprint", F.coalesce("root", "node").alias("component_id"))
    joined = rows.join(named, "fingerprint", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return joined.select("doc_id", "fingerprint", component.alias("component_id"))


def first_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, rev): of every group of texts that are linked, the smallest id with the smallest text hash under it.

    Fingerprints are linked, not ids, so different texts of one id are in one group only if they are near copies.
    """
    rows = fingerprints(docs, id_col, text_col, shingle, carry=True).where("doc_id IS NOT NULL")
    nodes = staged(rows.groupBy("fingerprint").agg(F.min(F.struct("doc_id", "rev")).alias("first")), "simhash-nodes")
    roots = components(near_links(nodes.select(F.col("fingerprint").alias("node"), "fingerprint"), max_bits))
    grouped = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").groupBy(F.coalesce("root", "fingerprint"))
    return grouped.agg(F.min("first").alias("first")).select("first.doc_id", "first.rev")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows and columns of ``docs`` that come first in their group of near copies; of equal ids and texts one row stays.

    Texts of one id that are no near copies are judged each by itself. Where rows of equal id and text differ elsewhere,
    the hash of the other columns decides. Rows with a null id stay.
    """
    key, rev, mine, row = clear_of(docs, "simhash_first", "simhash_rev", "simhash_mine", "simhash_row")
    firsts = first_of_each(docs, id_col, text_col, **options).toDF(key, rev)
    named = docs.where(F.col(id_col).isNotNull()).withColumn(mine, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    kept = named.join(firsts, (named[id_col] == firsts[key]) & (named[mine] == firsts[rev]), "left_semi")
    order = F.struct(F.col(text_col).isNull(), F.xxhash64(F.to_json(F.struct(*[c for c in docs.columns if c != text_col]))))
    one = kept.groupBy(id_col, mine).agg(F.min_by(F.struct(*docs.columns), order).alias(row)).select(f"{row}.*")
    return one.unionByName(docs.where(F.col(id_col).isNull()))


ship_by_value(__name__)

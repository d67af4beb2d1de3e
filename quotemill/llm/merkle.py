"""Merkle manifest of a dataset: a hash for every row, a tree over each group of rows, a tree over the groups, and proofs.

A leaf is the hash of a row's columns. Within its group (``source``) leaves ascend by id; as long as a level has several
nodes, every 16 neighbours, the last run fewer, become the hash of their digests. The groups' roots, in the order of the
groups, make the last tree in the same way.

Proofs are made by blocks of 16**3 leaves, which are aligned with the tree, as multiproofs: the digests a block cannot
derive from its own leaves are, on each level above it, the other nodes of the run its ancestor is in, and above those the
path of its group's root. The union of these coordinates is asked for once, by one join for all blocks; the task that holds
a block's leaves derives all nodes inside it once and expands from both the proof of every leaf. So a proof's upper part is
fetched once in 4096 leaves, and no task holds more than a block. Nodes near a root are asked for by very many blocks; they
are dealt out in as many copies as they have spans of ``SPAN`` blocks below them, so no key of the join is asked for more
often than that.

Leaves are numbered by ranges of (group, id, digest, place in the written table), of which no single value is hot, and
by counts of the ranges before; the levels above the blocks are grouped 16 by 16 and written one after the other.

Defined cases: a null value counts as ``-``; null groups are one group, the first; null ids come first in their group;
rows with equal ids follow each other by digest, so what the manifest says does not depend on the order they were read
in, and each has its own proof; the only leaf of a group is the group's root, and one group's root is the root: an empty
proof; an empty table gives an empty result; columns that are not named are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.llm.common import lower_ascii
from quotemill.session import staged
from quotemill.shipping import ship_by_value

ARITY, BLOCK_LEVELS = 16, 3
BLOCK = ARITY**BLOCK_LEVELS
SPAN = 4096
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_ROW = (1 << 33) - 1  # monotonically_increasing_id keeps the row within the partition in the low 33 bits


def leaf_hash(values: Sequence[Column]) -> Column:
    """sha256 of all values: ``-`` for a null, else the bytes of its text, a colon and the text."""
    said = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*said), 256)


def leaves(docs: DataFrame, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id", group_col: str = "source", tampered: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """(tree, doc_id, leaf, shown): ``shown`` is the leaf of the row with the columns ``tampered``, where that is asked for.

    ``tree`` orders the groups: empty for the null group, else the group's text behind a sign.
    """
    leaf = leaf_hash([F.col(c) for c in columns])
    other = leaf_hash([(tampered or {}).get(c, F.col(c)) for c in columns])
    shown = F.when(F.coalesce(where, F.lit(False)), other) if tampered and where is not None else F.lit(None).cast("string")
    tree = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    return docs.select(tree.alias("tree"), F.col(id_col).alias("doc_id"), leaf.alias("leaf"), shown.alias("shown"))


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with idx = 0..n-1 in the total ``order`` of each group, and n. No task sees a whole group."""
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = staged(ranged.withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id().bitwiseAND(_ROW)), "merkle-ranges")
    parts = placed.groupBy(group, "part").agg(F.count(F.lit(1)).alias("rows"), F.min("row").alias("first"))
    whole = W.partitionBy(group)  # one row a range
    parts = parts.withColumn("n", F.sum("rows").over(whole)).withColumn("before", F.sum("rows").over(whole.orderBy("part")) - F.col("rows"))
    joined = placed.join(parts, [group, "part"])
    return joined.select(*rows.columns, (F.col("before") + F.col("row") - F.col("first")).alias("idx"), "n")


def _span(idx: Column) -> Column:
    return F.floor(idx / F.lit(SPAN))


def _up(nodes: DataFrame, *also: str) -> DataFrame:
    """The next level of (tree, idx, h, n), n being how many nodes the level has; a single node stays as it is."""
    grouped = nodes.groupBy("tree", *also, F.shiftright("idx", 4).alias("run"), "n").agg(F.array_sort(F.collect_list(F.struct("idx", "h"))).alias("run_nodes"))
    digests = F.transform("run_nodes", lambda x: x["h"])
    h = F.when(F.col("n") == 1, digests[0]).otherwise(F.sha2(F.array_join(digests, ""), 256))
    return grouped.select("tree", *also, F.col("run").alias("idx"), h.alias("h"), F.shiftright(F.col("n") + (ARITY - 1), 4).alias("n"))


def grown(nodes: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(runs, roots) above nodes (tree, idx, h, n).

    Runs are (tree, level, run, leaves, digests) of all levels with several nodes; level 0 is the given nodes, ``leaves`` of
    them in the tree. Roots are (tree, h).
    """
    nodes, runs, roots, level = staged(nodes.withColumn("leaves", F.col("n")), name), [], [], 0
    most = nodes.agg(F.max("n")).first()[0] or 1
    while True:
        roots.append(nodes.where("n = 1").select("tree", "h"))
        ordered = F.array_sort(F.collect_list(F.struct("idx", "h")))
        grouped = nodes.where("n > 1").groupBy("tree", F.shiftright("idx", 4).alias("run"), "n", "leaves")
        grouped = staged(grouped.agg(F.transform(ordered, lambda x: x["h"]).alias("digests")), name)
        runs.append(grouped.select("tree", F.lit(level).alias("level"), "run", "leaves", "digests"))
        if most == 1:
            break
        above = F.sha2(F.array_join("digests", ""), 256)
        nodes = grouped.select("tree", F.col("run").alias("idx"), above.alias("h"), F.shiftright(F.col("n") + (ARITY - 1), 4).alias("n"), "leaves")
        most, level = -(-most // ARITY), level + 1
    return reduce(DataFrame.unionByName, runs), reduce(DataFrame.unionByName, roots)


def paths(asking: DataFrame, runs: DataFrame) -> DataFrame:
    """(tree, idx, path) of every node (tree, idx, n): on each level above it the place of its ancestor and the whole run.

    A run on level k is asked for by 16**(k+1) nodes; it is copied once for every ``SPAN`` of them, which keeps each key of
    the join small.
    """
    # Level k is there as long as it has several nodes: n > 16**k.
    levels = F.filter(F.sequence(F.lit(0), F.lit(15)), lambda k: F.col("n") > F.pow(F.lit(float(ARITY)), k))
    wanted = asking.select("tree", "idx", F.explode(levels).alias("level")).withColumn("span", _span(F.col("idx")))
    wanted = wanted.withColumn("ancestor", F.expr("shiftright(idx, cast(4 * level as int))")).withColumn("run", F.shiftright("ancestor", 4))
    first = F.expr("shiftleft(run, cast(4 * (level + 1) as int))")
    last = F.least(F.expr("shiftleft(run + 1, cast(4 * (level + 1) as int)) - 1"), F.col("leaves") - 1)
    copies = runs.withColumn("span", F.explode(F.sequence(_span(first), _span(last)))).drop("leaves")
    found = wanted.join(copies, ["tree", "level", "run", "span"])
    step = F.struct("level", F.pmod("ancestor", F.lit(ARITY)).cast("int").alias("place"), "digests")
    grouped = found.groupBy("tree", "idx").agg(F.array_sort(F.collect_list(step)).alias("path"))
    return asking.select("tree", "idx").join(grouped, ["tree", "idx"], "left")


def proofs(docs: DataFrame, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id", group_col: str = "source", tampered: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``proof_sha256`` hashes the leaf's siblings, level by level up to the root, each run's from left to right. The folded
    root is what the siblings make of the row's leaf, of the tampered one where that is asked for.
    """
    rows = staged(leaves(docs, columns, id_col, group_col, tampered, where).withColumn("nth", F.monotonically_increasing_id()), "merkle-leaves")
    placed = staged(numbered(rows, "tree", ["doc_id", "leaf", "nth"]).withColumn("block", F.shiftright("idx", 4 * BLOCK_LEVELS)).drop("nth"), "merkle-placed")
    dealt = placed.select("tree", "block", "idx", F.col("leaf").alias("h"), "n").repartition("tree", "block")
    tops = reduce(lambda nodes, _: _up(nodes, "block"), range(BLOCK_LEVELS), dealt)
    tops = tops.select("tree", "idx", "h", "n")
    tops = staged(tops, "merkle-blocks")
    runs, subroots = grown(tops, "merkle-levels")
    groups = staged(numbered(subroots.select(F.lit("").alias("all"), "tree", F.col("h").alias("subroot")), "all", ["tree"]), "merkle-groups")
    root_runs, roots = grown(groups.select(F.col("all").alias("tree"), "idx", F.col("subroot").alias("h"), "n"), "merkle-root")
    root_paths = paths(groups.select(F.col("all").alias("tree"), "idx", "n"), root_runs).select("idx", F.col("path").alias("root_path"))
    root = F.broadcast(roots.select(F.col("tree").alias("all"), F.col("h").alias("root")))  # one row
    of_group = groups.select("all", "tree", "subroot", "idx").join(root_paths, "idx").join(root, "all").drop("all")
    # What a group's blocks share is copied like the top of its tree.
    blocks = tops.select("tree", "idx", "n")
    sizes = blocks.where("idx = 0").select("tree", "n")
    shared = of_group.drop("idx").join(sizes, "tree").withColumn("span", F.explode(F.sequence(F.lit(0).cast("bigint"), _span(F.col("n") - 1)))).drop("n")
    fetched = paths(blocks, runs).withColumn("span", _span(F.col("idx"))).join(shared, ["tree", "span"])
    fetched = fetched.select("tree", F.col("idx").alias("block"), F.lit(-1).cast("bigint").alias("idx"), "path", "root_path", "subroot", "root")
    both = fetched.unionByName(placed.select("tree", "block", "idx", "n", "doc_id", "leaf", "shown"), allowMissingColumns=True)
    both = both.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType)])
    for field in T.StructType.fromDDL("leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"):
        schema = schema.add(field)
    both = both.select("doc_id", "idx", "n", "leaf", "shown", "path", "root_path", "subroot", "root")

    def run(batches):
        block, kind = None, None
        for batch in batches:
            kind, out = batch.schema.field("doc_id").type, []
            # A block's first row is what was fetched for it; its leaves follow.
            for doc_id, idx, n, leaf, shown, path, root_path, subroot, root in zip(*(c.to_pylist() for c in batch.columns)):
                if idx < 0:
                    out += block.expanded() if block else []
                    block = Block(path, root_path, subroot, root)
                else:
                    block.add(doc_id, n, leaf, shown)
            if out:
                yield _batch(out, kind, schema.names)
        if block:
            yield _batch(block.expanded(), kind, schema.names)

    return both.mapInArrow(run, schema)


def _batch(rows: list[tuple], id_type, names: list[str]):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [id_type, *[pa.string()] * 5, pa.bool_()])], names=names)


def digest(text: str) -> str:
    import hashlib

    return hashlib.sha256(text.encode("ascii")).hexdigest()


class Block:
    """Leaves that follow each other from a place that is a multiple of ``BLOCK`` on, and what was fetched for them."""

    def __init__(self, path, root_path, subroot: str, root: str):
        self.steps = [
            ("".join(step["digests"][: step["place"]]), "".join(step["digests"][step["place"] + 1 :])) for step in [*(path or []), *(root_path or [])]
        ]
        self.siblings = "".join(a + b for a, b in self.steps)
        self.subroot, self.root, self.n = subroot, root, 0
        self.ids, self.leaves, self.shown = [], [], []

    def add(self, doc_id, n: int, leaf: str, shown: str | None) -> None:
        self.n = n
        self.ids.append(doc_id)
        self.leaves.append(leaf)
        self.shown.append(shown)

    def fold(self, node: str, steps) -> str:
        for before, after in steps:
            node = digest(before + node + after)
        return node

    def expanded(self) -> list[tuple]:
        """A row for each leaf. Levels inside the block are derived once."""
        levels, width, node = [], self.n, self.leaves
        while width > 1 and len(levels) < BLOCK_LEVELS:
            runs = [node[a : a + ARITY] for a in range(0, len(node), ARITY)]
            levels.append(runs)
            node, width = [digest("".join(r)) for r in runs], -(-width // ARITY)
        whole = self.fold(node[0], self.steps)  # of every leaf that is shown as it is
        # From the top down: the siblings of each node up to the block's top.
        above: list[tuple[str, tuple]] = [("", ())]
        for runs in reversed(levels):
            below = []
            for run, (said, steps) in zip(runs, above):
                for k in range(len(run)):
                    before, after = "".join(run[:k]), "".join(run[k + 1 :])
                    below.append((before + after + said, ((before, after), steps)))
            above = below
        out = []
        for doc_id, leaf, shown, (said, steps) in zip(self.ids, self.leaves, self.shown, above):
            folded = whole
            if shown is not None and shown != leaf:
                folded = shown
                while steps:
                    folded, steps = self.fold(folded, steps[:1]), steps[1]
                folded = self.fold(folded, self.steps)
            out.append((doc_id, leaf, self.subroot, self.root, digest(said + self.siblings), folded, folded == self.root))
        return out


def lower_text(text_col: str = "text") -> dict[str, Column]:
    """What tampering does in the tests of a manifest: A-Z of the text in lower case."""
    return {text_col: lower_ascii(F.col(text_col))}


ship_by_value(__name__)

"""Token ids in a file format that is compressed by a grammar (Re-Pair) and read at random.

Documents are encoded, each with an end id behind it, and dealt by ranges of the document id, so the parts of the file
follow each other in ascending order. A part is a row of blocks of about ``BLOCK_TOKENS`` ids. In each block the most
frequent pairs of neighbouring symbols are replaced by new symbols, again and again; a pair never spans two documents.
A block holds its rules, the expansion length of every rule, where each document starts in the sequence, how many ids
it has, and the sequence. The ids of one document, or a range of them, are decoded without the others.

The file is a folder of Parquet rows (part, block, doc_ids, n_tokens, payload), written and read by Spark, so it can
lie wherever Spark reads. The payload is little-endian: eight unsigned 32-bit numbers (mark, version, width of a symbol
in bytes, first new symbol, documents, rules, symbols, ids), then starts, counts, rules as pairs, lengths, sequence.

Defined cases: a null text is the empty one, its document is the end id alone; null ids come first, repeated ids one
after the other in the order of their texts' hashes; a text of any length is one document of one block; an empty table
makes an empty file. Strings of special tokens inside a text are what the tokenizers library makes of them.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.llm.common import kept_in_worker, texts
from quotemill.llm.words import WordEncoder
from quotemill.shipping import ship_by_value

MARK, VERSION = 0x52505231, 1
BLOCK_TOKENS = 1 << 20
# Six rounds leave a sequence 1.7 % longer than as many as find a frequent pair (ROUNDS = None), for half the CPU time.
ROUNDS, RULES_PER_ROUND, LEAST_USES = 6, 2048, 16
BUCKET_BITS = 18
APART = "\x0b"  # a white space character: always a match, and a token, of its own between two parts


def compress(ids, starts, first_new: int, rounds: int | None = ROUNDS, per_round: int = RULES_PER_ROUND, least: int = LEAST_USES):
    """(rules, lengths, sequence, starts) of ids whose documents begin at ``starts``.

    A round counts all pairs by hash bucket and takes the most frequent pair out of each of the ``per_round`` fullest buckets.
    Where replaceable pairs overlap, they are taken from left to right; a pair left with fewer than ``least`` uses makes no
    rule. It ends after ``rounds`` rounds, or when no pair is left that is frequent enough (``rounds=None``).
    """
    import numpy as np

    seq, starts = ids.astype(np.uint32), np.asarray(starts, np.int64)
    rules, lengths = [np.zeros((0, 2), np.int64)], [np.ones(first_new, np.int64)]
    next_new = first_new
    for turn in range(rounds) if rounds is not None else itertools.count():
        if len(seq) < 2 * least:
            break
        left, right = seq[:-1], seq[1:]
        bucket = ((left * np.uint32(2654435761 + 2 * turn)) ^ (right * np.uint32(2246822519))) >> np.uint32(32 - BUCKET_BITS)
        bucket = bucket.astype(np.intp)  # what counting and looking up take as it is
        inner = starts[(starts > 0) & (starts < len(seq))] - 1
        full = np.bincount(bucket, minlength=1 << BUCKET_BITS)
        full -= np.bincount(bucket[inner], minlength=1 << BUCKET_BITS)  # the last symbol of a document has no pair
        heavy = np.argpartition(full, -per_round)[-per_round:]
        heavy = heavy[full[heavy] >= least]
        if not len(heavy):
            break
        number_of = np.full(1 << BUCKET_BITS, -1, np.int16)
        number_of[heavy] = np.arange(len(heavy))
        slot = number_of.take(bucket)
        slot[inner] = -1
        at = np.flatnonzero(slot >= 0)
        slot = slot[at]
        # Each full bucket's most frequent pair is taken; others in the bucket wait for a round with another hash.
        key = left[at].astype(np.int64) << 32 | right[at]
        chosen = np.zeros(len(heavy), np.int64)
        chosen[slot[::-1]] = key[::-1]
        hit = key == chosen[slot]
        # The pair met first is that one if half of the bucket's pairs are equal to it; the other buckets are counted.
        unsure = 2 * np.bincount(slot[hit], minlength=len(heavy)) < np.bincount(slot, minlength=len(heavy))
        if unsure.any():
            among = np.flatnonzero(unsure[slot])
            pairs, first, uses = np.unique(key[among], return_index=True, return_counts=True)
            order = np.argsort(uses, kind="stable")  # of a bucket's pairs the last one, with most uses, stays
            chosen[slot[among[first[order]]]] = pairs[order]
            hit[among] = key[among] == chosen[slot[among]]
        at, slot = at[hit], slot[hit]
        # In a run of neighbouring hits every second one counts, from the first on.
        fresh = np.concatenate([[True], np.diff(at) != 1])
        head = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        taken = (np.arange(len(at)) - head) % 2 == 0
        at, slot = at[taken], slot[taken]
        uses = np.bincount(slot, minlength=len(chosen))
        worth = uses >= least
        if not worth.any():
            break
        number = np.cumsum(worth) - 1
        at, slot = at[worth[slot]], slot[worth[slot]]
        pairs = np.stack([chosen[worth] >> 32, chosen[worth] & 0xFFFFFFFF], axis=1)
        known = np.concatenate(lengths)
        rules.append(pairs)
        lengths.append(known[pairs[:, 0]] + known[pairs[:, 1]])
        seq[at] = (next_new + number[slot]).astype(np.uint32)
        next_new += len(pairs)
        stays = np.ones(len(seq), bool)
        stays[at + 1] = False
        starts = starts - np.searchsorted(at + 1, starts)
        seq = seq[stays]
    return np.concatenate(rules), np.concatenate(lengths)[first_new:], seq, starts


def write_block(ids, counts, first_new: int) -> bytes:
    """The payload of documents whose ids follow each other, ``counts`` ids each."""
    import numpy as np

    counts = np.asarray(counts, np.int64)
    starts = np.cumsum(counts) - counts
    rules, lengths, seq, starts = compress(ids, starts, first_new)
    width = 2 if first_new + len(rules) <= 1 << 16 else 4
    head = np.array([MARK, VERSION, width, first_new, len(counts), len(rules), len(seq), len(ids)], "<u4")
    tables = [head, starts.astype("<u4"), counts.astype("<u4"), rules.astype("<u4").ravel(), lengths.astype("<u4")]
    return b"".join(x.tobytes() for x in tables) + seq.astype(f"<u{width}").tobytes()


class Block:
    """Reads a payload: whole, one document, or ids ``a`` to ``b`` of a document."""

    def __init__(self, payload: bytes):
        import numpy as np

        mark, version, width, first, docs, rules, symbols, self.n_tokens = (int(x) for x in np.frombuffer(payload, "<u4", 8))
        if (mark, version) != (MARK, VERSION):
            raise ValueError("not a block of token ids")
        at = 32

        def take(n: int, kind: str = "<u4"):
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        self.starts, self.counts = take(docs).astype(np.int64), take(docs).astype(np.int64)
        pairs, self.lengths = take(2 * rules).reshape(-1, 2), take(rules).astype(np.int64)
        self.seq, self.first = take(symbols, f"<u{width}"), first
        # All expansions behind each other; a rule's pair is made of ids and earlier rules.
        self.size = np.concatenate([np.ones(first, np.int64), self.lengths])
        self.place = np.concatenate([np.arange(first), first + np.cumsum(self.lengths) - self.lengths])
        self.flat = np.concatenate([np.arange(first), np.zeros(int(self.lengths.sum()), np.int64)])
        for k, (a, b) in enumerate(pairs.tolist()):
            p, n = self.place[first + k], self.size[a]
            self.flat[p : p + n] = self.flat[self.place[a] : self.place[a] + n]
            self.flat[p + n : p + n + self.size[b]] = self.flat[self.place[b] : self.place[b] + self.size[b]]

    def expand(self, symbols):
        """The ids of some symbols."""
        import numpy as np

        symbols = symbols.astype(np.int64)
        size = self.size[symbols]
        ends = np.cumsum(size)
        return self.flat[np.repeat(self.place[symbols] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]

    def document(self, k: int):
        end = self.starts[k + 1] if k + 1 < len(self.starts) else len(self.seq)
        return self.expand(self.seq[self.starts[k] : end])

    def range(self, k: int, a: int, b: int):
        """Ids a to b (exclusive) of document k: only the symbols that cover them are expanded."""
        import numpy as np

        end = self.starts[k + 1] if k + 1 < len(self.starts) else len(self.seq)
        symbols = self.seq[self.starts[k] : end]
        ends = np.cumsum(self.size[symbols.astype(np.int64)])
        a, b = max(0, a), min(b, int(ends[-1]) if len(ends) else 0)
        if a >= b:
            return np.zeros(0, np.int64)
        i, j = int(np.searchsorted(ends, a, "right")), int(np.searchsorted(ends, b, "left"))
        skip = a - (int(ends[i - 1]) if i else 0)
        return self.expand(symbols[i : j + 1])[skip : skip + b - a]

    def documents(self) -> Iterator:
        """The ids of each document."""
        import numpy as np

        ids, stops = self.expand(self.seq).astype("<u4"), np.cumsum(self.counts).tolist()
        for a, b in zip([0, *stops], stops):
            yield ids[a:b]


FILE_COLUMNS = "part int, block int, n_docs long, n_tokens long, payload binary"


def write_ids(
    docs: DataFrame, path: str, vocabulary_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Encode all texts and write the file in ascending order of the document ids."""
    with open(vocabulary_path, encoding="utf-8") as file:
        held = docs.sparkSession.sparkContext.broadcast(file.read())  # a few megabytes, whatever the input
    rows = texts(docs, id_col, text_col).withColumn("h", F.xxhash64("text")).withColumn("nth", F.monotonically_increasing_id())
    keys = ["doc_id", "h", "nth"]  # the last one parts rows that are equal
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = kept_in_worker("token_file/encoder", held.value, lambda: WordEncoder(held.value, " ", APART, end_id))
        part, block = TaskContext.get().partitionId(), 0
        names, held_ids, counts, size = [], [], [], 0

        def made():
            payload = write_block(np.concatenate(held_ids), counts, max(encoder.n_ids, end_id + 1))
            values = ([part], [block], [len(names)], [size], [payload], [names])
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)

        for batch in batches:
            schema = pa.schema([
                ("part", pa.int32()), ("block", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
                ("payload", pa.binary()), ("doc_ids", pa.list_(batch.schema.field(0).type)),
            ])
            ids_of, at = batch.column(0).to_pylist(), 0
            for n_docs, ids, sizes in encoder.portions(batch.column(1)):
                ends, first = np.cumsum(sizes), 0
                while first < n_docs:
                    # As many documents as the block takes, one at least where it is empty.
                    before = int(ends[first] - sizes[first])
                    stop = int(np.searchsorted(ends, before + block_tokens - size, "right"))
                    stop = max(stop, first if names else first + 1)
                    if stop > first:
                        names += ids_of[at + first : at + stop]
                        held_ids.append(ids[before : int(ends[stop - 1])])
                        counts += sizes[first:stop].tolist()
                        size += int(ends[stop - 1]) - before
                        first = stop
                    if first < n_docs:
                        yield made()
                        names, held_ids, counts, size, block = [], [], [], 0, block + 1
                at += n_docs
        if names:
            yield made()

    schema = T.StructType.fromDDL(FILE_COLUMNS).add("doc_ids", T.ArrayType(kind))
    dealt.mapInArrow(run, schema).write.mode("overwrite").parquet(path)


def block_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, block, base): how many ids lie before each block. Sums within the parts, then over the parts."""
    index = spark.read.parquet(path).select("part", "block", "n_tokens")
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = parts.select("part", (F.sum("total").over(W.orderBy("part")) - F.col("total")).alias("part_base"))
    inside = F.sum("n_tokens").over(W.partitionBy("part").orderBy("block")) - F.col("n_tokens")
    return index.withColumn("inside", inside).join(before, "part").select("part", "block", (F.col("part_base") + F.col("inside")).alias("base"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(part, block, doc_id, place, n_tokens, ids): every document of the file, ``place`` counted within its block."""
    rows = spark.read.parquet(path).select("part", "block", "doc_ids", "payload")
    kind = rows.schema["doc_ids"].dataType.elementType

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            id_type = batch.schema.field(2).type.value_type
            schema = pa.schema([
                ("part", pa.int32()), ("block", pa.int32()), ("doc_id", id_type), ("place", pa.int64()), ("n_tokens", pa.int64()),
                ("ids", pa.binary()),
            ])
            for part, block, names, payload in zip(*(batch.column(k) for k in range(4))):
                block_ids, names, place, held, size = Block(payload.as_py()), names.as_py(), 0, [], 0
                for name, ids in zip(names, block_ids.documents()):
                    held.append((part.as_py(), block.as_py(), name, place, len(ids), ids.tobytes()))
                    place += len(ids)
                    size += ids.nbytes
                    if size >= 16 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)

    schema = T.StructType.fromDDL("part int, block int").add("doc_id", kind)
    schema = schema.add("place", T.LongType()).add("n_tokens", T.LongType()).add("ids", T.BinaryType())
    return rows.mapInArrow(run, schema)


ship_by_value(__name__)

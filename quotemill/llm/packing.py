"""Packs tokenized documents into as few sequences of a fixed capacity as large-item matching and best fit need.

Documents are encoded, each with an end id behind it; only those longer than the capacity are cut, into full pieces and
a rest. A packing depends on the pieces' lengths alone, so it is planned on how many pieces there are of each length,
at most ``capacity`` numbers: pieces above a third of the capacity, of which a sequence holds two at most, are matched
greedily, the longest with the longest that fits beside it; all others, longest first, go each into the smallest gap
that holds them, and open a sequence where none does. Pieces of one length are interchangeable, and so are sequences with
one gap, so a step of the plan places a whole run of them: piece ranks a to b of a length go to sequences from s on, some to
each. Best fit fills a gap with as many pieces as it takes before it looks at another, and what is left of a gap is then
less than half of it; so a range of sequences is split at most twice a length and taken up at most log2(capacity) times, and
the plan has some hundred thousand rows at most, whatever the input. Only counts by length and the plan pass the driver.

The rank of a piece among those of its length is its rank within the task that made it plus the counts of the tasks
before; no group of equal lengths, however large, meets in one task.

Defined cases: a null text is the empty one, its document is the end id alone; repeated rows are packed each; null ids are
ids like others; texts of any length; an empty table gives an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.llm.common import kept_in_worker, texts
from quotemill.llm.words import WordEncoder
from quotemill.session import staged
from quotemill.shipping import ship_by_value

CAPACITY = 4096
APART = "•"  # a sign that the vocabulary gives one id, put between words that are encoded together
RUN = ("length", "first", "last", "sequence", "each", "offset")


def match_large(counts: dict[int, int], capacity: int) -> list[tuple[int, int | None, int]]:
    """(longer length, shorter length or None, sequences) of all pieces above a third of the capacity."""
    left = dict(counts)
    lengths, out = sorted(left), []
    while lengths:
        a = lengths[-1]
        k = bisect.bisect_right(lengths, capacity - a) - 1
        if k >= 0 and lengths[k] == a and left[a] == 1:  # a piece is not its own partner
            k -= 1
        b = lengths[k] if k >= 0 else None
        n = left[a] if b is None else left[a] // 2 if b == a else min(left[a], left[b])
        out.append((a, b, n))
        for length in (a, b):
            if length is not None:
                left[length] -= n
        lengths = [x for x in lengths if left[x]] if not left[a] or b is not None and not left[b] else lengths
    return out


class Plan:
    """The runs of a packing of ``counts`` pieces by length, and the number of sequences."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity, self.sequences, self.runs = capacity, 0, []
        self.rank = dict.fromkeys(counts, 0)
        self.ranges: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, sequences)
        self.gaps: list[int] = []
        large = {length: n for length, n in counts.items() if 3 * length > capacity and n}
        for a, b, n in match_large(large, capacity):
            first, self.sequences = self.sequences, self.sequences + n
            self.place(a, n, first, 1, 0)
            if b is not None:
                self.place(b, n, first, 1, a)
            self.free(first, n, capacity - a - (b or 0))
        for length in sorted((x for x in counts if 3 * x <= capacity), reverse=True):
            self.best_fit(length, counts[length])

    def place(self, length: int, n: int, sequence: int, each: int, offset: int) -> None:
        first = self.rank[length]
        self.rank[length] = first + n
        self.runs.append((length, first, first + n, sequence, each, offset))

    def free(self, first: int, n: int, gap: int) -> None:
        if n and gap:
            if not self.ranges.get(gap):
                self.ranges[gap] = []
                bisect.insort(self.gaps, gap)
            self.ranges[gap].append((first, n))

    def best_fit(self, length: int, n: int) -> None:
        while n:
            k = bisect.bisect_left(self.gaps, length)
            if k == len(self.gaps):
                opened = -(-n // (self.capacity // length))
                self.free(self.sequences, opened, self.capacity)
                self.sequences += opened
                continue
            gap = self.gaps[k]
            first, size = self.ranges[gap].pop()
            if not self.ranges[gap]:
                del self.gaps[k]
            each = min(n, gap // length)
            used = min(size, n // each)
            self.place(length, used * each, first, each, self.capacity - gap)
            self.free(first, used, gap - each * length)
            self.free(first + used, size - used, gap)
            n -= used * each


def lookup(runs: Iterable[tuple]) -> dict:
    """Runs as columns, ordered by length and first rank, with one number to search by."""
    import numpy as np

    table = np.array(sorted(runs), np.int64).reshape(-1, len(RUN))
    return dict(zip(RUN, table.T)) | {"key": table[:, 0] << 48 | table[:, 1]}


def place_of(runs: dict, length, rank) -> tuple:
    """(sequence, offset) of pieces by length and rank."""
    import numpy as np

    k = np.searchsorted(runs["key"], length << 48 | rank, "right") - 1
    nth = rank - runs["first"][k]
    return runs["sequence"][k] + nth // runs["each"][k], runs["offset"][k] + nth % runs["each"][k] * length


def pieces(
    docs: DataFrame, vocabulary_path: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, nth): every piece, the ``nth`` of its length in its part; staged."""
    with open(vocabulary_path, encoding="utf-8") as file:
        held = docs.sparkSession.sparkContext.broadcast(file.read())  # a few megabytes, whatever the input
    rows = texts(docs, id_col, text_col)
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType)])
    for field in T.StructType.fromDDL("piece int, start long, length long, ids_crc32 long, part int, nth long"):
        schema = schema.add(field)

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = kept_in_worker("packing/encoder", held.value, lambda: WordEncoder(held.value, "", APART, end_id))
        seen, part = np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            at = 0
            for n_docs, ids, sizes in encoder.portions(batch.column(1)):
                many = -(-sizes // capacity)
                doc = np.repeat(np.arange(n_docs), many)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                start = piece * capacity
                length = np.minimum(sizes[doc] - start, capacity)
                begin = (np.cumsum(sizes) - sizes)[doc] + start
                packed = memoryview(ids.astype("<u4", copy=False)).cast("B")
                crc = [zlib.crc32(packed[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist())]
                order = np.argsort(length, kind="stable")
                ranked = length[order]
                fresh = np.flatnonzero(np.diff(ranked, prepend=-1))
                nth = np.empty(len(doc), np.int64)
                nth[order] = np.arange(len(doc)) - np.repeat(fresh, np.diff(fresh, append=len(doc))) + seen[ranked]
                seen += np.bincount(length, minlength=capacity + 1)
                columns = [batch.column(0).take(pa.array(at + doc)), piece.astype(np.int32), start, length, np.array(crc, np.int64)]
                columns += [np.full(len(doc), part, np.int32), nth]
                yield pa.RecordBatch.from_arrays([columns[0], *map(pa.array, columns[1:])], names=schema.names)
                at += n_docs

    return staged(rows.mapInArrow(run, schema), "packing-pieces")


def packed(
    docs: DataFrame, vocabulary_path: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    found = pieces(docs, vocabulary_path, end_id, capacity, id_col, text_col)
    sizes = found.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("length").orderBy("part")) - F.col("n")  # one row a part
    sizes = staged(sizes.withColumn("base", before), "packing-sizes")
    counts = {length: n for length, n in sizes.groupBy("length").agg(F.sum("n")).collect()}  # at most one row a length
    runs = docs.sparkSession.sparkContext.broadcast(lookup(Plan(counts, capacity).runs))
    ranked = found.join(sizes.drop("n"), ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank")
    )
    schema = T.StructType([f for f in ranked.schema if f.name != "rank"]).add("sequence_id", T.LongType()).add("offset", T.LongType())

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            place = place_of(runs.value, batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, place)], names=schema.names)

    return ranked.mapInArrow(run, schema)


ship_by_value(__name__)

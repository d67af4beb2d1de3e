"""Ranked lexical search: the documents that score highest for each item of a set of queries.

The documents are indexed once for the terms of the queries: every task cuts its rows into segments of at most
``SEGMENT_DOCS`` documents, numbers them by ascending id, and writes for each term the documents that hold it and how
often. How many documents and terms there are, and in how many documents each term occurs, are sums over the segments.

A segment answers an item by a hybrid of two ways to walk its lists. Short lists, together at most ``SHORT`` of the
segment's documents, are added up term at a time; the sums, sorted by document, are from then on one iterator with a
bound, like a list. It and the long lists are read document at a time, in windows of ``WINDOW`` documents: a window
whose bounds together cannot beat the fiftieth score so far is skipped in all lists; in others the iterators with the
smallest bounds, which alone cannot beat it either, are only asked for the documents the others name, and for no
document that cannot beat it any more. Documents come by ascending id, so one that only equals the fiftieth score
never enters; what the sums promise before any document is seen is taken as one less, since those may come later.

The first ``SEED_PARTS`` parts are searched alone; the scores they reach bound the search in all others. Every
segment names its best documents, and two ranked passes, by slices and then over all, pick the best of an item. Weights,
lengths and scores are integers, so the result does not depend on how the documents are dealt.

Queries are taken in blocks of about ``BLOCK_PAIRS`` pairs of item and term; only one block's terms, statistics and
thresholds are held and sent to the tasks at once.

Defined cases: a null text has no terms; a document or item without terms is in no result; rows with equal item ids,
null included, are one item; every document row is a document, so repeated rows are ranked each; null document ids rank
behind others of the same score; empty tables give an empty result; of both tables only id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import repeat
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.llm.common import lower_ascii, texts
from quotemill.session import staged
from quotemill.shipping import ship_by_value

TOP = 50
SEGMENT_DOCS, SEGMENT_POSTINGS = 1 << 16, 1 << 22
PORTION_BYTES = 8 << 20
WINDOW, SHORT = 512, 1 / 4
SEED_PARTS, SLICES = 16, 64
BLOCK_PAIRS = 1 << 20
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, A-Z in lower case: all of their bytes are digits, letters or above 127."""
    return text.translate(_LETTERS).split()


def length_norm(n, docs: int, terms: int):
    """100 - 50 + 50 * n * docs / terms, rounded down, of an array of document lengths."""
    import numpy as np

    if len(n) and int(n.max()) * 50 * docs >= 1 << 63:  # exact beyond 64 bits as well
        return np.array([50 + 50 * int(x) * docs // terms for x in n], np.int64)
    return 50 + (50 * n * docs) // terms


def weight(docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * holding + 1)))


class Segment:
    """Lists of one segment: for term ``t`` documents ``docs[starts[t]:starts[t+1]]`` and what each adds to a score."""

    def __init__(self, n_docs: int, terms, dfs, docs, impacts):
        import numpy as np

        ends = np.cumsum(dfs)
        self.n_docs, self.docs, self.impacts = n_docs, docs, impacts
        self.range_of = {int(t): (int(b - n), int(b)) for t, n, b in zip(terms, dfs, ends)}
        self.borders = np.arange(0, n_docs + WINDOW, WINDOW)
        self.known: dict[int, tuple] = {}

    def iterator(self, docs, impacts) -> tuple:
        """(documents, what each adds, where each window begins, the most a document of each window gets)."""
        import numpy as np

        cuts = np.searchsorted(docs, self.borders)
        most = np.zeros(len(self.borders) - 1, np.int64)
        filled = cuts[1:] > cuts[:-1]
        if len(docs):
            most[filled] = np.maximum.reduceat(impacts, cuts[:-1][filled])
        return docs, impacts, cuts, most

    def long_list(self, term: int) -> tuple:
        if term not in self.known:
            a, b = self.range_of[term]
            self.known[term] = self.iterator(self.docs[a:b], self.impacts[a:b])
        return self.known[term]

    def summed(self, terms: list[int]) -> tuple:
        """The short lists added up, as one iterator."""
        import numpy as np

        ranges = [self.range_of[t] for t in terms]
        docs = np.concatenate([self.docs[a:b] for a, b in ranges])
        impacts = np.concatenate([self.impacts[a:b] for a, b in ranges])
        order = np.argsort(docs, kind="stable")
        docs, impacts = docs[order], impacts[order]
        first = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
        return self.iterator(docs[first], np.add.reduceat(impacts, first))

    def best(self, terms, top: int, floor: int = 0) -> tuple:
        """(documents, scores) of the ``top`` best ones, best first; those that score below ``floor`` may be missing."""
        import numpy as np

        found = sorted((self.range_of[t][1] - self.range_of[t][0], t) for t in terms if t in self.range_of)
        short, left = [], self.n_docs * SHORT
        while found and found[0][0] <= left:
            left -= found[0][0]
            short.append(found.pop(0)[1])
        lists = [self.long_list(t) for _, t in found]
        theta = max(0, floor - 1)
        if short:
            sums = self.summed(short)
            lists.append(sums)
            if len(sums[1]) >= top:
                theta = max(theta, int(np.partition(sums[1], -top)[-top]) - 1)
        best_docs, best_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not lists:
            return best_docs, best_scores
        bounds = np.stack([most for *_, most in lists])
        for window in np.flatnonzero(bounds.sum(axis=0) > theta).tolist():
            bound = bounds[:, window]
            if int(bound.sum()) <= theta:
                continue
            order = np.argsort(bound, kind="stable")
            reach = np.cumsum(bound[order])
            asked = int(np.searchsorted(reach, theta, "right"))  # so many alone cannot beat it
            base = window * WINDOW
            score = np.zeros(WINDOW, np.int64)
            for k in order[asked:].tolist():
                docs, impacts, cuts, _ = lists[k]
                a, b = cuts[window], cuts[window + 1]
                score[docs[a:b] - base] += impacts[a:b]
            named = np.flatnonzero(score)
            for j in range(asked - 1, -1, -1):
                named = named[score[named] + reach[j] > theta]
                if not len(named):
                    break
                docs, impacts, cuts, _ = lists[order[j]]
                a, b = cuts[window], cuts[window + 1]
                if a == b:
                    continue
                at = np.searchsorted(docs[a:b], named + base)
                at[at == b - a] = 0
                held = docs[a:b][at] == named + base
                score[named[held]] += impacts[a:b][at[held]]
            named = named[score[named] > theta]
            if not len(named):
                continue
            best_docs = np.concatenate([best_docs, named + base])
            best_scores = np.concatenate([best_scores, score[named]])
            if len(best_docs) > top:
                kept = np.lexsort((best_docs, -best_scores))[:top]
                best_docs, best_scores = best_docs[kept], best_scores[kept]
            if len(best_docs) == top:
                theta = max(theta, int(best_scores.min()))
        order = np.lexsort((best_docs, -best_scores))
        return best_docs[order], best_scores[order]


def write_index(docs: DataFrame, vocabulary) -> DataFrame:
    """Segments of all documents for the terms of ``vocabulary`` (a broadcast dictionary of their numbers), one row each, staged."""
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    id_field = T.StructField("doc_ids", T.ArrayType(rows.schema["doc_id"].dataType))
    schema = T.StructType.fromDDL(
        "part int, n_docs long, n_terms long, terms array<int>, dfs array<int>, lengths binary, docs binary, tfs binary"
    ).add(id_field)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        number = vocabulary.value
        part, size = TaskContext.get().partitionId(), len(number)
        ids, lengths, keys, counts, n_docs, n_keys = [], [], [], [], 0, 0

        def portion(batch) -> Iterator[tuple]:
            """(ids, lengths, keys of (document, term), occurrences) of some of a batch's documents that have terms."""
            held, at, used = [], [], 0
            for k, text in enumerate(batch.column(1)):
                found = terms_of(text.as_buffer().to_pybytes()) if text.is_valid else []
                if found:
                    numbers = np.fromiter(map(number.get, found, repeat(-1)), np.int64, len(found))
                    held.append(numbers)
                    at.append(k)
                    used += 8 * len(numbers)
                if at and (used >= PORTION_BYTES or k + 1 == batch.num_rows):
                    n = np.array([len(x) for x in held], np.int64)
                    key = np.repeat(np.arange(len(n)) * size, n) + (flat := np.concatenate(held))
                    yield batch.column(0).take(pa.array(at)), n, *np.unique(key[flat >= 0], return_counts=True)
                    held, at, used = [], [], 0
            if at:
                n = np.array([len(x) for x in held], np.int64)
                key = np.repeat(np.arange(len(n)) * size, n) + (flat := np.concatenate(held))
                yield batch.column(0).take(pa.array(at)), n, *np.unique(key[flat >= 0], return_counts=True)

        def made():
            all_ids, n = pa.concat_arrays(ids), np.concatenate(lengths)
            order = pc.sort_indices(all_ids, null_placement="at_end").to_numpy()
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            key, tf = np.concatenate(keys), np.concatenate(counts)
            term, doc = key % size if size else key, place[key // size] if size else key
            by_term = np.lexsort((doc, term))
            used, df = np.unique(term, return_counts=True)
            values = [
                pa.array([part], pa.int32()), pa.array([len(n)]), pa.array([int(n.sum())]),
                pa.array([used.astype(np.int32)], pa.list_(pa.int32())), pa.array([df.astype(np.int32)], pa.list_(pa.int32())),
                pa.array([n[order].astype("<i8").tobytes()]), pa.array([doc[by_term].astype("<u4").tobytes()]),
                pa.array([tf[by_term].astype("<u4").tobytes()]),
                pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), all_ids.take(pa.array(order))),
            ]
            return pa.RecordBatch.from_arrays(values, names=schema.names)

        for batch in batches:
            for some, n, key, count in portion(batch):
                if n_docs and (n_docs + len(n) > SEGMENT_DOCS or n_keys + len(key) > SEGMENT_POSTINGS):
                    yield made()
                    ids, lengths, keys, counts, n_docs, n_keys = [], [], [], [], 0, 0
                ids.append(some)
                lengths.append(n)
                keys.append(key + n_docs * size)
                counts.append(count)
                n_docs, n_keys = n_docs + len(n), n_keys + len(key)
        if n_docs:
            yield made()

    return staged(rows.mapInArrow(run, schema), "lexical-index")


def search_index(index: DataFrame, queries, n_docs: int, n_terms: int, top: int = TOP) -> DataFrame:
    """(part, item_id, doc_id, score): the best documents of every segment for every item of the broadcast ``queries``.

    ``queries`` holds item ids, where each item's terms end, the terms, their weights, and each item's floor.
    """
    id_type = index.schema["doc_ids"].dataType.elementType
    schema = T.StructType.fromDDL("part int").add("item_id", queries.value["type"]).add("doc_id", id_type).add("score", T.LongType())

    def run(batches):
        import numpy as np
        import pyarrow as pa

        asked = queries.value
        weights, ends = asked["weights"], asked["ends"].tolist()
        wanted = [asked["terms"][a:b].tolist() for a, b in zip([0, *ends], ends)]
        for batch in batches:
            for row in range(batch.num_rows):
                cell = {name: batch.column(name)[row] for name in batch.schema.names}
                terms, dfs = cell["terms"].values.to_numpy(), cell["dfs"].values.to_numpy()
                docs, tf = (np.frombuffer(cell[c].as_buffer(), "<u4").astype(np.int64) for c in ("docs", "tfs"))
                norm = length_norm(np.frombuffer(cell["lengths"].as_buffer(), "<i8"), n_docs, n_terms)
                impacts = np.repeat(weights[terms], dfs) * ((1_000_000_000 * tf) // (1000 * tf + 20 * norm[docs]))
                segment = Segment(len(norm), terms, dfs, docs, impacts)
                found = [segment.best(t, top, f) for t, f in zip(wanted, asked["floors"].tolist())]
                items = np.repeat(np.arange(len(found)), [len(d) for d, _ in found])
                at = np.concatenate([d for d, _ in found]) if found else items
                scores = np.concatenate([s for _, s in found]) if found else items
                columns = [
                    pa.array(np.full(len(items), cell["part"].as_py()), pa.int32()), asked["ids"].take(pa.array(items)),
                    cell["doc_ids"].values.take(pa.array(at)), pa.array(scores),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return index.mapInArrow(run, schema)


def ranked(found: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the best of all segments, slices of the parts first, then all together."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    slices = found.withColumn("slice", F.pmod("part", F.lit(SLICES)))
    some = slices.withColumn("rank", F.row_number().over(W.partitionBy("item_id", "slice").orderBy(*order))).where(F.col("rank") <= top)
    last = some.withColumn("rank", F.row_number().over(W.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= top)
    return last.select("item_id", "rank", "doc_id", "score")


def _block(pairs: DataFrame) -> tuple[Any, Any, list[bytes]]:
    """(item ids, each pair's item, each pair's term, words) of one block, sorted by item."""
    import numpy as np
    import pyarrow as pa

    held = pairs.toArrow().combine_chunks()
    ids = pa.concat_arrays(held["item_id"].chunks or [pa.array([], held.schema.field("item_id").type)]).dictionary_encode("encode")
    words = pa.concat_arrays(held["term"].chunks or [pa.array([], pa.binary())]).dictionary_encode()
    item, term = ids.indices.to_numpy(), words.indices.to_numpy()
    order = np.lexsort((term, item))
    ends = np.cumsum(np.bincount(item, minlength=len(ids.dictionary)))
    return (ids.dictionary, ends), term[order], words.dictionary.to_pylist()


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", block_pairs: int = BLOCK_PAIRS,
) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``top`` documents that score highest, and above 0, for each item."""
    import numpy as np

    spark = docs.sparkSession
    read = texts(docs, id_col, text_col)
    terms = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(TERM), F.lit(0))
    asked = texts(items, item_col, item_text_col).select(F.col("doc_id").alias("item_id"), F.explode(F.array_distinct(terms)).alias("term"))
    asked = staged(asked.distinct().withColumn("term", F.col("term").cast("binary")), "lexical-queries")
    kind = asked.schema["item_id"].dataType
    blocks = max(1, math.ceil(asked.count() / block_pairs))
    results = []
    for block in range(blocks):
        (ids, ends), term, words = _block(asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block))
        index = write_index(read, spark.sparkContext.broadcast({w: k for k, w in enumerate(words)}))
        n_docs, n_terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        pairs = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x")).groupBy("x.terms").agg(F.sum("x.dfs").alias("df"))
        weights = np.zeros(len(words), np.int64)
        for number, df in pairs.collect():  # one row a term of this block
            weights[number] = weight(n_docs, df)
        floors = np.zeros(len(ends), np.int64)
        query = {"ids": ids, "type": kind, "ends": ends, "terms": term, "weights": weights, "floors": floors}
        seeds = staged(
            search_index(index.where(F.col("part") < SEED_PARTS), spark.sparkContext.broadcast(query), n_docs, n_terms, top), "lexical-seeds"
        )
        reached = ranked(seeds, top).where(F.col("rank") == top).select("item_id", "score").collect()  # one row an item
        at = {i: k for k, i in enumerate(ids.to_pylist())}
        for item, score in reached:
            floors[at[item]] = score
        rest = search_index(index.where(F.col("part") >= SEED_PARTS), spark.sparkContext.broadcast(query), n_docs, n_terms, top)
        results.append(seeds.unionByName(rest))
    return ranked(reduce(DataFrame.unionByName, results), top)


ship_by_value(__name__)

"""Approximate nearest neighbours by an adaptive dimension scan within probed lists.

A bounded sample (``SAMPLE`` rows with the smallest hashes of their ids) fits the lists' centres; every row is put into
the list of its nearest centre. Vectors are brought to length one and turned by a random rotation, so that every run of
columns says about as much of a distance as any other. A query is scanned against its ``PROBED`` share of the lists,
columns in blocks: after each block a test estimates the distance from the part seen so far, and drops the candidate
where it is larger than the query's fifth best at the chosen confidence. What is left is scored exactly, by the cosine
of the original vectors in double precision.

Lists are cut into chunks of at most about ``CHUNK_ROWS`` rows and queries into groups of about ``QUERY_ROWS``, by
counts; a list that holds a third of all rows is that many more chunks. A task sees one chunk and one group of queries.

Defined cases: vectors that are null, zero, or hold null or non-finite components, and rows with a null id, take no
part; nor do vectors whose length is not the most frequent one (of equally frequent ones the smallest); rows with the
query's id are its own; equal rows count once; ties go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.llm.common import smallest_hashes
from quotemill.session import staged
from quotemill.shipping import ship_by_value

SAMPLE = 20_000
LISTS, PROBED = 32, 0.85
BLOCK, CONFIDENCE = 16, 2.1
CHUNK_ROWS, QUERY_ROWS = 32_768, 8_192
FIRST_ROWS, SCAN_ROWS, SCAN_QUERIES = 128, 2_048, 1_024
SEED = 42


def usable(vector: Column) -> Column:
    """Whether a vector has a direction."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def fit(sample, lists: int = LISTS, rounds: int = 12, seed: int = SEED):
    """(rotation, centres) of a sample of vectors; centres are of turned unit vectors."""
    import numpy as np

    rng = np.random.default_rng(seed)
    turn, _ = np.linalg.qr(rng.standard_normal((sample.shape[1], sample.shape[1])))
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True) @ turn
    centres = unit[rng.permutation(len(unit))[:lists]].copy()
    for _ in range(rounds):
        mine = np.argmax(unit @ centres.T, axis=1)
        sums, counts = np.zeros_like(centres), np.bincount(mine, minlength=len(centres))
        np.add.at(sums, mine, unit)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where((counts[:, None] > 0) & (norms > 0), sums / np.where(norms > 0, norms, 1), centres)
    return turn, centres


def _matrix(column):
    """A list column of vectors of equal length as a matrix of doubles."""
    import numpy as np

    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


class Best:
    """The k best rows so far of each query of a group."""

    def __init__(self, queries: int, k: int):
        import numpy as np

        self.k, self.limit = k, np.full(queries, np.inf)
        self.query, self.row, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def add(self, query, row, score) -> None:
        import numpy as np

        query, row, score = (np.concatenate(x) for x in ((self.query, query), (self.row, row), (self.score, score)))
        order = np.lexsort((row, -score, query))
        query, row, score = query[order], row[order], score[order]
        if not len(query):
            return
        fresh = np.concatenate([[True], (np.diff(query) != 0) | (np.diff(row) != 0)])  # equal rows count once
        query, row, score = query[fresh], row[fresh], score[fresh]
        first = np.concatenate([[True], np.diff(query) != 0])
        place = np.arange(len(query)) - np.maximum.accumulate(np.where(first, np.arange(len(query)), 0))
        last = place == self.k - 1
        self.limit[query[last]] = 2 - 2 * score[last]  # the squared distance of unit vectors
        kept = place < self.k
        self.query, self.row, self.score = query[kept], row[kept], score[kept]


def scan(query_ids, queries, ids, vectors, turn, k: int, block: int = BLOCK, confidence: float = CONFIDENCE):
    """(query number, row id, cosine) of up to k best rows for each query, candidates dropped from partial distances."""
    import numpy as np

    q_norm, v_norm = np.linalg.norm(queries, axis=1), np.linalg.norm(vectors, axis=1)
    q_turned, v_turned = queries / q_norm[:, None] @ turn, vectors / v_norm[:, None] @ turn
    width, best = queries.shape[1], Best(len(queries), k)
    bounds = [0, *range(FIRST_ROWS, len(vectors), SCAN_ROWS), len(vectors)]
    for a, b in zip(bounds, bounds[1:]):
        v_part = v_turned[a:b, :block]
        v_square = (v_part**2).sum(axis=1)
        found = []
        for c in range(0, len(queries), SCAN_QUERIES):
            q_part = q_turned[c : c + SCAN_QUERIES, :block]
            part = np.maximum((q_part**2).sum(axis=1)[:, None] + v_square - 2 * q_part @ v_part.T, 0)
            limit = best.limit[c : c + SCAN_QUERIES]
            seen = min(block, width)
            slack = (1 + confidence / np.sqrt(seen)) ** 2 * seen / width
            alive = (part <= (limit * slack + 1e-9)[:, None]) & (query_ids[c : c + SCAN_QUERIES, None] != ids[a:b])
            qi, vi = np.nonzero(alive)
            part, qi, vi = part[qi, vi], qi + c, vi + a
            while seen < width:
                upto = min(seen + block, width)
                part = part + ((q_turned[qi, seen:upto] - v_turned[vi, seen:upto]) ** 2).sum(axis=1)
                seen = upto
                slack = (1 + confidence / np.sqrt(seen)) ** 2 * seen / width if seen < width else 1 + 1e-9
                stays = part <= best.limit[qi] * slack + 1e-9
                part, qi, vi = part[stays], qi[stays], vi[stays]
            score = np.einsum("ij,ij->i", queries[qi], vectors[vi]) / (q_norm[qi] * v_norm[vi])
            found.append((qi, ids[vi], score))
        best.add(*(np.concatenate(x) for x in zip(*found)))
    return best.query, best.row, best.score


def nearest(
    rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", lists: int = LISTS,
    probed: float = PROBED, sample: int = SAMPLE, chunk_rows: int = CHUNK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row that ``is_query`` (on ``id_col``) picks."""
    import numpy as np

    spark = rows.sparkSession
    plain = rows.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("is_query")
    )
    out = T.StructType.fromDDL("query_id bigint, vec_id bigint, score double")
    lengths = plain.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if lengths is None:
        return spark.createDataFrame([], out).select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    plain = plain.where(F.size("vector") == lengths["n"])
    drawn = smallest_hashes(plain.select("vector", F.xxhash64("vec_id").alias("h"), "vec_id"), "h", sample, "vec_id")
    turn, centres = fit(np.array([r["vector"] for r in drawn.collect()], np.float64), lists)  # at most ``sample`` rows
    n_lists = len(centres)
    n_probed = max(1, int(np.ceil(probed * n_lists)))

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column(1))
            near = np.argsort(-(vectors / np.linalg.norm(vectors, axis=1, keepdims=True) @ turn @ centres.T), axis=1, kind="stable")
            asked = batch.column(2).to_numpy(zero_copy_only=False)
            probes = [x[:n_probed].tolist() if q else None for x, q in zip(near, asked)]
            columns = [batch.column(0), batch.column(1), pa.array(near[:, 0], pa.int32()), pa.array(probes, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "vector", "list", "probes"])

    kind = plain.schema["vector"].dataType
    schema = T.StructType().add("vec_id", T.LongType()).add("vector", kind).add("list", T.IntegerType()).add("probes", T.ArrayType(T.IntegerType()))
    placed = staged(plain.mapInArrow(place, schema), "ann-lists")

    sizes = {r["list"]: r["count"] for r in placed.groupBy("list").count().collect()}  # ``lists`` rows
    asked = placed.where("probes IS NOT NULL")
    groups = max(1, -(-asked.count() // query_rows))
    chunks = F.create_map(*[F.lit(x) for n, size in sizes.items() for x in (n, -(-size // chunk_rows))])
    members = placed.select(
        "vec_id", "vector", "list", F.pmod(F.xxhash64("vec_id"), chunks[F.col("list")]).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
    )
    probing = asked.dropDuplicates(["vec_id"]).select(
        "vec_id", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("group"), F.explode("probes").alias("list")
    )
    probing = probing.where(F.array_contains(F.map_keys(chunks), F.col("list")))
    probing = probing.withColumn("chunk", F.explode(F.sequence(F.lit(0), (chunks[F.col("list")] - 1).cast("int"))))

    def search(left, right):
        import pyarrow as pa

        if not left.num_rows or not right.num_rows:
            return pa.Table.from_arrays([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64())], names=["query_id", "vec_id", "score"])
        query_ids = right.column("vec_id").to_numpy()
        query, row, score = scan(
            query_ids, _matrix(right.column("vector")), left.column("vec_id").to_numpy(), _matrix(left.column("vector")), turn, k
        )
        return pa.table({"query_id": query_ids[query], "vec_id": row, "score": score})

    keys = ["list", "chunk", "group"]
    found = members.groupBy(*keys).cogroup(probing.groupBy(*keys)).applyInArrow(search, out)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ship_by_value(__name__)

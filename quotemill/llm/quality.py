"""Quality classifier: random-indexing word vectors, pooled per document, and a small calibrated network.

Every word falls into one of ``BUCKETS`` buckets by its hash, and every bucket has a fixed random vector with few
entries of 1 and -1. A bucket's word vector is the sum of the random vectors of the words around its words, over the
whole corpus: tasks add up a table of bounded size (``BUCKETS`` x ``DIMS`` numbers), and the tables are summed by a
grouped aggregate. A document's features are the weighted mean and spread of its words' vectors, frequent words
weighing less, how many distinct buckets its words fall into, and how often a word follows itself.

A network with one hidden layer is trained with numpy on the driver, on at most ``SAMPLE`` labelled rows (those with the
smallest hashes of their ids) of which a fifth sets the temperature that calibrates the probabilities. Scores are then
computed in tasks from the features. Only labelled rows that ``learn`` admits are learned from.

Defined cases: a null or blank text has features of zero and the score the network gives those; ids whose labels
contradict each other, and null labels, teach nothing; without a usable label every score is 0.5; repeated rows are
scored each; an empty table gives an empty result; of other columns only those of ``labels`` named here are read.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.llm.common import kept_in_worker, smallest_hashes, texts
from quotemill.session import staged
from quotemill.shipping import ship_by_value

BUCKETS, DIMS, ENTRIES, REACH = 1 << 13, 32, 4, 2
N_FEATURES, PRIOR = 2 * DIMS + 3, 8
SAMPLE = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 60, 128, 3e-3, 1e-4
SEED = 42
REMEMBERED = 400_000
WORD = re.compile(r"\w+|[^\w\s]+")


class Buckets(dict):
    """word -> bucket, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = bucket = zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS
        return bucket


def word_ids(text: str, buckets: Buckets):
    import numpy as np

    return np.fromiter(map(buckets.__getitem__, WORD.findall(text)), np.int64)


def random_vectors(seed: int = SEED):
    """(places, signs): where each bucket's random vector has entries, and which."""
    import numpy as np

    rng = np.random.default_rng(seed)
    places = np.argsort(rng.random((BUCKETS, DIMS)), axis=1)[:, :ENTRIES]
    return places, rng.choice([-1.0, 1.0], (BUCKETS, ENTRIES))


def add_contexts(table, ids, places, signs) -> None:
    """Add to ``table`` (bucket x dimension, flat) the random vectors around each word; -1 parts documents."""
    import numpy as np

    for distance in range(1, REACH + 1):
        left, right = ids[:-distance], ids[distance:]
        # A document's end lies between two words if any id from one to the other is -1.
        near = (left >= 0) & (right >= 0)
        for between in range(1, distance):
            near &= ids[between : len(ids) - distance + between] >= 0
        left, right = left[near], right[near]
        for word, other in ((left, right), (right, left)):
            for entry in range(ENTRIES):
                table += np.bincount(word * DIMS + places[other, entry], signs[other, entry], len(table))


def word_vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """(vectors, weights) of all buckets from all texts: at most ``BUCKETS`` rows reach the driver."""
    import numpy as np

    rows = texts(docs, id_col, text_col).select("text")

    def run(batches):
        import pyarrow as pa

        buckets = kept_in_worker("quality/buckets", BUCKETS, Buckets)
        (places, signs), table, count = random_vectors(), np.zeros(BUCKETS * DIMS), np.zeros(BUCKETS, np.int64)
        gap = np.array([-1])
        for batch in batches:
            held, size = [], 0
            for k, text in enumerate(batch.column(0)):
                ids = word_ids(text.as_py(), buckets)
                held += [ids, gap]
                size += len(ids)
                if size > 1 << 19 or k + 1 == batch.num_rows:
                    joined = np.concatenate(held)
                    add_contexts(table, joined, places, signs)
                    held, size = [], 0
                    count += np.bincount(joined[joined >= 0], minlength=BUCKETS)
        used = np.flatnonzero(count)
        sums = table.reshape(BUCKETS, DIMS)[used]
        columns = [pa.array(used, pa.int32()), pa.array(count[used])] + [pa.array(sums[:, d].astype(np.int64)) for d in range(DIMS)]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "n", *[f"v{d}" for d in range(DIMS)]])

    names = ["n", *[f"v{d}" for d in range(DIMS)]]
    partial = rows.mapInArrow(run, "bucket int, " + ", ".join(f"{c} bigint" for c in names))
    found = partial.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names]).collect()
    vectors, count = np.zeros((BUCKETS, DIMS), np.float32), np.zeros(BUCKETS)
    for row in found:
        count[row["bucket"]] = row["n"]
        vectors[row["bucket"]] = np.array(row[2:]) / row["n"]
    share = count / max(1.0, count.sum())
    middle = share @ vectors
    vectors = vectors - middle.astype(np.float32)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.where(norm > 0, norm, 1)).astype(np.float32), (1e-3 / (1e-3 + share)).astype(np.float32)


def features(ids, vectors, weights):
    """Mean, spread and variety of a document's words, and how often a word follows itself.

    ``PRIOR`` words of average make stand in front of every document, so that a few words do not say too much.
    """
    import numpy as np

    if not len(ids):
        return np.zeros(N_FEATURES, np.float32)
    weight = weights[ids]
    total = float(weight.sum()) + PRIOR / 2
    mean, square = np.zeros(DIMS), np.full(DIMS, PRIOR / 2 / DIMS)
    for a in range(0, len(ids), 1 << 16):
        some, w = vectors[ids[a : a + (1 << 16)]], weight[a : a + (1 << 16)]
        mean += w @ some
        square += w @ (some * some)
    mean, square = mean / total, square / total
    distinct = (np.count_nonzero(np.bincount(ids, minlength=1)) + PRIOR) / (min(len(ids), BUCKETS) + PRIOR)
    again = np.count_nonzero(ids[1:] == ids[:-1]) / (len(ids) + PRIOR)
    spread = np.sqrt(np.maximum(square - mean**2, 0))
    return np.concatenate([mean, spread, [distinct, again, np.log1p(len(ids)) / 10]]).astype(np.float32)


def document_features(docs: DataFrame, vectors, weights, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, rev, features): ``rev`` tells texts of one id apart."""
    rows = texts(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("rev"), "text")
    held = docs.sparkSession.sparkContext.broadcast((vectors, weights))  # of BUCKETS rows, whatever the input

    def run(batches):
        import numpy as np
        import pyarrow as pa

        buckets = kept_in_worker("quality/buckets", BUCKETS, Buckets)
        for batch in batches:
            found = [features(word_ids(text.as_py(), buckets), *held.value) for text in batch.column(2)]
            flat = pa.array(np.concatenate(found) if found else np.zeros(0, np.float32))
            offsets = pa.array(np.arange(len(found) + 1) * N_FEATURES, pa.int32())
            columns = [batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, flat)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "rev", "features"])

    schema = T.StructType([rows.schema["doc_id"], T.StructField("rev", T.LongType()), T.StructField("features", T.ArrayType(T.FloatType()))])
    return rows.mapInArrow(run, schema)


@dataclass
class Network:
    """Two layers, on standardised features, and a temperature."""

    shift: Any
    scale: Any
    hidden: Any
    hidden_bias: Any
    out: Any
    out_bias: float
    temperature: float = 1.0

    def logits(self, x):
        import numpy as np

        return np.maximum((x - self.shift) / self.scale @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias

    def score(self, x):
        import numpy as np

        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def train(x, y, seed: int = SEED) -> Network:
    """Adam on the logistic loss; every fifth row is left out and sets the temperature."""
    import numpy as np

    rng = np.random.default_rng(seed)
    x, y = x.astype(np.float64), y.astype(np.float64)
    aside = np.arange(len(x)) % 5 == 4
    tx, ty = x[~aside], y[~aside]
    scale = tx.std(axis=0)
    net = Network(
        tx.mean(axis=0), np.where(scale > 1e-9, scale, 1.0), rng.standard_normal((x.shape[1], HIDDEN)) * np.sqrt(2 / x.shape[1]),
        np.zeros(HIDDEN), rng.standard_normal(HIDDEN) * np.sqrt(1 / HIDDEN), float(np.log((ty.sum() + 1) / (len(ty) - ty.sum() + 1))),
    )
    values = [net.hidden, net.hidden_bias, net.out, np.array([net.out_bias])]
    first, second, turn = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    z = (tx - net.shift) / net.scale
    for epoch in range(EPOCHS):
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
        order = rng.permutation(len(z))
        for a in range(0, len(z), BATCH):
            some = order[a : a + BATCH]
            inner = z[some] @ values[0] + values[1]
            active = np.maximum(inner, 0)
            error = (1 / (1 + np.exp(-np.clip(active @ values[2] + values[3], -60, 60))) - ty[some]) / len(some)
            back = np.outer(error, values[2]) * (inner > 0)
            slopes = [z[some].T @ back + DECAY * values[0], back.sum(axis=0), active.T @ error + DECAY * values[2], np.array([error.sum()])]
            turn += 1
            for k, slope in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope**2
                values[k] -= rate * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.999**turn)) + 1e-8)
    net.hidden, net.hidden_bias, net.out, net.out_bias = values[0], values[1], values[2], float(values[3][0])
    if aside.any():
        logit, truth = net.logits(x[aside]), y[aside]
        options = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        loss = [np.mean(np.logaddexp(0, logit / t) - truth * logit / t) for t in options]
        net.temperature = float(options[int(np.argmin(loss))])
    return net


def learned_ids(labels: DataFrame, learn: Column, label_id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(label_id, label): ids that ``learn`` admits, with a label that nothing contradicts."""
    rows = labels.where(learn).select(F.col(label_id_col).alias("label_id"), F.col(label_col).alias("label")).where("label_id IS NOT NULL")
    agreed = rows.groupBy("label_id").agg(F.min("label").alias("label"), F.max("label").alias("top"))
    return agreed.where("label = top AND label IN (0, 1)").drop("top")


def trained(
    rows: DataFrame, labels: DataFrame, learn: Column, label_id_col: str = "doc_id", label_col: str = "quality",
    sample: int = SAMPLE,
) -> Network | None:
    """The network learned from rows (doc_id, rev, features); None without a usable label."""
    import numpy as np

    taught = rows.join(learned_ids(labels, learn, label_id_col, label_col), F.col("doc_id") == F.col("label_id"))
    drawn = taught.select("features", "label", F.xxhash64("doc_id", "rev").alias("h"), "doc_id")
    known = smallest_hashes(drawn, "h", sample, "doc_id").collect()  # at most ``sample`` rows
    return train(np.array([r["features"] for r in known]), np.array([r["label"] for r in known])) if known else None


def scored(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
    label_col: str = "quality", sample: int = SAMPLE,
) -> DataFrame:
    """(doc_id, rev, score) of every row of ``docs``; ``learn`` is a condition on columns of ``labels``."""
    vectors, weights = word_vectors(docs, id_col, text_col)
    rows = staged(document_features(docs, vectors, weights, id_col, text_col), "quality-features")
    net = trained(rows, labels, learn, label_id_col, label_col, sample)
    if net is None:
        return rows.select("doc_id", "rev", F.lit(0.5).alias("score"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(np.float64)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(net.score(x))], names=["doc_id", "rev", "score"])

    schema = T.StructType([rows.schema["doc_id"], T.StructField("rev", T.LongType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema)


def drop_rejected(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5, **options
) -> DataFrame:
    """The rows and columns of ``docs`` whose score is ``least`` or more. Rows are filtered where they are read."""
    vectors, weights = word_vectors(docs, id_col, text_col)
    rows = staged(document_features(docs, vectors, weights, id_col, text_col), "quality-features")
    net = trained(rows, labels, learn, **options)
    if net is None:
        return docs
    held = docs.sparkSession.sparkContext.broadcast((vectors, weights))
    at = docs.columns.index(text_col)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        buckets = kept_in_worker("quality/buckets", BUCKETS, Buckets)
        for batch in batches:
            if batch.num_rows:
                found = np.stack([features(word_ids(text.as_py() or "", buckets), *held.value) for text in batch.column(at)])
                yield batch.filter(pa.array(net.score(found.astype(np.float64)) >= least))

    return docs.mapInArrow(run, docs.schema)


ship_by_value(__name__)

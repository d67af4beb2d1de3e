"""Streams of landed batches into keyed tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quotemill.operators.latest import latest_with_smallest
from quotemill.operators.merge import KeyedTable
from quotemill.session import written_once


def upsert_stream(
    stream: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    order: Sequence[str] = (),
    normalise: Callable[[DataFrame], DataFrame] | None = None,
    mode: str = "append",
    rejects: str | None = None,
) -> StreamingQuery:
    """Each micro-batch is normalised and upserted. A batch that is replayed after a failure writes the
    same cells again, so the table ends the same. The batch is written out once first: the upsert
    reads it twice, and a stateful batch must not be computed twice. With a folder for ``rejects`` rows
    without a whole key go there, by batch, instead of stopping the stream."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = written_once(normalise(batch) if normalise else batch, table.side("delta"))
        if rejects:
            whole = reduce(and_, [F.col(key).isNotNull() for key in [*table.keys, *table.partition_by]])
            rows.where(~whole).write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
            rows = rows.where(whole)
        table.upsert(rows, order)

    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def latest_stream(documents: DataFrame, title: str = "title", newest: str = "fetched_at", smallest: str = "url") -> DataFrame:
    """The newest document per title, kept up to date; the state is one row per title."""
    return latest_with_smallest(documents, [title], newest, smallest)

"""Repeat suppression on a stream, in event-time order.

The rule is that of :mod:`quotemill.streaming.suppress`. Rows wait in keyed state until the watermark has passed them,
so files may come in any order within the delay; what is known of a key after that is one number, until when it is
blocked, and goes when the watermark passes it. Rows that come behind the watermark are not lost: they come out marked
as late, and are written to a folder of their own.

A key's rows of one micro-batch are one task's work, as with every keyed state; where one key holds a large part of all
rows, use the batch form, which cuts keys into slices. The state store is the RocksDB one (``use_rocksdb``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from quotemill.session import written_once
from quotemill.shipping import ship_by_value

# All digits of an instant.
CLOCK = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state of arbitrary shape needs this state store; the setting counts for queries started afterwards."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class Suppressor(StatefulProcessor):
    """Rows (key, _at, ties, _body): the accepted ones and, marked, those behind the watermark."""

    def __init__(self, key: str, waiting: T.StructType, ttl: int):
        self.key, self.waiting_type, self.ttl = key, waiting, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.waiting_type)
        self.until = handle.getValueState("until", "until bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0] is None or pd.isna(key[0]):
            return
        mark = max(0, timerValues.getCurrentWatermarkInMs()) * 1000
        waiting, late = [], []
        for batch in rows:
            for row in zip(*(batch.iloc[:, k].tolist() for k in range(1, batch.shape[1]))):  # the key is the first column
                (late if row[0] < mark else waiting).append(row)
        if late:
            yield self.out(key, late, True)
        yield from self.decide(key, waiting, mark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self.decide(key, [], timerValues.getCurrentWatermarkInMs() * 1000)

    def decide(self, key, new: list[tuple], mark: int) -> Iterator[pd.DataFrame]:
        """Rows the watermark has passed are accepted or not; the others wait on, and a timer with them."""
        held = list(self.waiting.get()) if self.waiting.exists() else []
        until = self.until.get()[0] if self.until.exists() else None
        rest, accepted = [], []
        for row in sorted([*map(tuple, held), *new], key=lambda r: r[:-1]):
            if row[0] >= mark:
                rest.append(row)
            elif until is None or row[0] >= until:
                accepted.append(row)
                until = row[0] + self.ttl
        if rest:
            self.waiting.put(rest)
        elif held:
            self.waiting.clear()
        if until is not None and (rest or until > mark):
            self.until.update((until,))
        elif until is not None:
            self.until.clear()  # nothing that still comes is blocked
        if rest or until is not None and until > mark:
            self.handle.registerTimer(((rest[0][0] if rest else until) + 999) // 1000 + 1)
        if accepted:
            yield self.out(key, accepted, False)

    def out(self, key, rows: list[tuple], late: bool) -> pd.DataFrame:
        return pd.DataFrame({self.key: [key[0]] * len(rows), "_body": [r[-1] for r in rows], "_late": late})

    def close(self) -> None:
        pass


def marked_repeats(stream: DataFrame, key: str, time: str, tie: Sequence[str], ttl_seconds: int, delay: str) -> DataFrame:
    """(key, _body, _late): accepted rows and late ones of a stream, whole rows as JSON. ``tie`` holds numbers or texts without nulls."""
    watermarked = stream.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", delay)
    ties = [f"_tie{k}" for k in range(len(tie))]
    # The time goes on as a number: the state then sees late rows too, instead of losing them.
    rows = watermarked.select(
        key, F.unix_micros("_time").alias("_at"), *[F.col(c).alias(t) for c, t in zip(tie, ties)],
        F.to_json(F.struct(*stream.columns), CLOCK).alias("_body"),
    )
    waiting = T.StructType([rows.schema[name] for name in ("_at", *ties, "_body")])
    out = T.StructType([rows.schema[key]]).add("_body", T.StringType()).add("_late", T.BooleanType())
    return rows.groupBy(key).transformWithStateInPandas(Suppressor(key, waiting, ttl_seconds * 1_000_000), out, "append", "EventTime")


def suppress_stream(
    stream: DataFrame, sink: str, rejects: str, checkpoint: str, key: str, time: str, tie: Sequence[str], ttl_seconds: int, delay: str
) -> StreamingQuery:
    """Accepted rows go to ``sink``, late ones to ``rejects``, a folder for each micro-batch; a replayed batch writes the same again."""
    schema = stream.schema
    parsed = marked_repeats(stream, key, time, tie, ttl_seconds, delay).select("_late", F.from_json("_body", schema, CLOCK).alias("_row"))

    def write(batch: DataFrame, number: int) -> None:
        rows = written_once(batch, f"{checkpoint}-batches/{number}")
        for path, flag in ((sink, ~F.col("_late")), (rejects, F.col("_late"))):
            written_once(rows.where(flag).select("_row.*"), f"{path}/batch={number}")

    return parsed.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


ship_by_value(__name__)

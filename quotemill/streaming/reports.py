"""What a stream read and what it dropped, batch by batch."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

REPORT = "batch bigint, rows_in bigint, rows_late bigint, watermark string, observed string"


class BatchReports(StreamingQueryListener):
    """Collects one report a batch of the queries it is told to follow; the driver holds a few numbers a batch.

    ``rows_late`` are the rows behind the watermark that stateful operators dropped. Spark counts them as they reach the
    operator: before a deduplication that is every row, before an aggregate the partial groups.
    """

    def __init__(self):
        self.rows: dict[str, dict[int, tuple]] = {}
        self.ended: dict[str, threading.Event] = {}

    def follow(self, query: StreamingQuery) -> str:
        return str(query.runId)

    def _end(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        observed = json.dumps({name: row.asDict() for name, row in (p.observedMetrics or {}).items()}, default=str, sort_keys=True)
        held = self.rows.setdefault(str(p.runId), {})
        before = held.get(p.batchId, (0, 0, 0, None, None))  # a batch without data may follow under the same number
        held[p.batchId] = (p.batchId, before[1] + p.numInputRows, before[2] + late, (p.eventTime or {}).get("watermark"), observed)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def report(self, spark: SparkSession, query: StreamingQuery, wait_seconds: float = 60) -> DataFrame:
        """The reports of an ended query. Events come after the query has ended, in order, the end last."""
        run = self.follow(query)
        if not self._end(run).wait(wait_seconds):
            raise TimeoutError("the end of the stream was not reported")
        return spark.createDataFrame(sorted(self.rows.get(run, {}).values()), REPORT)

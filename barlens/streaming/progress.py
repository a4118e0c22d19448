"""Counts of every micro-batch: messages that passed, and rows that came too late."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = (
    "query string, name string, batch long, input_rows long, rows long, late_rows long"
)


class BatchCounts(StreamingQueryListener):
    """Collects, per query and batch, what ``streaming.jobs.counted`` saw and what a watermark dropped.

    ``rows`` is the observed count named ``metric``, null where a query observes none. ``late_rows``
    counts rows that reached a stateful operator behind the watermark; operators that combine rows
    first count combined ones. ``input_rows`` is Spark's own count, which is higher where a sink
    reads a batch twice. A batch that runs again replaces its counts.

    Add it with ``spark.streams.addListener``. Counts stay in memory until ``take`` hands them
    over as a table, so a long-running job takes and appends them from time to time.
    """

    def __init__(self, metric: str = "messages"):
        self._metric = metric
        self._counts: dict[tuple[str, int], tuple] = {}
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self._change:
            self._ended.discard(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(self._metric)
        late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        query = str(progress.id)
        row = (
            query, progress.name, progress.batchId, progress.numInputRows,
            None if seen is None else seen["rows"], late,
        )
        with self._change:
            self._counts[query, progress.batchId] = row

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all counts of an ended query have arrived; its end is reported last."""
        with self._change:
            if not self._change.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"the end of query {query.id} was not reported")

    def take(self, spark: SparkSession) -> DataFrame:
        """The counts collected since the last call, as a table."""
        with self._change:
            rows, self._counts = list(self._counts.values()), {}
        return spark.createDataFrame(rows, SCHEMA)

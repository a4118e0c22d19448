"""Streaming queries: metrics, alerts, relay and incremental archive.

Every query is restartable from its checkpoint, and its sink may see a batch twice without
changing the result: documents are replaced by id, archive rows are merged by time, and a
second sink gets the number of the batch to key its write by.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barlens.functions.quality import decode
from barlens.functions.rules import AlertLimits
from barlens.operators.windows import (
    LATENESS,
    WINDOW_LENGTH,
    bar_windows,
    move_alerts,
    window_metrics,
)
from barlens.plans.archive import archive_batch
from barlens.sinks.messages import relayed
from barlens.sinks.tables import upsert_by_key
from barlens.sources.bars import envelope_range
from barlens.sources.streams import PROCESSING, stamp_clock

# Columns and rows of a preview, and how often the metric job runs a batch.
PREVIEW_COLUMNS = (
    "ticker", "window_start", "open_1m", "close_1m", "return_pct_1m", "range_pct_1m",
    "alert_reason", "direction", "alert_score",
)
PREVIEW_ROWS = 10
METRICS_TRIGGER = {"processingTime": "30 seconds"}


def metrics_stream(
    messages: DataFrame,
    clock: str = PROCESSING,
    length: str = WINDOW_LENGTH,
    lateness: str = LATENESS,
    drop_invalid: bool = True,
) -> DataFrame:
    """Message stream to metric documents."""
    bars = stamp_clock(decode(messages), clock, "event_time")
    return window_metrics(bars, "event_time", length, lateness, drop_invalid)


def alerts_stream(
    messages: DataFrame,
    clock: str = PROCESSING,
    length: str = WINDOW_LENGTH,
    lateness: str = LATENESS,
    limits: AlertLimits = AlertLimits(),
) -> DataFrame:
    """Message stream to alert documents."""
    bars = stamp_clock(decode(messages), clock, "timestamp")
    return move_alerts(bar_windows(bars, "timestamp", length, lateness), limits)


def preview(df: DataFrame, columns: Sequence[str] = PREVIEW_COLUMNS, rows: int = PREVIEW_ROWS) -> DataFrame:
    return df.select(*columns).limit(rows)


def start_preview(
    df: DataFrame, checkpoint: str, columns: Sequence[str] = PREVIEW_COLUMNS, rows: int = PREVIEW_ROWS
) -> StreamingQuery:
    """Print the first rows of each batch, untruncated, as a query of its own."""
    return (
        df.select(*columns)
        .writeStream.outputMode("append")
        .format("console")
        .options(truncate="false", numRows=str(rows), checkpointLocation=checkpoint)
        .start()
    )


def start_documents(
    df: DataFrame,
    checkpoint: str,
    fmt: str = "org.elasticsearch.spark.sql",
    trigger: dict | None = None,
    **options: str,
) -> StreamingQuery:
    """Append closed windows to a streaming sink, such as a search index keyed by ``doc_id``."""
    writer = df.writeStream.outputMode("append").format(fmt).options(**options)
    return writer.option("checkpointLocation", checkpoint).trigger(**_trigger(trigger)).start()


def start_upsert(
    df: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "doc_id",
    partition: Column | None = None,
    trigger: dict | None = None,
    also: Callable[[DataFrame, int], None] | None = None,
    buckets: int | None = None,
) -> StreamingQuery:
    """Upsert each batch into a document table.

    ``partition`` must follow from the key; by default it is the hour of the window, so that
    a batch rewrites an hour, not a day. ``also`` gets the same batch and its number after the
    write, for a preview or a second sink: one source read and one window state serve both. A
    batch can come again after a lost driver, with the same number, so a second sink must be
    keyed by it, as ``sinks.tables.write_batch`` is, or by document. ``buckets`` as in
    ``upsert_by_key``.
    """
    part = F.date_format("window_start", "yyyyMMddHH") if partition is None else partition

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.withColumn("part", part).persist()
        try:
            upsert_by_key(held, path, key, "part", buckets=buckets)
            if also is not None:
                also(held.drop("part"), batch_id)
        finally:
            held.unpersist()

    return _start_batches(df, write, checkpoint, trigger)


def start_metrics(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, **windows: str
) -> StreamingQuery:
    """The metric job: upsert metric documents, by default every 30 seconds."""
    documents = metrics_stream(messages, **windows)
    return start_upsert(documents, path, checkpoint, trigger=trigger or METRICS_TRIGGER)


def start_relay(
    messages: DataFrame,
    checkpoint: str,
    fmt: str = "kafka",
    topic: str | None = None,
    trigger: dict | None = None,
    **options: str,
) -> StreamingQuery:
    """Copy messages to another topic. The checkpoint takes the place of offset commits."""
    writer = relayed(messages, topic).writeStream.format(fmt).options(**options)
    return writer.option("checkpointLocation", checkpoint).trigger(**_trigger(trigger)).start()


def start_archive(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    between: tuple | None = None,
    trigger: dict | None = None,
    **layout,
) -> StreamingQuery:
    """Archive what has arrived since the last run, then stop.

    Progress is recorded after the write, so a failed run is repeated, not lost.
    """
    if between is not None:
        messages = envelope_range(messages, *between)
    bars = decode(messages)

    def write(batch: DataFrame, batch_id: int) -> None:
        archive_batch(batch, path, batch_id=batch_id, **layout)

    return _start_batches(bars, write, checkpoint, trigger or {"availableNow": True})


def _trigger(trigger: dict | None) -> dict:
    return trigger or {"processingTime": "0 seconds"}


def _start_batches(df: DataFrame, write, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    writer = df.writeStream.outputMode("append").foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**_trigger(trigger)).start()


def counted(df: DataFrame, name: str = "messages") -> DataFrame:
    """Report the number of rows that pass through, per run or per micro-batch."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))

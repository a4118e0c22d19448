"""Bars as queue messages, and the relay from one topic to another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENVELOPE_TIME_HEADER = "envelope-time-ms"


def to_messages(bars: DataFrame, key: str = "ticker") -> DataFrame:
    """One JSON message per bar, keyed by instrument. Null fields are kept as nulls."""
    fields = F.struct(*[F.col(f"`{c}`") for c in bars.columns])
    value = F.to_json(fields, {"ignoreNullFields": "false"})
    return bars.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def relayed(messages: DataFrame, topic: str | None = None) -> DataFrame:
    """Messages for the next topic: key, value and headers unchanged.

    Queue sinks cannot set the envelope time, so it travels as one more header.
    """
    at = F.unix_millis("timestamp").cast("string").cast("binary")
    stamp = F.array(F.struct(F.lit(ENVELOPE_TIME_HEADER).alias("key"), at.alias("value")))
    before = F.coalesce(F.col("headers"), F.slice(stamp, 1, 0))
    headers = F.when(F.col("timestamp").isNull(), before).otherwise(F.concat(before, stamp))
    columns = ["key", "value", headers.alias("headers")]
    if topic:
        columns.append(F.lit(topic).alias("topic"))
    return messages.select(*columns)


def write_messages(messages: DataFrame, fmt: str = "kafka", **options: str) -> None:
    messages.write.format(fmt).options(**options).mode("append").save()

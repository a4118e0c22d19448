"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barlens.functions.quality import parse_time

PROCESSING, EVENT = "processing", "event"


def read_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    schema: StructType | None = None,
    path: str | None = None,
    **options: str,
) -> DataFrame:
    """Any streaming source. Start position and loss tolerance are options of the source."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def kafka_options(servers: str, topic: str, fail_on_data_loss: bool = True, starting: str = "latest") -> dict[str, str]:
    """Options for a topic subscription. Metric jobs tolerate lost offsets, alert jobs do not."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "includeHeaders": "true",
    }


def stamp_clock(bars: DataFrame, clock: str = PROCESSING, name: str = "event_time") -> DataFrame:
    """Add ``source_time`` and the time that windows run on.

    ``processing`` stamps arrival, the same for a whole micro-batch; windows then close
    steadily but say when a bar came in, not when it was traded. ``event`` uses the bar's
    own time.
    """
    if clock not in (PROCESSING, EVENT):
        raise ValueError(f"clock must be {PROCESSING!r} or {EVENT!r}")
    if "source_time" not in bars.columns:
        bars = bars.withColumn("source_time", parse_time(F.col("time")))
    at = F.current_timestamp() if clock == PROCESSING else F.col("source_time").cast("timestamp")
    return bars.withColumn(name, at)

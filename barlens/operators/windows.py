"""Tumbling-window metrics, OHLCV bars and move alerts, on batch and streaming frames alike.

All three are plain aggregates: each task combines its rows per window and instrument before
the shuffle, so an instrument with very many ticks costs no more than any other. On a stream
the watermark closes windows; on a batch frame it has no effect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlens.functions import rules
from barlens.functions.ids import TO_THE_MINUTE, doc_id
from barlens.functions.rules import AlertLimits

# Window length and how long a window waits for late rows.
WINDOW_LENGTH = "1 minute"
LATENESS = "2 minutes"


def window_metrics(
    bars: DataFrame,
    clock: str = "event_time",
    length: str = WINDOW_LENGTH,
    lateness: str = LATENESS,
    drop_invalid: bool = True,
    company_in_id: bool = False,
) -> DataFrame:
    """One metric document per window, instrument and company spelling.

    ``drop_invalid`` leaves out rows without an instrument; otherwise undecodable payloads
    form a group of their own. The id names instrument and minute only, so two spellings of
    a company share one unless ``company_in_id`` is set.
    """
    if drop_invalid:
        bars = bars.where(F.col("ticker").isNotNull())
    grouped = bars.withWatermark(clock, lateness).groupBy(
        F.window(clock, length).alias("w"), "ticker", "company"
    )
    stats = grouped.agg(
        F.avg("Close").alias("avg_price"),
        F.min("Low").alias("min_price"),
        F.max("High").alias("max_price"),
        F.sum("Volume").alias("total_volume"),
        F.count(F.lit(1)).alias("trade_count"),
        F.stddev_samp("Close").alias("price_volatility"),
        F.max("source_time").alias("source_time"),
    )
    start = F.col("w.start")
    extra = [F.col("company")] if company_in_id else []
    # The field names of a metric document.
    return stats.select(
        start.alias("@timestamp"),
        start.alias("window_start"),
        F.col("w.end").alias("window_end"),
        "ticker",
        "company",
        "avg_price",
        "min_price",
        "max_price",
        "total_volume",
        "trade_count",
        "price_volatility",
        "source_time",
        F.current_timestamp().alias("processed_time"),
        doc_id(F.col("ticker"), start, TO_THE_MINUTE, *extra).alias("doc_id"),
    )


def bar_windows(
    bars: DataFrame,
    clock: str = "timestamp",
    length: str = WINDOW_LENGTH,
    lateness: str = LATENESS,
) -> DataFrame:
    """One OHLCV bar per window and instrument.

    Rows sharing the first instant count with their smallest open (a null one wins), rows
    sharing the last instant with their largest close.
    """
    known = F.col("ticker").isNotNull() & F.col(clock).isNotNull()
    grouped = (
        bars.where(known)
        .withWatermark(clock, lateness)
        .groupBy(F.window(clock, length).alias("w"), "ticker")
    )
    stats = grouped.agg(
        F.min(F.struct(clock, "Open")).alias("head"),
        F.max(F.struct(clock, "Close")).alias("tail"),
        F.max("High").alias("high_1m"),
        F.min("Low").alias("low_1m"),
        F.sum("Volume").alias("volume_sum_1m"),
        F.max("source_time").alias("source_time"),
    )
    # The field names of a window's bar.
    return stats.select(
        "ticker",
        F.col("w.start").alias("@timestamp"),
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        F.col("head.Open").alias("open_1m"),
        F.col("tail.Close").alias("close_1m"),
        "high_1m",
        "low_1m",
        "volume_sum_1m",
        "source_time",
    )


def move_alerts(windows: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """Windows that moved or ranged beyond the limits, with reason, direction, score and id."""
    opened = F.col("open_1m")
    move, span = F.col("return_pct_1m"), F.col("range_pct_1m")
    reason, direction = F.col("alert_reason"), F.col("direction")
    return (
        windows.withColumns(
            {
                "return_pct_1m": rules.share_of_open(F.col("close_1m") - opened, opened),
                "range_pct_1m": rules.share_of_open(F.col("high_1m") - F.col("low_1m"), opened),
            }
        )
        .withColumn("alert_reason", rules.alert_reason(move, span, limits))
        .where(reason.isNotNull())
        .withColumns(
            {
                "direction": rules.alert_direction(move),
                "alert_score": rules.alert_score(reason, move, span),
            }
        )
        .withColumn(
            "doc_id",
            doc_id(F.col("ticker"), F.col("window_start"), TO_THE_MINUTE, reason, direction),
        )
    )

"""Bars, ticks and messages derived from the sample order and event tables."""

from __future__ import annotations

from dataclasses import replace
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlens.operators.heat import HeatPolicy, with_counts

# Lines that one task turns into bars.
LINES_PER_TASK = 500_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def quantised(price: Column) -> Column:
    """Price on a 1/64 grid, so that sums are exact whatever their order."""
    return F.floor(price * 64).cast("double") / 64


def line_rank() -> Column:
    """Order of the lines that make up a bar, as one number that a hash aggregate can keep."""
    order = F.col("l_orderkey").cast("decimal(19,0)") * F.lit(10**10).cast("decimal(11,0)")
    return order + F.col("l_linenumber")


def known_heat(spark: SparkSession, folder: str) -> HeatPolicy:
    """Hot instruments, judged from the raw lines: one narrow column, before any bar is built."""
    counted = with_counts(table(spark, folder, "lineitem"), "l_suppkey")
    return replace(counted, known=counted.known.keyed_as("ticker", F.col("l_suppkey").cast("string")))


def _dealt(lines: DataFrame, heat: HeatPolicy) -> DataFrame:
    """Lines shuffled once, by instrument, which serves bars and windows alike.

    That needs instruments that a task can hold, so with hot ones among them lines stay as they
    are and the aggregates shuffle. The number of tasks follows the lines, so a task's memory does not.
    """
    if heat.known.keys:
        return lines
    cores = lines.sparkSession.sparkContext.defaultParallelism
    rounds = max(1, ceil(heat.rows / LINES_PER_TASK / cores))
    return lines.repartition(rounds * cores, "ticker")


def bars_from_lineitem(
    spark: SparkSession, folder: str, smooth: bool = False, company: bool = False,
    exact: bool = False, heat: HeatPolicy | None = None,
) -> DataFrame:
    """Daily bars: one instrument per supplier, one bar per ship date.

    ``exact`` keeps the prices in cents, ``smooth`` brings them close together. ``heat`` is what
    ``known_heat`` found, if it is known already.
    """
    raw = F.col("l_extendedprice")
    price = raw if exact else F.lit(1024.0) + quantised(raw / 1000) if smooth else quantised(raw)
    rank = line_rank()
    named = table(spark, folder, "lineitem").withColumn("ticker", F.col("l_suppkey").cast("string"))
    # Rows of one line of an order are tied; the lower price opens, the higher one closes.
    lines = (
        _dealt(named, heat or known_heat(spark, folder))
        .groupBy("ticker", "l_suppkey", F.col("l_shipdate").alias("time"), "l_orderkey", "l_linenumber")
        .agg(F.min(price).alias("low"), F.max(price).alias("high"), F.sum("l_quantity").alias("volume"))
    )
    bars = lines.groupBy("ticker", "l_suppkey", "time").agg(
        F.min_by("low", rank).alias("Open"),
        F.max("high").alias("High"),
        F.min("low").alias("Low"),
        F.max_by("high", rank).alias("Close"),
        F.sum("volume").alias("Volume"),
    )
    prices = ["time", "Open", "High", "Low", "Close", "Volume"]
    if not company:
        return bars.select("ticker", *prices)
    supplier = table(spark, folder, "supplier")
    return bars.join(supplier, bars["l_suppkey"] == supplier["s_suppkey"]).select(
        "ticker", F.col("s_name").alias("company"), *prices
    )


def bars_per_line(spark: SparkSession, folder: str, hot_share: int = 3) -> DataFrame:
    """One bar per order line. Every ``hot_share``-th supplier trades as the instrument HOT.

    The line's order number serves as second of the day, so HOT has a long history of its own.
    """
    price = quantised(F.col("l_extendedprice"))
    at = F.timestamp_add("SECOND", F.pmod("l_orderkey", F.lit(86400)).cast("int"), "l_shipdate")
    supplier = F.col("l_suppkey").cast("string")
    ticker = F.when(F.col("l_suppkey") % hot_share == 0, F.lit("HOT")).otherwise(supplier)
    return table(spark, folder, "lineitem").select(
        ticker.alias("ticker"),
        at.alias("time"),
        *[price.alias(c) for c in ("Open", "High", "Low", "Close")],
        F.col("l_quantity").alias("Volume"),
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        "l_partkey",
    )


def ticks_from_events(events: DataFrame) -> DataFrame:
    """One tick per event, on batch and streaming frames; ``source_time`` is the event's time."""
    price = F.lit(5000.0) + quantised(F.col("value"))
    at = F.col("ts").cast("timestamp")
    return events.select(
        F.col("event_type").alias("ticker"),
        F.col("event_type").alias("company"),
        F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSSXXX").alias("time"),
        *[price.alias(c) for c in ("Open", "High", "Low", "Close")],
        F.lit(1.0).alias("Volume"),
        at.alias("source_time"),
    )


def messages_from_bars(bars: DataFrame) -> DataFrame:
    """Queue messages of daily bars, a good share of them damaged in a known way.

    The day of the year modulo 11 picks the damage: 1 drops Open, 2 breaks the JSON, 3 blanks
    the time, 4 drops the ticker, 5 makes Close text, 6 makes company null, 7 drops Volume.
    """
    day = F.dayofyear("time")
    kind = F.pmod(day, F.lit(11))
    fields = F.struct(
        F.when(kind != 4, F.col("ticker")).alias("ticker"),
        F.when(kind != 6, F.col("company")).alias("company"),
        F.when(kind == 3, F.lit("")).otherwise(F.date_format("time", "yyyy-MM-dd HH:mm:ss")).alias("time"),
        F.when(kind != 1, F.col("Open")).alias("Open"),
        F.col("High"),
        F.col("Low"),
        F.col("Close"),
        F.when(kind != 7, F.col("Volume") + 0.5).alias("Volume"),
    )
    text = F.to_json(fields)
    text = F.when(kind == 2, F.substr(text, F.lit(2))).when(
        kind == 5, F.regexp_replace(text, '"Close":[0-9.E]+', '"Close":"n/a"')
    ).when(kind == 6, F.regexp_replace(text, r"\{", '{"company":null,')).otherwise(text)
    return bars.select(
        F.col("ticker").cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.array(
            F.struct(F.lit("origin").alias("key"), F.lit("sample").cast("binary").alias("value"))
        ).alias("headers"),
        F.timestamp_add("MINUTE", day, F.col("time").cast("timestamp")).alias("timestamp"),
        F.col("time").alias("bar_time"),
    )

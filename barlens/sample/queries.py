"""One query per operator, over the whole sample tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlens.functions import quality
from barlens.functions.rules import month_of
from barlens.operators import features
from barlens.operators.heat import HeatPolicy
from barlens.operators.lookup import attach
from barlens.operators.merge import archive_merge, merge_stats, new_records, slice_stats, slices_present
from barlens.operators.places import places_within
from barlens.operators.windows import LATENESS, bar_windows, move_alerts, window_metrics
from barlens.plans.archive import archive_batch, backfill, read_archive
from barlens.plans.feature_table import feature_documents, feature_table, publish_features
from barlens.sample import inputs
from barlens.schema import BAR_SCHEMA, ENVELOPE_SCHEMA, BarSpec
from barlens.session import stage, work_folder
from barlens.sinks.messages import to_messages
from barlens.sinks.tables import upsert_by_key, write_batch, write_table
from barlens.sources import bars as bar_sources
from barlens.sources.streams import EVENT, PROCESSING, read_stream, stamp_clock
from barlens.streaming import jobs
from barlens.streaming.progress import BatchCounts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ONE_RUN = {"availableNow": True}
ALERT_WINDOW = "1 hour"


def query(build: Query) -> Query:
    @wraps(build)
    def in_utc(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(spark, folder)

    QUERIES[build.__name__] = in_utc
    return build


def bars_and_heat(spark: SparkSession, folder: str, **kind: bool) -> tuple[DataFrame, HeatPolicy]:
    """Bars and their hot instruments. Bars without hot ones are dealt by instrument as they come,
    so the policy states no size for a second shuffle."""
    heat = inputs.known_heat(spark, folder)
    bars = inputs.bars_from_lineitem(spark, folder, heat=heat, **kind)
    return bars, heat if heat.known.keys else replace(heat, rows=None)


def local_times(df: DataFrame) -> DataFrame:
    """Zone-free times, as in the sample tables."""
    zoned = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(f"`{c}`").cast("timestamp_ntz") for c in zoned})


# --- bars and batch features -------------------------------------------------------------


@query
def bars_daily(spark, folder):
    return inputs.bars_from_lineitem(spark, folder, company=True)


@query
def moving_averages(spark, folder):
    bars, heat = bars_and_heat(spark, folder)
    bars = bars.select("ticker", "time", "Close")
    out = features.trend_features(bars, method="stacked", heat=heat)
    return out.select("ticker", "time", "ma50", "ma100", "ma200")


@query
def moving_averages_frame(spark, folder):
    bars, heat = bars_and_heat(spark, folder)
    bars = bars.select("ticker", "time", "Close")
    out = features.trend_features(bars, method="frame", heat=heat)
    return out.select("ticker", "time", "ma50", "ma100", "ma200")


@query
def moving_averages_prefix(spark, folder):
    bars, heat = bars_and_heat(spark, folder)
    bars = bars.select("ticker", "time", "Close")
    out = features.trend_features(bars, heat=heat)
    return out.select("ticker", "time", "ma50", "ma100", "ma200")


@query
def trend(spark, folder):
    bars, heat = bars_and_heat(spark, folder)
    bars = bars.select("ticker", "time", "Close")
    out = features.trend_features(bars, heat=heat)
    return out.select("ticker", "time", "trend", "trend_strength")


@query
def trend_unquantised(spark, folder):
    """Labels on prices in cents, whose sums depend on the order of adding."""
    bars, heat = bars_and_heat(spark, folder, exact=True)
    bars = bars.select("ticker", "time", "Close")
    out = features.trend_features(bars, heat=heat)
    return out.select("ticker", "time", "trend")


@query
def returns(spark, folder):
    bars, heat = bars_and_heat(spark, folder)
    bars = bars.select("ticker", "time", "Close")
    return features.return_features(bars, heat=heat).drop("Close")


@query
def drawdown(spark, folder):
    bars, heat = bars_and_heat(spark, folder)
    bars = bars.select("ticker", "time", "Close")
    return features.drawdown_features(bars, heat=heat).drop("Close")


@query
def volume_profile(spark, folder):
    bars, heat = bars_and_heat(spark, folder)
    bars = bars.select("ticker", "time", "Volume")
    out = features.volume_features(
        bars.withColumn("Close", F.lit(None).cast("double")), heat=heat
    )
    return out.drop("Close")


@query
def monthly_returns(spark, folder):
    return features.monthly_returns(inputs.bars_from_lineitem(spark, folder))


@query
def monthly_volatility(spark, folder):
    bars, heat = bars_and_heat(spark, folder)
    out = features.monthly_volatility(
        bars, heat=heat
    )
    return out.withColumn("monthly_volatility", F.round("monthly_volatility", 9))


@query
def volatility_join(spark, folder):
    bars, heat = bars_and_heat(spark, folder)
    bars = bars.select("ticker", "time", "Close")
    monthly = features.monthly_volatility(bars, heat=heat)
    out = attach(bars.withColumn("month", month_of(F.col("time"))), monthly, policy=heat)
    return out.withColumn("monthly_volatility", F.round("monthly_volatility", 9))


@query
def volatility_window(spark, folder):
    bars, heat = bars_and_heat(spark, folder)
    bars = bars.select("ticker", "time", "Close")
    out = feature_table(bars.withColumn("Volume", F.lit(0.0)), heat=heat)
    return _rounded(out.select("ticker", "month", "time", "Close", "monthly_volatility"))


@query
def market_regime(spark, folder):
    bars, heat = bars_and_heat(spark, folder, smooth=True)
    out = feature_table(bars, heat=heat)
    return out.select("ticker", "time", "market_regime")


def _rounded(table: DataFrame) -> DataFrame:
    return table.withColumn("monthly_volatility", F.round("monthly_volatility", 9))


@query
def feature_table_all(spark, folder):
    bars, heat = bars_and_heat(spark, folder)
    return _rounded(feature_table(bars, heat=heat))


@query
def feature_table_hot_key(spark, folder):
    """One instrument holds a third of all bars and is computed in blocks."""
    bars = inputs.bars_per_line(spark, folder)
    heat = HeatPolicy(max_rows_per_key=1_500, block_rows=25_000)
    spec = BarSpec(tiebreak=("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey"))
    return _rounded(feature_table(bars, spec, heat=heat)).drop("Open", "High", "Low")


@query
def feature_documents_complete(spark, folder):
    bars, heat = bars_and_heat(spark, folder, company=True)
    table = feature_table(bars, heat=heat)
    out = feature_documents(table)
    return out.select("doc_id", "ticker", "company", "month", "time", "return_90d", "market_regime")


@query
def feature_documents_published(spark, folder):
    """The daily job: feature table and documents written, documents read back."""
    bars, heat = bars_and_heat(spark, folder, company=True)
    table, documents = work_folder(spark, "features"), work_folder(spark, "feature-documents")
    publish_features(bars, table, documents, heat=heat)
    return spark.read.parquet(documents).select(
        "doc_id", "ticker", "company", "month", "time", "return_90d", "market_regime"
    )


@query
def cast_to_float(spark, folder):
    bars = quality.cast_prices(inputs.bars_from_lineitem(spark, folder), "float")
    return bars.select(
        "ticker", "time", *[F.col(c).cast("double").alias(c) for c in ("Open", "High", "Low", "Close", "Volume")]
    )


# --- selections --------------------------------------------------------------------------


@query
def latest_bar(spark, folder):
    return bar_sources.latest_per_key(inputs.bars_from_lineitem(spark, folder))


@query
def range_and_tickers(spark, folder):
    """An allow-list of instruments and two years up to a date: the selection is the feature."""
    bars = inputs.bars_from_lineitem(spark, folder)
    chosen = bar_sources.tickers_in(bars, "1, 2 ,3,5,8")
    return bar_sources.range_filter(chosen, end="1999-01-01", days=730)


@query
def union_tickers(spark, folder):
    bars = inputs.bars_from_lineitem(spark, folder)
    rest = F.col("ticker").cast("bigint") % 3
    parts = [bars.where(rest == 0), bars.where(rest == 1).drop("Volume"), bars.where(rest == 2)]
    return bar_sources.union_bars(parts)


# --- messages ----------------------------------------------------------------------------


def sample_messages(spark, folder) -> DataFrame:
    return inputs.messages_from_bars(inputs.bars_from_lineitem(spark, folder, company=True))


KEPT = ("key", "bar_time")


def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("key", F.col("key").cast("string"))


@query
def decode_messages(spark, folder):
    return _named(quality.decode(sample_messages(spark, folder), keep=KEPT)).drop("Adj Close")


@query
def message_round_trip(spark, folder):
    bars = inputs.bars_from_lineitem(spark, folder, company=True)
    text = bars.withColumn("time", F.col("time").cast("string"))
    sent = to_messages(text.withColumn("Adj Close", F.lit(None).cast("double")))
    return quality.decode(sent, keep=("key",)).drop("Adj Close")


@query
def parse_times(spark, folder):
    """Six ways to write the order date, and two that are no dates."""
    orders = inputs.table(spark, folder, "orders")
    day, way = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey") % 8
    text = (
        F.when(way == 0, F.concat(day, F.lit(" 09:30:00-05:00")))
        .when(way == 1, F.concat(day, F.lit(" 09:30:00")))
        .when(way == 2, day)
        .when(way == 3, F.concat(day, F.lit("T23:15:00+02:00")))
        .when(way == 4, F.concat(day, F.lit(" 09:30")))
        .when(way == 5, F.concat(day, F.lit(" 22:00:00Z")))
        .when(way == 6, F.lit("junk"))
    )
    out = orders.select("o_orderkey", text.alias("time"))
    out = quality.parse_times(out).withColumn("bound", quality.parse_bound(F.col("time")))
    out = out.withColumn("archive_date", F.date_format(quality.archive_date(
        F.when(F.col("source_time").isNotNull(), F.col("time"))), "yyyy-MM-dd"))
    return local_times(out.drop("time"))


@query
def missing_fields(spark, folder):
    checked = quality.with_validity(sample_messages(spark, folder))
    return _named(
        checked.select(
            *KEPT,
            F.concat_ws(",", "missing").alias("missing"),
            F.col("is_valid").cast("bigint").alias("is_valid"),
        )
    )


@query
def standardised(spark, folder):
    good, _ = quality.split_valid(quality.standardise(sample_messages(spark, folder), keep=KEPT))
    return _named(good)


@query
def standardise_problems(spark, folder):
    _, bad = quality.split_valid(quality.standardise(sample_messages(spark, folder), keep=KEPT))
    return _named(bad.select(*KEPT, "problem"))


@query
def quarantine(spark, folder):
    decoded = quality.decode(sample_messages(spark, folder), keep=KEPT)
    return _named(quality.with_problem(decoded).select(*KEPT, "problem"))


@query
def envelope_range(spark, folder):
    messages = local_times(sample_messages(spark, folder))
    chosen = bar_sources.envelope_range(messages, datetime(1997, 1, 1), datetime(1998, 1, 1))
    return _named(chosen.select("key", "bar_time", "timestamp"))


@query
def nan_to_null(spark, folder):
    bars = inputs.bars_from_lineitem(spark, folder)
    holes = bars.withColumn("Close", F.when(F.dayofyear("time") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("Close")))
    return quality.nan_to_null(holes).select("ticker", "time", "Close")


@query
def complete_rows(spark, folder):
    bars = inputs.bars_from_lineitem(spark, folder)
    day = F.dayofyear("time")
    holes = bars.withColumn("Close", F.when(day % 7 == 0, F.lit(float("nan"))).when(day % 5 > 0, F.col("Close")))
    return quality.complete_rows(holes, ["Close"]).select("ticker", "time", "Close")


# --- windows -----------------------------------------------------------------------------


def sample_ticks(spark, folder) -> DataFrame:
    return inputs.ticks_from_events(inputs.table(spark, folder, "events"))


def _metric_view(docs: DataFrame) -> DataFrame:
    out = docs.withColumn("price_volatility", F.round("price_volatility", 6)).drop("processed_time")
    return local_times(out)


@query
def window_metrics_batch(spark, folder):
    return _metric_view(window_metrics(stamp_clock(sample_ticks(spark, folder), EVENT)))


@query
def window_ohlcv(spark, folder):
    ticks = stamp_clock(sample_ticks(spark, folder), EVENT, "timestamp")
    return local_times(bar_windows(ticks, length=ALERT_WINDOW))


@query
def move_alerts_batch(spark, folder):
    ticks = stamp_clock(sample_ticks(spark, folder), EVENT, "timestamp")
    return local_times(move_alerts(bar_windows(ticks, length=ALERT_WINDOW)))


# --- streams -----------------------------------------------------------------------------


def tick_messages(spark, folder) -> DataFrame:
    """The event table as a message stream."""
    schema = inputs.table(spark, folder, "events").schema
    events = read_stream(spark, "parquet", schema, folder, pathGlobFilter="events.parquet")
    return to_messages(inputs.ticks_from_events(events).drop("source_time"))


def _documents(spark, stream: DataFrame, label: str) -> DataFrame:
    """Run a document stream to its end and read the table it wrote."""
    path = work_folder(spark, label)
    day = F.date_format("window_start", "yyyyMMdd")
    state = work_folder(spark, f"{label}-state")
    jobs.start_upsert(stream, path, state, partition=day, trigger=ONE_RUN).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path).select(*[f"`{c}`" for c in stream.columns])


@query
def window_metrics_stream(spark, folder):
    docs = jobs.metrics_stream(tick_messages(spark, folder), EVENT)
    return _metric_view(_documents(spark, docs, "metrics"))


@query
def move_alerts_stream(spark, folder):
    docs = jobs.alerts_stream(tick_messages(spark, folder), EVENT, length=ALERT_WINDOW)
    return local_times(_documents(spark, docs, "alerts"))


@query
def late_data_stream(spark, folder):
    """Half of the early ticks arrive a run too late: those whose window has closed are dropped."""
    events = inputs.table(spark, folder, "events")
    early = (F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")) & (F.col("event_id") % 2 == 0)
    landing, out, state = (work_folder(spark, f"late-{part}") for part in ("in", "out", "state"))
    for arrival in (events.where(early), events.where(~early)):
        arrival.write.mode("append").parquet(landing)
        ticks = inputs.ticks_from_events(read_stream(spark, "parquet", events.schema, landing))
        docs = window_metrics(stamp_clock(ticks, EVENT), length=ALERT_WINDOW)
        jobs.start_documents(docs, state, "parquet", ONE_RUN, path=out).awaitTermination()
    docs = spark.read.schema(docs.schema).parquet(out)
    return local_times(docs.select("ticker", "window_start", "trade_count", "avg_price"))


@query
def relay_stream(spark, folder):
    landing, out = work_folder(spark, "relay-in"), work_folder(spark, "relay-out")
    write_table(sample_messages(spark, folder).drop("bar_time"), landing)
    source = read_stream(spark, "parquet", ENVELOPE_SCHEMA, landing)
    run = jobs.start_relay(source, work_folder(spark, "relay-state"), "parquet", trigger=ONE_RUN, path=out)
    run.awaitTermination()
    sent = spark.read.parquet(out)
    header = F.element_at("headers", -1)
    return sent.select(
        F.col("key").cast("string").alias("key"),
        F.get_json_object(F.col("value").cast("string"), "$.High").cast("double").alias("high"),
        F.size("headers").cast("bigint").alias("n_headers"),
        header["value"].cast("string").cast("bigint").alias("envelope_ms"),
    )


# --- archive and documents ---------------------------------------------------------------

ARCHIVED = ("date", "ticker", "time", "Close", "Volume")


def archive_sides(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Stored and incoming bars: a third overlaps, and some incoming bars come twice."""
    bars = inputs.bars_from_lineitem(spark, folder)
    day = F.dayofyear("time")
    text = F.date_format("time", "yyyy-MM-dd HH:mm:ss")
    rows = stage(
        bars.select(
            F.to_date("time").alias("date"), "ticker", text.alias("time"), "Close", "Volume", day.alias("day")
        ),
        "archive-rows",
    )
    stored = rows.where(F.col("day") % 3 != 0)
    arriving = rows.where(F.col("day") % 3 != 1).withColumn("Close", F.col("Close") + 1)
    copies = F.when(F.col("day") % 5 == 0, 2).otherwise(1)
    arriving = arriving.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    return stored.select(*ARCHIVED), arriving.select(*ARCHIVED)


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query
def archive_merged(spark, folder):
    stored, incoming = archive_sides(spark, folder)
    return _dated(archive_merge(incoming, stored))


@query
def archive_merged_dedup(spark, folder):
    stored, incoming = archive_sides(spark, folder)
    return _dated(archive_merge(incoming, stored, dedup_within_batch=True))


@query
def archive_stats(spark, folder):
    stored, incoming = archive_sides(spark, folder)
    return merge_stats(slice_stats(incoming, stored, new_records(incoming, stored)))


@query
def archive_slices_present(spark, folder):
    stored, incoming = archive_sides(spark, folder)
    return _dated(slices_present(incoming.select("date", "ticker").distinct(), stored))


def _as_bars(rows: DataFrame) -> DataFrame:
    """Archive columns to decoded bars."""
    held = set(rows.columns)
    return rows.select(
        *[
            F.col(f.name) if f.name in held else F.lit(None).cast(f.dataType).alias(f.name)
            for f in BAR_SCHEMA
        ]
    )


@query
def archive_written(spark, folder):
    """Two runs of the archive job, then the archive as read back."""
    path = work_folder(spark, "archive")
    for rows in archive_sides(spark, folder):
        archive_batch(_as_bars(rows), path, partition_by=("month",))
    return _dated(spark.read.parquet(path).select(*ARCHIVED))


@query
def backfill_stats(spark, folder):
    """Statistics of a backfill over an archive that already holds a third of the bars."""
    path = work_folder(spark, "backfill")
    stored, _ = archive_sides(spark, folder)
    archive_batch(_as_bars(stored), path, partition_by=("year",))
    bars = inputs.bars_from_lineitem(spark, folder)
    text = F.date_format("time", "yyyy-MM-dd HH:mm:ss")
    history = _as_bars(bars.withColumn("time", text)).withColumn("source_time", F.to_timestamp("time"))
    tickers = [str(n) for n in range(1, 51)]
    return backfill(history, path, tickers, start="1996-01-01", end="2000-07-01", partition_by=("year",))


@query
def archive_stream(spark, folder):
    """Messages archived by a bounded stream; damaged ones stay out."""
    landing, path = work_folder(spark, "archive-landing"), work_folder(spark, "archive")
    write_table(sample_messages(spark, folder).drop("bar_time"), landing)
    source = read_stream(spark, "parquet", ENVELOPE_SCHEMA, landing)
    run = jobs.start_archive(
        source, path, work_folder(spark, "archive-state"), trigger=ONE_RUN, partition_by=("month",)
    )
    run.awaitTermination()
    return _dated(spark.read.parquet(path).select(*ARCHIVED))


@query
def ndjson_archive(spark, folder):
    """Bars as JSON lines in nested folders, read back with the fixed schema."""
    bars = inputs.bars_from_lineitem(spark, folder, company=True)
    text = F.date_format("time", "yyyy-MM-dd HH:mm:ss")
    rows = bars.withColumn("year", F.year("time")).withColumn("time", text)
    path = work_folder(spark, "ndjson")
    write_table(rows, path, "json", partition_by=["year"])
    return bar_sources.read_bars(spark, path).drop("Adj Close", bar_sources.CORRUPT)


@query
def upsert_documents(spark, folder):
    """A table of documents, then a second version of some of them, twice."""
    bars = inputs.bars_from_lineitem(spark, folder)
    at = F.date_format("time", "yyyyMMddHHmmss")
    docs = bars.select(
        F.concat_ws("_", "ticker", at).alias("doc_id"),
        "Close",
        F.dayofyear("time").alias("day"),
        month_of(F.col("time")).alias("part"),
    )
    docs = stage(docs, "documents")
    path = work_folder(spark, "upsert")
    upsert_by_key(docs.drop("day"), path, written=True)
    second = docs.where(F.col("day") % 2 == 0).drop("day").withColumn("Close", F.col("Close") + 1)
    for _ in range(2):
        upsert_by_key(second.union(second), path, written=True)
    return spark.read.parquet(path).select("doc_id", "Close", "part")


def _archived_features(spark, folder, fmt: str, partition_by) -> DataFrame:
    """Bars to the archive, back from it, and their features."""
    heat = inputs.known_heat(spark, folder)
    bars = inputs.bars_from_lineitem(spark, folder, heat=heat)
    text = F.date_format("time", "yyyy-MM-dd HH:mm:ss")
    path = work_folder(spark, "archive")
    archive_batch(_as_bars(bars.withColumn("time", text)), path, partition_by, fmt)
    stored = quality.parse_times(quality.cast_prices(read_archive(spark, path, fmt)), target="time")
    table = feature_table(stored, heat=heat)
    return local_times(table).select("ticker", "time", "ma50", "trend", "drawdown", "max_drawdown")


@query
def archive_to_features(spark, folder):
    return _archived_features(spark, folder, "json", ("year", "ticker"))


@query
def archive_to_features_parquet(spark, folder):
    return _archived_features(spark, folder, "parquet", ("month",))


@query
def range_on_text_times(spark, folder):
    """Times as text in three forms, one with an offset."""
    bars = inputs.bars_from_lineitem(spark, folder)
    way = F.dayofyear("time") % 3
    text = (
        F.when(way == 0, F.date_format("time", "yyyy-MM-dd"))
        .when(way == 1, F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.concat(F.date_format("time", "yyyy-MM-dd"), F.lit(" 22:00:00-05:00")))
    )
    texts = bars.select("ticker", text.alias("time"), "Close")
    return bar_sources.range_filter(texts, start="1996-03-01", end="1999-08-15")


@query
def cast_bad_text(spark, folder):
    """Prices as text, some of them no number."""
    bars = inputs.bars_from_lineitem(spark, folder).select("ticker", "time", "Close", "Volume")
    bad = F.dayofyear("time") % 7 == 0
    texts = bars.withColumn("Close", F.when(bad, F.lit("n/a")).otherwise(F.col("Close").cast("string")))
    return quality.cast_prices(texts)


@query
def latest_with_null_times(spark, folder):
    """Instruments all of whose times are null keep their row."""
    bars = inputs.bars_from_lineitem(spark, folder).select("ticker", "time", "Close")
    lost = F.col("ticker").cast("bigint") % 4 == 0
    same = bars.where(~lost).unionByName(
        bars.where(lost).select("ticker", F.lit(None).cast("timestamp_ntz").alias("time"), "Close")
    )
    return bar_sources.latest_per_key(same)


@query
def upsert_wider_schema(spark, folder):
    """Documents with a further column, then some of them again without it."""
    bars = inputs.bars_from_lineitem(spark, folder)
    docs = stage(
        bars.select(
            F.concat_ws("_", "ticker", F.date_format("time", "yyyyMMdd")).alias("doc_id"),
            "Close", "Volume", F.dayofyear("time").alias("day"), month_of(F.col("time")).alias("part"),
        ),
        "documents",
    )
    path = work_folder(spark, "upsert")
    upsert_by_key(docs.drop("day"), path, written=True)
    upsert_by_key(docs.where("day % 2 = 0").drop("day", "Volume"), path, written=True)
    return spark.read.parquet(path).select("doc_id", "Close", "Volume", "part")


@query
def arrival_clock(spark, folder):
    """Windows on arrival time: all rows of a batch run share one window per instrument."""
    stamped = stamp_clock(sample_ticks(spark, folder), PROCESSING)
    docs = window_metrics(stamped, "event_time", "1 day")
    return docs.groupBy("ticker").agg(
        F.sum("trade_count").cast("bigint").alias("trade_count"),
        F.count_distinct("window_start").alias("windows"),
    )


@query
def labelled_prices(spark, folder):
    """Price rows of one instrument as bars."""
    bars = inputs.bars_from_lineitem(spark, folder)
    nan = F.when(F.dayofyear("time") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("Close"))
    prices = bars.where("ticker = '7'").select("time", nan.alias("Close"), "Volume")
    return bar_sources.label_bars(prices, "SEVEN", None)


@query
def labelled_prices_all(spark, folder):
    """Price rows of all instruments as bars, labelled by their columns."""
    bars = inputs.bars_from_lineitem(spark, folder, company=True)
    nan = F.when(F.dayofyear("time") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("Close"))
    prices = bars.select(
        F.col("ticker").alias("symbol"), "company", "time", nan.alias("Close"), "Volume"
    )
    labelled = bar_sources.label_bars(prices, F.concat(F.lit("T"), "symbol"), F.col("company"))
    return labelled.drop("symbol")


@query
def two_sinks_stream(spark, folder):
    """One stream of metrics into a document table and, batch by batch, into a second sink."""
    second, path = work_folder(spark, "second-sink"), work_folder(spark, "documents")
    documents = jobs.metrics_stream(tick_messages(spark, folder), EVENT)
    run = jobs.start_upsert(
        documents, path, work_folder(spark, "state"), trigger=ONE_RUN,
        partition=F.date_format("window_start", "yyyyMMdd"),
        also=lambda batch, number: write_batch(batch, second, "metrics", number),
    )
    run.awaitTermination()
    written = spark.read.parquet(path).select("doc_id", "trade_count")
    copied = spark.read.parquet(second).select("doc_id", "trade_count")
    return written.withColumn("sink", F.lit(1)).unionByName(copied.withColumn("sink", F.lit(2)))


def _with_counts_of(spark, run) -> tuple:
    """(result of ``run``, counts of its batches); ``run`` is given the counts to wait on."""
    counts = BatchCounts()
    spark.streams.addListener(counts)
    try:
        return run(counts), counts.take(spark)
    finally:
        spark.streams.removeListener(counts)


@query
def message_counts(spark, folder):
    """Messages that a relay passed on, as its batches reported them and as they arrived."""
    out = work_folder(spark, "relay-out")

    def run(counts):
        messages = jobs.counted(tick_messages(spark, folder))
        state = work_folder(spark, "relay-state")
        sent = jobs.start_documents(messages, state, "parquet", ONE_RUN, path=out)
        sent.awaitTermination()
        counts.wait_for(sent)

    _, counts = _with_counts_of(spark, run)
    return _totals(counts.select(F.col("rows").alias("reported")), "reported", spark.read.parquet(out), "arrived")


def _totals(counts: DataFrame, counted: str, arrived: DataFrame, name: str) -> DataFrame:
    """One row: the sum of ``counted``, and the number of rows that arrived."""
    rows = counts.select(counted, F.lit(0).cast("long").alias(name)).unionByName(
        arrived.select(F.lit(0).cast("long").alias(counted), F.lit(1).cast("long").alias(name))
    )
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (counted, name)])


@query
def late_rows_counted(spark, folder):
    """Rows behind the watermark, as a stateful operator counts them: arrivals as in late_data_stream."""
    events = inputs.table(spark, folder, "events")
    early = (F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")) & (F.col("event_id") % 2 == 0)
    landing, out, state = (work_folder(spark, f"rows-{part}") for part in ("in", "out", "state"))

    def run(counts):
        for arrival in (events.where(early), events.where(~early)):
            arrival.write.mode("append").parquet(landing)
            stream = read_stream(spark, "parquet", events.schema, landing)
            known = stream.select("event_id", F.col("ts").cast("timestamp").alias("at"))
            once = known.withWatermark("at", LATENESS).dropDuplicates(["event_id", "at"])
            sent = jobs.start_documents(once, state, "parquet", ONE_RUN, path=out)
            sent.awaitTermination()
            counts.wait_for(sent)

    _, counts = _with_counts_of(spark, run)
    return _totals(counts, "late_rows", spark.read.parquet(out), "kept_rows")


@query
def slice_places(spark, folder):
    """The place of every bar inside its archive slice, a month, in archive order."""
    bars = inputs.bars_from_lineitem(spark, folder).select(
        month_of(F.col("time")).alias("month"), "ticker", "time", "Close"
    )
    return places_within(bars, ["month"], ["time", "ticker"])


TYPED = {"ticker": "string", "company": "string", "time": "string", "Open": "double", "Close": "double",
         "Volume": "double"}


@query
def typed_messages(spark, folder):
    """Fields of messages by their JSON type: absent, null, text and numbers told apart."""
    return _named(quality.typed_fields(sample_messages(spark, folder), TYPED, keep=KEPT))


@query
def archive_by_date_and_ticker(spark, folder):
    """The archive in its narrowest layout: a folder of JSON lines per date and instrument.

    Daily bars of all instruments would be a folder each. So the bars of a month count as one
    date, with the day as the minute, and instruments form five groups.
    """
    path = work_folder(spark, "archive")
    number, time = F.col("ticker").cast("bigint"), F.col("time")
    at = F.concat(
        F.substring(time, 1, 8), F.lit("01 00:"), F.substring(time, 9, 2), F.lit(":"),
        F.lpad((number % 60).cast("string"), 2, "0"),
    )
    for rows in archive_sides(spark, folder):
        grouped = rows.withColumns({"time": at, "ticker": F.concat(F.lit("g"), (number % 5).cast("string"))})
        archive_batch(_as_bars(grouped), path, ("date", "ticker"), "json")
    return _dated(read_archive(spark, path).groupBy("date", "ticker").agg(F.count("*").alias("rows")))


@query
def absent_columns_skipped(spark, folder):
    """Casting and time parsing of frames that lack most of the columns."""
    bars = inputs.bars_from_lineitem(spark, folder)
    few = bars.select("ticker", F.col("Close").cast("string").alias("Close"), "Volume")
    return quality.cast_prices(quality.parse_times(few))


@query
def preview_size(spark, folder):
    """Columns and rows of the alert preview: which rows it shows is left open, how many is not."""
    ticks = stamp_clock(sample_ticks(spark, folder), EVENT, "timestamp")
    shown = jobs.preview(move_alerts(bar_windows(ticks, length=ALERT_WINDOW)))
    return shown.agg(
        F.count("*").alias("rows"), F.count("alert_reason").alias("reasons"),
    ).withColumn("columns", F.lit(",".join(shown.columns)))

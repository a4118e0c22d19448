"""Batch sources of bars, and the selections made on them."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType, TimestampType

from barlens.functions.quality import nan_to_null, parse_time
from barlens.schema import BAR_SCHEMA, BarSpec

CORRUPT = "_corrupt_record"


def read_bars(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "json",
    schema: StructType = BAR_SCHEMA,
    partitioned: bool = False,
    **options: str,
) -> DataFrame:
    """Bars below ``path``, at any folder depth, with a fixed schema.

    There is no inference pass, and a malformed JSON line lands in ``_corrupt_record``
    with all other fields null. With ``partitioned`` the folders are read as partition
    columns instead, so that filters on them skip files.
    """
    reader = spark.read.options(**options)
    if not partitioned:
        reader = reader.option("recursiveFileLookup", "true")
    if fmt == "json":
        schema = StructType([*schema.fields]).add(CORRUPT, StringType())
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.format(fmt).schema(schema).load(path)


def read_messages(spark: SparkSession, fmt: str, schema: StructType | None = None, **options: str) -> DataFrame:
    """Bounded read of a queue (``kafka`` with ``kafka_range_options``) or of any other format."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load()


def kafka_range_options(start: datetime, end: datetime) -> dict[str, str]:
    """Options that make the queue source seek to both ends of an envelope-time range."""
    millis = {"startingTimestamp": start, "endingTimestamp": end + timedelta(milliseconds=1)}
    return {
        **{name: str(int(at.timestamp() * 1000)) for name, at in millis.items()},
        "startingOffsetsByTimestampStrategy": "latest",
    }


def lookback_range(hours: int = 24, now: datetime | None = None) -> tuple[datetime, datetime]:
    end = now or datetime.now(timezone.utc)
    return end - timedelta(hours=hours), end


def envelope_range(messages: DataFrame, start: datetime, end: datetime, column: str = "timestamp") -> DataFrame:
    """Messages whose envelope time lies in the range, both ends included."""
    return messages.where(F.col(column).between(F.lit(start), F.lit(end)))


def time_bounds(
    start: str | date | None = None,
    end: str | date | None = None,
    days: int | None = None,
    now: datetime | None = None,
) -> tuple[datetime, datetime]:
    """Resolve ``start`` or ``days`` (exactly one) and ``end`` (default: now)."""
    if (start is None) == (days is None):
        raise ValueError("give either start or days")
    upper = _moment(end) if end is not None else (now or _utc_now())
    return (upper - timedelta(days=days) if days is not None else _moment(start)), upper


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _moment(value: str | date) -> datetime:
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(value)


def range_filter(
    bars: DataFrame,
    start: str | date | None = None,
    end: str | date | None = None,
    days: int | None = None,
    time: str = "time",
    now: datetime | None = None,
) -> DataFrame:
    """Bars from ``start`` (included) to ``end`` (excluded).

    The bounds become literals of the column's own type, so they reach the file scan. Times in
    text are compared as instants, whatever their form and offset; the scan gets the days
    around the range. A text that is no time is in no range.
    """
    low, high = time_bounds(start, end, days, now)
    kind, at = bars.schema[time].dataType, F.col(time)
    if isinstance(kind, StringType):
        # An offset moves a time by less than a day.
        first, last = (low - timedelta(days=1)).date(), (high + timedelta(days=2)).date()
        bars = bars.where((at >= str(first)) & (at < str(last)))
        kind, at = TimestampType(), parse_time(at)
    return bars.where((at >= _bound(low, kind)) & (at < _bound(high, kind)))


def _bound(at: datetime, kind) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast(kind)


def tickers_in(bars: DataFrame, tickers: str | Iterable[str], key: str = "ticker") -> DataFrame:
    """Bars of the listed instruments; a comma list is split and trimmed."""
    names = tickers.split(",") if isinstance(tickers, str) else tickers
    return bars.where(F.col(key).isin([n.strip() for n in names]))


def latest_per_key(bars: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """The last bar of each instrument.

    An aggregate rather than a ranking window: each task keeps one bar per instrument before
    anything is shuffled. A null time comes before all others. Bars that agree in time and
    tie-break are ordered by their columns.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in bars.columns])
    ranked = F.max(F.struct(*[F.col(c) for c in spec.order], row.alias("_row")))
    return bars.groupBy(F.col(spec.key).alias("_key")).agg(ranked.alias("_last")).select("_last._row.*")


def union_bars(frames: Iterable[DataFrame]) -> DataFrame:
    """All bars of several frames; a column missing in one becomes null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def label_bars(
    prices: DataFrame, ticker: str | Column, company: str | Column | None, time: str = "time"
) -> DataFrame:
    """Price rows as bars: identity added, time as text, NaN as null.

    ``ticker`` and ``company`` are literals for rows of one instrument, or columns of ``prices``.
    """
    clean = nan_to_null(prices)
    rest = [f"`{c}`" for c in clean.columns if c not in (time, "ticker", "company")]
    identity = [v if isinstance(v, Column) else F.lit(v) for v in (ticker, company)]
    return clean.select(
        identity[0].alias("ticker"),
        identity[1].cast("string").alias("company"),
        F.col(time).cast("string").alias("time"),
        *rest,
    )

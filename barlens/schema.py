"""The bar contract: field names, types and the roles columns play."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    StringType,
    StructType,
    TimestampType,
)

# Field names and types every producer and reader shares.
BAR_SCHEMA = (
    StructType()
    .add("ticker", StringType())
    .add("company", StringType())
    .add("time", StringType())
    .add("Open", DoubleType())
    .add("High", DoubleType())
    .add("Low", DoubleType())
    .add("Close", DoubleType())
    .add("Adj Close", DoubleType())
    .add("Volume", DoubleType())
)
REQUIRED_FIELDS = ("ticker", "time", "Open", "High", "Low", "Close", "Volume")
PRICE_FIELDS = ("Open", "High", "Low", "Close", "Volume")
TIME_PATTERN_WITH_OFFSET = "yyyy-MM-dd HH:mm:ssXXX"

# A queue message as Spark's queue sources deliver it.
_HEADER = StructType().add("key", StringType()).add("value", BinaryType())
ENVELOPE_SCHEMA = (
    StructType()
    .add("key", BinaryType())
    .add("value", BinaryType())
    .add("headers", ArrayType(_HEADER))
    .add("timestamp", TimestampType())
)


@dataclass(frozen=True)
class BarSpec:
    """Which column plays which role.

    ``tiebreak`` lists further columns that order bars of one instrument carrying the same
    time. Without it the order of such bars is arbitrary, as in any SQL window.
    """

    key: str = "ticker"
    time: str = "time"
    open: str = "Open"
    high: str = "High"
    low: str = "Low"
    close: str = "Close"
    volume: str = "Volume"
    company: str = "company"
    tiebreak: tuple[str, ...] = ()

    @property
    def order(self) -> list[str]:
        return [self.time, *self.tiebreak]

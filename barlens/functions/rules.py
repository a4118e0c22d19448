"""Column expressions: ratios, labels and alert rules. Division by zero gives null."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RegimeLimits:
    # Monthly volatility limits.
    calm: float = 0.02
    stressed: float = 0.03
    extreme: float = 0.05


@dataclass(frozen=True)
class AlertLimits:
    # Smallest move that raises an alert.
    move: float = 0.01
    span: float = 0.015


def relative_change(now: Column, base: Column) -> Column:
    return F.try_divide(now - base, base)


def trend_label(fast: Column, slow: Column) -> Column:
    """``sideway`` when equal or when either average is missing."""
    return F.when(fast > slow, F.lit("up")).when(fast < slow, F.lit("down")).otherwise(F.lit("sideway"))


def regime_label(fast: Column, slow: Column, volatility: Column, limits: RegimeLimits) -> Column:
    """Tested in this order, so ``high_vol`` is only reached when the trend is not falling."""
    rising = (fast > slow) & (volatility < limits.calm)
    falling = (fast < slow) & (volatility > limits.stressed)
    return (
        F.when(rising, F.lit("bull"))
        .when(falling, F.lit("bear"))
        .when(volatility > limits.extreme, F.lit("high_vol"))
        .otherwise(F.lit("normal"))
    )


def month_of(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM")


def share_of_open(amount: Column, opened: Column) -> Column:
    """Null unless the opening price is positive."""
    return F.when(opened > 0, F.try_divide(amount, opened))


def alert_reason(move: Column, span: Column, limits: AlertLimits) -> Column:
    """Limits count as exceeded when reached. A price move outranks a wide range."""
    return F.when(F.abs(move) >= limits.move, F.lit("return_pct")).when(
        span >= limits.span, F.lit("range_pct")
    )


def alert_direction(move: Column) -> Column:
    """An unknown move counts as down."""
    return F.when(move >= 0, F.lit("up")).otherwise(F.lit("down"))


def alert_score(reason: Column, move: Column, span: Column) -> Column:
    return F.when(reason == "return_pct", F.abs(move)).otherwise(span)

"""Per-instrument features of bar histories. Each function adds columns to its input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlens.functions.rules import (
    RegimeLimits,
    month_of,
    regime_label,
    relative_change,
    trend_label,
)
from barlens.operators.exact import Over, sample_deviation
from barlens.operators.heat import DEFAULT_HEAT, HeatPolicy, Layout, per_instrument
from barlens.operators.rolling import moving_averages
from barlens.operators.steps import Steps, apply_steps
from barlens.schema import BarSpec

# Rows per average and rows per lagged return.
TREND_SIZES = {"ma50": 50, "ma100": 100, "ma200": 200}
VOLUME_SIZES = {"volume_ma20": 20}
RETURN_LAGS = {"daily_return": 1, "return_30d": 30, "return_90d": 90}

_SPEC = BarSpec()


def trend_steps(layout: Layout, sizes: dict[str, int], method: str) -> Steps:
    by_length = sorted(sizes, key=sizes.get)
    fast, slow = F.col(by_length[0]), F.col(by_length[-1])
    return moving_averages(layout, layout.spec.close, sizes, method) + Steps(
        labels={
            "trend": trend_label(fast, slow),
            "trend_strength": F.try_divide(fast - slow, F.col(layout.spec.close)),
        }
    )


def return_steps(layout: Layout, lags: dict[str, int]) -> Steps:
    close, past = layout.spec.close, layout.rows_so_far()
    now = F.col(close)
    earlier = {f"_{name}_base": F.lag(close, rows).over(past) for name, rows in lags.items()}
    returns = {name: relative_change(now, F.col(f"_{name}_base")) for name in lags}
    return Steps(
        first={**earlier, "_origin": layout.first(close)},
        final={**returns, "cumulative_return": F.try_divide(now, F.col("_origin")) - 1},
    )


def drawdown_steps(layout: Layout) -> Steps:
    close = layout.spec.close
    return Steps(
        first={"_peak": layout.running_max(close)},
        final={"drawdown": relative_change(F.col(close), F.col("_peak"))},
    )


def volume_steps(layout: Layout, sizes: dict[str, int], method: str) -> Steps:
    volume = layout.spec.volume
    (average,) = sizes
    return moving_averages(layout, volume, sizes, method) + Steps(
        labels={"volume_ratio": F.try_divide(F.col(volume), F.col(average))}
    )


WORST_DRAWDOWN = {"max_drawdown": (F.min, "drawdown")}


def _deviation(over: Over) -> Column:
    return sample_deviation("daily_return", over)


def add_group_values(rows: DataFrame, layout: Layout, month: str) -> DataFrame:
    """Worst drawdown and monthly volatility of rows that carry drawdown and daily return.

    Rows without key or month get no volatility, as in a join.
    """
    rows = layout.group_values(rows, WORST_DRAWDOWN, month, {"_deviation": _deviation})
    known = F.col(layout.spec.key).isNotNull() & F.col(month).isNotNull()
    return rows.withColumn("monthly_volatility", F.when(known, F.col("_deviation"))).drop("_deviation")


def _reach(sizes: dict[str, int]) -> int:
    return max(sizes.values()) - 1


def trend_features(
    bars: DataFrame,
    spec: BarSpec = _SPEC,
    sizes: dict[str, int] = TREND_SIZES,
    method: str = "prefix",
    heat: HeatPolicy = DEFAULT_HEAT,
) -> DataFrame:
    """Moving averages, trend label (shortest against longest) and trend strength."""
    return per_instrument(
        bars,
        spec,
        _reach(sizes),
        lambda rows, layout: layout.settle(apply_steps(rows, trend_steps(layout, sizes, method))),
        heat,
    )


def return_features(
    bars: DataFrame,
    spec: BarSpec = _SPEC,
    lags: dict[str, int] = RETURN_LAGS,
    heat: HeatPolicy = DEFAULT_HEAT,
) -> DataFrame:
    """Returns against earlier bars, counted in rows, and against the first bar."""
    return per_instrument(
        bars,
        spec,
        max(lags.values()),
        lambda rows, layout: layout.settle(apply_steps(rows, return_steps(layout, lags))),
        heat,
    )


def drawdown_features(
    bars: DataFrame, spec: BarSpec = _SPEC, heat: HeatPolicy = DEFAULT_HEAT
) -> DataFrame:
    """Distance from the running peak, and its minimum over the whole history."""

    def build(rows: DataFrame, layout: Layout) -> DataFrame:
        rows = layout.settle(apply_steps(rows, drawdown_steps(layout)))
        return layout.group_values(rows, WORST_DRAWDOWN)

    return per_instrument(bars, spec, 0, build, heat)


def volume_features(
    bars: DataFrame,
    spec: BarSpec = _SPEC,
    sizes: dict[str, int] = VOLUME_SIZES,
    method: str = "prefix",
    heat: HeatPolicy = DEFAULT_HEAT,
) -> DataFrame:
    """Average volume and the current volume relative to it."""
    return per_instrument(
        bars,
        spec,
        _reach(sizes),
        lambda rows, layout: layout.settle(apply_steps(rows, volume_steps(layout, sizes, method))),
        heat,
    )


def monthly_returns(bars: DataFrame, spec: BarSpec = _SPEC) -> DataFrame:
    """Last against first close inside each month: one row per instrument and month.

    A plain aggregate, combined before the shuffle, so hot instruments need no care.
    """
    rank = F.col(spec.time) if not spec.tiebreak else F.struct(*spec.order)
    ends = bars.groupBy(spec.key, month_of(F.col(spec.time)).alias("month")).agg(
        F.min_by(spec.close, rank).alias("first"), F.max_by(spec.close, rank).alias("last")
    )
    return ends.select(
        spec.key, "month", relative_change(F.col("last"), F.col("first")).alias("monthly_return")
    )


def monthly_volatility(
    bars: DataFrame, spec: BarSpec = _SPEC, heat: HeatPolicy = DEFAULT_HEAT
) -> DataFrame:
    """Sample deviation of daily returns: one row per instrument and month."""
    narrow = bars.select(spec.key, *spec.order, spec.close)
    daily = return_features(narrow, spec, {"daily_return": 1}, heat)
    return daily.groupBy(spec.key, month_of(F.col(spec.time)).alias("month")).agg(
        sample_deviation("daily_return").alias("monthly_volatility")
    )


def market_regime(
    rows: DataFrame,
    fast: str = "ma50",
    slow: str = "ma200",
    volatility: str = "monthly_volatility",
    limits: RegimeLimits = RegimeLimits(),
) -> DataFrame:
    """Label each row from two averages and the monthly volatility it already carries."""
    label = regime_label(F.col(fast), F.col(slow), F.col(volatility), limits)
    return rows.withColumn("market_regime", label)

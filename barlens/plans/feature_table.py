"""The batch job: all features of every bar in one pass, and the documents made from them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlens.functions.ids import TO_THE_SECOND, doc_id
from barlens.functions.quality import complete_rows
from barlens.functions.rules import RegimeLimits, month_of
from barlens.operators import features as ops
from barlens.operators.heat import DEFAULT_HEAT, HeatPolicy, Layout, per_instrument
from barlens.operators.steps import apply_steps
from barlens.schema import BarSpec
from barlens.sinks.tables import upsert_by_key, write_table

_MONTH_NO = "_month_no"


def feature_table(
    bars: DataFrame,
    spec: BarSpec = BarSpec(),
    method: str = "prefix",
    limits: RegimeLimits = RegimeLimits(),
    heat: HeatPolicy = DEFAULT_HEAT,
) -> DataFrame:
    """All features, key and month first. Every input row comes back once.

    Ordinary instruments need one shuffle and one sort by (key, month, time). That order is
    the time order of the instrument, and it also groups its months, so the monthly
    volatility is one more window over the same rows instead of an aggregate joined back.
    """
    by_month = replace(spec, time=_MONTH_NO, tiebreak=(spec.time, *spec.tiebreak))

    def build(rows: DataFrame, layout: Layout) -> DataFrame:
        steps = (
            ops.return_steps(layout, ops.RETURN_LAGS)
            + ops.drawdown_steps(layout)
            + ops.volume_steps(layout, ops.VOLUME_SIZES, method)
            + ops.trend_steps(layout, ops.TREND_SIZES, method)
        )
        rows = layout.settle(apply_steps(rows, steps))
        rows = ops.add_group_values(rows, layout, _MONTH_NO)
        return ops.market_regime(rows, limits=limits)

    time = F.col(spec.time)
    numbered = bars.withColumn(_MONTH_NO, F.year(time) * 12 + F.month(time))
    lookback = max(*ops.RETURN_LAGS.values(), max(ops.TREND_SIZES.values()) - 1)
    table = per_instrument(numbered, by_month, lookback, build, heat)
    table = table.withColumn("month", month_of(time))
    others = [c for c in bars.columns if c != spec.key]
    added = [
        *ops.TREND_SIZES, "trend", "trend_strength",
        "daily_return", "cumulative_return", "return_30d", "return_90d",
        "drawdown", "max_drawdown",
        *ops.VOLUME_SIZES, "volume_ratio",
        "monthly_volatility", "market_regime",
    ]
    return table.select(spec.key, "month", *[f"`{c}`" for c in others], *added)


def feature_documents(
    table: DataFrame, spec: BarSpec = BarSpec(), required: Sequence[str] | None = None
) -> DataFrame:
    """Complete feature rows with their document id, ready for a keyed index."""
    return complete_rows(table, required).withColumn(
        "doc_id", doc_id(F.col(spec.key), F.col(spec.time), TO_THE_SECOND)
    )


def publish_features(
    bars: DataFrame,
    table_path: str,
    documents_path: str,
    spec: BarSpec = BarSpec(),
    fmt: str = "parquet",
    **options,
) -> None:
    """The daily job: write the feature table, then upsert its complete rows as documents.

    The features are computed once; documents come from the table as written. They are
    partitioned by month, which follows from the time in their id.
    """
    table = feature_table(bars, spec, **options)
    write_table(table, table_path, fmt)
    written = bars.sparkSession.read.schema(table.schema).format(fmt).load(table_path)
    documents = feature_documents(written, spec)
    upsert_by_key(documents, documents_path, partition="month", written=True)

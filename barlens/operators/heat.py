"""Per-instrument windows that survive an instrument holding a large share of all rows.

``Window.partitionBy(ticker)`` puts one instrument into one task. That is the cheapest plan
for ordinary instruments and is used for them. Instruments above a row limit ("hot") are cut
into blocks of consecutive bars, each small enough for a task:

1. The hot rows are range-partitioned by (key, time, tie-break, row number) and written. The
   partition a row landed in is its block; a running row id gives its place in the order.
2. A small table with one row per (key, block) holds the place of the block in the history
   of its instrument and what later blocks need from it: first close and running maximum.
3. Every block gets the last ``lookback`` rows in front of it as extra "lead-in" rows, so
   that bounded frames and lags see their full past. Windows then run per (key, block).

Rows and values are the same either way, to the last bit: what is summed over an instrument or its
months is summed exactly, and so does not depend on how rows are grouped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlens.operators.exact import Over, as_it_is
from barlens.schema import BarSpec
from barlens.session import ROWS_PER_TASK, stage, tasks_for

BLOCK, PLACE, LEAD_IN = "_block", "_place", "_lead_in"
TOP_BEFORE, FIRST_CLOSE = "_top_before", "_first_close"


@dataclass(frozen=True)
class HotKeys:
    """The hot instruments as a table (key, count), with what plans need to know of it."""

    table: DataFrame | None = None
    keys: int = 0
    rows: int = 0
    null_key: bool = False

    def keyed_as(self, key: str, value: Column) -> HotKeys:
        """The same under another key column."""
        if self.table is None:
            return self
        return replace(self, table=self.table.select(value.alias(key), "count"))

    def split(self, rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        """(ordinary rows, hot rows). The table is joined as its size allows."""
        hot = self.table.select(F.col(key).alias("_hot"))
        same = F.col(key).eqNullSafe(F.col("_hot")) if self.null_key else F.col(key) == F.col("_hot")
        return rows.join(hot, same, "left_anti"), rows.join(hot, same, "left_semi")


@dataclass(frozen=True)
class HeatPolicy:
    """When an instrument counts as hot, and how large its blocks are.

    ``known`` skips the counting pass: the hot keys with their (approximate) row counts, as a
    mapping or as ``HotKeys``. ``rows`` then says how many rows there are in all, to size the
    shuffle.
    """

    max_rows_per_key: int = 2_000_000
    block_rows: int = ROWS_PER_TASK
    known: dict | HotKeys | None = None
    rows: int | None = None


DEFAULT_HEAT = HeatPolicy()


@dataclass(frozen=True)
class Layout:
    """How windows must be declared over a set of rows."""

    spec: BarSpec
    blocked: bool
    null_key: bool = False

    def rows_so_far(self):
        """Window over one instrument in time order (or over one block of it)."""
        if self.blocked:
            return Window.partitionBy(self.spec.key, BLOCK).orderBy(PLACE)
        return Window.partitionBy(self.spec.key).orderBy(*self.spec.order)

    def first(self, column: str) -> Column:
        """First close of the instrument."""
        if self.blocked:
            return F.col(FIRST_CLOSE)
        whole_past = self.rows_so_far().rowsBetween(Window.unboundedPreceding, 0)
        return F.first(column).over(whole_past)

    def running_max(self, column: str) -> Column:
        """Largest close of the instrument up to the current bar."""
        whole_past = self.rows_so_far().rowsBetween(Window.unboundedPreceding, 0)
        top = F.max(column).over(whole_past)
        return F.greatest(top, F.col(TOP_BEFORE)) if self.blocked else top

    def settle(self, rows: DataFrame) -> DataFrame:
        """Drop lead-in rows once all ordered windows are computed."""
        if not self.blocked:
            return rows
        return rows.where(~F.col(LEAD_IN)).drop(PLACE, LEAD_IN, TOP_BEFORE, FIRST_CLOSE)

    def group_values(
        self,
        rows: DataFrame,
        whole: dict[str, tuple[Callable[[str], Column], str]],
        month: str | None = None,
        monthly: dict[str, Callable[[Over], Column]] | None = None,
    ) -> DataFrame:
        """Repeat aggregates of an instrument, and of its months, on all its rows.

        ``whole`` maps an output name to a function that can be applied to partial results
        (min, max) and its column; ``monthly`` maps names to functions that build a value from
        aggregates per ``month``, given how to apply each aggregate.

        A blocked instrument may be huge, so its aggregates are combined before the shuffle.
        What a block needs of them is gathered into one row per block, which joins back by
        (key, block).
        """
        key, monthly = self.spec.key, monthly or {}
        if not self.blocked:
            over_key = Window.partitionBy(key)
            rows = rows.withColumns({n: f(c).over(over_key) for n, (f, c) in whole.items()})
            if not monthly:
                return rows
            over_month = Window.partitionBy(key, month)
            return rows.withColumns(
                {n: build(lambda a: a.over(over_month)) for n, build in monthly.items()}
            )

        by = [key, month] if month else [key]
        rows = stage(rows, "hot-windows")  # read three times below
        totals = rows.groupBy(*by).agg(
            *[f(c).alias(n) for n, (f, c) in whole.items()],
            *[build(as_it_is).alias(n) for n, build in monthly.items()],
        )
        over_key = Window.partitionBy(key)
        totals = totals.withColumns({n: f(n).over(over_key) for n, (f, _) in whole.items()})
        members = rows.select(*by, BLOCK).distinct()
        found = _join_null_safe(members, totals, by)
        gathered = [F.any_value(n).alias(n) for n in whole]
        if monthly:
            entry = F.struct(F.col(month), F.struct(*monthly))
            entries = F.collect_list(F.when(F.col(month).isNotNull(), entry))
            gathered.append(F.map_from_entries(entries).alias("_months"))
        # Written, so that its size is known before the plan is made: small, it is broadcast and the
        # wide rows above are not shuffled for it.
        per_block = stage(found.groupBy(key, BLOCK).agg(*gathered), "hot-values")
        if self.null_key:
            joined = _join_null_safe(rows, per_block, [key, BLOCK])
        else:
            joined = rows.join(per_block, [key, BLOCK], "left")
        if not monthly:
            return joined
        values = F.col("_months")[F.col(month)]
        return joined.withColumns({n: values[n] for n in monthly}).drop("_months")


def _join_null_safe(rows: DataFrame, lookup: DataFrame, by: list[str]) -> DataFrame:
    renamed = lookup.withColumnsRenamed({c: f"_g_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by]
    return rows.join(renamed, same, "left").drop(*[f"_g_{c}" for c in by])


def with_counts(rows: DataFrame, key: str, policy: HeatPolicy = DEFAULT_HEAT) -> HeatPolicy:
    """The policy with hot keys and total filled in, by one count per key.

    One aggregate finds the largest count, and nothing more is done unless it exceeds the limit.
    The hot keys are then written to the work area, whatever their number; a cluster session
    without a shared folder fails here, before any other work.

    ``rows`` may be any frame that has at least as many rows per key as the bars themselves,
    such as the raw table the bars are built from. Counting is combined before the shuffle.
    """
    if isinstance(policy.known, HotKeys):
        return policy
    spark = rows.sparkSession
    if policy.known is not None:
        counts = policy.known
        if not counts:
            return replace(policy, known=HotKeys())
        kind = rows.schema[key].dataType.simpleString()
        table = spark.createDataFrame(list(counts.items()), f"`{key}` {kind}, count long")
        known = HotKeys(table, len(counts), sum(counts.values()), None in counts)
        return replace(policy, known=known)
    counted = rows.groupBy(key).count()
    total, largest = counted.agg(
        F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))
    ).first()
    if largest <= policy.max_rows_per_key:
        return replace(policy, known=HotKeys(), rows=total)
    table = stage(counted.where(F.col("count") > policy.max_rows_per_key), "hot-keys")
    keys, held, nulls = table.agg(
        F.count("*"), F.sum("count"), F.count_if(F.col(key).isNull())
    ).first()
    return replace(policy, known=HotKeys(table, keys, held, nulls > 0), rows=total)


def hot_keys(rows: DataFrame, key: str, policy: HeatPolicy = DEFAULT_HEAT) -> HotKeys:
    """Instruments with more rows than the policy allows in one task, with their counts."""
    return with_counts(rows, key, policy).known


def ordered_rows(
    rows: DataFrame, order: list[str], parts: int | None = None, copies: bool = True
) -> DataFrame:
    """Range-partition and sort so that no partition is large, whatever the key distribution.

    Rows that agree in all order columns, copies included, would stick together in a range
    partition. Where ``copies`` may be many, a row id splits them. It is taken after sorting
    each partition by all columns (a hash of them first, which is cheap to compare): a retried
    task then hands out the same ids up to identical rows, so nothing can be lost or doubled.
    Spark sorts before a round-robin repartition for the same reason.
    """
    total_order = _quoted(order)
    if copies:
        everything = _quoted(order + [c for c in rows.columns if c not in order])
        rows = rows.sortWithinPartitions(F.xxhash64(*everything), *everything)
        rows = rows.withColumn(PLACE, F.monotonically_increasing_id())
        total_order = [*everything, PLACE]
    spread = (
        rows.repartitionByRange(parts, *total_order) if parts else rows.repartitionByRange(*total_order)
    )
    return spread.sortWithinPartitions(*total_order).drop(PLACE)


def _quoted(names: list[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def _written_blocks(rows: DataFrame, spec: BarSpec, parts: int) -> DataFrame:
    """Hot rows in order, with their block and place.

    Written as they come first: a scan of files numbers its rows the same way in every
    attempt, so the number may serve as the last sort key and splits ties and copies. It
    also keeps the sampling of the range partitioning from computing the rows twice.
    """
    numbered = stage(rows, "hot-rows").withColumn(PLACE, F.monotonically_increasing_id())
    order = [*_quoted([spec.key, *spec.order]), PLACE]
    ordered = numbered.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = ordered.withColumns(
        {BLOCK: F.spark_partition_id(), PLACE: F.monotonically_increasing_id()}
    )
    return stage(placed, "hot-bars")


def _block_summary(blocks: DataFrame, spec: BarSpec) -> DataFrame:
    """One row per (key, block): position, carried values and the blocks it must feed.

    Bars without a close carry none.
    """
    close = F.col(spec.close) if spec.close in blocks.columns else F.lit(None).cast("double")
    whole_past = Window.partitionBy(spec.key).orderBy(BLOCK)
    before = whole_past.rowsBetween(Window.unboundedPreceding, -1)
    upto = whole_past.rowsBetween(Window.unboundedPreceding, 0)
    per_block = blocks.groupBy(spec.key, BLOCK).agg(
        F.min(PLACE).alias("_from"),
        F.max(PLACE).alias("_to"),
        F.max(close).alias("_top"),
        F.min_by(close, PLACE).alias("_open"),
    )
    size = F.col("_to") - F.col("_from") + 1
    return per_block.select(
        spec.key,
        BLOCK,
        "_from",
        "_to",
        F.coalesce(F.sum(size).over(before), F.lit(0)).alias("_start"),
        F.sum(size).over(upto).alias("_end"),
        F.max("_top").over(before).alias(TOP_BEFORE),
        F.first("_open").over(upto).alias(FIRST_CLOSE),
    )


def _lead_in_rows(
    blocks: DataFrame, summary: DataFrame, spec: BarSpec, lookback: int, null_key: bool
) -> DataFrame:
    """The last ``lookback`` rows in front of each block, tagged with that block.

    A short block may need rows from several earlier ones, so each block lists the later
    blocks that begin within ``lookback`` rows of its end. There are at most that many.
    Lead-in rows only feed windows over close and volume and are dropped afterwards, so their
    other columns stay empty and are not read.
    """
    by_end = Window.partitionBy("_k").orderBy("_end")
    reach = (
        summary.select(
            F.col(spec.key).alias("_k"),
            F.col(BLOCK).alias("_b"),
            "_from",
            "_to",
            "_start",
            "_end",
            F.struct(F.col(BLOCK).alias("block"), F.col("_start").alias("start")).alias("_here"),
        )
        .withColumn("_next", F.lead("_here").over(by_end))
        .withColumn("_feeds", F.collect_list("_next").over(by_end.rangeBetween(0, lookback - 1)))
        .where(F.size("_feeds") > 0)
        .drop("_here", "_next", "_end")
    )
    at_the_end = F.col(PLACE) > F.col("_to") - lookback
    here = _same_block(spec, null_key)
    tails = blocks.join(reach, here & at_the_end)
    position = F.col("_start") + F.col(PLACE) - F.col("_from")
    read = {spec.key, spec.close, spec.volume, BLOCK, PLACE}

    def or_empty(field) -> Column:
        if field.name in read:
            return F.col(f"`{field.name}`")
        return F.lit(None).cast(field.dataType).alias(field.name)

    return (
        tails.withColumn("_feed", F.explode("_feeds"))
        .where(position >= F.col("_feed.start") - lookback)
        .withColumn(BLOCK, F.col("_feed.block"))
        .select(*[or_empty(field) for field in blocks.schema])
    )


def _same_block(spec: BarSpec, null_key: bool) -> Column:
    """Join condition with a per-block table. A plain equality where possible, because that
    is what a shuffle by (key, block) serves."""
    key = F.col(spec.key)
    same_key = key.eqNullSafe(F.col("_k")) if null_key else key == F.col("_k")
    return same_key & (F.col(BLOCK) == F.col("_b"))


def _blocked(rows: DataFrame, spec: BarSpec, policy: HeatPolicy, hot: HotKeys, lookback: int) -> DataFrame:
    parts = max(1, ceil(hot.rows / policy.block_rows))
    blocks = _written_blocks(rows, spec, parts)
    summary = stage(_block_summary(blocks, spec), "hot-blocks")
    tagged = blocks.withColumn(LEAD_IN, F.lit(False))
    if lookback > 0:
        lead_in = _lead_in_rows(blocks, summary, spec, lookback, hot.null_key)
        tagged = tagged.unionByName(lead_in.withColumn(LEAD_IN, F.lit(True)))
    carried = summary.select(
        F.col(spec.key).alias("_k"), F.col(BLOCK).alias("_b"), TOP_BEFORE, FIRST_CLOSE
    )
    return tagged.join(carried, _same_block(spec, hot.null_key), "left").drop("_k", "_b")


def _spread(bars: DataFrame, key: str, policy: HeatPolicy) -> DataFrame:
    """Shuffle by instrument into enough partitions; the windows find their rows in place."""
    parts = tasks_for(bars.sparkSession, (policy.rows or 0) - policy.known.rows, policy.block_rows)
    return bars.repartition(parts, key) if parts else bars


def per_instrument(
    bars: DataFrame,
    spec: BarSpec,
    lookback: int,
    build: Callable[[DataFrame, Layout], DataFrame],
    policy: HeatPolicy = DEFAULT_HEAT,
) -> DataFrame:
    """Apply ``build`` to ordinary instruments as they are and to hot ones in blocks.

    ``build`` declares its windows through the layout it is given and looks back no further
    than ``lookback`` rows other than through the layout's own running aggregates.
    """
    policy = with_counts(bars, spec.key, policy)
    hot = policy.known
    plain = Layout(spec, blocked=False)
    if not hot.keys:
        return build(_spread(bars, spec.key, policy), plain)
    cool, heated = hot.split(bars, spec.key)
    ordinary = build(_spread(cool, spec.key, policy), plain)
    blocks = _blocked(heated, spec, policy, hot, lookback)
    in_blocks = build(blocks, Layout(spec, blocked=True, null_key=hot.null_key)).drop(BLOCK)
    return ordinary.unionByName(in_blocks)

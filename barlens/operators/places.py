"""Places of rows in a total order, without a window over more than one task's rows."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlens.session import stage

_ROW, _PLACED, _PART, _START = "_row", "_placed", "_part", "_start"
# ``monotonically_increasing_id`` counts from the partition number times 2 to this power.
_PART_BITS = 33


def with_places(
    rows: DataFrame, order: Sequence[Column | str], name: str = "place", written: bool = False
) -> DataFrame:
    """Add the place (from 0) of every row when all rows are put in ``order``.

    The rows are range-partitioned, sorted and written; each task counts its own rows and the
    counts of the tasks, one number each, say where a task begins. Rows that agree in ``order``
    are told apart by their number in the files they were written to first, so that ties and
    copies of any number are split as well; which of them comes first is arbitrary, but the same
    in every attempt. ``written`` says that ``rows`` is a plain scan of files already.
    """
    numbered = (rows if written else stage(rows, "unplaced")).withColumn(
        _ROW, F.monotonically_increasing_id()
    )
    keys = [*order, F.col(_ROW)]
    spread = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(_ROW)
    placed = stage(spread.withColumn(_PLACED, F.monotonically_increasing_id()), "placed")
    return placed.join(
        _starts(placed, F.shiftright(_PLACED, _PART_BITS)),
        F.shiftright(_PLACED, _PART_BITS) == F.col(_PART),
    ).select(
        *[f"`{c}`" for c in rows.columns],
        (F.col(_PLACED) - F.shiftleft(_PART, _PART_BITS) + F.col(_START)).alias(name),
    )


def _starts(placed: DataFrame, part: Column) -> DataFrame:
    return running_starts(placed.groupBy(part.alias(_PART)).agg(F.count("*").alias("n")))


def running_starts(sizes: DataFrame, part: str = _PART, start: str = _START) -> DataFrame:
    """(part, start) from one (part, n) per task of a write: the sum of all earlier n."""
    found = sorted(tuple(row) for row in sizes.collect())
    starts = accumulate((n for _, n in found), initial=0)
    table = pa.table(
        {
            part: pa.array([p for p, _ in found], pa.int64()),
            start: pa.array([s for _, s in zip(found, starts)], pa.int64()),
        }
    )
    return sizes.sparkSession.createDataFrame(table)


def places_within(
    rows: DataFrame, group: Sequence[str], order: Sequence[Column | str], name: str = "place"
) -> DataFrame:
    """Add the place (from 0) of every row inside its group, groups of any size included.

    Rows are placed in the order (group, ``order``) as a whole; a group's first place is the
    smallest of its places, an aggregate that is combined before its shuffle.
    """
    firsts = [F.col(f"`{g}`").asc_nulls_first() for g in group]
    placed = with_places(rows, [*firsts, *order], name)
    keys = [F.col(f"`{g}`").alias(f"_group{i}") for i, g in enumerate(group)]
    starts = placed.groupBy(*keys).agg(F.min(name).alias(_START))
    same = [F.col(f"`{g}`").eqNullSafe(F.col(f"_group{i}")) for i, g in enumerate(group)]
    return placed.join(starts, same).select(
        *[f"`{c}`" for c in rows.columns], (F.col(name) - F.col(_START)).alias(name)
    )

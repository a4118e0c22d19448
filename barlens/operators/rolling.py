"""Moving averages over the last k rows."""

from __future__ import annotations

from functools import reduce
from math import gcd

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barlens.operators.exact import combined, multiples, quoted
from barlens.operators.heat import Layout
from barlens.operators.steps import Steps

METHODS = ("prefix", "frame", "stacked")


def moving_averages(
    layout: Layout, column: str, sizes: dict[str, int], method: str = "prefix"
) -> Steps:
    """One average per entry of ``sizes`` (output name -> rows, the current one included).

    Frames shrink at the start of an instrument and nulls are skipped, as in ``avg`` over a
    row frame. ``prefix`` (default) keeps exact running sums and takes the difference of two of
    them, so its cost does not depend on the length of the frame. The sum of a frame is exact up
    to its last rounding; NaN and infinities are counted apart, so they leave the average again
    when they leave the frame. Finite values from 2^60 in size, or windows of more than
    four million rows, can exceed the running sums, which raises. ``frame`` declares the plain row frame; Spark then re-adds every
    frame for each row. ``stacked`` sums a short frame once and adds up shifted copies of that
    sum. Both round in the order of adding, so averages of prices with many digits differ in their
    last bits between the methods, and so may labels that compare averages of nearly constant
    prices.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")
    window = layout.rows_so_far()
    if method == "prefix":
        return _by_running_sums(layout, column, sizes)
    base = _base_length(list(sizes.values()))
    if method == "frame" or base == max(sizes.values()):
        return Steps(first={n: F.avg(column).over(window.rowsBetween(1 - k, 0)) for n, k in sizes.items()})
    short = window.rowsBetween(1 - base, 0)
    total, seen = f"_sum_{column}", f"_seen_{column}"
    shifts = range(base, max(sizes.values()), base)
    shifted = {
        f"{name}_{rows}": F.coalesce(F.lag(name, rows).over(window), F.lit(0))
        for name in (total, seen)
        for rows in shifts
    }

    def stacked(name: str, size: int) -> Column:
        parts = [F.col(f"{name}_{rows}") for rows in range(base, size, base)]
        return reduce(lambda a, b: a + b, parts, F.coalesce(F.col(name), F.lit(0)))

    return Steps(
        first={total: F.sum(column).over(short), seen: F.count(column).over(short)},
        second=shifted,
        final={n: F.try_divide(stacked(total, k), stacked(seen, k)) for n, k in sizes.items()},
    )


# Running sums count multiples of these powers of two; a window of two million rows fits.
_POWERS = (20, -20, -60)
# NaN, positive and negative infinities are counted in one integer, this many bits apart.
_ODD_BITS = 21


def _by_running_sums(layout: Layout, column: str, sizes: dict[str, int]) -> Steps:
    window = layout.rows_so_far()
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    value = f"CAST({quoted(column)} AS DOUBLE)"
    kinds = ("isnan({0})", "{0} = double('Infinity')", "{0} = double('-Infinity')")
    odd = " ".join(
        f"WHEN {kind.format(value)} THEN {1 << _ODD_BITS * i}L" for i, kind in enumerate(kinds)
    )
    added = dict(zip("abc", multiples(value, _POWERS)))
    added |= {"odd": f"CASE {odd} END", "n": f"CASE WHEN {value} IS NOT NULL THEN 1L END"}
    now = {name: f"_{name}_{column}" for name in added}

    def average(rows: int) -> Column:
        inside = {
            name: f"(coalesce({quoted(run)}, 0L) - coalesce({quoted(f'{run}_{rows}')}, 0L))"
            for name, run in now.items()
        }
        nan, up, down = (
            f"(shiftright({inside['odd']}, {_ODD_BITS * i}) & {(1 << _ODD_BITS) - 1}L)" for i in range(3)
        )
        total = combined([inside[name] for name in "abc"], _POWERS)
        return F.expr(
            f"CASE WHEN {inside['odd']} = 0L THEN try_divide({total}, {inside['n']})"
            f" WHEN {nan} > 0L OR ({up} > 0L AND {down} > 0L) THEN double('NaN')"
            f" WHEN {up} > 0L THEN double('Infinity') ELSE double('-Infinity') END"
        )

    return Steps(
        first={now[name]: F.sum(F.expr(text)).over(so_far) for name, text in added.items()},
        second={
            f"{run}_{rows}": F.lag(run, rows).over(window)
            for rows in sorted(set(sizes.values()))
            for run in now.values()
        },
        final={name: average(rows) for name, rows in sizes.items()},
    )


def _base_length(sizes: list[int]) -> int:
    """Length of the short frame: the divisor of all sizes with the least work per row.

    A shifted copy costs about as much as a dozen additions inside a frame.
    """
    shared, longest = gcd(*sizes), max(sizes)
    divisors = [d for d in range(1, shared + 1) if shared % d == 0]
    return min(divisors, key=lambda d: d + 12 * (longest // d - 1))

"""Sums of doubles that come out the same in any order, and from which values can be taken away.

A double is cut into whole multiples of falling powers of two, which are added as 64-bit integers.
Such sums are exact, so they depend neither on the order of rows nor on how rows were grouped:
partial sums can be combined anywhere, and a sum over a frame is the difference of two running
sums. Digits below the last power are rounded, by value and not by place. NaN and infinities are
left out and counted apart.

Expressions are SQL text: they are long, and text is parsed in one step.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Over = Callable[[Column], Column]


def as_it_is(aggregate: Column) -> Column:
    return aggregate


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _double(value: float) -> str:
    return f"{value!r}D"


def multiples(value: str, powers: tuple[int, ...]) -> list[str]:
    """A finite double as whole multiples of the powers of two given, the largest first.

    Null for a null, NaN or an infinity. What the last power leaves is rounded to it.
    """
    out, before = [], None
    for power in powers:
        here = f"rint({value} * {_double(2.0**-power)})"
        rest = here if before is None else f"{here} - {before[0]} * {_double(2.0 ** (before[1] - power))}"
        out.append(f"CASE WHEN abs({value}) < double('Infinity') THEN CAST({rest} AS BIGINT) END")
        before = here, power
    return out


def combined(sums: list[str], powers: tuple[int, ...]) -> str:
    """The double that sums of multiples stand for, added from the smallest up."""
    text = ""
    for name, power in reversed(list(zip(sums, powers))):
        term = f"CAST({name} AS DOUBLE) * {_double(2.0**power)}"
        text = f"({text} + {term})" if text else term
    return text


# Multiples of 2^32 are kept as doubles, which add exactly up to 2^85; integers hold the rest.
_TOP, _POWERS = 32, (0, -32, -64, -96)
# A double this large has no digits left for the integers.
_WHOLE = _double(2.0**84)


def _sums(value: str, over: Over) -> dict[str, Column]:
    top = f"rint({value} * {_double(2.0**-_TOP)}) * {_double(2.0**_TOP)}"
    fits = f"abs({value}) < {_WHOLE}"
    finite = f"abs({value}) < double('Infinity')"
    out = {
        "top": over(F.sum(F.expr(f"CASE WHEN {fits} THEN {top} WHEN {finite} THEN {value} END")))
    }
    rest = f"(CASE WHEN {fits} THEN {value} - {top} WHEN {finite} THEN 0D END)"
    for power, text in zip(_POWERS, multiples(rest, _POWERS)):
        out[f"at{-power}"] = over(F.sum(F.expr(text)))
    return out


def _total(sums: Column, field: str) -> Column:
    names = [f"{field}_at{-power}" for power in _POWERS]
    scaled = None
    for name, power in reversed(list(zip(names, _POWERS))):
        term = sums[name].cast("double") * F.lit(2.0**power)
        scaled = term if scaled is None else scaled + term
    return scaled + sums[f"{field}_top"]


def _applied(build: Callable[[Column], Column], fields: dict[str, Column]) -> Column:
    """``build`` on a struct of the fields, which it may refer to often at no cost."""
    struct = F.struct(*[column.alias(name) for name, column in fields.items()])
    return F.transform(F.array(struct), build)[0]


def exact_sum(name: str, over: Over = as_it_is) -> Column:
    """The sum of the finite values of a double column; null if there is none.

    ``over`` makes it a window sum.
    """
    fields = {f"v_{k}": c for k, c in _sums(quoted(name), over).items()}
    return _applied(lambda sums: _total(sums, "v"), fields)


def sample_deviation(name: str, over: Over = as_it_is) -> Column:
    """The sample deviation of a double column; null below two values, NaN if a value or its square
    is not finite.

    It follows from exact sums of values and of rounded squares, so every order and grouping of
    the rows gives the same bits. Its relative error is a few units in the last place times
    (mean / deviation) squared; equal values have none.
    """
    value = quoted(name)
    square = f"({value} * {value})"
    fields = {
        **{f"v_{k}": c for k, c in _sums(value, over).items()},
        **{f"s_{k}": c for k, c in _sums(square, over).items()},
        "n": over(F.count(name)),
        "odd": over(F.count_if(F.expr(f"NOT abs({square}) < double('Infinity')"))),
        "low": over(F.min(name)),
        "high": over(F.max(name)),
    }

    def build(x: Column) -> Column:
        first, second, n = _total(x, "v"), _total(x, "s"), x["n"]
        spread = F.greatest(second - first * first / n, F.lit(0.0))
        return (
            F.when(n < 2, F.lit(None).cast("double"))
            .when(x["odd"] > 0, F.lit(float("nan")))
            .when(x["low"] == x["high"], F.lit(0.0))
            .otherwise(F.sqrt(spread / (n - 1)))
        )

    return _applied(build, fields)

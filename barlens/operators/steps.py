"""Columns computed in levels, so that many features share few window passes."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame


@dataclass(frozen=True)
class Steps:
    """Columns to add in order; each level may use those before it.

    ``first`` and ``second`` hold window expressions, ``final`` and ``labels`` plain ones.
    Columns whose name starts with an underscore are helpers and are dropped at the end.
    """

    first: dict[str, Column] = field(default_factory=dict)
    second: dict[str, Column] = field(default_factory=dict)
    final: dict[str, Column] = field(default_factory=dict)
    labels: dict[str, Column] = field(default_factory=dict)

    def __add__(self, other: Steps) -> Steps:
        return Steps(
            {**self.first, **other.first},
            {**self.second, **other.second},
            {**self.final, **other.final},
            {**self.labels, **other.labels},
        )


def apply_steps(rows: DataFrame, steps: Steps) -> DataFrame:
    levels = (steps.first, steps.second, steps.final, steps.labels)
    for level in levels:
        if level:
            rows = rows.withColumns(level)
    return rows.drop(*[name for level in levels for name in level if name.startswith("_")])

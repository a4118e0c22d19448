"""Attaching per-month values to bars by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlens.operators.heat import DEFAULT_HEAT, HeatPolicy, hot_keys


def attach(
    rows: DataFrame,
    lookup: DataFrame,
    by: Sequence[str] = ("ticker", "month"),
    policy: HeatPolicy = DEFAULT_HEAT,
) -> DataFrame:
    """Left join on ``by``, join columns first; null keys match nothing and stay out of it.

    Rows of hot keys are spread over as many salts as they fill blocks, and their few lookup
    rows are repeated once per salt. The salt is a hash of the row, so it spreads rows that lie
    together and a retried task gets it again.
    """
    by = list(by)
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in by])
    whole, broken = rows.where(complete), rows.where(~complete)
    hot = hot_keys(whole, by[0], policy)
    if hot.keys:
        cool, heated = hot.split(whole, by[0])
        joined = cool.join(lookup, by, "left").unionByName(_salted(heated, lookup, by, hot, policy))
    else:
        joined = whole.join(lookup, by, "left")
    return joined.unionByName(broken, allowMissingColumns=True)


def _salted(heated, lookup, by, hot, policy) -> DataFrame:
    salts = hot.table.select(by[0], F.ceil(F.col("count") / policy.block_rows).alias("_salts"))
    row = F.xxhash64(*[F.col(f"`{c}`") for c in heated.columns])
    salted = heated.join(salts, by[0]).withColumn("_salt", F.pmod(row, "_salts")).drop("_salts")
    repeated = lookup.join(salts, by[0]).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1))
    )
    return salted.join(repeated.drop("_salts"), [*by, "_salt"], "left").drop("_salt")

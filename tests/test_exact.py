"""Sums and deviations that do not depend on the order or grouping of rows."""

import math
import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barlens.operators import features
from barlens.operators.exact import exact_sum, sample_deviation
from barlens.operators.heat import HeatPolicy

PLAIN = HeatPolicy(known={})


def frame_of(spark, values, parts=3):
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "i int, v double").repartition(parts, "i")


def one(df, column):
    return df.agg(column.alias("out")).first().out


@pytest.mark.parametrize("scale", [1e-9, 1.0, 1e6, 1e15, 1e19])
def test_sum_is_the_exact_one(spark, scale):
    pick = random.Random(1)
    values = [pick.gauss(0, 1) * scale * 10 ** pick.randrange(-3, 4) for _ in range(500)]
    values += [-v for v in values[:100]] + [0.1, -0.1, 0.0, None]
    found = one(frame_of(spark, values), exact_sum("v"))
    assert found == pytest.approx(math.fsum(v for v in values if v is not None), rel=1e-15, abs=1e-26)
    pick.shuffle(values)
    assert one(frame_of(spark, values, 7), exact_sum("v")) == found


def test_sum_of_nothing_and_of_no_numbers(spark):
    assert one(frame_of(spark, [None, None]), exact_sum("v")) is None
    assert one(frame_of(spark, [float("nan"), float("inf"), 2.0]), exact_sum("v")) == 2.0


def test_values_can_be_taken_away_again(spark):
    """A huge value leaves no trace behind."""
    closes = [1e17, 0.1, 0.2, 0.3, 0.4]
    df = frame_of(spark, closes).select(
        F.lit("A").alias("ticker"), F.col("i").alias("time"), F.col("v").alias("Close"),
        F.lit(1.0).alias("Volume"),
    )
    out = features.trend_features(df, sizes={"a": 2, "b": 3}, heat=PLAIN).orderBy("time").collect()
    assert [r.a for r in out][2:] == [pytest.approx(x, rel=1e-15) for x in (0.15, 0.25, 0.35)]
    assert out[4].b == pytest.approx(0.3, rel=1e-15)


@pytest.mark.parametrize("mean, spread", [(0, 1), (0.01, 0.02), (3, 1e-3), (-1e5, 10)])
def test_deviation(spark, mean, spread):
    pick = random.Random(2)
    values = [pick.gauss(mean, spread) for _ in range(300)]
    found = one(frame_of(spark, values), sample_deviation("v"))
    close = 1e-15 * (1 + (mean / spread) ** 2) * 10
    assert found == pytest.approx(statistics.stdev(values), rel=close)
    pick.shuffle(values)
    assert one(frame_of(spark, values, 5), sample_deviation("v")) == found
    over = frame_of(spark, values, 2).select(
        sample_deviation("v", lambda a: a.over(Window.partitionBy(F.lit(1)))).alias("out")
    )
    assert {r.out for r in over.collect()} == {found}


@pytest.mark.parametrize(
    "values, expected",
    [
        ([], None), ([None], None), ([1.5], None), ([1.5, None], None), ([0.1] * 7, 0.0),
        ([1.0, float("nan")], "nan"), ([1.0, float("inf"), 2.0], "nan"), ([1e200, 1.0], "nan"),
    ],
)
def test_deviation_of_odd_values(spark, values, expected):
    found = one(frame_of(spark, values), sample_deviation("v"))
    assert math.isnan(found) if expected == "nan" else found == expected


def test_prefix_averages_equal_frames(spark):
    """On a price grid, with nulls, NaN and both infinities, whatever lies in the frame."""
    pick = random.Random(4)
    odd = (None, float("nan"), float("inf"), float("-inf"))
    closes = [pick.choice(odd) if pick.random() < 0.05 else pick.randrange(64, 6400) / 64 for _ in range(900)]
    df = frame_of(spark, closes).select(
        F.when(F.col("i") % 3 == 0, "A").otherwise("B").alias("ticker"), F.col("i").alias("time"),
        F.col("v").alias("Close"), F.lit(1.0).alias("Volume"),
    ).cache()
    sizes = {"a": 1, "b": 7, "c": 200}
    left, right = (
        features.trend_features(df, sizes=sizes, method=method, heat=PLAIN)
        .select("ticker", "time", *[F.col(n).cast("string").alias(n) for n in sizes], "trend")
        .orderBy("ticker", "time").collect()
        for method in ("prefix", "frame")
    )
    assert left == right


def test_prefix_averages_are_exact_on_many_digits(spark):
    pick = random.Random(5)
    closes = [pick.lognormvariate(3, 4) for _ in range(400)]
    df = frame_of(spark, closes).select(
        F.lit("A").alias("ticker"), F.col("i").alias("time"), F.col("v").alias("Close"),
        F.lit(1.0).alias("Volume"),
    )
    out = features.trend_features(df, sizes={"a": 50, "b": 200}, heat=PLAIN).orderBy("time").collect()
    for i, row in enumerate(out):
        frame = closes[max(0, i - 49) : i + 1]
        assert row.a == pytest.approx(math.fsum(frame) / len(frame), rel=1e-15)


def test_no_frame_is_added_up_again(spark):
    df = frame_of(spark, [1.0, 2.0]).select(
        F.lit("A").alias("ticker"), F.col("i").alias("time"), F.col("v").alias("Close")
    )
    text = features.trend_features(df, heat=PLAIN)._jdf.queryExecution().executedPlan().toString()
    assert "specifiedwindowframe(RowFrame, -199" not in text
    assert "-49" not in text and text.count("Sort [") == 1

"""Blocked windows must give what plain windows give, whatever the skew."""

import random

import pytest
from pyspark.sql import functions as F

from barlens.operators import features, heat
from barlens.operators.heat import HeatPolicy, hot_keys
from barlens.operators.lookup import attach
from barlens.plans.feature_table import feature_table
from barlens.schema import BarSpec

SPEC = BarSpec(tiebreak=("seq",))
PLAIN = HeatPolicy(known={})


def skewed(spark, seed, null_key=False, copies=0):
    """A hot instrument with ties in time, holes and NaN; ordinary ones; one null key."""
    pick = random.Random(seed)
    rows = []
    for ticker, size in (("HOT", 900), ("WARM", 260), ("A", 40), ("B", 1), (None if null_key else "N", 300)):
        day = 0
        for seq in range(size):
            day += pick.choice((0, 0, 1, 1, 2, 9))
            close = pick.choice((None, float("nan"))) if pick.random() < 0.02 else pick.randrange(64, 6400) / 64
            rows.append((ticker, day, close, float(pick.randrange(0, 50)), seq))
    rows += [("HOT", 400, 5.0, 1.0, 10_000)] * copies
    df = spark.createDataFrame(rows, "ticker string, day int, Close double, Volume double, seq int")
    return df.select(
        "ticker",
        F.expr("timestampadd(DAY, day, timestamp '2020-01-01')").alias("time"),
        "Close", "Volume", "seq",
    ).repartition(5, "seq")


def listed(hot):
    return {row["ticker"]: row["count"] for row in hot.table.collect()}


def assert_same(left, right):
    text = lambda df: df.select([F.col(f"`{c}`").cast("string").alias(c) for c in sorted(df.columns)])
    left, right = text(left), text(right)
    assert left.exceptAll(right).count() == 0
    assert right.exceptAll(left).count() == 0


@pytest.mark.parametrize("seed, block, broadcast", [(1, 37, True), (2, 150, False), (3, 450, True), (4, 5000, True)])
def test_feature_table_in_blocks(spark, request, seed, block, broadcast):
    if not broadcast:
        limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit))
    data = skewed(spark, seed).cache()
    heat_policy = HeatPolicy(max_rows_per_key=200, block_rows=block)
    assert set(listed(hot_keys(data, "ticker", heat_policy))) == {"HOT", "WARM", "N"}
    blocked = feature_table(data, SPEC, heat=heat_policy)
    plain = feature_table(data, SPEC, heat=PLAIN)
    rounded = F.round("monthly_volatility", 9)
    assert_same(
        blocked.withColumn("monthly_volatility", rounded), plain.withColumn("monthly_volatility", rounded)
    )


def test_blocks_with_null_key(spark):
    data = skewed(spark, 5, null_key=True)
    policy = HeatPolicy(max_rows_per_key=200, block_rows=64)
    assert hot_keys(data, "ticker", policy).null_key
    blocked, plain = feature_table(data, SPEC, heat=policy), feature_table(data, SPEC, heat=PLAIN)
    assert blocked.count() == data.count()
    drop = "monthly_volatility"
    assert_same(blocked.drop(drop, "market_regime"), plain.drop(drop, "market_regime"))


def test_identical_copies_are_split_over_blocks(spark):
    data = skewed(spark, 6, copies=2000).cache()
    policy = HeatPolicy(max_rows_per_key=1000, block_rows=200)
    hot = listed(hot_keys(data, "ticker", policy))
    blocks = heat._written_blocks(data.where("ticker = 'HOT'"), SPEC, 15)
    sizes = [r[1] for r in blocks.groupBy(heat.BLOCK).count().collect()]
    assert sum(sizes) == hot["HOT"] == 2900
    assert max(sizes) < 900
    rounded = F.round("monthly_volatility", 9)
    assert_same(
        feature_table(data, SPEC, heat=policy).withColumn("monthly_volatility", rounded),
        feature_table(data, SPEC, heat=PLAIN).withColumn("monthly_volatility", rounded),
    )


@pytest.mark.parametrize(
    "build",
    [features.trend_features, features.return_features, features.drawdown_features, features.volume_features],
)
def test_single_features_in_blocks(spark, build):
    data = skewed(spark, 7).cache()
    policy = HeatPolicy(max_rows_per_key=100, block_rows=90)
    assert_same(build(data, SPEC, heat=policy), build(data, SPEC, heat=PLAIN))


def test_monthly_volatility_in_blocks(spark):
    data = skewed(spark, 8).cache()
    policy = HeatPolicy(max_rows_per_key=100, block_rows=90)
    rounded = F.round("monthly_volatility", 9).alias("v")
    assert_same(
        features.monthly_volatility(data, SPEC, policy).select("ticker", "month", rounded),
        features.monthly_volatility(data, SPEC, PLAIN).select("ticker", "month", rounded),
    )


@pytest.mark.parametrize("seed, block", [(21, 100), (22, 37), (23, 400)])
def test_blocked_values_are_bit_equal(spark, seed, block):
    """Prices of many digits, nothing rounded: averages, deviations and regimes."""
    data = skewed(spark, seed).withColumn("Close", F.col("Close") * F.lit(0.1234567891)).cache()
    policy = HeatPolicy(max_rows_per_key=100, block_rows=block)
    assert_same(feature_table(data, SPEC, heat=policy), feature_table(data, SPEC, heat=PLAIN))
    assert_same(
        features.monthly_volatility(data, SPEC, policy), features.monthly_volatility(data, SPEC, PLAIN)
    )


def test_attach_with_salted_hot_keys(spark):
    data = skewed(spark, 9, null_key=True).withColumn("month", F.date_format("time", "yyyy-MM")).cache()
    monthly = data.groupBy("ticker", "month").agg(F.count("*").alias("bars"))
    policy = HeatPolicy(max_rows_per_key=200, block_rows=100)
    assert_same(attach(data, monthly, policy=policy), data.join(monthly, ["ticker", "month"], "left"))


def test_result_does_not_depend_on_input_order(spark):
    data = skewed(spark, 10).cache()
    again = data.orderBy(F.rand(3)).repartition(3)
    policy = HeatPolicy(max_rows_per_key=200, block_rows=100)
    rounded = F.round("monthly_volatility", 9)
    assert_same(
        feature_table(data, SPEC, heat=policy).withColumn("monthly_volatility", rounded),
        feature_table(again, SPEC, heat=policy).withColumn("monthly_volatility", rounded),
    )


def test_every_key_above_the_limit_is_split(spark):
    rows = spark.range(5000 * 3).select(
        F.concat(F.lit("k"), F.col("id") % 5000).alias("ticker"),
        F.expr("timestampadd(DAY, int(id / 5000), timestamp '2020-01-01')").alias("time"),
        F.col("id").cast("double").alias("Close"), F.lit(1.0).alias("Volume"), F.col("id").alias("seq"),
    )
    policy = HeatPolicy(max_rows_per_key=2, block_rows=1000)
    hot = hot_keys(rows, "ticker", policy)
    assert (hot.keys, hot.rows) == (5000, 15000)
    cool, heated = hot.split(rows, "ticker")
    assert (cool.count(), heated.count()) == (0, 15000)
    assert_same(
        features.return_features(rows, SPEC, heat=policy), features.return_features(rows, SPEC, heat=PLAIN)
    )


def test_volume_in_blocks_without_close(spark):
    data = skewed(spark, 12).drop("Close").cache()
    policy = HeatPolicy(max_rows_per_key=100, block_rows=90)
    assert_same(
        features.volume_features(data, SPEC, heat=policy), features.volume_features(data, SPEC, heat=PLAIN)
    )


def test_salts_spread_rows_that_lie_together(spark):
    rows = spark.range(1000).select(
        F.lit("HOT").alias("ticker"), F.lit("2024-01").alias("month"), "id"
    ).repartition(1)
    lookup = spark.createDataFrame([("HOT", "2024-01", 7)], "ticker string, month string, v int")
    policy = HeatPolicy(max_rows_per_key=10, block_rows=100)
    hot = hot_keys(rows, "ticker", policy)
    from barlens.operators.lookup import _salted

    assert _salted(rows, lookup, ["ticker", "month"], hot, policy).where("v = 7").count() == 1000
    salts = hot.table.select(F.ceil(F.col("count") / 100)).first()[0]
    spread = rows.groupBy(F.pmod(F.xxhash64(*rows.columns), F.lit(salts))).count().collect()
    assert len(spread) == 10 and max(r["count"] for r in spread) < 300

import math

import pytest
from conftest import column
from pyspark.sql import functions as F

from barlens.functions.rules import RegimeLimits, regime_label
from barlens.operators import features
from barlens.plans.feature_table import feature_documents, feature_table, publish_features


def close_to(values, expected):
    assert len(values) == len(expected)
    for got, want in zip(values, expected):
        assert (got is None) == (want is None)
        if want is not None:
            assert got == pytest.approx(want, abs=1e-9)


def test_returns(series):
    out = features.return_features(series([100.0, 110.0, 99.0]))
    close_to(column(out, "daily_return"), [None, 0.10, -0.10])
    close_to(column(out, "cumulative_return"), [0.0, 0.10, -0.01])
    assert column(out, "return_30d") == [None] * 3


def test_lags_count_rows_not_days(bars):
    rows = [("A", f"{2000 + i}-01-01", float(i + 1)) for i in range(31)]
    out = features.return_features(bars(*rows))
    assert column(out, "return_30d")[-1] == pytest.approx(30.0)


def test_null_first_close_leaves_no_cumulative_return(series):
    out = features.return_features(series([None, 110.0, 99.0]))
    assert column(out, "cumulative_return") == [None] * 3


def test_drawdown(series):
    out = features.drawdown_features(series([100.0, 120.0, 90.0, 130.0]))
    close_to(column(out, "drawdown"), [0.0, 0.0, -0.25, 0.0])
    assert column(out, "max_drawdown") == [-0.25] * 4


@pytest.mark.parametrize("method", ["prefix", "stacked", "frame"])
def test_trend_warm_up(series, method):
    out = features.trend_features(series([100.1] * 49 + [7.3]), method=method)
    assert set(column(out, "trend")) == {"sideway"}
    assert set(column(out, "trend_strength")) == {0.0}
    out = features.trend_features(series([100.0] * 50 + [200.0]), method=method)
    last = out.orderBy(F.desc("time")).first()
    assert (last.ma50, last.trend) == (102.0, "up")
    assert last.ma200 == pytest.approx(5200 / 51)


@pytest.mark.parametrize("method", ["prefix", "stacked", "frame"])
def test_averages_skip_null_and_recover_from_nan(series, method):
    sizes = {"short": 2, "long": 4}
    closes = [math.nan, 1.0, None, 3.0, None, None, 5.0, 6.0]
    out = features.trend_features(series(closes), sizes=sizes, method=method)
    short, long = column(out, "short"), column(out, "long")
    assert math.isnan(short[0]) and math.isnan(short[1])
    assert short[2:] == [1.0, 3.0, 3.0, None, 5.0, 5.5]
    assert all(math.isnan(v) for v in long[:4])
    assert long[4:] == [2.0, 3.0, 4.0, 5.5]


@pytest.mark.parametrize("sizes", [{"a": 50, "b": 100, "c": 200}, {"a": 7, "b": 11}, {"a": 6, "b": 60}])
def test_stacked_equals_frame(series, sizes):
    closes = [None if i % 13 == 0 else math.floor(1000 * math.sin(i) ** 2) / 64 for i in range(450)]
    stacked = features.trend_features(series(closes), sizes=sizes, method="stacked")
    frame = features.trend_features(series(closes), sizes=sizes)
    assert stacked.exceptAll(frame).count() == 0 and frame.exceptAll(stacked).count() == 0


def test_running_maximum_stays_nan(series):
    out = features.drawdown_features(series([math.nan, 1.0, 3.0]))
    assert all(math.isnan(v) for v in column(out, "drawdown"))


def test_volume(bars):
    out = features.volume_features(bars(("A", "2024-01-01", 1.0, 10.0), ("A", "2024-01-02", 1.0, 30.0)))
    assert column(out, "volume_ma20") == [10.0, 20.0]
    assert column(out, "volume_ratio") == [1.0, 1.5]


def test_division_by_zero_gives_null(bars):
    out = features.volume_features(bars(("A", "2024-01-01", 0.0, 0.0), ("A", "2024-01-02", 1.0, 0.0)))
    assert column(out, "volume_ratio") == [None, None]
    assert column(features.return_features(out), "daily_return") == [None, None]


def test_months(bars):
    rows = [("A", "2024-01-30", 100.0), ("A", "2024-01-31", 110.0), ("A", "2024-02-01", 121.0)]
    returns = features.monthly_returns(bars(*rows))
    close_to(column(returns, "monthly_return", "month"), [0.10, 0.0])
    assert column(features.monthly_volatility(bars(*rows)), "monthly_volatility", "month") == [None, None]
    rows.append(("A", "2024-02-02", 121.0))
    close_to(
        column(features.monthly_volatility(bars(*rows)), "monthly_volatility", "month"),
        [None, math.sqrt(0.005)],
    )


def test_monthly_return_keeps_null_ends(bars):
    out = features.monthly_returns(bars(("A", "2024-01-01", None), ("A", "2024-01-02", 2.0)))
    assert column(out, "monthly_return", "month") == [None]


@pytest.mark.parametrize(
    "fast, slow, volatility, label",
    [
        (2.0, 1.0, 0.01, "bull"), (2.0, 1.0, 0.02, "normal"), (2.0, 1.0, 0.04, "normal"),
        (2.0, 1.0, 0.06, "high_vol"), (1.0, 2.0, 0.01, "normal"), (1.0, 2.0, 0.03, "normal"),
        (1.0, 2.0, 0.04, "bear"), (1.0, 2.0, 0.06, "bear"), (1.0, 1.0, 0.05, "normal"),
        (1.0, 1.0, 0.06, "high_vol"), (2.0, 1.0, None, "normal"),
    ],
)
def test_regime(spark, fast, slow, volatility, label):
    df = spark.createDataFrame([(fast, slow, volatility)], "f double, s double, v double")
    got = df.select(regime_label(F.col("f"), F.col("s"), F.col("v"), RegimeLimits())).first()[0]
    assert got == label


def test_feature_table_shape_and_properties(bars):
    rows = [
        (t, f"2024-{1 + i // 28:02d}-{1 + i % 28:02d}", 50 + (i * k) % 17 + 0.25, float(i % 5))
        for k, t in enumerate(["A", "B", "C"], 3)
        for i in range(150)
    ]
    data = bars(*rows)
    table = feature_table(data).cache()
    assert table.count() == data.count()
    assert table.columns[:2] == ["ticker", "month"]
    assert table.where("drawdown > 0").count() == 0
    worst = table.groupBy("ticker").agg(F.min("drawdown").alias("w"), F.max("max_drawdown").alias("m"))
    assert worst.where("w <> m").count() == 0
    for ticker in "ABC":
        one = table.where(F.col("ticker") == ticker)
        grown = 1.0
        for daily, total in zip(column(one, "daily_return"), column(one, "cumulative_return")):
            grown *= 1 + (daily or 0.0)
            assert total == pytest.approx(grown - 1, abs=1e-9)
    joined = data.withColumn("month", F.date_format("time", "yyyy-MM")).join(
        features.monthly_volatility(data), ["ticker", "month"], "left"
    )
    same = joined.select("ticker", "time", F.round("monthly_volatility", 12).alias("v"))
    ours = table.select("ticker", "time", F.round("monthly_volatility", 12).alias("v"))
    assert same.exceptAll(ours).count() == 0


def test_rows_without_ticker_or_time_stay_and_get_no_volatility(bars):
    rows = [(None, f"2024-01-0{i}", 1.0 * i) for i in range(1, 5)] + [("A", None, 5.0), ("A", "2024-01-01", 6.0)]
    table = feature_table(bars(*rows))
    assert table.count() == 6
    assert table.where("ticker is null or time is null").where("monthly_volatility is not null").count() == 0


def test_documents_are_complete_rows_with_ids(series):
    closes = [100.0 + (i * 7) % 13 for i in range(100)]
    docs = feature_documents(feature_table(series(closes)))
    # Ninety earlier bars are needed; the last two days begin a month with enough returns.
    assert column(docs, "doc_id")[0] == "A_20240331000000"
    assert docs.count() == 10
    assert feature_documents(feature_table(series(closes)), required=["Close"]).count() == 100


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_publish_writes_table_and_documents(spark, series, tmp_path, fmt):
    data = series([100.0 + (i * 7) % 13 for i in range(100)])
    table, docs = str(tmp_path / "table"), str(tmp_path / "docs")
    for _ in range(2):
        publish_features(data, table, docs, fmt=fmt)
    assert spark.read.format(fmt).load(table).count() == 100
    assert spark.read.parquet(docs).count() == 10

"""Shapes of physical plans."""

import pytest

from barlens.operators.features import return_features
from barlens.operators.heat import HeatPolicy, HotKeys, with_counts
from barlens.operators.windows import window_metrics
from barlens.plans.feature_table import feature_table
from barlens.sample.inputs import bars_from_lineitem
from barlens.sample.queries import bars_and_heat
from barlens.session import tasks_for
from barlens.sources.bars import latest_per_key, range_filter, tickers_in
from barlens.sources.streams import EVENT, stamp_clock

PLAIN = HeatPolicy(known={})


@pytest.fixture
def stored(spark, tmp_path, series):
    path = str(tmp_path / "bars")
    series([float(i) for i in range(40)]).write.parquet(path)
    return spark.read.parquet(path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_table_needs_one_shuffle_and_one_sort(stored):
    text = plan(feature_table(stored, heat=PLAIN))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Exchange") == 1
    assert text.count("Sort [") == 1
    assert text.count("FileScan") == 1
    assert "Python" not in text and "Join" not in text


def test_only_needed_columns_are_read(stored):
    text = plan(return_features(stored.select("ticker", "time", "Close"), heat=PLAIN))
    assert "ReadSchema: struct<ticker:string,time:timestamp,Close:double>" in text


def test_selections_reach_the_scan(stored):
    text = plan(range_filter(tickers_in(stored, "A,B"), "2024-01-03", "2024-01-05"))
    assert "GreaterThanOrEqual(time,2024-01-03" in text and "LessThan(tim" in text
    assert "In(ticker, [A,B])" in text


def test_latest_bar_is_combined_before_the_shuffle(stored):
    text = plan(latest_per_key(stored))
    assert "partial_max(" in text and "Window" not in text


def test_window_metrics_are_combined_before_the_shuffle(stored, spark):
    from pyspark.sql import functions as F

    rows = stored.select(
        "ticker", F.lit("x").alias("company"), F.col("time").cast("string").alias("time"),
        *[F.col("Close").alias(c) for c in ("Open", "High", "Low", "Close")], "Volume",
    )
    text = plan(window_metrics(stamp_clock(rows, EVENT)))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text
    assert "SortAggregate" not in text


def test_daily_bars_are_hashed_not_sorted(spark):
    text = plan(bars_from_lineitem(spark, "/root/testdata/sf0.001"))
    assert "HashAggregate" in text and "SortAggregate" not in text and "Sort [" not in text


def test_no_table_is_written_where_no_key_is_hot(stored, monkeypatch):
    monkeypatch.setattr("barlens.operators.heat.stage", None)
    assert with_counts(stored, "ticker").known.keys == 0


def test_large_inputs_state_their_partitions(stored):
    text = plan(feature_table(stored, heat=HeatPolicy(known={}, rows=70_000_000)))
    assert "Exchange hashpartitioning(ticker" in text and ", 70)" in text
    assert text.count("Exchange") == 1


def test_counting_fills_in_the_policy(stored):
    counted = with_counts(stored, "ticker", HeatPolicy(max_rows_per_key=30))
    assert [tuple(row) for row in counted.known.table.collect()] == [("A", 40)]
    assert (counted.known.keys, counted.known.rows, counted.rows) == (1, 40, 40)
    assert with_counts(stored.limit(0), "ticker").rows == 0


def test_tasks_follow_the_rows(spark):
    assert tasks_for(spark, 1000) is None
    assert tasks_for(spark, 1000, 10) == 100


def test_lines_are_shuffled_once_for_bars_and_features(spark):
    bars, heat = bars_and_heat(spark, "/root/testdata/sf0.001", company=True)
    text = plan(feature_table(bars, heat=heat))
    assert text.count("Exchange hashpartitioning") == 1


def test_lines_of_hot_suppliers_are_not_dealt_by_supplier(spark):
    hot = HeatPolicy(known=HotKeys(spark.createDataFrame([("1", 9)], "ticker string, count long"), 1, 9), rows=9)
    text = plan(bars_from_lineitem(spark, "/root/testdata/sf0.001", heat=hot))
    assert "REPARTITION" not in text and "partial_min" in text


def test_tasks_of_bars_follow_the_lines(spark):
    many = HeatPolicy(known=HotKeys(), rows=30_000_000)
    text = plan(bars_from_lineitem(spark, "/root/testdata/sf0.001", heat=many))
    assert "hashpartitioning(ticker" in text and ", 64)" in text

from datetime import datetime

import pytest
from conftest import column
from pyspark.sql import functions as F

from barlens.operators.merge import only_partitions
from barlens.schema import BarSpec
from barlens.session import Staging, work_folder
from barlens.sinks.tables import index_options
from barlens.sources import bars as src
from barlens.sources.streams import kafka_options


def test_latest_bar_keeps_whole_rows(bars):
    data = bars(("A", "2024-01-01", 1.0), ("A", "2024-01-03", None), ("B", "2024-01-02", 2.0))
    out = src.latest_per_key(data)
    assert column(out, "Close", "ticker") == [None, 2.0]
    assert out.columns == data.columns


def test_latest_bar_breaks_ties(bars):
    data = bars(("A", "2024-01-01", 1.0, 5.0), ("A", "2024-01-01", 2.0, 4.0))
    assert src.latest_per_key(data, BarSpec(tiebreak=("Volume",))).first().Close == 1.0


def test_range_is_half_open(series):
    data = series([float(i) for i in range(10)])
    assert column(src.range_filter(data, start="2024-01-03", end="2024-01-05"), "Close") == [2.0, 3.0]
    assert column(src.range_filter(data, end="2024-01-05", days=2), "Close") == [2.0, 3.0]
    assert src.range_filter(data, days=1, now=datetime(2024, 1, 2)).count() == 1
    for wrong in ({}, {"start": "2024-01-01", "days": 3}):
        with pytest.raises(ValueError):
            src.range_filter(data, end="2024-01-05", **wrong)


def test_range_bounds_with_time():
    assert src.time_bounds("2024-01-02 09:30", "2024-01-03") == (datetime(2024, 1, 2, 9, 30), datetime(2024, 1, 3))


def test_tickers(bars):
    data = bars(("A", "2024-01-01", 1.0), ("B", "2024-01-01", 1.0), ("C", "2024-01-01", 1.0))
    assert column(src.tickers_in(data, " A, C "), "ticker", "ticker") == ["A", "C"]
    assert column(src.tickers_in(data, ["B"]), "ticker") == ["B"]


def test_union_fills_missing_columns(series):
    out = src.union_bars([series([1.0]), series([2.0], "B").drop("Volume")])
    assert column(out, "Volume", "ticker") == [1.0, None]


def test_envelope_range_includes_both_ends(spark):
    rows = spark.range(5).select(F.expr("timestampadd(HOUR, id, timestamp '2024-01-01')").alias("timestamp"))
    start, end = src.lookback_range(2, datetime(2024, 1, 1, 3))
    assert src.envelope_range(rows, start, end).count() == 3


def test_connector_options():
    options = src.kafka_range_options(datetime(2024, 1, 1), datetime(2024, 1, 2))
    assert int(options["endingTimestamp"]) - int(options["startingTimestamp"]) == 86_400_001
    assert kafka_options("h:1", "t", fail_on_data_loss=False)["failOnDataLoss"] == "false"
    assert index_options("h", 9200, "docs")["es.mapping.id"] == "doc_id"


def test_only_touched_partitions(spark):
    stored = spark.range(10).select("id", (F.col("id") % 5).alias("p"))
    changed = spark.createDataFrame([(1,), (3,), (3,)], "p long")
    assert column(only_partitions(stored, changed, "p"), "id", "id") == [1, 3, 6, 8]
    holes = stored.withColumn("p", F.when(F.col("p") > 0, F.col("p")))
    unknown = spark.createDataFrame([(None,), (1,)], "p long")
    assert column(only_partitions(holes, unknown, "p"), "id", "id") == [0, 1, 5, 6]


def test_work_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    folder = work_folder(spark, "x")
    assert folder != work_folder(spark, "x")
    if root:
        assert folder.startswith(root.rstrip("/"))


def test_staging_removes_its_tables(spark, tmp_path):
    with Staging(spark, "t") as staging:
        staging._folder = str(tmp_path / "stage")
        assert staging.hold(spark.range(3).toDF("x"), "one").count() == 3
        assert (tmp_path / "stage" / "one").exists()
    assert not (tmp_path / "stage").exists()

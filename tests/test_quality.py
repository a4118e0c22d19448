import json
import math
from datetime import date, datetime

import pytest
from conftest import column
from pyspark.sql import functions as F

from barlens.functions import quality
from barlens.plans.archive import archivable
from barlens.sinks.messages import to_messages
from barlens.sources.bars import label_bars, read_bars

GOOD = {
    "ticker": "A", "company": "Äpfel GmbH", "time": "2024-01-02 09:30:00-05:00",
    "Open": 1.5, "High": 2.0, "Low": 1.0, "Close": 1.75, "Volume": 12.9,
}


@pytest.fixture
def messages(spark):
    def build(*payloads):
        rows = [
            (i, bytearray((p if isinstance(p, str) else json.dumps(p, ensure_ascii=False)).encode()))
            for i, p in enumerate(payloads)
        ]
        return spark.createDataFrame(rows, "id int, value binary")

    return build


def without(*names):
    return {k: v for k, v in GOOD.items() if k not in names}


def test_decode(messages):
    rows = quality.decode(messages(GOOD, "{broken", {**GOOD, "Close": "x"}), keep=["id"]).orderBy("id").collect()
    assert (rows[0].company, rows[0].Close, rows[0]["Adj Close"]) == ("Äpfel GmbH", 1.75, None)
    assert rows[1][:9] == (None,) * 9
    assert rows[2].Close is None and rows[2].Open == 1.5


def test_missing_fields(messages):
    sample = messages(GOOD, {"ticker": "A", "time": "t", "Open": None}, "{broken", "[1]")
    out = quality.with_validity(sample).orderBy("id").collect()
    assert (out[0].is_valid, out[0].missing) == (True, [])
    assert (out[1].is_valid, out[1].missing) == (False, ["High", "Low", "Close", "Volume"])
    assert not out[2].is_valid and "ticker" in out[2].missing
    assert not out[3].is_valid


def test_standardise(messages):
    sample = messages(
        GOOD, without("ticker", "company", "Volume"), {**GOOD, "Close": "x"}, {**GOOD, "company": None},
        {**GOOD, "Open": None}, "{broken", {**GOOD, "Adj Close": "7.5"}, {**GOOD, "Adj Close": None},
        {**GOOD, "Volume": 9007199254740993},
    )
    rows = quality.standardise(sample, keep=["id"]).orderBy("id").collect()
    assert rows[0].Volume == 12 and rows[0].problem is None and rows[0]["Adj Close"] is None
    assert (rows[1].ticker, rows[1].company, rows[1].Volume, rows[1].problem) == ("", None, 0, None)
    assert rows[2].problem == "Close"
    assert rows[3].company is None and rows[3].problem is None
    assert rows[4].problem == "Open"
    assert rows[5].problem == "bad_json"
    assert rows[6]["Adj Close"] == 7.5
    assert rows[7].problem == "Adj Close"
    assert rows[8].Volume == 9007199254740993


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-02 09:30:00-05:00", datetime(2024, 1, 2, 14, 30)),
        ("2024-01-02 09:30:00Z", datetime(2024, 1, 2, 9, 30)),
        ("2024-01-02 09:30:00", datetime(2024, 1, 2, 9, 30)),
        ("2024-01-02T09:30:00.125+01:00", datetime(2024, 1, 2, 8, 30, 0, 125000)),
        ("2024-01-02", datetime(2024, 1, 2)),
        ("2024-1-2 9:30:00+00:00", datetime(2024, 1, 2, 9, 30)),
        ("2024-13-40", None), ("junk", None), ("", None), (None, None),
    ],
)
def test_parse_time(spark, text, expected):
    df = spark.createDataFrame([(text,)], "time string")
    got = quality.parse_times(df).select(F.col("source_time").cast("timestamp_ntz")).first()[0]
    assert got == expected


def test_parse_bound(spark):
    df = spark.createDataFrame([("2024-01-02 09:30",), ("2024-01-02",), ("soon",)], "t string")
    got = [r[0] for r in df.select(quality.parse_bound(F.col("t")).cast("timestamp_ntz")).collect()]
    assert got == [datetime(2024, 1, 2, 9, 30), datetime(2024, 1, 2), None]


def test_steps_skip_absent_columns(spark):
    df = spark.createDataFrame([("1.5",)], "Close string")
    assert quality.parse_times(df).columns == ["Close"]
    assert quality.cast_prices(df).first().Close == 1.5
    assert quality.cast_prices(df, "float").schema["Close"].dataType.typeName() == "float"


def test_complete_rows_drop_null_and_nan(series):
    data = series([math.nan, 1.0, None, 3.0])
    assert column(quality.complete_rows(data, ["Close"]), "Close") == [1.0, 3.0]
    assert column(quality.nan_to_null(data), "Close") == [None, 1.0, None, 3.0]


def test_archivable_splits_and_dates_as_written(messages):
    late = {**GOOD, "time": "2024-01-01 22:00:00-05:00"}
    sample = messages(
        late, without("ticker"), {**GOOD, "time": ""}, {**GOOD, "time": "2024"}, {**GOOD, "time": "2024-02-31"}, "{"
    )
    good, bad = archivable(quality.decode(sample))
    assert [r.date for r in good.collect()] == [date(2024, 1, 1)]
    problems = sorted(r.problem for r in bad.collect())
    assert problems == ["bad_json", "bad_time", "bad_time", "bad_time", "no_ticker"]


def test_messages_keep_nulls_and_letters(spark):
    df = spark.createDataFrame([("A", "Äpfel", None)], "ticker string, company string, Close double")
    sent = to_messages(df).first()
    assert sent.key == "A"
    assert "Äpfel" in sent.value and json.loads(sent.value)["Close"] is None


def test_corrupt_line_is_isolated(spark, tmp_path):
    folder = tmp_path / "2024-01-02"
    folder.mkdir()
    lines = [json.dumps(GOOD), "{broken", json.dumps({**GOOD, "Close": math.nan})]
    (folder / "A.json").write_text("\n".join(lines))
    rows = read_bars(spark, str(tmp_path)).cache()
    assert rows.count() == 3
    assert rows.where("_corrupt_record is null").count() == 2
    assert math.isnan(rows.where("isnan(Close)").first().Close)


def test_label_bars(spark):
    prices = spark.createDataFrame([(date(2024, 1, 2), math.nan, 2.0)], "time date, Open double, Close double")
    row = label_bars(prices, "A", None).first()
    assert row.asDict() == {"ticker": "A", "company": None, "time": "2024-01-02", "Open": None, "Close": 2.0}


def test_label_bars_of_several_instruments(spark):
    prices = spark.createDataFrame(
        [("A", "Alpha", "t", 1.0), ("B", None, "t", math.nan)], "ticker string, name string, time string, Close double"
    )
    rows = label_bars(prices, F.col("ticker"), F.col("name")).drop("name").collect()
    assert sorted(tuple(r) for r in rows) == [("A", "Alpha", "t", 1.0), ("B", None, "t", None)]

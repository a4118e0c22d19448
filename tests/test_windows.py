from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barlens.functions.rules import AlertLimits
from barlens.operators.windows import bar_windows, move_alerts, window_metrics
from barlens.sources.streams import EVENT, PROCESSING, stamp_clock

T0 = datetime(2024, 1, 2, 9, 30)
COLUMNS = (
    "ticker string, company string, source_time timestamp, Open double, High double, Low double, "
    "Close double, Volume double"
)


@pytest.fixture
def ticks(spark):
    """Ticks from (second, open, close) or (ticker, company, second, open, high, low, close)."""

    def build(*rows, clock="timestamp"):
        full = []
        for row in rows:
            if len(row) == 3:
                second, opened, closed = row
                row = ("AAA", "Alpha", second, opened, closed, opened, closed)
            ticker, company, second, o, h, lo, c = row
            full.append((ticker, company, T0 + timedelta(seconds=second), o, h, lo, c, 2.0))
        return stamp_clock(spark.createDataFrame(full, COLUMNS), EVENT, clock)

    return build


def test_open_and_close_with_ties(ticks):
    row = bar_windows(ticks((1, 10.0, 11.0), (1, 9.0, 12.0), (2, 13.0, 14.0), (2, 15.0, 8.0))).first()
    assert (row.open_1m, row.close_1m, row.volume_sum_1m) == (9.0, 14.0, 8.0)


def test_null_open_wins_and_null_close_loses(ticks):
    row = bar_windows(ticks((1, 10.0, 11.0), (1, None, 12.0), (2, 13.0, None), (2, 15.0, 14.0))).first()
    assert (row.open_1m, row.close_1m) == (None, 14.0)


def test_windows_drop_rows_without_ticker(ticks):
    assert bar_windows(ticks((None, None, 1, 1.0, 1.0, 1.0, 1.0))).count() == 0


@pytest.mark.parametrize(
    "o, c, h, lo, expected",
    [
        (100.0, 101.0, 101.0, 100.0, ("return_pct", "up", 0.01)),
        (100.0, 98.0, 100.0, 98.0, ("return_pct", "down", 0.02)),
        (100.0, 100.5, 102.0, 100.0, ("range_pct", "up", 0.02)),
        (100.0, 99.5, 101.0, 99.0, ("range_pct", "down", 0.02)),
        (100.0, None, 102.0, 100.0, ("range_pct", "down", 0.02)),
        (100.0, 100.5, 101.0, 100.0, None),
        (0.0, 5.0, 9.0, 1.0, None),
        (None, 5.0, 9.0, 1.0, None),
    ],
)
def test_alerts(ticks, o, c, h, lo, expected):
    out = move_alerts(bar_windows(ticks(("AAA", "Alpha", 1, o, h, lo, c)))).collect()
    if expected is None:
        assert out == []
        return
    (row,) = out
    assert (row.alert_reason, row.direction) == expected[:2]
    assert row.alert_score == pytest.approx(expected[2])
    assert row.doc_id == f"AAA_202401020930_{row.alert_reason}_{row.direction}"


def test_alert_limits_are_parameters(ticks):
    rows = bar_windows(ticks(("AAA", "Alpha", 1, 100.0, 101.0, 100.0, 101.0)))
    assert move_alerts(rows, AlertLimits(0.02, 0.5)).count() == 0


def test_metrics(ticks):
    rows = ticks((1, 10.0, 11.0), (30, 9.0, 13.0), (61, 5.0, 5.0), clock="event_time")
    first, second = window_metrics(rows).orderBy("window_start").collect()
    assert (first.doc_id, second.doc_id) == ("AAA_202401020930", "AAA_202401020931")
    assert (first.avg_price, first.min_price, first.max_price) == (12.0, 9.0, 13.0)
    assert (first.total_volume, first.trade_count) == (4.0, 2)
    assert first.price_volatility == pytest.approx(2**0.5)
    assert second.price_volatility is None
    assert first["@timestamp"] == first.window_start
    assert first.window_end - first.window_start == timedelta(minutes=1)
    assert first.processed_time is not None


def test_undecodable_rows_form_a_group_on_request(ticks):
    rows = ticks((None, None, 1, None, None, None, None), (1, 1.0, 1.0), clock="event_time")
    assert window_metrics(rows).count() == 1
    ids = {r.doc_id for r in window_metrics(rows, drop_invalid=False).collect()}
    assert ids == {"202401020930", "AAA_202401020930"}


def test_company_can_be_part_of_the_id(ticks):
    rows = ticks(("A", "x", 1, 1.0, 1.0, 1.0, 1.0), ("A", "y", 1, 1.0, 1.0, 1.0, 1.0), clock="event_time")
    assert len({r.doc_id for r in window_metrics(rows).collect()}) == 1
    assert len({r.doc_id for r in window_metrics(rows, company_in_id=True).collect()}) == 2


def test_processing_clock_is_one_instant_per_batch(ticks):
    rows = stamp_clock(ticks((1, 1.0, 1.0), (500, 2.0, 2.0)).drop("timestamp"), PROCESSING, "timestamp")
    assert rows.select("timestamp").distinct().count() == 1
    assert rows.where(F.col("timestamp") < F.lit("2025-01-01")).count() == 0
    with pytest.raises(ValueError):
        stamp_clock(rows, "lunar")

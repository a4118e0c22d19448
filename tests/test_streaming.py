import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barlens.operators.windows import window_metrics
from barlens.schema import ENVELOPE_SCHEMA
from barlens.sources.streams import EVENT, read_stream
from barlens.streaming import jobs

T0 = datetime(2024, 1, 2, 9, 30)
RUN = {"availableNow": True}


def payload(second, close=1.0, ticker="AAA", opened=1.0):
    at = (T0 + timedelta(seconds=second)).strftime("%Y-%m-%d %H:%M:%S+00:00")
    return json.dumps(
        {"ticker": ticker, "company": "Alpha", "time": at, "Open": opened, "High": max(opened, close),
         "Low": min(opened, close), "Close": close, "Volume": 1.0}
    )


@pytest.fixture
def topic(spark, tmp_path):
    """A folder standing in for a topic; each call adds one batch of messages."""
    folder = str(tmp_path / "topic")

    def send(*values):
        rows = [
            (bytearray(b"AAA"), bytearray(v.encode()), [("h", bytearray(b"1"))], T0 + timedelta(hours=i))
            for i, v in enumerate(values)
        ]
        spark.createDataFrame(rows, ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    send.stream = lambda **o: read_stream(spark, "parquet", ENVELOPE_SCHEMA, folder, **o)
    return send


def metrics(spark, topic, tmp_path, **options):
    docs = jobs.metrics_stream(topic.stream(), EVENT)
    out = str(tmp_path / "out")
    jobs.start_upsert(docs, out, str(tmp_path / "state"), trigger=RUN, **options).awaitTermination()
    rows = spark.read.parquet(out).orderBy("window_start").collect()
    return {r.doc_id[-4:]: r.trade_count for r in rows}


def test_windows_close_once_and_late_rows_are_dropped(spark, topic, tmp_path):
    topic(payload(10), payload(50), payload(70), payload(610))
    assert metrics(spark, topic, tmp_path) == {"0930": 2, "0931": 1}
    topic(payload(20), payload(800))
    assert metrics(spark, topic, tmp_path) == {"0930": 2, "0931": 1, "0940": 1}


def test_restart_without_new_data_changes_nothing(spark, topic, tmp_path):
    topic(payload(10), payload(610))
    before = metrics(spark, topic, tmp_path)
    assert metrics(spark, topic, tmp_path) == before == {"0930": 1}


def test_stream_equals_batch_of_closed_windows(spark, topic, tmp_path):
    seconds = [7 * i % 900 for i in range(200)]
    for start in range(0, 200, 50):
        topic(*[payload(s, close=float(s)) for s in sorted(seconds[start : start + 50])])
    docs = jobs.metrics_stream(topic.stream(), EVENT, lateness="1 hour")
    assert docs.isStreaming
    # An hour of lateness keeps every row; a last far tick closes the windows.
    topic(payload(90_000))
    out = str(tmp_path / "out")
    jobs.start_upsert(docs, out, str(tmp_path / "state"), trigger=RUN).awaitTermination()
    streamed = spark.read.parquet(out).drop("part", "processed_time")
    from barlens.functions.quality import decode
    from barlens.sources.streams import stamp_clock

    batch = spark.read.schema(ENVELOPE_SCHEMA).parquet(str(tmp_path / "topic"))
    expected = window_metrics(stamp_clock(decode(batch), EVENT)).drop("processed_time")
    expected = expected.where("window_end <= timestamp '2024-01-03 09:30:00'").select(streamed.columns)
    assert streamed.count() == 15
    assert streamed.exceptAll(expected).count() == 0 and expected.exceptAll(streamed).count() == 0


def test_processing_clock_runs(spark, topic, tmp_path):
    topic(payload(10), "{broken")
    docs = jobs.metrics_stream(topic.stream(), lateness="0 seconds", length="1 second")
    query = jobs.start_documents(docs, str(tmp_path / "state"), "memory", RUN, queryName="arrivals")
    query.awaitTermination()
    assert query.exception() is None


def test_alerts_with_preview_share_one_query(spark, topic, tmp_path):
    topic(payload(10, 1.0), payload(20, 1.5), payload(70, 1.0), payload(610))
    seen = []
    alerts = jobs.alerts_stream(topic.stream(), EVENT)
    run = jobs.start_upsert(
        alerts, str(tmp_path / "out"), str(tmp_path / "state"), trigger=RUN,
        also=lambda batch, _number: seen.extend(jobs.preview(batch).collect()),
    )
    run.awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [r.doc_id for r in stored] == ["AAA_202401020930_return_pct_up"]
    assert [tuple(r) for r in seen] == [("AAA", T0, 1.0, 1.5, 0.5, 0.5, "return_pct", "up", 0.5)]


def test_console_preview_starts(spark, topic, tmp_path):
    topic(payload(10, 1.5), payload(610))
    alerts = jobs.alerts_stream(topic.stream(), EVENT)
    query = jobs.start_preview(alerts, str(tmp_path / "console"))
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None


def test_replayed_batch_is_idempotent(spark, topic, tmp_path):
    """The same batch reaching the sink twice, as after a crash before the commit."""
    topic(payload(10), payload(610))
    docs = jobs.metrics_stream(topic.stream(), EVENT)
    out = str(tmp_path / "out")
    for attempt in ("first", "second"):
        jobs.start_upsert(docs, out, str(tmp_path / attempt), trigger=RUN).awaitTermination()
    assert spark.read.parquet(out).count() == 1


def test_relay_keeps_messages_and_carries_envelope_time(spark, topic, tmp_path):
    topic(payload(1), payload(2))
    out = str(tmp_path / "out")
    for _ in range(2):
        jobs.start_relay(
            topic.stream(), str(tmp_path / "state"), "parquet", "next", RUN, path=out
        ).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 2
    assert {bytes(r.value).decode() for r in rows} == {payload(1), payload(2)}
    assert rows[0].topic == "next" and bytes(rows[0].key) == b"AAA"
    assert [h.key for h in rows[0].headers] == ["h", "envelope-time-ms"]
    sent = {int(bytes(r.headers[1].value)) for r in rows}
    assert len(sent) == 2


def test_relay_without_headers(spark):
    row = spark.createDataFrame([(bytearray(b"k"), bytearray(b"v"), None, None)], ENVELOPE_SCHEMA)
    from barlens.sinks.messages import relayed

    assert relayed(row).first().headers == []


def test_archive_stream_is_incremental(spark, topic, tmp_path):
    out, state = str(tmp_path / "archive"), str(tmp_path / "state")

    def run(**options):
        jobs.start_archive(topic.stream(), out, state, **options).awaitTermination()
        return spark.read.parquet(out).count()

    topic(payload(1), payload(2), "{broken")
    assert run() == 2
    topic(payload(2), payload(3))
    assert run() == 3
    assert run() == 3


def test_archive_stream_respects_envelope_range(spark, topic, tmp_path):
    topic(*[payload(i) for i in range(5)])
    between = (T0 + timedelta(hours=1), T0 + timedelta(hours=3))
    out = str(tmp_path / "archive")
    jobs.start_archive(topic.stream(), out, str(tmp_path / "state"), between).awaitTermination()
    assert spark.read.parquet(out).count() == 3


def test_counted_reports_rows(spark):
    from pyspark.sql import Observation

    seen = Observation("messages")
    spark.range(7).observe(seen, F.count(F.lit(1)).alias("rows")).count()
    assert seen.get["rows"] == 7
    assert jobs.counted(spark.range(3)).count() == 3

"""Partition pruning, bucketed upserts, second sinks, batch counts and places."""

import re
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barlens.functions.quality import typed_fields
from barlens.operators.merge import only_partitions
from barlens.operators.places import places_within, with_places
from barlens.sinks.tables import bucket_count, upsert_by_key, write_batch
from barlens.sources.streams import read_stream
from barlens.streaming import jobs
from barlens.streaming.progress import BatchCounts

RUN = {"availableNow": True}


@pytest.fixture
def months(spark, tmp_path):
    path = str(tmp_path / "months")
    rows = spark.range(120).select(
        F.date_format(F.add_months(F.lit("2014-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM").alias("month"),
        (F.col("id") % 2).cast("int").alias("half"), "id",
    )
    rows = rows.unionByName(spark.range(2).select(F.lit(None).cast("string").alias("month"), F.lit(0).alias("half"), "id"))
    rows.write.partitionBy("month", "half").parquet(path)
    return spark.read.schema("id long, month string, half int").parquet(path)


def test_all_partition_columns_are_pruned_at_run_time(spark, months):
    changed = spark.createDataFrame([("2014-01", 0), ("2023-12", 1)], "month string, half int")
    found = only_partitions(months, changed, "month", "half")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"dynamicpruning#\d+ \[month", plan) and re.search(r"dynamicpruning#\d+ \[half", plan)
    for file in months.inputFiles():  # files of other partitions are never opened
        if "month=2014-01/half=0" not in file and "month=2023-12/half=1" not in file:
            Path(file.removeprefix("file://")).write_bytes(b"no parquet")
    assert sorted(r.id for r in found.collect()) == [0, 119]


@pytest.mark.parametrize(
    "touched, expected",
    [([], []), ([(None, 0)], [0, 1]), ([("2014-02", 1), (None, 0)], [0, 1, 1]), ([("2014-02", 0)], [])],
)
def test_null_and_absent_partitions(spark, months, touched, expected):
    changed = spark.createDataFrame(touched, "month string, half int")
    found = only_partitions(months, changed, "month", "half")
    assert sorted(r.id for r in found.collect()) == expected


def names(folder):
    return {str(p.relative_to(folder)) for p in folder.rglob("*.parquet")}


def test_upsert_rewrites_one_bucket_of_many(spark, tmp_path):
    path, folder = str(tmp_path / "docs"), tmp_path / "docs"
    docs = spark.range(5000).select(
        F.col("id").cast("string").alias("doc_id"), F.lit(1).alias("v"), F.lit("p").alias("part")
    )
    upsert_by_key(docs, path, buckets=64)
    assert bucket_count(spark, path) == 64
    before = names(folder)
    for _ in range(2):
        upsert_by_key(docs.where("doc_id = '7'").withColumn("v", F.lit(2)), path)
    gone = {name.rsplit("/", 1)[0] for name in before - names(folder)}
    assert len(gone) == 1
    stored = spark.read.parquet(path)
    assert stored.count() == 5000 and stored.where("v = 2").count() == 1
    with pytest.raises(ValueError, match="64 buckets"):
        upsert_by_key(docs, path, buckets=32)


def test_plain_tables_have_no_buckets(spark, tmp_path):
    path = str(tmp_path / "docs")
    docs = spark.createDataFrame([("a", "p")], "doc_id string, part string")
    assert bucket_count(spark, path) is None
    upsert_by_key(docs, path)
    assert bucket_count(spark, path) is None
    with pytest.raises(ValueError, match="no buckets"):
        upsert_by_key(docs, path, buckets=4)


def alerts_like(spark, folder):
    schema = StructType.fromDDL("doc_id string, window_start timestamp, v int")
    return read_stream(spark, "parquet", schema, folder)


def test_second_sink_survives_a_crash_before_the_commit(spark, tmp_path):
    """The driver is lost after both writes and before the batch is recorded as done."""
    landing, first, second, state = (str(tmp_path / n) for n in ("in", "first", "second", "state"))
    start = datetime(2024, 1, 2, 9)

    def land(*ids):
        rows = [(f"d{i}", start + timedelta(hours=i), i) for i in ids]
        spark.createDataFrame(rows, "doc_id string, window_start timestamp, v int").write.mode(
            "append"
        ).parquet(landing)

    class Lost(Exception):
        pass

    def run(lose):
        def also(batch, number):
            write_batch(batch, second, "alerts", number)
            if lose:
                raise Lost("driver")

        query = jobs.start_upsert(alerts_like(spark, landing), first, state, trigger=RUN, also=also)
        try:
            query.awaitTermination()
        except Exception:
            assert lose

    land(1, 2)
    run(lose=True)
    assert spark.read.parquet(second).count() == 2
    run(lose=False)
    land(3)
    run(lose=False)
    run(lose=False)
    for path in (first, second):
        assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    assert sorted({r.batch for r in spark.read.parquet(second).collect()}) == [0, 1]


def test_counts_of_batches(spark, tmp_path):
    landing, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    counts = BatchCounts()
    spark.streams.addListener(counts)
    try:
        for size in (3, 4):
            spark.range(size).write.mode("append").parquet(landing)
            stream = read_stream(spark, "parquet", StructType.fromDDL("id long"), landing)
            query = jobs.start_documents(jobs.counted(stream), state, "parquet", RUN, path=out)
            query.awaitTermination()
            counts.wait_for(query)
    finally:
        spark.streams.removeListener(counts)
    found = counts.take(spark).orderBy("batch").collect()
    assert [(r.batch, r.rows, r.late_rows) for r in found] == [(0, 3, 0), (1, 4, 0)]
    assert counts.take(spark).count() == 0


def test_metrics_job_runs_every_half_minute(spark, tmp_path):
    from barlens.schema import ENVELOPE_SCHEMA

    landing = str(tmp_path / "in")
    spark.createDataFrame([], ENVELOPE_SCHEMA).write.parquet(landing)
    messages = read_stream(spark, "parquet", ENVELOPE_SCHEMA, landing)
    query = jobs.start_metrics(messages, str(tmp_path / "out"), str(tmp_path / "state"))
    try:
        trigger = query._jsq.toString()
        assert query.isActive, trigger
        kind = query._jsq.streamingQuery().trigger().toString()
        assert "30000" in kind
    finally:
        query.stop()


# --- places ------------------------------------------------------------------------------


def test_places_split_ties_and_copies(spark):
    rows = spark.range(3000).select(F.lit("same").alias("k"), F.lit(1).alias("v")).repartition(5)
    placed = with_places(rows, ["k"])
    assert sorted(r.place for r in placed.collect()) == list(range(3000))


@pytest.mark.parametrize("n", [0, 1, 700])
def test_places_in_groups(spark, n):
    rows = [(None if i % 5 == 0 else f"g{i % 3}", (i * 37) % 101, i) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, v int, place_of int")
    found = places_within(df, ["g"], ["v", "place_of"], "at").collect()
    groups = {}
    for g, v, i in sorted(rows, key=lambda r: r[1:]):
        groups.setdefault(g, []).append(i)
    expected = {i: at for members in groups.values() for at, i in enumerate(members)}
    assert {r.place_of: r.at for r in found} == expected


# --- typed fields ------------------------------------------------------------------------


def test_kinds_of_fields(spark):
    texts = [
        '{"a": 1, "b": "x"}', '{"a": 1.5, "b": ""}', '{"a": "1", "b": 2}', '{"a": null}', "{}",
        '{"a": true, "b": [1]}', "[1]", "7", "broken", None, '{"a": 1e400, "b": "x"}',
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    typed = typed_fields(df, {"a": "double", "b": "string"}, keep=["i"])
    assert typed._jdf.queryExecution().executedPlan().toString().count("parse_json(") <= 2
    found = [tuple(r)[1:] for r in typed.orderBy("i").collect()]
    assert found[:10] == [
        (1.0, "number", "x", "text"), (1.5, "number", "", "text"), (None, "text", None, "number"),
        (None, "null", None, "missing"), (None, "missing", None, "missing"),
        (None, "other", None, "other"), *[(None, "missing", None, "missing")] * 4,
    ]

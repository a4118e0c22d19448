import json

import pytest
from pyspark.sql import functions as F

from barlens.functions.quality import decode
from barlens.operators import merge
from barlens.operators.heat import ordered_rows
from barlens.plans import archive
from barlens.plans.archive import archive_batch, backfill, read_archive
from barlens.schema import BAR_SCHEMA
from barlens.sinks import tables
from barlens.sources.bars import read_bars

T = "2024-01-02 09:3{}:00"


@pytest.fixture
def records(spark):
    """Decoded bars from (ticker, time, close) tuples."""

    def build(*rows):
        full = [(t, "x", time, 1.0, 1.0, 1.0, close, None, 1.0) for t, time, close in rows]
        return spark.createDataFrame(full, BAR_SCHEMA)

    return build


def times(df):
    return [(r.time, r.Close) for r in df.orderBy("ticker", "time", "Close").collect()]


def read(spark, path):
    return spark.read.parquet(path)


def test_merge_keeps_stored_and_copies_in_batch(spark, records, tmp_path):
    path = str(tmp_path / "a")
    archive_batch(records(("A", T.format(1), 1.0), ("A", T.format(2), 2.0)), path)
    batch = records(("A", T.format(2), 9.0), ("A", T.format(3), 3.0), ("A", T.format(3), 3.0))
    stats = archive_batch(batch, path).first()
    assert (stats.slices_written, stats.slices_skipped, stats.new_records, stats.total_records) == (1, 0, 2, 4)
    expected = [(T.format(1), 1.0), (T.format(2), 2.0), (T.format(3), 3.0), (T.format(3), 3.0)]
    assert times(read(spark, path)) == expected
    again = archive_batch(batch, path).first()
    assert (again.slices_written, again.slices_skipped, again.new_records) == (0, 1, 0)
    assert times(read(spark, path)) == expected


def test_merge_can_drop_copies(spark, records, tmp_path):
    path = str(tmp_path / "a")
    batch = records(("A", T.format(3), 3.0), ("A", T.format(3), 3.0), ("A", T.format(3), 4.0))
    assert archive_batch(batch, path, dedup_within_batch=True).first().new_records == 1


def test_stored_json_is_parsed_once_and_keeps_its_columns(spark, records, tmp_path, monkeypatch):
    path, layout = str(tmp_path / "a"), {"partition_by": ("date", "ticker"), "fmt": "json"}
    first = records(("A", T.format(1), 1.0), ("B", "2024-01-03", 2.0)).withColumn("venue", F.lit("X"))
    archive_batch(first, path, **layout)
    parsed, count = spark.sparkContext.accumulator(0), archive.read_if_there

    def counting(*args):
        stored = count(*args)

        @F.udf("string")
        def seen(venue):
            parsed.add(1)
            return venue

        return stored.withColumn("venue", seen.asNondeterministic()("venue"))

    monkeypatch.setattr(archive, "read_if_there", counting)
    stats = archive_batch(records(("A", T.format(1), 9.0), ("A", T.format(2), 3.0)), path, **layout).first()
    assert (stats.slices_written, stats.new_records, stats.total_records) == (1, 1, 2)
    assert parsed.value == 2  # both stored rows, once each
    back = spark.read.json(path).orderBy("ticker", "time").collect()
    assert [(r.ticker, r.Close, r.venue) for r in back] == [("A", 1.0, "X"), ("A", 3.0, None), ("B", 2.0, "X")]


def test_small_slices_are_not_searched_for_copies(spark, records, tmp_path, monkeypatch):
    def searched(*_):
        raise AssertionError("searched for crowded keys")

    monkeypatch.setattr(archive, "crowded_keys", searched)
    path, days = str(tmp_path / "a"), ("2024-01-02", "2024-01-03", "2024-01-04")
    for close in (1.0, 2.0):
        archive_batch(records(*[("A", d, close) for d in days]), path, ("month",), max_copies=2)
    assert times(read(spark, path)) == [(d, 1.0) for d in days]
    with pytest.raises(AssertionError, match="crowded"):
        archive_batch(records(*[("A", days[0], c) for c in (1.0, 2.0, 3.0)]), str(tmp_path / "b"), max_copies=2)
    monkeypatch.undo()
    archive_batch(records(*[("B", days[0], c) for c in (1.0, 2.0, 3.0)]), path, ("month",), max_copies=2)
    assert read(spark, path).count() == 6


def test_untouched_dates_stay_and_reference_layout(spark, records, tmp_path):
    path = str(tmp_path / "a")
    layout = {"partition_by": ("date", "ticker"), "fmt": "json"}
    archive_batch(records(("Ä", "2024-01-02", 1.0), ("B", "2024-01-03", 2.0)), path, **layout)
    archive_batch(records(("C", "2024-01-02", 4.0)), path, **layout)
    untouched = ("date=2024-01-03/ticker=B", "date=2024-01-02/ticker=C")
    kept = [sorted(p.name for p in (tmp_path / "a" / u).glob("part-*")) for u in untouched]
    archive_batch(records(("Ä", "2024-01-02 10:00:00", 3.0)), path, **layout)
    assert all(kept)
    assert [sorted(p.name for p in (tmp_path / "a" / u).glob("part-*")) for u in untouched] == kept
    (folder,) = [f for f in (tmp_path / "a" / "date=2024-01-02").iterdir() if "C" not in f.name]
    lines = [json.loads(x) for f in sorted(folder.glob("part-*")) for x in f.read_text("utf-8").splitlines()]
    assert [(x["ticker"], x["time"]) for x in lines] == [("Ä", "2024-01-02"), ("Ä", "2024-01-02 10:00:00")]
    back = read_archive(spark, path)
    assert sorted((r.ticker, str(r.date), r.Close) for r in back.collect()) == [
        ("B", "2024-01-03", 2.0), ("C", "2024-01-02", 4.0), ("Ä", "2024-01-02", 1.0), ("Ä", "2024-01-02", 3.0)
    ]
    with pytest.raises(ValueError, match="is json"):
        read_archive(spark, path, "parquet")
    loose = read_bars(spark, path)
    assert {r.ticker for r in loose.collect()} == {"Ä", "B", "C"}


def test_stored_columns_survive_narrower_batches(spark, records, tmp_path):
    path = str(tmp_path / "a")
    wide = records(("A", "2024-01-02", 1.0)).withColumn("venue", F.lit("X"))
    archive_batch(wide, path)
    archive_batch(records(("A", "2024-01-02 10:00:00", 2.0)), path)
    rows = spark.read.option("mergeSchema", "true").parquet(path).collect()
    assert sorted((r.Close, r.venue) for r in rows) == [(1.0, "X"), (2.0, None)]


def test_partitions_outside_the_range_are_not_scanned(spark, records, tmp_path):
    path = str(tmp_path / "a")
    archive_batch(records(*[("A", f"2024-01-{d:02d}", 1.0) for d in range(1, 10)]), path)
    stored = spark.read.parquet(path)
    changed = spark.createDataFrame([("2024-01-03",), ("2024-01-05",)], "date string").select(
        F.to_date("date").alias("date")
    )
    found = merge.only_partitions(stored, changed, "date")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and ">= 2024-01-03" in plan
    assert found.count() == 2


def test_replayed_quarantine_is_not_repeated(spark, records, tmp_path):
    bad = str(tmp_path / "bad")
    for _ in range(2):
        archive_batch(records((None, "2024-01-02", 2.0)), str(tmp_path / "a"), quarantine=bad, batch_id=7)
    assert spark.read.json(bad).count() == 1


def test_bad_records_are_quarantined(spark, records, tmp_path):
    path, bad = str(tmp_path / "a"), str(tmp_path / "bad")
    rows = records(("A", "2024-01-02", 1.0), (None, "2024-01-02", 2.0), ("A", "soon", 3.0))
    assert archive_batch(rows, path, quarantine=bad).first().new_records == 1
    assert sorted(r.problem for r in spark.read.json(bad).collect()) == ["bad_time", "no_ticker"]


def test_empty_batch(spark, records, tmp_path):
    stats = archive_batch(records(("A", "", 1.0)), str(tmp_path / "a")).first()
    assert tuple(stats) == (0, 0, 0, 0)
    assert not (tmp_path / "a").exists()


def test_backfill_selects_range_and_tickers(spark, records, tmp_path):
    rows = records(*[(t, f"2024-01-{d:02d}", float(d)) for t in "ABC" for d in range(1, 11)])
    history = rows.withColumn("source_time", F.to_timestamp("time"))
    path = str(tmp_path / "a")
    stats = backfill(history, path, "A, C", start="2024-01-03", end="2024-01-06").first()
    assert (stats.slices_written, stats.new_records) == (6, 6)
    stats = backfill(history, path, "A,C", end="2024-01-08", days=5).first()
    assert (stats.slices_written, stats.slices_skipped, stats.new_records) == (4, 6, 4)


def test_crowded_keys_are_looked_up_without_shuffling_them(spark, records):
    hot = [("A", T.format(1), float(i)) for i in range(300)]
    known = [("A", T.format(2), float(i)) for i in range(200)]
    rows = records(*hot, *known, ("B", T.format(1), 1.0), ("B", T.format(2), 2.0))
    rows = rows.withColumn("date", F.to_date("time"))
    stored = records(("A", T.format(2), 0.0), ("B", T.format(2), 0.0)).withColumn("date", F.to_date("time"))
    found = merge.crowded_keys(rows, merge.ARCHIVE_KEY, 100)
    assert sorted(r.time for r in found.collect()) == [T.format(1), T.format(2)]
    for limit in (100, 10_000):
        fresh = merge.new_records(rows, stored, max_copies=limit)
        assert fresh.count() == 301
        assert fresh.where("time <> '2024-01-02 09:31:00'").count() == 0
    assert merge.crowded_keys(rows, merge.ARCHIVE_KEY, 10_000) is None


def test_slices_present(records):
    stored = records(("A", "2024-01-02", 1.0)).withColumn("date", F.to_date("time"))
    asked = records(("A", "2024-01-02", 1.0), ("B", "2024-01-02", 1.0)).withColumn("date", F.to_date("time"))
    assert [r.ticker for r in merge.slices_present(asked.select("date", "ticker"), stored).collect()] == ["A"]


def test_copies_do_not_end_up_in_one_file(spark):
    rows = spark.range(4000).select(F.lit("A").alias("k"), F.lit(1).alias("v")).repartition(6)
    parts = ordered_rows(rows, ["k"], 4).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 4 and max(p[1] for p in parts) < 2000


def test_upsert_replaces_and_repeats_safely(spark, tmp_path):
    path = str(tmp_path / "docs")
    columns = "doc_id string, v int, at int, part string"
    first = spark.createDataFrame([("a", 1, 1, "p"), ("b", 1, 1, "p"), ("c", 1, 1, "q")], columns)
    second = spark.createDataFrame([("b", 5, 2, "p"), ("b", 4, 3, "p"), ("d", 2, 1, "p")], columns)
    tables.upsert_by_key(first, path)
    untouched = {p.name for p in (tmp_path / "docs" / "part=q").glob("*.parquet")}
    for _ in range(2):
        tables.upsert_by_key(second, path, latest=F.col("at"))
        got = {r.doc_id: r.v for r in read(spark, path).collect()}
        assert got == {"a": 1, "b": 4, "c": 1, "d": 2}
    assert {p.name for p in (tmp_path / "docs" / "part=q").glob("*.parquet")} == untouched


def test_upsert_replaces_with_null(spark, tmp_path):
    path, columns = str(tmp_path / "docs"), "doc_id string, v int, part string"
    tables.upsert_by_key(spark.createDataFrame([("a", 1, "p")], columns), path)
    tables.upsert_by_key(spark.createDataFrame([("a", None, "p")], columns), path)
    assert [tuple(r) for r in read(spark, path).collect()] == [("a", None, "p")]


def test_write_table_raises(spark, tmp_path):
    tables.write_table(spark.range(3).toDF("x"), str(tmp_path / "t"), "json")
    tables.write_table(spark.range(2).toDF("x"), str(tmp_path / "t"), "json")
    assert spark.read.json(str(tmp_path / "t")).count() == 2
    with pytest.raises(Exception):
        tables.write_table(spark.range(3), str(tmp_path / "t"), "no-such-format")


def test_decoded_messages_archive(spark, tmp_path):
    payload = json.dumps({"ticker": "A", "time": "2024-01-01 22:00:00-05:00", "Close": 1.0})
    raw = spark.createDataFrame([(payload,), ("{",)], "value string")
    archive_batch(decode(raw), str(tmp_path / "a"))
    assert str(read(spark, str(tmp_path / "a")).first().date) == "2024-01-01"


def test_append_adds_files_and_rewrites_nothing(spark, records, tmp_path):
    path = str(tmp_path / "a")
    folder = tmp_path / "a" / "date=2024-01-02"
    archive_batch(records(("A", T.format(1), 1.0)), path, append=True)
    before = {p.name for p in folder.glob("*.parquet")}
    batch = records(("A", T.format(1), 9.0), ("A", T.format(2), 2.0))
    for _ in range(2):
        archive_batch(batch, path, append=True)
    assert before < {p.name for p in folder.glob("*.parquet")}
    assert times(read(spark, path)) == [(T.format(1), 1.0), (T.format(2), 2.0)]


def test_rewrite_unchanged_slices_on_request(spark, records, tmp_path):
    path, batch = str(tmp_path / "a"), records(("A", T.format(1), 1.0))
    folder = tmp_path / "a" / "date=2024-01-02"
    archive_batch(batch, path)
    before = {p.name for p in folder.glob("*.parquet")}
    archive_batch(batch, path)
    assert {p.name for p in folder.glob("*.parquet")} == before
    archive_batch(batch, path, rewrite_unchanged=True)
    assert {p.name for p in folder.glob("*.parquet")} != before
    assert times(read(spark, path)) == [(T.format(1), 1.0)]


def test_very_many_copies_are_spread_over_files(spark, records, tmp_path):
    path = str(tmp_path / "a")
    one = records(("A", T.format(1), 1.0), ("B", T.format(2), 2.0))
    copies = F.when(F.col("ticker") == "A", 6000).otherwise(1)
    batch = one.withColumn("n", F.explode(F.sequence(F.lit(1), copies))).drop("n").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert archive_batch(batch, path, max_copies=100).first().new_records == 6001
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    per_file = [r[1] for r in read(spark, path).groupBy(F.input_file_name()).count().collect()]
    assert sum(per_file) == 6001 and max(per_file) < 4000
    assert archive_batch(batch, path, max_copies=100).first().new_records == 0
    assert read(spark, path).count() == 6001

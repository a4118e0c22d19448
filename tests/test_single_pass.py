"""Steps that must not read, write or shuffle rows more often than the job needs."""

import re

import pytest
from pyspark.sql import functions as F

from barlens import session
from barlens.functions.quality import typed_fields
from barlens.operators import merge
from barlens.operators.heat import HeatPolicy
from barlens.plans.archive import archive_batch, read_archive
from barlens.plans.feature_table import feature_table
from barlens.sample import queries
from barlens.schema import BAR_SCHEMA
from barlens.session import few_listing_tasks, first_file
from barlens.sinks import tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def held(monkeypatch):
    """Names of the tables that jobs stage."""
    names, hold = [], session.Staging.hold
    monkeypatch.setattr(
        session.Staging, "hold", lambda self, df, name: names.append(name) or hold(self, df, name)
    )
    return names


@pytest.fixture
def bars_of(spark):
    def build(*rows):
        df = spark.createDataFrame(list(rows), "ticker string, time string, Close double")
        return df.select(
            *[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in BAR_SCHEMA]
        )

    return build


def test_first_archive_run_stages_the_batch_once(spark, bars_of, held, tmp_path):
    path = str(tmp_path / "a")
    batch = bars_of(("A", "2024-01-02", 1.0), ("A", "2024-01-02", 1.0), ("B", "2024-01-03", 2.0))
    stats = archive_batch(batch, path, ("month",)).first()
    assert held == ["incoming"]
    assert tuple(stats) == (2, 0, 3, 3)
    again = archive_batch(batch, path, ("month",)).first()
    assert tuple(again) == (0, 2, 0, 3)
    assert spark.read.parquet(path).count() == 3


def test_first_run_without_rows_writes_nothing(spark, bars_of, tmp_path):
    stats = archive_batch(bars_of(("A", "", 1.0)), str(tmp_path / "a")).first()
    assert tuple(stats) == (0, 0, 0, 0) and not (tmp_path / "a").exists()


def test_keys_of_an_ordinary_batch_are_not_counted_one_by_one(spark, monkeypatch):
    counted, crowded = [], merge._crowded
    monkeypatch.setattr(merge, "_crowded", lambda rows, by, n: counted.append(by) or crowded(rows, by, n))
    rows = spark.range(500).select(
        F.lit("2024-01-02").alias("date"), F.lit("A").alias("ticker"), F.col("id").alias("time")
    )
    assert merge.crowded_keys(rows, merge.ARCHIVE_KEY, 100) is None
    assert counted == [["_group"]]


def test_sides_of_the_archive_are_built_from_one_table(spark):
    for side in queries.archive_sides(spark, "/root/testdata/sf0.001"):
        assert "lineitem" not in plan(side) and "Exchange" not in plan(side)


def test_merge_and_write_share_one_shuffle(spark, tmp_path):
    path = str(tmp_path / "docs")
    docs = spark.range(100).select(
        F.col("id").cast("string").alias("doc_id"), F.lit(1).alias("v"), F.lit("p").alias("part")
    )
    docs.write.parquet(path)
    stored = spark.read.parquet(path)
    merged = merge.newest_in_order(stored, stored.where("v = 1"), ["part", "doc_id"])
    assert plan(merged).count("Exchange") == 1


def test_newest_agrees_with_replace_by_key(spark):
    stored = spark.createDataFrame(
        [("a", 1, "x", "p"), ("b", 9, "x", "p"), ("c", 1, None, "q")], "doc_id string, v int, w string, part string"
    )
    changed = spark.createDataFrame(
        [("p", None, "b", 2), ("p", 3, "b", 1), ("q", 5, "d", 1), ("q", 5, "d", 1)],
        "part string, v int, doc_id string, n int",
    )
    for latest in (None, F.col("n")):
        expected = merge.replace_by_key(stored, changed, ["doc_id"], latest)
        found = merge.newest_in_order(stored, changed, ["part", "doc_id"], latest)
        assert found.columns == expected.columns
        assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))


def test_written_documents_are_not_staged(spark, held, tmp_path):
    docs = spark.createDataFrame([("a", 1, "p"), ("a", 2, "p")], "doc_id string, v int, part string")
    tables.upsert_by_key(docs, str(tmp_path / "docs"), written=True)
    assert held == []
    assert [r.v for r in spark.read.parquet(str(tmp_path / "docs")).collect()] == [2]


def test_copies_of_a_document_are_combined_first(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "MAX_COPIES", 100)
    combined, one = [], merge.one_per_key
    monkeypatch.setattr(tables, "one_per_key", lambda *a: combined.append(1) or one(*a))
    docs = spark.range(300).select(F.lit("a").alias("doc_id"), F.col("id").alias("v"), F.lit("p").alias("part"))
    tables.upsert_by_key(docs, str(tmp_path / "docs"))
    assert combined == [1]
    assert [r.v for r in spark.read.parquet(str(tmp_path / "docs")).collect()] == [299]


def test_an_archive_is_listed_once_by_few_tasks(spark, bars_of, tmp_path, monkeypatch):
    path = str(tmp_path / "a")
    archive_batch(bars_of(("A", "2024-01-02", 1.0), ("B", "2024-01-03", 2.0)), path, ("year", "ticker"), "json")
    assert first_file(spark, path).split("/")[-2] in ("ticker=A", "ticker=B")
    assert read_archive(spark, path).count() == 2
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    with few_listing_tasks(spark):
        assert int(spark.conf.get(setting)) == 8 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(setting) == before


def test_typed_fields_are_compiled(spark):
    rows = spark.createDataFrame([('{"a": 1, "b c": null}', "k")], "value string, key string")
    out = typed_fields(rows, {"a": "double", "b c": "string", "d": "string"}, keep=("key",))
    assert "lambda" not in plan(out)
    assert tuple(out.first()) == ("k", 1.0, "number", None, "null", None, "missing")


def test_blocks_get_their_values_without_a_shuffle_of_their_rows(series):
    table = feature_table(series([float(i) for i in range(40)]), heat=HeatPolicy(known={"A": 40}, block_rows=10))
    assert re.search(r"hashpartitioning\(ticker#\d+, _block", plan(table)) is None
    assert table.count() == 40

"""Lines of text in very many folders: written by the tasks, read without discovering each folder."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barlens.plans import archive
from barlens.plans.archive import archive_batch, read_archive
from barlens.schema import BAR_SCHEMA
from barlens.sinks import line_files, tables

ODD = [*[chr(i) for i in range(1, 128)], "a/b+c %41 Ä", "100%", "", None]


@pytest.fixture
def rows(spark):
    data = [(name, 1995 + i % 3, i * 0.5, "é" * i) for i, name in enumerate(ODD)]
    data += [(None, 1995, -1.0, "x"), ("", None, -2.0, "y"), (None, None, -3.0, "z"), ("A", 1996, -4.0, None)]
    return spark.createDataFrame(data, "a string, y int, v double, text string")


def contents(top: Path) -> dict[str, list[bytes]]:
    """What the files of each folder hold, checksum files included."""
    found = {}
    for kind in ("part-*", ".part-*.crc"):
        for file in sorted(top.rglob(kind)):
            found.setdefault(f"{file.parent.relative_to(top)} {kind}", []).append(file.read_bytes())
    return {folder: sorted(held) for folder, held in found.items()}


def written(df, path, append=False):
    tables.write_partitions(df, str(path), ["y", "a"], ["v"], "json", None, append, False)


def test_files_are_those_of_sparks_writer(rows, tmp_path, monkeypatch):
    some = rows.where("y = 1996 or a is null").withColumn("v", F.col("v") + 1)
    steps = [(rows, True), (rows, True), (some, False)]
    for df, append in steps:
        written(df, tmp_path / "own", append)
    monkeypatch.setattr(tables, "mounted", lambda *_: None)
    for df, append in steps:
        written(df, tmp_path / "spark", append)
    own, spark = contents(tmp_path / "own"), contents(tmp_path / "spark")
    assert own == spark and len(own) > 250
    names = [{n for n in os.listdir(tmp_path / side) if not n.startswith(".")} for side in ("own", "spark")]
    assert names[0] == names[1] and "_SUCCESS" in names[0]
    assert not list((tmp_path / "own").glob(".lines-*"))


def test_no_process_is_started_per_folder(spark, tmp_path):
    def started() -> int:
        (line,) = [x for x in Path("/proc/stat").read_text().splitlines() if x.startswith("processes")]
        return int(line.split()[1])

    many = spark.range(1000).select(F.col("id").cast("string").alias("a"), F.lit(1).alias("y"), F.lit(0.5).alias("v"))
    written(many, tmp_path / "warm")
    before = started()
    written(many, tmp_path / "t")
    assert started() - before < 1000  # three for each folder, by Hadoop without its native library
    assert len(list((tmp_path / "t").glob("y=1/a=*/part-*"))) == 1000


def test_folders_of_several_tasks_are_joined(spark, tmp_path):
    def batch(first):
        numbers = spark.range(first, first + 400, 1, 4)
        return numbers.select(F.lit("A").alias("a"), F.lit(1).alias("y"), F.col("id").alias("v"))

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for first in (0, 1000):
            written(batch(first), tmp_path / "t")
            files = sorted((tmp_path / "t" / "y=1" / "a=A").glob("part-*"))
            assert len(files) > 1
            assert [r.v for f in files for r in spark.read.json(str(f)).collect()] == [*range(first, first + 400)]
        written(batch(0), tmp_path / "t", append=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.json(str(tmp_path / "t")).distinct().count() == 800


def test_errors_leave_the_table_as_it_was(rows, tmp_path):
    written(rows, tmp_path / "t")
    before = contents(tmp_path / "t")
    fails = F.when(F.col("y") == 1997, F.raise_error(F.lit("no"))).otherwise(F.col("v"))
    with pytest.raises(Exception, match="no"):
        written(rows.withColumn("v", fails), tmp_path / "t")
    assert contents(tmp_path / "t") == before
    assert not list((tmp_path / "t").glob(".lines-*"))


def test_empty_batches_and_cached_readers(spark, rows, tmp_path):
    written(rows.limit(0), tmp_path / "t")
    assert contents(tmp_path / "t") == {}
    written(rows, tmp_path / "t")
    held = spark.read.schema("v double").json(str(tmp_path / "t")).cache()
    assert held.count() == rows.count()
    written(rows.limit(5), tmp_path / "t", append=True)
    assert held.count() == rows.count() + 5
    held.unpersist()


def test_damaged_lines_are_noticed(spark, rows, tmp_path):
    written(rows, tmp_path / "t")
    (file,) = (tmp_path / "t" / "y=1997" / "a=0").glob("part-*")
    file.write_bytes(file.read_bytes().replace(b"1997", b"1990"))
    with pytest.raises(Exception, match="(?i)checksum"):
        spark.read.json(str(tmp_path / "t")).collect()


def test_only_mounted_folders_are_written_so(spark, tmp_path):
    assert line_files.mounted(spark, f"file://{tmp_path}/a b") == f"{tmp_path}/a b"
    assert line_files.mounted(spark, str(tmp_path)) == str(tmp_path)
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.lines.link./in", f"file://{tmp_path}")
    assert line_files.mounted(spark, "viewfs://lines/in/t") is None


@pytest.mark.parametrize("layout", [("date", "ticker"), ("year", "ticker"), ("month",)])
@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_columns_of_very_many_folders_come_from_their_places(spark, tmp_path, monkeypatch, layout, fmt):
    path = str(tmp_path / "a=b" / "year=1")
    full = [(t, "x", f"200{i % 3}-01-02", 1.0, 1.0, 1.0, float(i), None, 1.0) for i, t in enumerate(ODD) if t is not None]
    archive_batch(spark.createDataFrame(full, BAR_SCHEMA), path, layout, fmt)
    discovered = read_archive(spark, path)
    monkeypatch.setattr(archive, "MAX_DISCOVERED", 1)
    placed = read_archive(spark, path)
    assert "_metadata" in placed._jdf.queryExecution().analyzed().toString()
    assert placed.schema == discovered.schema
    assert placed.count() == len(full)
    assert placed.exceptAll(discovered).isEmpty() and discovered.exceptAll(placed).isEmpty()


def test_filters_on_very_many_folders_skip_files(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "a")
    full = [(str(i), "x", "2000-01-02", 1.0, 1.0, 1.0, float(i), None, 1.0) for i in range(30)]
    archive_batch(spark.createDataFrame(full, BAR_SCHEMA), path, ("year", "ticker"), "json")
    monkeypatch.setattr(archive, "MAX_DISCOVERED", 10)
    found = read_archive(spark, path).where("ticker = '7' and year = '2000'")
    damaged = [f for f in Path(path).rglob("part-*") if "ticker=7" not in str(f)]
    for file in damaged:
        file.unlink()
    assert [r.Close for r in found.collect()] == [7.0]

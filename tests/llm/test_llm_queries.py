"""Registered queries against their SQL, on sample tables and on odd rows."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from barlens.llm.registry import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
# Equal ids leave open which row is first; the SQL does not tell such rows apart.
NOT_ON_REPEATS = {"op10_ngram_jaccard_join"}


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sample(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_odd_rows(spark, odd_folder, name):
    assert differences(QUERIES[name](spark, odd_folder), connect(odd_folder), ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(ORACLE) - NOT_ON_REPEATS))
def test_repeated_rows(spark, repeated_folder, name):
    found = differences(QUERIES[name](spark, repeated_folder), connect(repeated_folder), ORACLE[name])
    assert found == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, odd_folder, tmp_path, name):
    for table in ("documents", "benchmark", "pages"):
        spark.read.parquet(f"{odd_folder}/{table}.parquet").limit(0).write.parquet(
            f"{tmp_path}/{table}.parquet"
        )
    assert QUERIES[name](spark, str(tmp_path)).count() == 0

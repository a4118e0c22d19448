"""The corpus pipeline: five stages over ``documents``, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the
last return the columns of ``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlens.llm import contamination, line_dedup, near_duplicates, packing, quality_rules
from barlens.llm.queries import table, tokenizer_path
from barlens.session import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


_ROW_BITS = 40


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents with a number per row that holds through all reads of them, as ``key``.

    The number of the file among all files and the row's place in it: nothing is copied. A frame
    that is no scan of files is written first.
    """
    at = F.col("_metadata.row_index")
    try:
        located = docs.select("*", F.col("_metadata.file_path").alias("_file"), at.alias("_at"))
    except AnalysisException:
        return _numbered(stage(docs, "documents"))
    files = sorted(row["_file"] for row in located.select("_file").distinct().collect())
    numbers = docs.sparkSession.createDataFrame(
        pa.table({"_file": pa.array(files, pa.string()), "_number": pa.array(range(len(files)), pa.int64())})
    )
    key = F.shiftleft("_number", _ROW_BITS) + F.col("_at")
    return located.join(numbers, "_file").select(*docs.columns, key.alias("key"))


def _without(numbered: DataFrame, judged: DataFrame, refused: Column, key: str) -> DataFrame:
    """The documents whose verdict is not ``refused``.

    The refused numbers are written as a table of their own, so that Spark knows its size: while
    it is small enough to broadcast, no text is shuffled to leave documents out.
    """
    gone = stage(judged.where(refused).select(F.col(key).alias("key")), "refused")
    return numbered.join(gone, "key", "left_anti").select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor their host's verdict refuse."""
    numbered = _numbered(docs)
    narrow = numbered.select("key", "source", "text")
    measured = stage(quality_rules.measured(narrow).drop("text"), "measures")
    hosts = stage(quality_rules.host_verdicts(measured, "source"), "hosts")
    judged = quality_rules.judged(measured, hosts, "source")
    return _without(numbered, judged, ~F.col("kept"), "key")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that others hold as well; n_chars follows the text."""
    return (
        line_dedup.dedup_lines(docs)
        .withColumn("n_chars", F.length("text").cast("long"))
        .select(*COLUMNS)
    )


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: the one with the smallest id."""
    numbered = _numbered(docs)
    found = near_duplicates.near_duplicates(numbered, row_column="key")
    return _without(numbered, found, ~F.col("is_first"), "row")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    numbered = _numbered(docs)
    found = contamination.find_contamination(
        numbered, table(spark, sf_dir, "benchmark"), id_column="key"
    )
    return _without(numbered, found, contamination.is_contaminated(), "doc_id")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their sequence and offset."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

# The stages together hold tokenization, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

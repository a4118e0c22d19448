"""Token ids of documents in ORC files, and reads that skip what they need not decode.

A file holds whole documents in ascending id order, one row each, with its ids as a list of
integers. ORC writes such lists run-length encoded and bit-packed, cuts a file into stripes that
tasks read independently, and keeps the smallest and largest id per stripe and per row group and
a Bloom filter on the ids: a lookup of a few documents decodes only the row groups that hold them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlens.llm.common import batch_of, chunks, list_array, raw_text
from barlens.llm.packing import END_OF_TEXT, text_ids
from barlens.operators.places import running_starts

STRIPE_BYTES = 16 << 20
ROWS_PER_GROUP = 1000
FALSE_POSITIVES = 0.01

_SCHEMA = "doc_id long, part long, part_start long, n_tokens long, ids array<int>"
_ROWS = pa.schema(
    [
        ("doc_id", pa.int64()), ("part", pa.int64()), ("part_start", pa.int64()),
        ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())),
    ]
)
_CHECKED = pa.schema(
    [
        ("doc_id", pa.int64()), ("part", pa.int64()), ("part_start", pa.int64()),
        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
    ]
)


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int = END_OF_TEXT) -> DataFrame:
    """One row per (doc_id, text) row: its ids, its task, and the task's ids before it."""
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_ids(tokenizer_path)
        part, start = TaskContext.get().partitionId(), 0
        for batch in chunks(batches, "text"):
            ids = [encode(t.decode("utf-8")) + end for t in batch.column("text").to_pylist()]
            sizes = np.array([len(i) // 4 for i in ids], np.int64)
            ends = start + np.cumsum(sizes)
            yield batch_of(
                _ROWS,
                {
                    "doc_id": batch.column("doc_id"),
                    "part": np.full(len(ids), part, np.int64),
                    "part_start": ends - sizes,
                    "n_tokens": sizes,
                    "ids": list_array(np.frombuffer(b"".join(ids), "<i4"), sizes, pa.int32()),
                },
            )
            start = int(ends[-1])

    return docs.mapInArrow(work, _SCHEMA)


def write_tokens(
    docs: DataFrame, path: str, tokenizer_path: str, id_column: str = "doc_id",
    text_column: str = "text", end_id: int = END_OF_TEXT, stripe_bytes: int = STRIPE_BYTES,
    rows_per_group: int = ROWS_PER_GROUP,
) -> None:
    """Write the ids of every text, with the end id, as ORC files in ascending document order.

    Texts are dealt out by ranges of their id and encoded where they arrive, so one shuffle of
    texts is all there is. Rows with equal ids, and those without an id, which come first, are
    ordered by a hash of their text, then by their number in the input, so a range can end inside
    any number of them. The input must therefore come in the same order when a task is repeated,
    as a scan of files does. Null and empty texts hold the end id alone. A long text is one row; a
    task encodes about 4 MB of text, or one longer text, at a time. Other columns are ignored. An
    empty table writes files without rows.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), raw_text(text_column).alias("text")
    ).withColumn("_row", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("_row")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_row")
    encoded(ordered, tokenizer_path, end_id).write.options(
        **{
            "orc.bloom.filter.columns": "doc_id",
            "orc.bloom.filter.fpp": str(FALSE_POSITIVES),
            "orc.create.index": "true",
            "orc.row.index.stride": str(rows_per_group),
            "orc.stripe.size": str(stripe_bytes),
        }
    ).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """All documents of the files: doc_id, start, n_tokens and ids; stripes are read in parallel.

    ``start`` counts the ids of all documents before it. Files hold it from their own beginning;
    the sizes of the files, one number per writing task, are summed on the driver.
    """
    stored = spark.read.schema(_SCHEMA).orc(path)
    return _with_start(stored, stored)


def read_documents(spark: SparkSession, path: str, ids: Iterable[int]) -> DataFrame:
    """The rows of the documents named; row groups without them are not decoded."""
    wanted = [int(i) for i in ids]
    stored = spark.read.schema(_SCHEMA).orc(path)
    return _with_start(stored.where(F.col("doc_id").isin(wanted)), stored)


def _with_start(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """The column ``start`` in place of part and part_start. Files are read for two narrow columns."""
    sizes = stored.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    starts = running_starts(sizes, "part", "_before")
    names = [c for c in rows.columns if c not in ("doc_id", "part", "part_start")]
    return rows.join(starts, "part").select(
        "doc_id", (F.col("part_start") + F.col("_before")).alias("start"), *names
    )


def token_checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values = memoryview(lists.values.to_numpy().astype("<i4", copy=False)).cast("B")
            at = lists.offsets.to_numpy().astype(np.int64) * 4
            columns = {n: batch.column(n) for n in _CHECKED.names[:-1]}
            columns["ids_crc32"] = [zlib.crc32(values[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield batch_of(_CHECKED, columns)

    stored = spark.read.schema(_SCHEMA).orc(path)
    checked = stored.mapInArrow(
        work, "doc_id long, part long, part_start long, n_tokens long, ids_crc32 long"
    )
    return _with_start(checked, stored)

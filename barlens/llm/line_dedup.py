"""Line deduplication across documents.

Lines are normalised and hashed where they are read; only (document, 128-bit hash) pairs are
shuffled. Documents are counted per hash with partial sums. The hashes over the threshold, one row
each, meet the pairs again, become one short list per document, and the document is put together
again from its own lines in their order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlens.llm.common import batch_of, chunks, key_of, raw_text
from barlens.session import stage

SHORTEST_KEY = 20
MOST_DOCUMENTS = 3

_SPACE = b" \t\n\x0b\x0c\r"


def line_hash(line: bytes, shortest: int = SHORTEST_KEY) -> bytes | None:
    """128-bit hash of the normalised line, or None if it is too short to count."""
    key = line.strip(_SPACE).lower()
    if len(key) < shortest or (not key.isascii() and len(key.decode("utf-8")) < shortest):
        return None
    return xxhash.xxh3_128_digest(key)


_PAIRS = pa.schema([("doc", pa.int64()), ("line", pa.binary())])


def line_pairs(docs: DataFrame, id_column: str, text_column: str, shortest: int) -> DataFrame:
    """(document key, line hash), each once per row of ``docs``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            rows = {"doc": [], "line": []}
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist()):
                found = {line_hash(line, shortest) for line in text.split(b"\n")}
                found.discard(None)
                rows["line"].extend(found)
                rows["doc"].extend([doc] * len(found))
            yield batch_of(_PAIRS, rows)

    narrow = docs.select(key_of(id_column).alias("doc"), raw_text(text_column).alias("text"))
    return narrow.mapInArrow(work, "doc long, line binary")


def dropped_lines(pairs: DataFrame, most_documents: int) -> DataFrame:
    """Per document key, the hashes of the lines it loses."""
    # Equal ids count once: distinct by (line, document) before counting by line.
    repeated = (
        pairs.groupBy("line", "doc").agg(F.lit(1).alias("one"))
        .groupBy("line").agg(F.count("*").alias("n"), F.max("doc").alias("keeper"))
        .where(F.col("n") >= most_documents)
        .select("line", "keeper")
    )
    return (
        pairs.join(repeated, "line")
        .where(F.col("doc") != F.col("keeper"))
        .groupBy("doc").agg(F.collect_set("line").alias("dropped"))
    )


def dedup_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    shortest: int = SHORTEST_KEY, most_documents: int = MOST_DOCUMENTS,
) -> DataFrame:
    """The documents with the kept lines in ``text_column``, plus n_lines and n_dropped.

    A line's key is the line without white space at both ends and with A-Z in lower case. Keys of
    at least ``shortest`` code points in ``most_documents`` or more documents stay only in the
    document with the largest id. A null or empty text is one empty line. Rows with equal ids are
    one document for the counts and lose lines alike; a null id is one document before all others.
    Other columns pass through; columns named n_lines or n_dropped are replaced.
    """
    pairs = stage(line_pairs(docs, id_column, text_column, shortest), "lines")
    dropped = dropped_lines(pairs, most_documents)
    source = docs.drop("n_lines", "n_dropped")
    row = F.struct(*[F.col(f"`{c}`") for c in source.columns if c != text_column]).alias("row")
    joined = source.select(
        key_of(id_column).alias("doc"), row, raw_text(text_column).alias("body")
    ).join(dropped, "doc", "left").select("row", "body", "dropped")
    schema = T.StructType(
        [joined.schema["row"], T.StructField("body", T.StringType()),
         T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "body"):
            bodies, n_lines, n_dropped = [], [], []
            drops = batch.column("dropped").to_pylist()
            for text, drop in zip(batch.column("body").to_pylist(), drops):
                lines = text.split(b"\n")
                kept = lines
                if drop:
                    drop = set(drop)
                    kept = [line for line in lines if line_hash(line, shortest) not in drop]
                bodies.append(b"\n".join(kept).decode("utf-8"))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            yield pa.RecordBatch.from_pydict(
                {
                    "row": batch.column("row"), "body": pa.array(bodies, pa.string()),
                    "n_lines": pa.array(n_lines, pa.int64()),
                    "n_dropped": pa.array(n_dropped, pa.int64()),
                }
            )

    rebuilt = joined.mapInArrow(work, schema)
    columns = [
        F.col("body").alias(c) if c == text_column else F.col(f"row.`{c}`").alias(c)
        for c in source.columns
    ]
    return rebuilt.select(*columns, "n_lines", "n_dropped")

"""Benchmark decontamination through a positional inverted index of the training tokens.

The index is cut into segments of whole documents. A row holds one term's places in one segment,
numbered through the segment with a gap after each document. A search reads the postings of the
test terms only, brings each segment's rows together, and intersects the offset-adjusted lists of
a test window from its rarest term on; most windows end at a term the segment does not have. With
``slop`` the same lists give proximity matches: every term within that many words of its place.

The test set is a stated query set. Its items, long ones in overlapping pieces, are dealt into blocks
of about ``BLOCK_WORDS`` words as rows of a table, and one pass over the postings serves all blocks:
the plan is the same for every size of the test set, and none of it passes through the driver. A
task reads a block's pieces once and streams its share of the segments past them.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type
from pyspark.sql.types import StructField, StructType

from barlens.llm.common import batch_of, chunks, covered, groups, raw_text, runs_of
from barlens.session import Staging, stage, tasks_for

WINDOW = 13
BLOCK_WORDS = 200_000

# Segments that a task searches for one block, about.
SEGMENTS_PER_TASK = 4

# Unused places after each document; slop must be smaller.
GAP = 64

_TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A
    else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A
    else 0x20
    for b in range(256)
)

_INDEX = pa.schema(
    [
        ("kind", pa.string()), ("segment", pa.int64()), ("term", pa.binary()),
        ("places", pa.binary()), ("place", pa.int64()), ("n_words", pa.int64()),
    ]
)
_INDEX_SCHEMA = from_arrow_schema(_INDEX)


def index_words(text: bytes) -> list[bytes]:
    """Runs of digits, letters and non-ASCII characters, with A-Z in lower case."""
    return text.translate(_TO_WORDS).split()


class _Terms(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def build_index(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Rows of kind ``doc`` (segment, place, doc_id, n_words) and ``term`` (segment, term, places).

    Ids keep their type.
    """
    kind = docs.schema[id_column].dataType
    arrow = pa.schema([*_INDEX, ("doc_id", to_arrow_type(kind))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(chunks(batches, "text")):
            segment = (part << 32) + number
            ids, texts = batch.column("doc").to_pylist(), batch.column("text").to_pylist()
            terms = _Terms()
            numbers, places, starts, sizes, place = [], [], [], [], 0
            for text in texts:
                words = index_words(text)
                numbers.append(np.fromiter(map(terms.__getitem__, words), np.int32, len(words)))
                places.append(np.arange(len(words)) + place)
                starts.append(place)
                sizes.append(len(words))
                place += len(words) + GAP
            numbers, places = np.concatenate(numbers), np.concatenate(places).astype("<u4")
            order = np.argsort(numbers, kind="stable")
            numbers, places = numbers[order], places[order]
            used, first = np.unique(numbers, return_index=True)
            names = list(terms)
            edges = [*first.tolist(), len(places)]
            n = len(ids)
            yield batch_of(
                arrow,
                {
                    "kind": ["doc"] * n, "segment": [segment] * n, "term": [None] * n,
                    "places": [None] * n, "place": starts, "doc_id": ids, "n_words": sizes,
                },
            )
            m = len(used)
            yield batch_of(
                arrow,
                {
                    "kind": ["term"] * m, "segment": [segment] * m,
                    "term": [names[t] for t in used.tolist()],
                    "places": [places[a:b].tobytes() for a, b in zip(edges, edges[1:])],
                    "place": [None] * m, "doc_id": [None] * m, "n_words": [None] * m,
                },
            )

    narrow = docs.select(F.col(id_column).alias("doc"), raw_text(text_column).alias("text"))
    return narrow.mapInArrow(
        work, StructType([*_INDEX_SCHEMA.fields, StructField("doc_id", kind)])
    )


class ItemBlock:
    """Windows of some test items, as rows of term numbers grouped by window width."""

    def __init__(self, items: list[tuple[str, list[bytes]]], width: int):
        terms = _Terms()
        windows: dict[int, tuple[list, list]] = {}
        for number, (_, words) in enumerate(items):
            ids = [terms[w] for w in words]
            size = min(width, len(ids))
            rows, owners = windows.setdefault(size, ([], []))
            for i in range(len(ids) - size + 1):
                rows.append(ids[i : i + size])
                owners.append(number)
        self.terms = list(terms)
        self.names = [name for name, _ in items]
        self.windows = [
            (np.array(rows, np.int32), np.array(owners)) for rows, owners in windows.values()
        ]

    def search(
        self, postings: dict[bytes, np.ndarray], slop: int = 0
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(item number, first places, end places) of the windows found in one segment."""
        lists = [postings.get(t) for t in self.terms]
        counts = np.array([0 if p is None else len(p) for p in lists])
        for rows, owners in self.windows:
            sizes = counts[rows]
            for i in np.flatnonzero(sizes.min(axis=1)).tolist():
                row, order = rows[i], np.argsort(sizes[i], kind="stable").tolist()
                starts = lists[row[order[0]]].astype(np.int64) - order[0]
                low, high = starts.copy(), starts.copy()
                for offset in order[1:]:
                    places = lists[row[offset]]
                    at = np.searchsorted(places, starts + offset - slop)
                    at[at == len(places)] = len(places) - 1
                    moved = places[at] - (starts + offset)
                    hit = np.abs(moved) <= slop
                    starts = starts[hit]
                    if not len(starts):
                        break
                    low = np.minimum(low[hit], starts + np.minimum(moved[hit], 0))
                    high = np.maximum(high[hit], starts + np.maximum(moved[hit], 0))
                if len(starts):
                    yield int(owners[i]), low, high + len(row)


_PIECES = pa.schema([("item", pa.string()), ("n", pa.int64()), ("words", pa.binary())])


def cut_items(
    tests: DataFrame, width: int, id_column: str, text_column: str, most: int
) -> DataFrame:
    """Rows (item, n, words): the items, cut so that a piece has at most ``most`` windows.

    Pieces of one item overlap, so that every window lies in exactly one.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            out = {"item": [], "n": [], "words": []}
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                words = index_words(text)
                for start in range(0, max(len(words) - width + 1, min(len(words), 1)), most):
                    piece = words[start : start + most + width - 1]
                    out["item"].append(item)
                    out["n"].append(len(piece))
                    out["words"].append(b" ".join(piece))
            yield batch_of(_PIECES, out)

    rows = tests.select(
        F.col(id_column).cast("string").alias("item"), raw_text(text_column).alias("text")
    )
    return rows.where("item is not null").mapInArrow(work, "item string, n long, words binary")


_BLOCK_TERMS = pa.schema([("block", pa.int64()), ("term", pa.binary())])


def _terms_of(pieces: DataFrame) -> DataFrame:
    """The distinct terms of every block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "words"):
            found = {
                (block, term)
                for block, words in zip(*(batch.column(c).to_pylist() for c in ("block", "words")))
                for term in words.split()
            }
            yield batch_of(
                _BLOCK_TERMS, {"block": [b for b, _ in found], "term": [t for _, t in found]}
            )

    return pieces.select("block", "words").mapInArrow(work, "block long, term binary").distinct()


_HITS = pa.schema(
    [
        ("segment", pa.int64()), ("place", pa.int64()), ("n_hit", pa.int64()),
        ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
        ("items", pa.list_(pa.string())),
    ]
)
_HITS_DDL = (
    "segment long, place long, n_hit long, starts array<int>, ends array<int>, items array<string>"
)


def _hits_of_segment(segment, starts, sizes, postings, block, slop):
    """Per document of a segment that holds a window: hit spans and items."""
    length = int(starts[-1] + sizes[-1])
    spans, owners = [], {}
    for item, low, high in block.search(postings, slop):
        spans.append((low, high))
        for doc in np.unique(np.searchsorted(starts, low, side="right") - 1).tolist():
            owners.setdefault(doc, set()).add(block.names[item])
    if not spans:
        return
    mask = covered(
        np.concatenate([s for s, _ in spans]), np.concatenate([e for _, e in spans]), length
    )
    for doc in sorted(owners):
        own = mask[starts[doc] : starts[doc] + sizes[doc]]
        first, last = runs_of(own)
        yield {
            "segment": segment, "place": int(starts[doc]), "n_hit": int(own.sum()),
            "starts": first.tolist(), "ends": last.tolist(), "items": sorted(owners[doc]),
        }


def search_index(
    index: DataFrame, pieces: DataFrame, terms: DataFrame, n_blocks: int, n_shares: int,
    width: int = WINDOW, slop: int = 0,
) -> DataFrame:
    """Per block and document with a match: segment, place, n_hit, hit spans in words, items.

    ``pieces`` are those of the test set with their block, ``terms`` the distinct terms of each block.
    The segments are dealt into ``n_shares``.
    """
    if not 0 <= slop < GAP:
        raise ValueError(f"slop must be from 0 to {GAP - 1}")
    share = F.pmod(F.xxhash64("segment"), F.lit(n_shares)).alias("share")
    columns = ("block", "share", "segment", "kind", "term", "places", "place", "n_words")
    # Spark broadcasts the test terms if their size allows.
    postings = index.where("kind = 'term'").join(terms, "term").select("*", share)
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long")))
    docs = index.where("kind = 'doc'").select("*", everywhere.alias("block"), share)
    shares = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shares - 1).cast("long")))
    # A piece goes before all segments of its block: its item as term, its words as places.
    tests = pieces.select(
        "block", shares.alias("share"), F.lit(-1).cast("long").alias("segment"),
        F.lit("piece").alias("kind"), F.col("item").cast("binary").alias("term"),
        F.col("words").alias("places"), F.lit(None).cast("long").alias("place"),
        F.col("n").alias("n_words"),
    )
    rows = postings.select(*columns).unionByName(docs.select(*columns)).unionByName(tests)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block = None, None
        for (number, part, segment), slices in groups(batches, ["block", "share", "segment"]):
            if segment < 0:
                items = [
                    (item.decode("utf-8"), words.split())
                    for piece in slices
                    for item, words in zip(
                        piece.column("term").to_pylist(), piece.column("places").to_pylist()
                    )
                ]
                if number != held:
                    held, block = number, ItemBlock(items, width)
                continue
            if number != held:  # a block without pieces
                continue
            starts, sizes, postings = [], [], {}
            for piece in slices:
                for kind, term, places, place, n in zip(
                    *(piece.column(c).to_pylist()
                      for c in ("kind", "term", "places", "place", "n_words"))
                ):
                    if kind == "doc":
                        starts.append(place)
                        sizes.append(n)
                    else:
                        postings[term] = np.frombuffer(places, "<u4").astype(np.int64)
            order = np.argsort(starts)
            starts, sizes = np.array(starts)[order], np.array(sizes)[order]
            found = list(_hits_of_segment(segment, starts, sizes, postings, block, slop))
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=_HITS)

    tasks = tasks_for(index.sparkSession, n_blocks * n_shares, 1)
    keys = ("block", "share")
    dealt = rows.repartition(tasks, *keys) if tasks else rows.repartition(*keys)
    return dealt.sortWithinPartitions(*keys, "segment").mapInArrow(work, _HITS_DDL)


def _joined_blocks(hits: DataFrame) -> DataFrame:
    """Matches of several blocks as one row per document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                starts = np.concatenate([np.array(s, np.int64) for s in row["starts"]])
                ends = np.concatenate([np.array(e, np.int64) for e in row["ends"]])
                mask = covered(starts, ends, int(ends.max()))
                first, last = runs_of(mask)
                out.append(
                    {
                        "segment": row["segment"], "place": row["place"],
                        "n_hit": int(mask.sum()), "starts": first.tolist(),
                        "ends": last.tolist(),
                        "items": sorted({i for own in row["items"] for i in own}),
                    }
                )
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_HITS)

    lists = [F.collect_list(c).alias(c) for c in ("starts", "ends", "items")]
    return hits.groupBy("segment", "place").agg(*lists).mapInArrow(work, _HITS_DDL)


def find_contamination(
    docs: DataFrame, tests: DataFrame, width: int = WINDOW, slop: int = 0,
    id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, spans (first and end word), items.

    A window is ``width`` consecutive words of an item, or all words of a shorter item. A document
    word inside any occurrence is hit; items are those with an occurring window, sorted as text.
    Null and empty texts have no words; items without words or with a null id match nothing; items
    with equal ids count as one. Repeated rows are reported one by one. An empty test set hits
    nothing. Other columns are ignored.
    """
    with Staging(docs.sparkSession, "contamination") as staging:
        index = staging.hold(build_index(docs, id_column, text_column), "index")
        most = max(1, BLOCK_WORDS // 8)
        pieces = staging.hold(cut_items(tests, width, item_column, item_text_column, most), "pieces")
        # Two numbers for the layout; the plan is the same for all.
        n_blocks = ceil((pieces.agg(F.sum("n")).first()[0] or 1) / BLOCK_WORDS)
        n_segments = index.where("kind = 'doc'").agg(F.countDistinct("segment")).first()[0]
        pieces = pieces.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(n_blocks)))
        terms = staging.hold(_terms_of(pieces), "terms")
        found = search_index(
            index, pieces, terms, n_blocks, ceil((n_segments or 1) / SEGMENTS_PER_TASK), width, slop
        )
        hits = _joined_blocks(found)
        # One narrow row per document; the postings go.
        return stage(_per_document(index, hits), "contamination")


def _per_document(index: DataFrame, hits: DataFrame) -> DataFrame:
    spans = F.arrays_zip("starts", "ends")
    return (
        index.where("kind = 'doc'").select("segment", "place", "doc_id", "n_words")
        .join(hits, ["segment", "place"], "left")
        .select(
            "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce(spans, F.array().cast("array<struct<starts:int,ends:int>>")).alias("spans"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def is_contaminated():
    """At least a twentieth of the words is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))

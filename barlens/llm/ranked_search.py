"""Ranked lexical search over an impact-sorted index by sequential reads alone.

The index is cut into segments of whole documents. A segment holds, per term, its documents in
descending order of impact (what a match adds per unit of the term's weight). A query reads the
lists of its terms side by side from the front, never looking a document up: whatever has been read
of a document is a lower bound of its score, and adding the next impact of every list it has not
turned up in yet gives an upper one. Reading goes on until no document outside the best ones can
still belong to them and the bounds of all that can have met, so scores are final.

Segments need nothing from each other but the statistics of the whole corpus, so postings are never
shuffled by term and no term is a hot key. A task keeps the best documents of its earlier segments,
whose scores cut later reads short; the tasks' lists, of a fixed length per query, are merged last.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlens.llm.common import batch_of, chunks, id_of, key_of, raw_text, signed, word_hashes
from barlens.session import Staging, stage

# Query terms a task holds at once, but for a longer query.
BLOCK_TERMS = 50_000
# Postings of each list read in the first round; every round doubles what has been read.
FIRST_READ = 8

# Fixed values of the term pattern: bytes that part terms, and the letters that are lower-cased.
_PARTS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_LETTERS = bytes(range(ord("A"), ord("Z") + 1))
_TABLE = bytes.maketrans(_PARTS + _LETTERS, b" " * len(_PARTS) + _LETTERS.lower())

_POSTINGS = pa.schema(
    [
        ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("docs", pa.binary()),
        ("lengths", pa.binary()), ("terms", pa.binary()), ("ends", pa.binary()),
        ("places", pa.binary()), ("counts", pa.binary()),
    ]
)
_SORTED = pa.schema(
    [
        ("segment", pa.int64()), ("docs", pa.binary()), ("terms", pa.binary()),
        ("ends", pa.binary()), ("places", pa.binary()), ("impacts", pa.binary()),
    ]
)
_BEST = pa.schema([("item", pa.int64()), ("doc", pa.int64()), ("score", pa.int64())])


@dataclass(frozen=True)
class Index:
    """``segments`` (impact-sorted postings), ``terms`` (term, df), and the corpus's N and L."""

    segments: DataFrame
    terms: DataFrame
    n_docs: int
    n_terms: int


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def _packed(values: np.ndarray) -> bytes:
    """Numbers that are not negative in the narrowest type, told by a leading byte."""
    top = int(values.max()) if len(values) else 0
    kind = "<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8"
    return kind[-1].encode() + values.astype(kind).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{chr(data[0])}", offset=1).astype(np.int64)


def _longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def _segments_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A segment per chunk of documents: for each term (as a 64-bit hash) its documents and counts."""
    for batch in chunks(batches, "text"):
        hashes = [word_hashes(terms_of(t)) for t in batch.column("text").to_pylist()]
        lengths = np.array([len(h) for h in hashes], np.int64)
        has_terms = lengths > 0
        if not has_terms.any():
            continue
        words, which = np.unique(np.concatenate(hashes), return_inverse=True)
        n = int(has_terms.sum())
        place = np.repeat(np.arange(n), lengths[has_terms])
        pairs, counts = np.unique(which * n + place, return_counts=True)
        docs = batch.column("doc").to_numpy()[has_terms]
        yield batch_of(
            _POSTINGS,
            {
                "n_docs": [n], "n_terms": [int(lengths.sum())], "docs": [docs.tobytes()],
                "lengths": [_packed(lengths[has_terms])], "terms": [signed(words).tobytes()],
                "ends": [_packed(np.searchsorted(pairs, (np.arange(len(words)) + 1) * n))],
                "places": [_packed(pairs % n)], "counts": [_packed(counts)],
            },
        )


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for terms, ends in zip(batch.column("terms").to_pylist(), batch.column("ends").to_pylist()):
            yield pa.RecordBatch.from_arrays(
                [pa.array(_longs(terms)), pa.array(np.diff(_unpacked(ends), prepend=0))],
                names=["term", "n"],
            )


def length_factors(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Per document 50 plus 50 times its length over the mean length, rounded down."""
    if 50 * n_docs * int(lengths.max(initial=0)) < 1 << 63:
        return 50 + (50 * lengths * n_docs) // n_terms
    return np.array([50 + 50 * int(n) * n_docs // n_terms for n in lengths], np.int64)


def _sort_by_impact(n_docs: int, n_terms: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                places, counts, ends = (_unpacked(row[c]) for c in ("places", "counts", "ends"))
                factor = length_factors(_unpacked(row["lengths"]), n_docs, n_terms)
                impacts = (1_000_000_000 * counts) // (1000 * counts + 20 * factor[places])
                lists = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
                order = np.lexsort((-impacts, lists))
                yield batch_of(
                    _SORTED,
                    {
                        "segment": [row["segment"]], "docs": [row["docs"]],
                        "terms": [row["terms"]], "ends": [row["ends"]],
                        "places": [_packed(places[order])], "impacts": [_packed(impacts[order])],
                    },
                )

    return work


def build_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Index:
    """The index of all documents, whatever will be asked of it.

    A null text has no terms, and a document without terms is not in the index. Rows with equal or
    null ids are documents of their own. A segment holds about 4 MB of text or one longer text.
    Terms are known by 64-bit hashes.
    """
    with Staging(docs.sparkSession, "postings") as staging:
        raw = staging.hold(
            docs.select(key_of(id_column).alias("doc"), raw_text(text_column).alias("text")).mapInArrow(
                _segments_of,
                "n_docs long, n_terms long, docs binary, lengths binary, terms binary, ends binary,"
                " places binary, counts binary",
            ),
            "raw",
        )
        n_docs, n_terms = raw.agg(
            F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))
        ).first()
        counts = raw.select("terms", "ends").mapInArrow(_document_counts, "term long, n long")
        segments = raw.withColumn("segment", F.monotonically_increasing_id()).mapInArrow(
            _sort_by_impact(n_docs, n_terms),
            "segment long, docs binary, terms binary, ends binary, places binary, impacts binary",
        )
        return Index(
            stage(segments, "segments"),
            stage(counts.groupBy("term").agg(F.sum("n").alias("df")), "terms"), n_docs, n_terms,
        )


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
            terms = np.unique(word_hashes(terms_of(text)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(terms), item)), pa.array(signed(terms))], names=["item", "term"]
            )


def weighted_terms(index: Index, items: DataFrame) -> DataFrame:
    """(item, term, weight) of the terms that add to a score, from (item, text as bytes)."""
    weight = F.floor(
        1000 * F.log((2.0 * index.n_docs + 2.0) / (2.0 * F.col("df") + 1.0))
    ).cast("long")
    terms = items.mapInArrow(_query_terms, "item long, term long")
    return terms.join(index.terms, "term").select("item", "term", weight.alias("weight")).where(
        "weight > 0"
    )


class _Queries:
    """A block of queries as one task reads it, with the best documents each has found so far."""

    def __init__(self, rows: list[dict]):
        self.items = [row["item"] for row in rows]
        self.terms = [np.array([t["term"] for t in row["terms"]], np.int64) for row in rows]
        self.weights = [np.array([t["weight"] for t in row["terms"]], np.int64) for row in rows]
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in rows]


class _Lists:
    """The posting lists of a segment."""

    def __init__(self, row: dict):
        self.docs = _longs(row["docs"])
        self.terms = _longs(row["terms"]).view(np.uint64)
        self.ends = _unpacked(row["ends"])
        self.places = _unpacked(row["places"])
        self.impacts = _unpacked(row["impacts"])

    def of(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the terms have a list here, and where those lists begin and end."""
        at = np.searchsorted(self.terms, terms.view(np.uint64))
        at[at == len(self.terms)] = 0
        has_list = self.terms[at] == terms.view(np.uint64)
        at = at[has_list]
        return has_list, np.where(at > 0, self.ends[at - 1], 0), self.ends[at]


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the half-open ranges, one after the other."""
    sizes = ends - starts
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
    return shift + np.arange(len(shift))


def _kth_largest(values: np.ndarray, k: int) -> int:
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else 0


def read_best(
    lists: _Lists, terms: np.ndarray, weights: np.ndarray, k: int, known: np.ndarray,
    first_read: int = FIRST_READ,
) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of documents of a segment that may be among the ``k`` best of a query.

    ``known`` are final scores of other documents. ``missing`` is what a document can still gain:
    the next impacts of all lists, less those of the lists that have shown it. ``floor`` is the
    score that k documents reach for certain, and a document whose upper bound is below it is out.
    Reading ends where no document left can gain anything; one that no list has shown yet can
    gain the next impacts of all lists. Otherwise the next round reads twice as far.
    """
    has_list, starts, ends = lists.of(terms)
    weights = weights[has_list]
    n = len(lists.docs)
    lower = np.zeros(n, np.int64)
    read, step = starts, first_read
    while len(starts):
        bounds = np.zeros(len(starts), np.int64)
        unread = read < ends
        bounds[unread] = lists.impacts[read[unread]] * weights[unread]
        shown = np.repeat(bounds, read - starts)
        missing = bounds.sum() - _summed(lists.places[_ranges(starts, read)], shown, n)
        floor = max(_kth_largest(np.concatenate((lower, known)), k), 1)
        still_open = lower + missing >= floor
        if not missing[still_open].any():
            places = np.flatnonzero(still_open)
            return places, lower[places]
        upto = np.minimum(ends, starts + step)
        rows = _ranges(read, upto)
        lower += _summed(lists.places[rows], lists.impacts[rows] * np.repeat(weights, upto - read), n)
        read, step = upto, 2 * step
    return np.empty(0, np.int64), lower[:0]


def _summed(places: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(n, np.int64)
    np.add.at(total, places, values)
    return total


def _search(k: int, first_read: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, key, waiting = None, None, []
        for batch in batches:
            for i in range(batch.num_rows):  # a row can be a whole segment
                row = batch.slice(i, 1).to_pylist()[0]
                if (row["block"], row["lane"]) != key:
                    yield from found(queries)
                    key, queries, waiting = (row["block"], row["lane"]), None, []
                if row["terms"] is None:
                    waiting.append({"item": row["item"], "terms": row["query"]})
                    continue
                if waiting:
                    queries, waiting = _Queries(waiting), []
                if queries:
                    look(queries, _Lists(row))
        yield from found(queries)

    def look(queries: _Queries, lists: _Lists) -> None:
        for i, (terms, weights) in enumerate(zip(queries.terms, queries.weights)):
            docs, scores = queries.best[i]
            places, new = read_best(lists, terms, weights, k, scores, first_read)
            if len(places):
                docs = np.concatenate((docs, lists.docs[places]))
                scores = np.concatenate((scores, new))
                keep = np.lexsort((docs, -scores))[:k]
                queries.best[i] = docs[keep], scores[keep]

    def found(queries: _Queries | None) -> Iterator[pa.RecordBatch]:
        if queries is None:
            return
        sizes = [len(docs) for docs, _ in queries.best]
        yield batch_of(
            _BEST,
            {
                "item": np.repeat(np.array(queries.items, np.int64), sizes),
                "doc": np.concatenate([docs for docs, _ in queries.best]),
                "score": np.concatenate([scores for _, scores in queries.best]),
            },
        )

    return work


def search(
    index: Index, items: DataFrame, k: int, item_column: str = "item_id", text_column: str = "text",
    block_terms: int = BLOCK_TERMS, first_read: int = FIRST_READ, lanes: int | None = None,
) -> DataFrame:
    """The ``k`` best documents of every item: item, rank (from 1), doc_id, score.

    Every row of ``items`` is a query of its own, also where ids repeat or are null; a null text
    asks for nothing. Equal scores are ranked by ascending id, a null id first. Documents with a
    score of 0 are not ranked. The column ``item_column`` comes back as it is.

    Queries form blocks by their number; a block holds about ``block_terms`` terms or one longer
    query, and meets every segment. Segments are dealt to ``lanes`` tasks per block, where the
    block's queries come first and the segments stream by, one in memory at a time.
    """
    spark = items.sparkSession
    asked = stage(
        items.select(
            F.monotonically_increasing_id().alias("item"), F.col(item_column).alias("name"),
            raw_text(text_column).alias("text"),
        ),
        "items",
    )
    terms = stage(weighted_terms(index, asked.select("item", "text")), "item-terms")
    blocks = 1 + terms.count() // block_terms
    lanes = lanes or int(spark.conf.get("spark.sql.shuffle.partitions"))
    queries = terms.groupBy("item").agg(F.collect_list(F.struct("term", "weight")).alias("query"))
    nothing = [F.lit(None).cast("binary").alias(c) for c in ("docs", "terms", "ends", "places", "impacts")]
    asking = queries.select(
        F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"),
        F.lit(-1).cast("long").alias("segment"), "item", "query", *nothing,
    )
    reading = index.segments.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.pmod(F.xxhash64("segment"), F.lit(lanes)).cast("int").alias("lane"),
        "segment", F.lit(None).cast("long").alias("item"),
        F.lit(None).cast("array<struct<term: bigint, weight: bigint>>").alias("query"),
        "docs", "terms", "ends", "places", "impacts",
    )
    found = (
        asking.union(reading)
        .repartition("block", "lane")
        .sortWithinPartitions("block", "lane", "segment")
        .mapInArrow(_search(k, first_read), "item long, doc long, score long")
    )
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item", "name"), "item").select(
        F.col("name").alias(item_column), "rank", id_of("doc").alias("doc_id"), "score"
    )

"""N-gram Jaccard join with Bayesian pruning of the candidates.

Texts with the same words are one class and take part once, whatever their number. Classes meet
where four consecutive values of their MinHash signatures agree; 32 such bands find a pair at the
threshold of 0.8 with a chance of 1 - 5e-8. Inside a bucket the signatures are compared sixteen
values at a time, and a pair is dropped once the posterior probability that its similarity reaches
the threshold (uniform prior) is below ``TOLERANCE``. What is left is verified on the shingles
themselves.

A bucket is compared in one task up to ``BLOCK`` classes; a larger one is cut into blocks, and
every pair of blocks is a task. Pairs never become rows: a task emits partner lists, then numbers of
links and the edges of a spanning forest. A pair is taken only in the first band it agrees in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from itertools import count
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlens.llm.common import (
    batch_of, chunks, groups, id_of, key_of, raw_text, window_hashes, word_hashes,
)
from barlens.session import Staging, stage

SHINGLE = 5
THRESHOLD = (4, 5)
HASHES = 128
ROWS = 4
STEP = 16
TOLERANCE = 1e-6
BLOCK = 1000

_random = np.random.default_rng(20240229)
_FACTORS = _random.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _random.integers(0, 2**32, HASHES, dtype=np.uint32)
_ROWS_AT_ONCE = 2048


def signature(words: list[bytes]) -> bytes:
    """128 MinHash values of the word shingles, 16 bits of each."""
    grams = window_hashes(word_hashes(words), min(SHINGLE, len(words)))
    grams = (grams >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(grams), _ROWS_AT_ONCE):
        values = grams[i : i + _ROWS_AT_ONCE, None] * _FACTORS + _SHIFTS
        np.minimum(least, values.min(axis=0), out=least)
    least ^= least >> np.uint32(15)
    least *= np.uint32(0x85EBCA6B)
    return (least >> np.uint32(16)).astype("<u2").tobytes()


def chance(matches: int, compared: int) -> float:
    """Posterior probability of reaching the threshold, from a uniform prior."""
    t = THRESHOLD[0] / THRESHOLD[1]
    n = compared + 1
    return sum(comb(n, k) * t**k * (1 - t) ** (n - k) for k in range(matches + 1))


@cache
def fewest_matches(compared: int) -> int:
    """Fewest agreeing values with which a pair goes on."""
    return next(m for m in range(compared + 1) if chance(m, compared) >= TOLERANCE)


def surviving_pairs(left: np.ndarray, right: np.ndarray | None, band: int):
    """Index pairs of signature rows that meet first in ``band`` and pass the pruning.

    Without ``right`` the pairs are those within ``left``.
    """
    other = left if right is None else right
    bands, other_bands = left.view(np.uint64), other.view(np.uint64)
    open_ = np.ones((len(left), len(other)), bool)
    if right is None:
        open_ = np.triu(open_, 1)
    for earlier in range(band):
        open_ &= bands[:, earlier, None] != other_bands[None, :, earlier]
    first, second = np.nonzero(open_)
    agree = np.zeros(len(first), np.int32)
    for start in range(0, HASHES, STEP):
        end = start + STEP
        agree += (left[first, start:end] == other[second, start:end]).sum(axis=1, dtype=np.int32)
        alive = agree >= fewest_matches(end)
        first, second, agree = first[alive], second[alive], agree[alive]
        if not len(first):
            break
    return first, second


_SIGNED = pa.schema(
    [
        ("row", pa.int64()), ("doc", pa.int64()), ("words_key", pa.binary()),
        ("signature", pa.binary()), ("packed", pa.binary()),
    ]
)


def _with_signatures(docs: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1).compress
        for batch in chunks(batches, "text"):
            keys, signatures, packed = [], [], []
            for text in batch.column("text").to_pylist():
                words = text.split()
                joined = b" ".join(words)
                keys.append(xxhash.xxh3_128_digest(joined) if words else None)
                signatures.append(signature(words) if words else None)
                packed.append(press(joined) if words else None)
            yield batch_of(
                _SIGNED,
                {
                    "row": batch.column("row"), "doc": batch.column("doc"), "words_key": keys,
                    "signature": signatures, "packed": packed,
                },
            )

    return docs.mapInArrow(
        work, "row long, doc long, words_key binary, signature binary, packed binary"
    )


_BANDS = pa.schema([("band", pa.int32()), ("value", pa.int64()), ("row", pa.int64())])


def _bands(classes: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = HASHES // ROWS
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.int64)
            rows = batch.column("row").to_numpy()
            yield batch_of(
                _BANDS,
                {
                    "band": np.tile(np.arange(n, dtype=np.int32), len(rows)), "value": values,
                    "row": np.repeat(rows, n),
                },
            )

    return classes.mapInArrow(work, "band int, value long, row long")


_BUCKET = ("band", "value", "x", "y")


def _block_members(bands: DataFrame, block: int) -> DataFrame:
    """Members of the buckets with company, once for each pair of blocks they belong to."""
    sizes = bands.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / block).cast("int")
    # A merge join at every size: the buckets with company grow with the corpus.
    members = bands.join(sizes.hint("merge"), ["band", "value"]).select(
        "band", "value", "row", parts.alias("parts"),
        F.pmod(F.xxhash64("row"), parts).cast("int").alias("own"),
    )
    return members.withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    ).select(
        "band", "value", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "row",
    )


_PARTNERS = pa.schema(
    [
        ("band", pa.int32()), ("value", pa.int64()), ("x", pa.int32()), ("y", pa.int32()),
        ("row", pa.int64()), ("partners", pa.list_(pa.int64())),
    ]
)


def _candidates(members: DataFrame) -> DataFrame:
    """Per bucket block and class, the partners that survive the pruning.

    A row without a class lists all classes of the block that take part.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, pieces in groups(batches, list(_BUCKET)):
            rows, sides, signatures = [], [], []
            for piece in pieces:
                rows.append(piece.column("row").to_numpy())
                sides.append(piece.column("side").to_numpy())
                signatures += piece.column("signature").to_pylist()
            rows, sides = np.concatenate(rows), np.concatenate(sides)
            table = np.frombuffer(b"".join(signatures), "<u2").reshape(len(rows), HASHES)
            if key[2] == key[3]:
                first, second = surviving_pairs(table, None, key[0])
                others = rows
            else:
                left = sides == 0
                first, second = surviving_pairs(table[left], table[~left], key[0])
                rows, others = rows[left], rows[~left]
            if not len(first):
                continue
            starts = np.flatnonzero(np.diff(first, prepend=-1))
            lists = np.split(others[second], starts[1:])
            own = rows[first[starts]]
            everyone = np.union1d(own, others[second])
            yield batch_of(
                _PARTNERS,
                {
                    **{name: [part] * (len(own) + 1) for name, part in zip(_BUCKET, key)},
                    "row": [None, *own.tolist()],
                    "partners": [everyone.tolist(), *(p.tolist() for p in lists)],
                },
            )

    return members.repartition(*_BUCKET).sortWithinPartitions(*_BUCKET).mapInArrow(
        work, "band int, value long, x int, y int, row long, partners array<long>"
    )


class _Forest:
    """Which of some nodes are connected."""

    def __init__(self):
        self._up: dict[int, int] = {}

    def _root(self, node: int) -> int:
        up = self._up
        while up.setdefault(node, node) != node:
            up[node] = up[up[node]]
            node = up[node]
        return node

    def join(self, a: int, b: int) -> bool:
        """Connects two nodes; whether they were apart."""
        a, b = self._root(a), self._root(b)
        self._up[max(a, b)] = min(a, b)
        return a != b


class _Shingles:
    """Shingles of the texts of one group as numbers, exact within the group."""

    def __init__(self, packed: dict[int, bytes]):
        self._packed, self._numbers, self._known = packed, {}, {}
        self._unpack = zstandard.ZstdDecompressor().decompress

    def __call__(self, row: int) -> np.ndarray:
        if row not in self._known:
            words = self._unpack(self._packed[row]).split()
            size = min(SHINGLE, len(words))
            grams = {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}
            numbers = self._numbers
            self._known[row] = np.fromiter(
                (numbers.setdefault(g, len(numbers)) for g in grams), np.int64, len(grams)
            )
        return self._known[row]

    def linked(self, row: int, partners: list[int]) -> Iterator[int]:
        """The partners whose similarity reaches the threshold."""
        own = self(row)
        others = [self(p) for p in partners]
        mark = np.zeros(len(self._numbers), bool)
        mark[own] = True
        for partner, other in zip(partners, others):
            common = int(mark[other].sum())
            either = len(own) + len(other) - common
            if THRESHOLD[1] * common >= THRESHOLD[0] * either:
                yield partner


_LINKS = pa.schema([("row", pa.int64()), ("links", pa.int64()), ("to", pa.list_(pa.int64()))])


def _verified(candidates: DataFrame, texts: DataFrame) -> DataFrame:
    """Per group and class: its number of verified links there, and edges of a forest of them."""
    asked = candidates.where("row is not null").select(
        *_BUCKET, F.lit(1).alias("kind"), "row", "partners",
        F.lit(None).cast("binary").alias("packed"),
    )
    # A merge join at every size: the texts grow with the corpus.
    members = (
        candidates.where("row is null")
        .select(*_BUCKET, F.explode("partners").alias("row"))
        .join(texts.hint("merge"), "row")
        .select(
            *_BUCKET, F.lit(0).alias("kind"), "row",
            F.lit(None).cast("array<bigint>").alias("partners"), "packed",
        )
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, pieces in groups(batches, list(_BUCKET)):
            packed, links, edges = {}, {}, {}
            shingles, forest = _Shingles(packed), _Forest()
            for piece in pieces:
                for kind, row, partners, text in zip(
                    *(piece.column(c).to_pylist() for c in ("kind", "row", "partners", "packed"))
                ):
                    if kind == 0:
                        packed[row] = text
                        continue
                    for partner in shingles.linked(row, partners):
                        links[row] = links.get(row, 0) + 1
                        links[partner] = links.get(partner, 0) + 1
                        if forest.join(row, partner):
                            edges.setdefault(row, []).append(partner)
            if links:
                yield batch_of(
                    _LINKS,
                    {
                        "row": list(links), "links": list(links.values()),
                        "to": [edges.get(row, []) for row in links],
                    },
                )

    return (
        members.unionByName(asked).repartition(*_BUCKET).sortWithinPartitions(*_BUCKET, "kind")
        .mapInArrow(work, "row long, links long, to array<long>")
    )


def components(edges: DataFrame, hold: Callable[[DataFrame, str], DataFrame] = stage) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): the smallest node it is connected with.

    Alternates two steps until nothing moves: every node hands its larger neighbours to the
    smallest node next to it, then its smaller ones. Each step is a minimum per node and a join;
    ``hold`` writes it and reads it back. Rounds grow with the logarithm of the largest component.
    """
    larger = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    current = hold(edges.where("a <> b").select(*larger).distinct(), "edges")
    before, rounds = None, count(1)
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        pulled = both.where("b > a").join(lowest, "a").select(
            F.col("b").alias("a"), F.col("low").alias("b")
        ).where("a <> b").distinct()
        least = pulled.groupBy("a").agg(F.min("b").alias("low"))
        pushed = pulled.join(least, "a").select(
            F.explode(
                F.array(F.struct(F.col("a"), F.col("low").alias("b")),
                        F.struct(F.col("b").alias("a"), F.col("low").alias("b")))
            ).alias("e")
        ).select("e.*").where("a <> b").distinct()
        current = hold(pushed, f"edges-{next(rounds)}")
        now = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", block: int = BLOCK,
    row_column: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, n_links, n_copies, is_first.

    Similarity is the Jaccard index of the sets of five consecutive words (words as white space
    separates them, unchanged; a shorter text is one shingle); a link needs 0.8. class_id is the
    smallest id among the documents connected by links, n_links the number of different texts
    linked with this one, n_copies the rows with the same words, is_first true for one row of each
    class: the smallest id, then the first read. A text without words is a class of its own with
    no links. Null ids come first and show as null. Rows with equal ids are told apart by their
    text; their classes may share an id. Other columns are ignored. ``row_column`` names a unique
    number of each row, which the result then holds as row.
    """
    number = F.col(row_column) if row_column else F.monotonically_increasing_id()
    narrow = docs.select(
        number.alias("row"), key_of(id_column).alias("doc"),
        raw_text(text_column).alias("text"),
    )
    with Staging(docs.sparkSession, "near-duplicates") as staging:
        result = _classified(narrow, block, staging.hold)
        # Narrow rows; the texts and signatures behind them go.
        return stage(result if row_column else result.drop("row"), "near-duplicates")


def _classified(
    narrow: DataFrame, block: int, hold: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """``near_duplicates`` of (row, doc, text); ``hold`` writes what is read several times."""
    base = hold(_with_signatures(narrow), "signatures")
    classes = hold(
        base.where("words_key is not null").groupBy("words_key")
        .agg(F.min(F.struct("doc", "row")).alias("first"), F.count("*").alias("n_copies"))
        .select("words_key", "first", F.col("first.row").alias("row"), "n_copies"),
        "classes",
    )
    signatures = hold(
        base.select("row", "signature").join(classes.select("row"), "row"), "class-signatures"
    )
    members = _block_members(_bands(signatures), block).join(signatures, "row")
    candidates = hold(_candidates(members), "candidates")
    links = hold(_verified(candidates, base.select("row", "packed")), "links")
    edges = links.select(F.col("row").alias("a"), F.explode("to").alias("b"))
    found = components(edges, hold).join(
        classes.select(F.col("row").alias("node"), "first"), "node"
    )
    heads = found.groupBy("root").agg(F.min("first").alias("head"))
    counts = links.groupBy(F.col("row").alias("node")).agg(F.sum("links").alias("n_links"))
    linked = found.join(heads, "root").join(counts, "node").select(
        F.col("node").alias("row"), "head", "n_links"
    )
    described = classes.join(linked, "row", "left").select(
        "words_key", "n_copies", F.coalesce("head", "first").alias("head"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
    alone = F.struct("doc", "row")
    result = base.select("row", "doc", "words_key").join(described, "words_key", "left")
    result = result.withColumn("head", F.coalesce("head", alone))
    return result.select(
        id_of("doc").alias("doc_id"), id_of("head.doc").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        (F.col("head.row") == F.col("row")).alias("is_first"),
        "row",
    )

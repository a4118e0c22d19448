"""Removal of long word sequences that an earlier document holds, by suffix automata.

A document's matching statistics against everything before it would cost the corpus times the
corpus, so three distributed steps first bring together what can match:

0. Documents of the same words are one class, and its smallest document stands for it. The words of
   the others all stand in that one, so they go without a search (unless too few for a window).
1. Every window of ``width`` words picks the smallest hash of the shorter runs inside it, its
   anchor. Equal windows have equal anchors, and a document has few of them. Anchors seen in one
   document only are out, and with them most of the text.
2. The remaining windows are hashed (128 bits) and get the first row of the smallest document that
   holds them, their owner. Partial minima combine before the shuffle, so frequent passages do no
   harm; rows are numbered in the order of their documents, so that a minimum of numbers is enough.
3. Runs of windows with one owner become spans of words: reference spans in the owner, probe spans
   in the later documents. Each distinct repeated window is reference once, in its owner.

Reference spans, sharded by owner (one row, however many have its id), become suffix automata. Probe spans stream through the automaton
of their owner and its matching statistics say which maximal spans of ``width`` words or more go;
words are compared as they are, hashes only route. An owner with very many probe words is copied
to several tasks, between which its probe spans are dealt out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlens.llm.common import (
    batch_of, chunks, covered, groups, id_of, key_of, list_array, mixed, raw_text, runs_of, signed,
    sliding_min, window_hashes, word_hashes,
)
from barlens.session import Staging, stage

WIDTH = 50

# Probe words of one owner that one task streams.
PROBE_WORDS = 500_000


class SuffixAutomaton:
    """All word sequences of some spans of words."""

    def __init__(self):
        self._next: list[dict] = [{}]
        self._link = [-1]
        self._length = [0]
        self._last = 0
        self._ends = 0

    def add(self, words: list) -> None:
        """Add a span; no match runs from one span into another."""
        for word in words:
            self._extend(word)
        self._ends += 1
        self._extend(self._ends)  # a number equals no word

    def _extend(self, word) -> None:
        following, link, length = self._next, self._link, self._length
        new = len(following)
        following.append({})
        link.append(0)
        length.append(length[self._last] + 1)
        state = self._last
        while state >= 0 and word not in following[state]:
            following[state][word] = new
            state = link[state]
        if state >= 0:
            target = following[state][word]
            if length[target] == length[state] + 1:
                link[new] = target
            else:
                copy = len(following)
                following.append(dict(following[target]))
                link.append(link[target])
                length.append(length[state] + 1)
                while state >= 0 and following[state].get(word) == target:
                    following[state][word] = copy
                    state = link[state]
                link[target] = link[new] = copy
        self._last = new

    def matches(self, words: list) -> Iterator[int]:
        """Matching statistics: length of the longest match that ends at each word."""
        following, link, length = self._next, self._link, self._length
        state = matched = 0
        for word in words:
            while state and word not in following[state]:
                state = link[state]
                matched = length[state]
            target = following[state].get(word)
            if target is not None:
                state = target
                matched += 1
            yield matched


def _anchor_width(width: int) -> int:
    """Long enough that few windows share an anchor without being equal."""
    return max(1, width * 3 // 5)


def _anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """The anchor of every window."""
    short = _anchor_width(width)
    return sliding_min(window_hashes(hashes, short), width - short + 1)


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


_BASE = pa.schema(
    [
        ("row", pa.int64()), ("doc", pa.int64()), ("n_words", pa.int64()),
        ("sha256", pa.string()), ("words_key", pa.binary()), ("anchors", pa.list_(pa.int64())),
    ]
)


def _with_anchors(docs: DataFrame, width: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            n_words, digests, keys, anchors = [], [], [], []
            for text in batch.column("text").to_pylist():
                words = text.split()
                joined = b" ".join(words)
                n_words.append(len(words))
                digests.append(hashlib.sha256(joined).hexdigest())
                keys.append(xxhash.xxh3_128_digest(joined) if len(words) >= width else None)
                anchors.append(np.unique(_anchors(word_hashes(words), width)))
            yield batch_of(
                _BASE,
                {
                    "row": batch.column("row"), "doc": batch.column("doc"), "n_words": n_words,
                    "sha256": digests, "words_key": keys, "anchors": list_array(
                        signed(np.concatenate(anchors)), map(len, anchors), pa.int64()
                    ),
                },
            )

    return docs.mapInArrow(
        work,
        "row long, doc long, n_words long, sha256 string, words_key binary, anchors array<long>",
    )


_PACKED = pa.schema([("row", pa.int64()), ("packed", pa.binary())])


def _packed(narrow: DataFrame) -> DataFrame:
    """The texts, compressed for the way through shuffles."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1).compress
        for batch in chunks(batches, "text"):
            packed = [press(text) for text in batch.column("text").to_pylist()]
            yield batch_of(_PACKED, {"row": batch.column("row"), "packed": packed})

    return narrow.select("row", "text").mapInArrow(work, "row long, packed binary")


_WINDOWS = pa.schema(
    [("row", pa.int64()), ("doc", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())]
)


def _second(hashes: np.ndarray) -> np.ndarray:
    return mixed(hashes ^ np.uint64(0xA5A5A5A55A5A5A5A))


def _shared_windows(candidates: DataFrame, width: int) -> DataFrame:
    """128-bit hashes of the windows whose anchor is in several documents, once per row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in chunks(batches, "packed"):
            out = {"row": [], "doc": [], "h1": [], "h2": []}
            for row, doc, packed, anchors in zip(
                *(batch.column(c).to_pylist() for c in ("row", "doc", "packed", "anchors"))
            ):
                hashes = word_hashes(unpack(packed).split())
                chosen = np.isin(
                    _anchors(hashes, width), np.array(anchors, np.int64).view(np.uint64)
                )
                h1 = window_hashes(hashes, width)[chosen]
                h2 = window_hashes(_second(hashes), width)[chosen]
                h1, first = np.unique(h1, return_index=True)
                out["row"].append(np.full(len(h1), row))
                out["doc"].append(np.full(len(h1), doc))
                out["h1"].append(signed(h1))
                out["h2"].append(signed(h2[first]))
            yield batch_of(_WINDOWS, {k: np.concatenate(v) for k, v in out.items()})

    return candidates.mapInArrow(work, "row long, doc long, h1 long, h2 long")


_SPANS = pa.schema(
    [
        ("owner", pa.int64()), ("kind", pa.int32()), ("row", pa.int64()), ("start", pa.int64()),
        ("n", pa.int64()), ("words", pa.binary()),
    ]
)


def _spans(marked: DataFrame, width: int) -> DataFrame:
    """Reference spans (kind 0) and probe spans (kind 1) of the marked windows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in chunks(batches, "packed"):
            out = {name: [] for name in _SPANS.names}
            for row, packed, marks in zip(
                *(batch.column(c).to_pylist() for c in ("row", "packed", "marks"))
            ):
                words = unpack(packed).split()
                known = np.array([m["h1"] for m in marks], np.int64)
                owners = np.array([m["owner"] for m in marks], np.int64)
                order = np.argsort(known)
                known, owners = known[order], owners[order]
                h1 = signed(window_hashes(word_hashes(words), width))
                at = np.minimum(np.searchsorted(known, h1), len(known) - 1)
                places = np.flatnonzero(known[at] == h1)
                of = owners[at[places]]
                cuts = np.flatnonzero((np.diff(places) != 1) | (np.diff(of) != 0)) + 1
                for run in np.split(np.arange(len(places)), cuts):
                    if not len(run):
                        continue
                    start, end = int(places[run[0]]), int(places[run[-1]]) + width
                    owner = int(of[run[0]])
                    out["owner"].append(owner)
                    out["kind"].append(0 if owner == row else 1)
                    out["row"].append(row)
                    out["start"].append(start)
                    out["n"].append(end - start)
                    out["words"].append(b" ".join(words[start:end]))
            yield batch_of(_SPANS, out)

    return marked.mapInArrow(
        work, "owner long, kind int, row long, start long, n long, words binary"
    )


def _with_salts(spans: DataFrame, probe_words: int) -> DataFrame:
    """Deals the probe spans of a busy owner out and copies its reference to each part."""
    busy = (
        spans.where("kind = 1").groupBy("owner").agg(F.sum("n").alias("probe"))
        .where(F.col("probe") > probe_words)
        .select("owner", F.ceil(F.col("probe") / probe_words).cast("int").alias("parts"))
    )
    parts = F.coalesce("parts", F.lit(1))
    dealt = F.when(
        F.col("kind") == 0, F.sequence(F.lit(0), parts - 1)
    ).otherwise(F.array(F.pmod(F.xxhash64("row", "start"), parts).cast("int")))
    return spans.join(busy, "owner", "left").withColumn("salt", F.explode(dealt)).drop("parts")


_REMOVED = pa.schema([("row", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _matched(salted: DataFrame, width: int) -> DataFrame:
    """Removed spans per row, from matching statistics against each owner's automaton."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, pieces in groups(batches, ["owner", "salt"]):
            automaton = SuffixAutomaton()
            for piece in pieces:
                out = {"row": [], "start": [], "end": []}
                for kind, row, start, joined in zip(
                    *(piece.column(c).to_pylist() for c in ("kind", "row", "start", "words"))
                ):
                    words = joined.split(b" ")
                    if kind == 0:
                        automaton.add(words)
                        continue
                    matched = np.fromiter(automaton.matches(words), np.int64, len(words))
                    ends = np.flatnonzero(matched >= width) + 1
                    mask = covered(ends - matched[ends - 1], ends, len(words))
                    for first, last in zip(*runs_of(mask)):
                        out["row"].append(row)
                        out["start"].append(start + int(first))
                        out["end"].append(start + int(last))
                if out["row"]:
                    yield batch_of(_REMOVED, out)

    return (
        salted.repartition("owner", "salt").sortWithinPartitions("owner", "salt", "kind")
        .mapInArrow(work, "row long, start long, end long")
    )


_KEPT = pa.schema(
    [
        ("row", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
        ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
    ]
)


def _kept(removed: DataFrame) -> DataFrame:
    """Per row that loses words: what is left, as counts, digest and removed spans."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in chunks(batches, "packed"):
            out = {name: [] for name in _KEPT.names}
            for row, packed, spans in zip(
                *(batch.column(c).to_pylist() for c in ("row", "packed", "spans"))
            ):
                words = unpack(packed).split()
                starts = np.array([s["start"] for s in spans], np.int64)
                ends = np.array([s["end"] for s in spans], np.int64)
                mask = covered(starts, ends, len(words))
                first, last = runs_of(mask)
                out["row"].append(row)
                out["n_removed"].append(int(mask.sum()))
                out["kept_sha256"].append(_digest([words[i] for i in np.flatnonzero(~mask)]))
                out["starts"].append(first.tolist())
                out["ends"].append(last.tolist())
            yield batch_of(_KEPT, out)

    return removed.mapInArrow(
        work, "row long, n_removed long, kept_sha256 string, starts array<long>, ends array<long>"
    )


def _kept_text(result: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in chunks(batches, "packed"):
            texts = []
            for packed, spans in zip(*(batch.column(c).to_pylist() for c in ("packed", "spans"))):
                words, kept, at = unpack(packed).split(), [], 0
                for span in spans:
                    kept += words[at : span["starts"]]
                    at = span["ends"]
                texts.append(b" ".join(kept + words[at:]).decode("utf-8"))
            columns = {n: batch.column(n) for n in batch.schema.names if n != "packed"}
            yield pa.RecordBatch.from_pydict({**columns, "kept_text": pa.array(texts)})

    fields = [f"{n} {t}" for n, t in result.dtypes if n != "packed"]
    return result.mapInArrow(work, ", ".join([*fields, "kept_text string"]))


def remove_repeats(
    docs: DataFrame, width: int = WIDTH, id_column: str = "doc_id", text_column: str = "text",
    probe_words: int = PROBE_WORDS, keep_text: bool = False, row_column: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, spans (word ranges).

    Words are what white space (ASCII) separates. A word goes if a window of ``width`` consecutive
    words around it also stands in a document with a smaller id; windows are judged on the input.
    ``keep_text`` adds kept_text, the kept words joined by one space. Null and empty texts have no
    words. Equal ids are one document, so copies under one id stay; a null id is before all others.
    Other columns are ignored.

    The texts are read twice. ``row_column`` names a number per row, none twice, that is the same in
    every read of ``docs`` (``with_file_rows``); without it the texts are written once more.

    Memory: a task holds the automaton of one row's repeated text, or one document.
    """
    number = F.col(row_column).cast("long") if row_column else F.monotonically_increasing_id()
    narrow = docs.select(
        number.alias("row"), key_of(id_column).alias("doc"), raw_text(text_column).alias("text")
    )
    with Staging(docs.sparkSession, "substring-dedup") as staging:
        if row_column is None:
            narrow = staging.hold(narrow, "rows")
        # Narrow rows unless texts are asked for; the tables behind them go.
        return stage(_without_repeats(narrow, width, probe_words, keep_text, staging.hold), "kept")


def _without_repeats(
    narrow: DataFrame, width: int, probe_words: int, keep_text: bool,
    hold: Callable[[DataFrame, str], DataFrame],
) -> DataFrame:
    """``remove_repeats`` of (row, doc, text), read twice; ``hold`` writes what is read several times.

    From ``candidates`` on, row numbers the rows in the order of doc; base_row is the row of ``narrow``.
    """
    base = hold(_with_anchors(narrow, width), "anchors")
    classes = base.where("words_key is not null").groupBy("words_key").agg(
        F.min(F.struct("doc", "row")).alias("first")
    )
    first_rows = classes.select("first.row", "first.doc")
    # Joined by both columns, so that the two uses of the anchors need, and share, one shuffle.
    anchors = (
        base.select("row", "doc", "anchors").join(first_rows, ["row", "doc"], "left_semi")
        .select("row", "doc", F.explode("anchors").alias("anchor"))
    )
    shared = (
        anchors.groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
        .where("low < high").select("anchor")
    )
    chosen = anchors.join(shared, "anchor").groupBy("row").agg(
        F.collect_list("anchor").alias("anchors")
    )
    places = (
        base.select("row", "doc").repartitionByRange("doc", "row").sortWithinPartitions("doc", "row")
        .select("row", "doc", F.monotonically_increasing_id().alias("place"))
    )
    candidates = hold(
        _packed(narrow).join(chosen.join(places, "row"), "row")
        .withColumnsRenamed({"row": "base_row", "place": "row"}),
        "candidates",
    )
    windows = _shared_windows(candidates, width)
    owners = (
        windows.groupBy("h1", "h2").agg(
            F.min("row").alias("owner"), F.min("doc").alias("low"), F.max("doc").alias("high")
        )
        .where("low < high").drop("high")
    )
    # The owner's document has nothing to look up in its other rows.
    marks = (
        windows.join(owners, ["h1", "h2"]).where("row = owner or doc > low").groupBy("row")
        .agg(F.collect_list(F.struct("h1", "owner")).alias("marks"))
    )
    texts = candidates.select("row", "base_row", "packed")
    spans = hold(_spans(texts.join(marks, "row"), width), "spans")
    removed = _matched(_with_salts(spans, probe_words), width)
    lists = removed.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    kept = _kept(
        texts.join(lists, "row").select(F.col("base_row").alias("row"), "packed", "spans")
    )
    span_list = F.coalesce(
        F.arrays_zip("starts", "ends"),
        F.array().cast("array<struct<starts:bigint,ends:bigint>>"),
    )
    copy = F.coalesce(F.col("doc") > F.col("first.doc"), F.lit(False))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("starts"), F.col("n_words").alias("ends")))
    found = (
        base.drop("anchors")
        .join(classes, "words_key", "left")
        .join(kept.withColumnRenamed("row", "first_row"), F.col("first.row") == F.col("first_row"), "left")
    )
    if keep_text:
        found = found.join(_packed(narrow), "row")
    result = found.select(
        id_of("doc").alias("doc_id"), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)).cast("long"))
        .alias("n_removed"),
        F.when(copy, F.lit(_digest([]))).otherwise(F.coalesce("kept_sha256", "sha256"))
        .alias("kept_sha256"),
        F.when(copy, whole).otherwise(span_list).alias("spans"),
        *(["packed"] if keep_text else []),
    )
    return _kept_text(result) if keep_text else result

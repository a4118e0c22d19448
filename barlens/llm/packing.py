"""Best-fit packing of tokenized documents into sequences of a fixed length.

The plan is made over the histogram of piece lengths, never over the pieces: best fit decreasing
places whole counts at once, so its size depends on the capacity and not on the corpus. Each piece
then takes the planned slot of its rank among the pieces of its length. Ranks need no sort and no
window over a length: a task numbers its own pieces of each length, and the counts per task,
summed in task order, say where its numbers begin. A third of all pieces may share one length.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlens.llm.common import batch_of, chunks, raw_text
from barlens.session import stage

END_OF_TEXT = 2
CAPACITY = 1024

_BARE_SPACE = re.compile(r"(?<!\s) (?!\s)")
_RANK_BITS = 44


# How a byte-level vocabulary writes bytes, and how its text falls into words.
_SHOWN_AS_IS = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in _SHOWN_AS_IS]
_LETTER_BYTES = {chr(b): b for b in _SHOWN_AS_IS} | {chr(256 + i): b for i, b in enumerate(_HIDDEN)}
_WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Words beyond these letters are left to the tokenizer's own Unicode tables.
_LATIN = re.compile(r"[\x00-\u024f]*")


def _quick_encoder(tokenizer):
    """The same vocabulary and merges in a form that is quick on plain text, or None.

    Merge ranks are the ids, which holds where the vocabulary lists merged tokens in merge order.
    """
    import tiktoken

    model = json.loads(tokenizer.to_str())
    merges = [m if isinstance(m, str) else "".join(m) for m in model["model"].get("merges", [])]
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    ids = [vocabulary[m.replace(" ", "")] for m in merges]
    usual = model["normalizer"] is None and (model["pre_tokenizer"] or {}).get("use_regex")
    if not usual or ids != sorted(ids):
        return None
    ranks = {bytes(_LETTER_BYTES[c] for c in token): i for token, i in vocabulary.items()}
    return tiktoken.Encoding(
        "plain", pat_str=_WORD_PATTERN, mergeable_ranks=ranks, special_tokens={}
    ).encode_to_numpy


class TextIds:
    """Token ids of whole texts through a tokenizer file, as little-endian unsigned 32-bit numbers.

    A byte-level BPE never joins a space between two other characters to what precedes it, so a
    text with special tokens or letters beyond Latin falls apart at those spaces: only the words
    concerned need the tokenizer's slower general way.
    """

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(tokenizer_path)
        self._quick = _quick_encoder(self._tokenizer)
        added = self._tokenizer.get_added_tokens_decoder().values()
        self._special = re.compile("|".join(re.escape(t.content) for t in added) or "(?!)")

    def _is_plain(self, text: str) -> bool:
        return bool(_LATIN.fullmatch(text)) and not self._special.search(text)

    def _encode(self, text: str, plain: bool) -> bytes:
        if plain:
            return self._quick(text).astype("<u4").tobytes()
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if self._quick is None:
            return self._encode(text, False)
        if self._is_plain(text):
            return self._encode(text, True)
        first, *rest = _BARE_SPACE.split(text)
        words = [first, *(" " + word for word in rest)]
        return b"".join(
            self._encode("".join(run), plain) for plain, run in groupby(words, self._is_plain)
        )


_known: dict[str, TextIds] = {}


def text_ids(tokenizer_path: str) -> TextIds:
    """The tokenizer of this Python worker."""
    if tokenizer_path not in _known:
        _known[tokenizer_path] = TextIds(tokenizer_path)
    return _known[tokenizer_path]


def piece_lengths(n: int, capacity: int) -> list[int]:
    """A document of ``n`` ids as pieces: the first takes what full pieces leave over."""
    if n <= capacity:
        return [n]
    rest = n % capacity
    return ([rest] if rest else []) + [capacity] * (n // capacity)


_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
        ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()),
        ("local_rank", pa.int64()), ("ids", pa.binary()),
    ]
)


def cut_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_column: str = "doc_id",
    text_column: str = "text", end_id: int = END_OF_TEXT, keep_ids: bool = False,
) -> DataFrame:
    """One row per piece of every document, with its rank among the task's pieces of its length."""
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_ids(tokenizer_path)
        part = TaskContext.get().partitionId()
        ranks = [0] * (capacity + 1)
        for batch in chunks(batches, "text"):
            rows = {name: [] for name in _PIECES.names}
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist()):
                ids = encode(text.decode("utf-8")) + end
                start = 0
                for piece, length in enumerate(piece_lengths(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    rows["doc_id"].append(doc)
                    rows["piece"].append(piece)
                    rows["start"].append(start)
                    rows["length"].append(length)
                    rows["ids_crc32"].append(zlib.crc32(own))
                    rows["local_rank"].append(ranks[length])
                    rows["ids"].append(own if keep_ids else None)
                    ranks[length] += 1
                    start += length
            rows["part"] = [part] * len(rows["doc_id"])
            yield batch_of(_PIECES, rows)

    narrow = docs.select(
        F.col(id_column).cast("long").alias("doc"), raw_text(text_column).alias("text")
    )
    return narrow.mapInArrow(
        work,
        "doc_id long, piece int, start long, length long, ids_crc32 long, part int,"
        " local_rank long, ids binary",
    )


def plan_best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit decreasing over counts.

    Returns runs (length, first rank, count, first sequence, offset): pieces of that length with
    these consecutive ranks go to consecutive sequences at the same offset.
    """
    open_at: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    runs, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            space = next((s for s in range(length, capacity + 1) if open_at[s]), None)
            if space is not None:
                first, n = open_at[space].pop()
                taken = min(n, left)
                if taken < n:
                    open_at[space].append((first + taken, n - taken))
                runs.append((length, rank, taken, first, capacity - space))
                open_at[space - length].append((first, taken))
                rank, left = rank + taken, left - taken
                continue
            each = min(capacity // length, left)
            new = left // each
            for place in range(each):
                runs.append((length, rank, new, sequences, place * length))
                rank += new
            open_at[capacity - each * length].append((sequences, new))
            sequences, left = sequences + new, left - new * each
        open_at[0].clear()
    return runs


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_column: str = "doc_id",
    text_column: str = "text", end_id: int = END_OF_TEXT, keep_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids with the sequence and offset each one takes.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids (little-endian
    unsigned 32-bit numbers) with ``keep_ids``. Null and empty texts are one piece that holds the
    end id. Rows with equal or null ids are documents of their own. Other columns are ignored. No
    rows in, no rows out. Sequences are filled without gaps from offset 0.

    The driver receives one count per length, at most ``capacity`` of them.
    """
    pieces = stage(
        cut_documents(docs, tokenizer_path, capacity, id_column, text_column, end_id, keep_ids),
        "pieces",
    )
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {
        row["length"]: row["n"]
        for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = counts.select(
        "part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    ranked = pieces.join(bases, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "ids",
        (F.col("base") + F.col("local_rank")).alias("rank"),
    )
    plan = sorted(plan_best_fit(histogram, capacity))
    keys = np.array([(r[0] << _RANK_BITS) + r[1] for r in plan], np.int64)
    first_sequence = np.array([r[3] for r in plan], np.int64)
    offset = np.array([r[4] for r in plan], np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            wanted = (batch.column("length").to_numpy() << _RANK_BITS) + rank
            run = np.searchsorted(keys, wanted, side="right") - 1
            columns = {n: batch.column(n) for n in batch.schema.names if n != "rank"}
            columns["sequence_id"] = pa.array(first_sequence[run] + wanted - keys[run])
            columns["offset"] = pa.array(offset[run])
            yield pa.RecordBatch.from_pydict(columns)

    packed = ranked.mapInArrow(
        work,
        "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary,"
        " sequence_id long, offset long",
    )
    return packed if keep_ids else packed.drop("ids")

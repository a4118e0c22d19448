"""Helpers the training-data operators share: words, hashes, Arrow batches, row keys."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stands for a null id inside an operator: a null id comes before every other.
NO_ID = -(2**63)

# Bytes of text a task turns into Python objects at once.
CHUNK_BYTES = 4 << 20

# Distinct words a Python worker remembers.
REMEMBERED_WORDS = 200_000


def key_of(name: str) -> Column:
    """An id as a long that is never null."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def id_of(key: str) -> Column:
    """The id behind ``key_of``."""
    return F.when(F.col(key) != F.lit(NO_ID), F.col(key))


def raw_text(name: str) -> Column:
    """A text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")


_ROW_BITS = 40


def with_file_rows(scan: DataFrame, name: str) -> DataFrame:
    """A scan of Parquet files with a number per row, as ``name``, that holds through all reads.

    It is the number of the file among all files and the row's place in it, so nothing is copied.
    The driver sees the names of the files, which it holds for the scan anyway.
    """
    located = scan.select(
        "*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__at")
    )
    files = sorted(row["__file"] for row in located.select("__file").distinct().collect())
    numbers = scan.sparkSession.createDataFrame(
        pa.table({"__file": pa.array(files, pa.string()), "__number": pa.array(range(len(files)), pa.int64())})
    )
    number = F.shiftleft("__number", _ROW_BITS) + F.col("__at")
    return located.join(numbers, "__file").select(*scan.columns, number.alias(name))


def chunks(batches: Iterable[pa.RecordBatch], size_of: str) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the named binary column stays near ``CHUNK_BYTES`` in each."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pc.binary_length(batch.column(size_of)).to_numpy(zero_copy_only=False)
        group = np.cumsum(np.nan_to_num(lengths.astype(np.float64))) // CHUNK_BYTES
        edges = np.flatnonzero(np.diff(group)) + 1
        start = 0
        for end in [*edges.tolist(), batch.num_rows]:
            yield batch.slice(start, end - start)
            start = end


class WordHashes(dict):
    """64-bit hash of a word, equal on every executor; forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = WordHashes()

_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        size = max(n, 4096, 2 * len(_powers[0]))
        for i, base in enumerate((_STEP, _STEP_INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits depend on all input bits."""
    x = values ^ (values >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words, from running sums."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = _power_tables(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:-1], out=sums[1:])
    return mixed((sums[width:] - sums[:n]) * down[:n])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    have, span = values, 1
    while 2 * span <= width:
        have = np.minimum(have[:-span], have[span:])
        span *= 2
    rest = width - span
    return np.minimum(have[:n], have[rest : rest + n])


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in any of the half-open intervals."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return edges[::2], edges[1::2]


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark longs."""
    return values.view(np.int64)


def list_array(values: np.ndarray, counts: Iterable[int], kind: pa.DataType) -> pa.ListArray:
    """A list column from concatenated values and the length of each list."""
    offsets = np.concatenate(([0], np.cumsum(np.fromiter(counts, np.int64)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def batch_of(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    arrays = []
    for field in schema:
        values = columns[field.name]
        arrays.append(values if isinstance(values, pa.Array) else pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator]]:
    """Consecutive rows with equal keys, of sorted batches, as (key, iterator of batch slices).

    One slice is held at a time, so a group of any size streams through.
    """
    source = _slices(batches, keys)
    current = next(source, None)
    while current is not None:
        key = current[0]
        state = {"next": None, "open": True}

        def members(first=current, key=key, state=state):
            yield first[1]
            for found, piece in source:
                if found != key:
                    state["next"] = (found, piece)
                    return
                yield piece
            state["open"] = False

        stream = members()
        yield key, stream
        for _ in stream:
            pass
        current = state["next"]


def _slices(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        change = np.zeros(n, bool)
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        for values in columns:
            change[1:] |= values[1:] != values[:-1]
        start = 0
        for end in [*np.flatnonzero(change).tolist(), n]:
            if end > start:
                yield tuple(v[start].item() for v in columns), batch.slice(start, end - start)
                start = end

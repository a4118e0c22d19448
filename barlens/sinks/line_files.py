"""Lines of text in one folder per partition, written by the tasks themselves.

For file systems that the driver and all executors mount (``file:``). Without its native library
Hadoop starts a process (``chmod``) there for every folder, file and checksum file it makes, some
20 ms of a core for each small partition. Here a task opens its files itself.

Commit is that of Spark's own writer: an attempt of a task writes below a hidden folder of its own,
and the driver moves what the successful attempts wrote into place when all tasks are done. Names of
folders, lines and checksum files are the same too, so that readers find no difference.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlens.session import located

_VALUE = "_line"


def mounted(spark: SparkSession, path: str) -> str | None:
    """The path as programs see it, or None if only Hadoop can reach it."""
    folder, files = located(spark, path)
    at = files.makeQualified(folder).toUri()
    return at.getPath() if at.getScheme() == "file" else None


def write_line_files(
    lines: DataFrame, path: str, partition_by: Sequence[str], append: bool, suffix: str = "txt"
) -> None:
    """Write the text column ``value`` below ``path``, a mounted folder, as Spark's text writer does.

    Folders that ``lines`` has rows for are replaced, or get further files with ``append``. A folder
    whose rows come one after the other in a task gets one file of it. An error leaves ``path`` as it
    was, unless it comes while files are moved into place.
    """
    spark, run = lines.sparkSession, uuid.uuid4().hex
    staging = f"{path}/.lines-{run}"
    named = lines.select(
        F.concat(F.col("value"), F.lit("\n")).cast("binary").alias(_VALUE),
        *[F.col(f"`{c}`").cast("string") for c in partition_by],
    )
    try:
        work = _task(staging, list(partition_by), run, suffix)
        attempts = [row.attempt for row in named.mapInArrow(work, "attempt string").collect()]
        _move_in(staging, attempts, path, len(partition_by), append)
        os.makedirs(path, exist_ok=True)
        open(f"{path}/_SUCCESS", "w").close()
    finally:
        shutil.rmtree(staging, ignore_errors=True)
    spark.catalog.refreshByPath(f"file://{path}")


def _task(staging: str, partition_by: list[str], run: str, suffix: str) -> Callable:
    """What a task does with its rows: files in, the name of its folder out.

    All it needs lies inside, so that executors can do without this package.
    """

    def work(batches: Iterator) -> Iterator:
        import os
        import re
        from itertools import groupby
        from struct import pack
        from zlib import crc32

        import pyarrow as pa
        from pyspark import TaskContext

        chunk = 512  # bytes per checksum, Hadoop's default; its files name it
        escaped = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")

        def escape(text: str) -> str:
            return escaped.sub(lambda m: f"%{ord(m[0]):02X}", text)

        def folder_of(values: tuple) -> str:
            parts = zip(partition_by, values)
            return "/".join(f"{escape(c)}={escape(v) if v else '__HIVE_DEFAULT_PARTITION__'}" for c, v in parts)

        class LineFile:
            """A file, and the checksums that Hadoop keeps beside it and verifies on reading."""

            def __init__(self, folder: str, name: str):
                os.makedirs(folder, exist_ok=True)
                self._lines = open(f"{folder}/{name}", "xb")
                self._sums = open(f"{folder}/.{name}.crc", "xb")
                self._sums.write(b"crc\0" + pack(">i", chunk))
                self._rest = b""

            def write(self, data: bytes) -> None:
                self._lines.write(data)
                data = self._rest + data
                whole = len(data) - len(data) % chunk
                self._sum(data[:whole])
                self._rest = data[whole:]

            def _sum(self, data: bytes) -> None:
                sums = [crc32(data[i : i + chunk]) for i in range(0, len(data), chunk)]
                self._sums.write(pack(f">{len(sums)}I", *sums))

            def close(self) -> None:
                self._sum(self._rest)
                self._lines.close()
                self._sums.close()

        task = TaskContext.get()
        attempt, n_files = str(task.taskAttemptId()), 0
        current, file = None, None
        for batch in batches:
            lines = batch.column(0).to_pylist()
            keys = list(zip(*[column.to_pylist() for column in batch.columns[1:]]))
            start = 0
            for values, same in groupby(keys):
                end = start + sum(1 for _ in same)
                folder = folder_of(values)
                if folder != current:
                    if file:
                        file.close()
                    name = f"part-{task.partitionId():05d}-{run}.c{n_files:03d}.{suffix}"
                    file, current = LineFile(f"{staging}/{attempt}/{folder}", name), folder
                    n_files += 1
                file.write(b"".join(lines[start:end]))
                start = end
        if file:
            file.close()
            yield pa.RecordBatch.from_pydict({"attempt": [attempt]})

    return work


def _move_in(staging: str, attempts: list[str], path: str, depth: int, append: bool) -> None:
    """Each folder of the attempts to its place; a folder that several of them wrote is joined."""
    replaced = set()
    for attempt in attempts:
        for folder in _folders(f"{staging}/{attempt}", depth):
            source, target = f"{staging}/{attempt}/{folder}", f"{path}/{folder}"
            if not append and folder not in replaced:
                replaced.add(folder)
                if os.path.lexists(target):
                    shutil.rmtree(target)
            if os.path.lexists(target):
                for name in sorted(os.listdir(source)):  # checksums, whose names begin with a dot, first
                    os.rename(f"{source}/{name}", f"{target}/{name}")
            else:
                os.makedirs(os.path.dirname(target), exist_ok=True)
                os.rename(source, target)


def _folders(top: str, depth: int) -> Iterator[str]:
    """Names of all folders ``depth`` levels below ``top``."""
    for name in sorted(os.listdir(top)):
        if depth == 1:
            yield name
        else:
            yield from (f"{name}/{inner}" for inner in _folders(f"{top}/{name}", depth - 1))

"""Session defaults and the shared work area."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from math import ceil

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.minBatchesToRetain": "2",
    # Open windows of very many instruments stay off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_local_work_root: str | None = None


def build_session(app: str = "barlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC. The master is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**_SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, label: str) -> str:
    """A new, empty place for written intermediates that every executor can reach.

    It lies in the folder named by ``spark.checkpoint.dir``. Only a local session may do
    without that setting: a cluster's executors do not share the driver's disk.
    """
    global _local_work_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if _local_work_root is None:
            _local_work_root = tempfile.mkdtemp(prefix="barlens-")
        root = _local_work_root
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the work area and read it back.

    Cuts the lineage and fixes values that a retried task could produce differently.
    """
    return _write_and_read(df, work_folder(df.sparkSession, label))


def _write_and_read(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def located(spark: SparkSession, path: str):
    """A path and the file system it lies in."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def entry_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in ``path`` that belong to a table; none if it does not exist."""
    folder, files = located(spark, path)
    if not files.exists(folder):
        return []
    found = [status.getPath().getName() for status in files.listStatus(folder)]
    return [name for name in found if not name.startswith(("_", "."))]


def first_file(spark: SparkSession, path: str) -> str | None:
    """Some file of the table at ``path``, found by going down its folders; None if there is none."""
    folder, files = located(spark, path)
    for status in files.listStatus(folder):
        found, name = status.getPath().toString(), status.getPath().getName()
        if not status.isDirectory():
            if name.startswith("part-"):
                return found
        elif not name.startswith(("_", ".")) and (inside := first_file(spark, found)):
            return inside
    return None


@contextmanager
def few_listing_tasks(spark: SparkSession):
    """Folders are listed by a few tasks with many of them each, not by a task per folder."""
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(8 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def folder_columns(spark: SparkSession, path: str, file: str) -> list[str]:
    """Columns that the folders between ``path`` and a ``file`` of it name, outermost first."""
    folder, files = located(spark, path)
    inside = file.removeprefix(files.makeQualified(folder).toString()).split("/")[1:-1]
    return [part.split("=", 1)[0] for part in inside if "=" in part]


def folder_count(spark: SparkSession, path: str, depth: int) -> int:
    """Partition folders ``depth`` levels below ``path``."""
    folder, files = located(spark, path + "/*=*" * depth)
    return len(files.globStatus(folder) or [])


def path_exists(spark: SparkSession, path: str) -> bool:
    folder, files = located(spark, path)
    return files.exists(folder)


# Rows a task can hold and sort with ease.
ROWS_PER_TASK = 1_000_000


def tasks_for(spark: SparkSession, rows: int, rows_per_task: int = ROWS_PER_TASK) -> int | None:
    """Partitions for a shuffle of ``rows``, or None if the session's setting is enough.

    Up to that setting adaptive execution merges partitions by their size; it does not split
    them, so larger inputs state the number they need.
    """
    needed = ceil(rows / rows_per_task)
    return needed if needed > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


class Staging:
    """Staged tables that one job needs only until it returns; removed on leaving the block."""

    def __init__(self, spark: SparkSession, label: str):
        self._spark = spark
        self._folder = work_folder(spark, label)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_) -> None:
        folder, files = located(self._spark, self._folder)
        files.delete(folder, True)

    def hold(self, df: DataFrame, name: str) -> DataFrame:
        return _write_and_read(df, f"{self._folder}/{name}")

    def hold_counted(self, df: DataFrame, name: str) -> tuple[DataFrame, int]:
        """Also the number of rows, counted while they are written."""
        seen = Observation()
        held = self.hold(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
        return held, seen.get.get("rows") or 0

"""The archive: bars by date, sorted, each stored once per (date, instrument, time)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructType

from barlens.functions.quality import archive_date, split_valid, with_problem
from barlens.operators.merge import (
    ARCHIVE_KEY,
    MAX_COPIES,
    came_in,
    crowded_keys,
    first_stats,
    merge_stats,
    new_records,
    only_partitions,
    slice_counts,
)
from barlens.schema import BAR_SCHEMA
from barlens.session import (
    Staging,
    entry_names,
    few_listing_tasks,
    first_file,
    folder_columns,
    folder_count,
    tasks_for,
)
from barlens.sinks.tables import read_if_there, write_partitions
from barlens.sources.bars import range_filter, tickers_in

ARCHIVE_SCHEMA = StructType([*BAR_SCHEMA.fields]).add("date", DateType())

# Coarser partition columns that can be derived from the date.
PERIODS = {"month": "yyyy-MM", "year": "yyyy"}

# Up to so many folders Spark finds their columns itself. Its time for that grows with the square of
# their number: some 0.3 s on the driver here, and 16 s for 70,000.
MAX_DISCOVERED = 10_000


def archivable(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split decoded bars into rows that can be archived, with their date, and the rest."""
    good, bad = split_valid(with_problem(records))
    return good.withColumn("date", archive_date(F.col("time"))), bad


def archive_batch(
    records: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("date",),
    fmt: str = "parquet",
    dedup_within_batch: bool = False,
    rewrite_unchanged: bool = False,
    append: bool = False,
    quarantine: str | None = None,
    max_copies: int = MAX_COPIES,
    batch_id: int | None = None,
) -> DataFrame:
    """Merge decoded bars into the archive at ``path`` and return the run's statistics.

    Only partitions in the batch are read, and only those that gain rows are rewritten, by all
    partition columns: a folder per slice leaves the other instruments of a date alone, unless
    ``rewrite_unchanged`` is set. With ``append`` nothing stored is rewritten: new rows become
    further files, each in order by itself, which suits frequent small batches. Bars that come
    more than ``max_copies`` times are kept from meeting in one task. The first partition column is ``date``, ``month`` or
    ``year``; inside a partition rows are in (date, instrument, time) order. Adding
    ``ticker`` as a second one gives a folder per slice, for few instruments. Running a batch
    twice adds nothing. Rows that cannot be archived go to ``quarantine``; with a ``batch_id``
    they replace those of the same batch, so a replay does not repeat them.
    """
    spark = records.sparkSession
    period = partition_by[0]
    with Staging(spark, "archive") as staging:
        if quarantine:
            records = staging.hold(records, "records")
        good, bad = archivable(records)
        if quarantine and batch_id is None:
            bad.write.mode("append").json(quarantine)
        elif quarantine:
            bad.write.mode("overwrite").json(f"{quarantine}/batch={batch_id}")
        if period in PERIODS:
            good = good.withColumn(period, F.date_format("date", PERIODS[period]))
        incoming, n_incoming = staging.hold_counted(good, "incoming")
        if not (entry_names(spark, path) or dedup_within_batch):  # nothing stored: all rows are new
            run, largest = _run_of(first_stats(incoming))
            if n_incoming:
                copies = largest > max_copies and crowded_keys(incoming, ARCHIVE_KEY, max_copies) is not None
                parts = tasks_for(spark, n_incoming)
                write_partitions(incoming, path, partition_by, ARCHIVE_KEY, fmt, parts, True, copies)
            return run
        stored = read_if_there(spark, path, incoming.schema, fmt)

        def touched_by(rows: DataFrame, label: str) -> DataFrame:
            return only_partitions(
                stored, rows, *partition_by, hold=lambda found: staging.hold(found, label)
            )

        touched = touched_by(incoming, "touched")
        if fmt == "json":  # read several times below, and text is parsed each time
            stored = touched = staging.hold(touched, "stored")
        new = new_records(incoming, touched, ARCHIVE_KEY, dedup_within_batch, max_copies, n_incoming)
        fresh, n_fresh = staging.hold_counted(new, "fresh")
        run, largest = _run_of(slice_counts(incoming, touched, fresh))
        whole = rewrite_unchanged and not append
        if n_incoming if whole else n_fresh:
            changed = incoming if whole else fresh
            kept = None if append else touched if whole else touched_by(changed, "rewritten")
            rows = fresh if kept is None else kept.unionByName(fresh, allowMissingColumns=True)
            n_rows = n_fresh + (0 if kept is None else kept.count())
            copies = largest > max_copies and crowded_keys(rows, ARCHIVE_KEY, max_copies) is not None
            parts = tasks_for(spark, n_rows)
            write_partitions(rows, path, partition_by, ARCHIVE_KEY, fmt, parts, append, copies)
    return run


def _run_of(counts: DataFrame) -> tuple[DataFrame, int]:
    """The one row of a run's statistics, apart from the tables it was found in, and the rows of the
    largest slice: no bar can come more often than its slice has rows."""
    seen = Observation()
    stats = merge_stats(came_in(counts.observe(seen, F.max("total_records").alias("largest"))))
    run = stats.sparkSession.createDataFrame(stats.collect(), stats.schema)
    return run, seen.get.get("largest") or 0


def read_archive(
    spark: SparkSession, path: str, fmt: str | None = None, extra: StructType | None = None
) -> DataFrame:
    """Archived bars as they were decoded, with date and the period of their folder.

    The format is found from the files; a ``fmt`` that they do not have raises. Folder columns are
    read as such, so filters on them skip files. With more than ``MAX_DISCOVERED`` folders they are
    taken from the files' places, and only joins no longer skip files. ``extra`` names further stored
    columns.
    """
    file = first_file(spark, path)
    found = "parquet" if file is None or ".parquet" in file else "json"
    if fmt not in (None, found):
        raise ValueError(f"the archive at {path} is {found}, not {fmt}")
    schema = StructType([*ARCHIVE_SCHEMA.fields, *(extra or StructType()).fields])
    for name in PERIODS:
        if file is not None and f"/{name}=" in file:
            schema = schema.add(name, StringType())
    outer = [] if file is None else folder_columns(spark, path, file)
    with few_listing_tasks(spark):
        if not (outer and set(outer) <= set(schema.names) and _many_folders(spark, path, file, len(outer))):
            return spark.read.schema(schema).format(found).load(path)
        inner = StructType([field for field in schema if field.name not in outer])
        rows = spark.read.schema(inner).option("recursiveFileLookup", "true").format(found).load(path)
    return rows.select("*", *[_of_place(outer, i).cast(schema[c].dataType).alias(c) for i, c in enumerate(outer)])


def _many_folders(spark: SparkSession, path: str, file: str, depth: int) -> bool:
    """Whether discovery would be slow. Those beside the folder of ``file`` often tell, and are listed soon."""
    beside = file.rsplit("/", 2)[0]
    return folder_count(spark, beside, 1) > MAX_DISCOVERED or folder_count(spark, path, depth) > MAX_DISCOVERED


def _of_place(names: Sequence[str], which: int) -> Column:
    """The text a row's file has in its place for one of the folder columns ``names``."""
    below = F.substring_index("_metadata.file_path", "/", which - len(names) - 1)
    folder = F.substring_index(below, "/", 1)
    text = F.substr(folder, F.locate("=", folder) + 1)
    plain = text
    for _ in ("as a URL", "as a folder name"):  # a plus sign stands for itself in both
        plain = F.coalesce(F.try_url_decode(F.replace(plain, F.lit("+"), F.lit("%2B"))), plain)
    text = F.when(F.contains(text, F.lit("%")), plain).otherwise(text)
    return F.when(text != "__HIVE_DEFAULT_PARTITION__", text)


def backfill(
    history: DataFrame,
    path: str,
    tickers: str | Sequence[str],
    start: str | None = None,
    end: str | None = None,
    days: int | None = None,
    source_time: str = "source_time",
    **layout,
) -> DataFrame:
    """Archive the chosen instruments and dates of a landed history; returns statistics."""
    chosen = range_filter(tickers_in(history, tickers), start, end, days, time=source_time)
    return archive_batch(chosen.drop(source_time), path, **layout)

"""Batch sinks: plain tables, partition-wise writes, keyed upsert, search index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barlens.operators.heat import ordered_rows
from barlens.operators.merge import MAX_COPIES, crowded_keys, newest_in_order, one_per_key, only_partitions
from barlens.session import Staging, entry_names, few_listing_tasks, tasks_for
from barlens.sinks.line_files import mounted, write_line_files


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    **options: str,
) -> None:
    """Write a whole table. A failed write raises."""
    df.write.mode(mode).options(**options).partitionBy(*partition_by).format(fmt).save(path)


def read_if_there(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet"
) -> DataFrame:
    """The table at ``path``, or no rows if nothing has been written there yet.

    Columns are the stored ones, so nothing stored is left out. Those that ``schema`` has too are
    read in its types, which decides the types of partition folders; data of another type raises.
    """
    if not entry_names(spark, path):
        return spark.createDataFrame([], schema)  # nothing, or only empty batches so far
    given = {field.name: field for field in schema}
    with few_listing_tasks(spark):
        stored = spark.read.option("mergeSchema", "true").format(fmt).load(path).schema
        return spark.read.schema(
            StructType([given.get(field.name, field) for field in stored])
        ).format(fmt).load(path)


def write_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str],
    fmt: str = "parquet",
    parts: int | None = None,
    append: bool = False,
    copies: bool = True,
) -> None:
    """Replace exactly the partitions that ``df`` holds, or add files to them.

    Rows are spread by range over (partition, sort columns), so a partition with a large
    share of the rows becomes several files in order instead of one task's work, and small
    partitions share a task. ``copies`` says that many rows may agree in all of these
    columns. One writer per table at a time.
    """
    order = [*partition_by, *[c for c in sort_by if c not in partition_by]]
    _write_ordered(ordered_rows(df, order, parts, copies), path, partition_by, fmt, append)


def _write_ordered(
    ordered: DataFrame, path: str, partition_by: Sequence[str], fmt: str, append: bool
) -> None:
    if fmt == "json":
        # Lines keep the fields that also name their folder.
        line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in ordered.columns])).alias("value")
        ordered, fmt = ordered.select(line, *partition_by), "text"
        if partition_by and (folder := mounted(ordered.sparkSession, path)):
            write_line_files(ordered, folder, partition_by, append)
            return
    (
        ordered.write.mode("append" if append else "overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .format(fmt)
        .save(path)
    )


_BUCKETS = "bucket_of_"


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """Into how many buckets the table's keys are dealt; its folders say so. None if they are not."""
    for outer in entry_names(spark, path)[:1]:
        for inner in entry_names(spark, f"{path.rstrip('/')}/{outer}")[:1]:
            if inner.startswith(_BUCKETS):
                return int(inner.removeprefix(_BUCKETS).split("=")[0])
    return None


def upsert_by_key(
    df: DataFrame,
    path: str,
    key: str = "doc_id",
    partition: str = "part",
    latest: Column | None = None,
    fmt: str = "parquet",
    buckets: int | None = None,
    written: bool = False,
) -> None:
    """Write documents so that one replaces an earlier one of the same key.

    The key must imply the partition. Only partitions with new documents are read and
    rewritten. With ``buckets`` keys are dealt by hash into that many folders inside a partition,
    and only buckets with new documents are: for large partitions and small batches. The number
    is fixed by the first write, later ones find it. Writing the same documents again changes
    nothing, which makes replays safe. A frame the caller has persisted is used as it is, and so is
    one of which ``written`` says that it only scans files; any other is staged first. Rows are
    shuffled once, for merging and writing alike.
    """
    spark = df.sparkSession
    stored_buckets = bucket_count(spark, path)
    first = not entry_names(spark, path)
    if buckets and buckets != stored_buckets and not first:
        raise ValueError(f"the table at {path} has {stored_buckets or 'no'} buckets, not {buckets}")
    buckets, by = buckets or stored_buckets, [partition]
    with Staging(spark, "upsert") as staging:
        changed = df if written or df.is_cached else staging.hold(df, "changed")
        if buckets:
            by.append(f"{_BUCKETS}{buckets}")
            changed = changed.withColumn(by[-1], F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        n_rows, touched = changed.count(), None
        if n_rows > MAX_COPIES and crowded_keys(changed, [key], MAX_COPIES) is not None:
            changed = one_per_key(changed, [key], latest)
        if not first:
            stored = read_if_there(spark, path, changed.schema, fmt)
            touched = only_partitions(stored, changed, *by, hold=lambda rows: staging.hold(rows, "touched"))
            n_rows += touched.count()
        merged = newest_in_order(touched, changed, [*by, key], latest, tasks_for(spark, n_rows))
        _write_ordered(merged, path, by, fmt, append=first)


def write_batch(batch: DataFrame, path: str, query: str, batch_id: int, fmt: str = "parquet") -> None:
    """Write a micro-batch under its query and number; the same batch again replaces itself.

    The columns ``query`` and ``batch`` name its folder. A batch without rows writes nothing.
    """
    named = batch.withColumn("query", F.lit(query)).withColumn("batch", F.lit(batch_id).cast("long"))
    (
        named.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("query", "batch")
        .format(fmt)
        .save(path)
    )


def index_options(
    nodes: str, port: int, resource: str, key: str = "doc_id", operation: str = "index"
) -> dict[str, str]:
    """Options of the search-index connector: documents keyed by ``key``, replaced on write."""
    return {
        "es.nodes": nodes,
        "es.port": str(port),
        "es.resource": resource,
        "es.mapping.id": key,
        "es.write.operation": operation,
    }


def write_documents(df: DataFrame, fmt: str = "org.elasticsearch.spark.sql", **options: str) -> None:
    """Append to a keyed document sink whose connector replaces by id."""
    df.write.format(fmt).options(**options).mode("append").save()

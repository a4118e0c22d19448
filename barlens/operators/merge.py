"""Merging new rows into stored ones: by time inside an archive slice, or by document key."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from barlens.session import stage

ARCHIVE_KEY = ("date", "ticker", "time")
SLICE = ("date", "ticker")

# A key with more rows than this is kept out of shuffles by key.
MAX_COPIES = 1_000_000

# Groups by hash in which keys are counted before any key is.
_HASH_GROUPS, _GROUP = 1 << 16, "_group"


def only_partitions(
    stored: DataFrame,
    changed: DataFrame,
    *columns: str,
    hold: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Stored rows in the partitions that ``changed`` touches.

    The touched partitions are written as a small table (by ``hold``, else to the work area). The
    scan of ``stored`` leaves out every folder that is not among them: the range of the first
    column is a literal, and all columns are joined by plain equality, which Spark turns into
    filters at run time, for any number of touched partitions, as long as the table is small
    enough to broadcast. Partitions of null are looked up apart, since equality does not match them.
    """
    seen, first = Observation(), F.col(columns[0])
    some_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    found = changed.select(*columns).distinct().observe(
        seen,
        F.min(first).alias("low"), F.max(first).alias("high"), F.count_if(some_null).alias("nulls"),
    )
    touched = (hold or (lambda df: stage(df, "touched")))(found)
    range_of = seen.get
    low, high = range_of.get("low"), range_of.get("high")
    inside = F.lit(False) if low is None else first.between(F.lit(low), F.lit(high))
    # Filtered too: without a comparison on this side Spark does not prune the other by the join.
    same = stored.where(inside).join(touched.where(inside), list(columns), "left_semi")
    if not range_of.get("nulls"):
        return same
    unknown = touched.where(some_null).select(*[F.col(c).alias(f"_touched_{c}") for c in columns])
    match = [F.col(c).eqNullSafe(F.col(f"_touched_{c}")) for c in columns]
    return same.unionByName(stored.where(some_null).join(unknown, match, "left_semi"))


def one_per_key(rows: DataFrame, key: Sequence[str], latest: Column | None = None) -> DataFrame:
    """Keep one row per key: the latest, or the largest in column order if none is named.

    An aggregate, so copies of a row are combined before the shuffle.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    rank = F.struct(row.alias("_row")) if latest is None else F.struct(latest.alias("_at"), row.alias("_row"))
    keys = [F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(key)]
    return rows.groupBy(*keys).agg(F.max(rank).alias("_best")).select("_best._row.*")


def crowded_keys(rows: DataFrame, key: Sequence[str], max_copies: int = MAX_COPIES) -> DataFrame | None:
    """Keys held by more than ``max_copies`` rows, or None if there are none.

    Keys are counted by hash first, in a fixed number of groups: only those with that many rows can
    contain such a key, so ordinary batches pay for one scan, and no key is shuffled.
    """
    rows = rows.select(*key).withColumn(_GROUP, F.pmod(F.xxhash64(*key), F.lit(_HASH_GROUPS)))
    groups = _crowded(rows, [_GROUP], max_copies)
    if groups.isEmpty():
        return None
    found = _crowded(rows.join(groups, [_GROUP], "left_semi"), list(key), max_copies)
    return None if found.isEmpty() else found


def _crowded(rows: DataFrame, by: list[str], limit: int) -> DataFrame:
    return rows.groupBy(*by).count().where(F.col("count") > limit).drop("count")


def new_records(
    incoming: DataFrame,
    stored: DataFrame,
    key: Sequence[str] = ARCHIVE_KEY,
    dedup_within_batch: bool = False,
    max_copies: int = MAX_COPIES,
    n_incoming: int | None = None,
) -> DataFrame:
    """Incoming rows whose key is not stored yet. Nothing stored is ever replaced.

    Copies inside the batch all stay unless ``dedup_within_batch`` is set. Keys with very
    many copies are looked up apart: there is one such key per ``max_copies`` rows at most, so
    Spark broadcasts them as long as their size allows and splits them beyond. All other keys
    meet in a shuffled anti-join, where no key is large. With ``n_incoming`` rows or fewer than
    ``max_copies`` no key can have that many, and none is looked for.
    """
    known = stored.select(*key).distinct()
    columns = [f"`{c}`" for c in incoming.columns]
    if dedup_within_batch:
        return one_per_key(incoming, key).join(known, list(key), "left_anti").select(*columns)
    few_rows = n_incoming is not None and n_incoming <= max_copies
    crowded = None if few_rows else crowded_keys(incoming, key, max_copies)
    if crowded is None:
        return incoming.join(known, list(key), "left_anti").select(*columns)
    few = incoming.join(crowded, list(key), "left_anti")
    many = incoming.join(crowded, list(key), "left_semi")
    known_many = known.join(crowded, list(key), "left_semi")
    return (
        few.join(known, list(key), "left_anti")
        .select(*columns)
        .unionByName(many.join(known_many, list(key), "left_anti").select(*columns))
    )


def archive_merge(
    incoming: DataFrame,
    stored: DataFrame,
    key: Sequence[str] = ARCHIVE_KEY,
    dedup_within_batch: bool = False,
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """Stored rows together with the new ones."""
    fresh = new_records(incoming, stored, key, dedup_within_batch, max_copies)
    return stored.unionByName(fresh, allowMissingColumns=True)


def slices_present(slices: DataFrame, stored: DataFrame, by: Sequence[str] = SLICE) -> DataFrame:
    """Those (date, instrument) slices that already hold something."""
    return slices.join(stored.select(*by).distinct(), list(by), "left_semi")


def slice_stats(
    incoming: DataFrame, stored: DataFrame, fresh: DataFrame, by: Sequence[str] = SLICE
) -> DataFrame:
    """Per touched slice: rows that came in, were new, and are there after the merge."""
    return came_in(slice_counts(incoming, stored, fresh, by))


def came_in(counts: DataFrame) -> DataFrame:
    """The slices that the batch touches."""
    return counts.where(F.col("incoming_records") > 0)


def slice_counts(
    incoming: DataFrame, stored: DataFrame, fresh: DataFrame, by: Sequence[str] = SLICE
) -> DataFrame:
    """``slice_stats`` of all slices, those too that only ``stored`` holds.

    One aggregate over tagged rows; counts are combined before the shuffle.
    """

    def tagged(rows: DataFrame, tag: str) -> DataFrame:
        marks = [F.lit(int(name == tag)).alias(name) for name in ("incoming", "stored", "fresh")]
        return rows.select(*by, *marks)

    everything = (
        tagged(incoming, "incoming")
        .unionByName(tagged(stored, "stored"))
        .unionByName(tagged(fresh, "fresh"))
    )
    return everything.groupBy(*by).agg(
        F.sum("incoming").alias("incoming_records"),
        F.sum("fresh").alias("new_records"),
        (F.sum("stored") + F.sum("fresh")).alias("total_records"),
    )


def first_stats(incoming: DataFrame, by: Sequence[str] = SLICE) -> DataFrame:
    """``slice_stats`` of rows that are all new, nothing being stored: one count per slice."""
    counts = ("incoming_records", "new_records", "total_records")
    return incoming.groupBy(*by).agg(*[F.count(F.lit(1)).alias(name) for name in counts])


def merge_stats(per_slice: DataFrame) -> DataFrame:
    """One row for the whole run; a slice without new rows counts as skipped."""
    changed = F.col("new_records") > 0
    return per_slice.agg(
        F.count_if(changed).alias("slices_written"),
        F.count_if(~changed).alias("slices_skipped"),
        F.coalesce(F.sum("new_records"), F.lit(0)).alias("new_records"),
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("total_records"),
    )


def replace_by_key(
    stored: DataFrame, changed: DataFrame, key: Sequence[str], latest: Column | None = None
) -> DataFrame:
    """Stored rows with every changed key replaced by its changed row."""
    newest = one_per_key(changed, key, latest)
    kept = stored.join(newest.select(*key), list(key), "left_anti")
    return kept.select(*[f"`{c}`" for c in stored.columns]).unionByName(newest, allowMissingColumns=True)


def newest_in_order(
    stored: DataFrame | None,
    changed: DataFrame,
    order: Sequence[str],
    latest: Column | None = None,
    parts: int | None = None,
) -> DataFrame:
    """What ``replace_by_key`` returns, for a key that is the last column of ``order`` and implies
    the others, range-partitioned and sorted by ``order``.

    Stored and changed rows go through one shuffle: all rows of a key meet in a range, where a
    changed row wins over a stored one. Keys with very many copies should be combined before.
    """
    plain = list(changed.columns)
    changed = changed.withColumns({"_new": F.lit(1), "_at": F.lit(0) if latest is None else latest})
    rows, names = changed, plain
    if stored is not None:
        names = [*stored.columns, *[c for c in plain if c not in stored.columns]]
        nothing = F.lit(None).cast(changed.schema["_at"].dataType)
        old = stored.withColumns({"_new": F.lit(0), "_at": nothing})
        rows = old.unionByName(changed, allowMissingColumns=True)
    spread = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    rest = [c for c in (*plain, *[n for n in names if n not in plain]) if c not in order]
    row = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(0)
    best = spread.groupBy(*order).agg(F.max(F.struct("_new", "_at", row.alias("_row"))).alias("_best"))
    found = [F.col(c) if c in order else F.col(f"_best._row.`{c}`").alias(c) for c in names]
    return best.select(*found).sortWithinPartitions(*order)

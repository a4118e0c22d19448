"""A content-addressed Merkle tree over documents, one subtree per source.

Leaves of a source stand in ascending id order and three consecutive nodes become their digest,
until one is left. Five levels are built at a time: up to 243 nodes are brought together under the
number of their block, so building takes a shuffle of narrow rows per five levels, whatever share
of the rows a source holds. What is stored is content-addressed: the digest on top of a block leads
to records of its inner nodes, each from a digest to its children.

Requests for leaves descend from the root by the digits of their rank to base three. All requests
below a block travel as one row, so the root is no hot key. Each step collects the children not
chosen; the segments of a path are reversed on the way, so that it reads from leaf to root.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlens.operators.places import with_places
from barlens.session import stage

FAN = 3
LEVELS = 5
BLOCK = FAN**LEVELS
_MOST_LEVELS = 39

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODES = "array<struct<digest: string, children: array<string>>>"
_PATH = "array<struct<place: int, others: array<string>>>"
_NODE_TYPE = pa.list_(pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))]))
_PATH_TYPE = pa.list_(pa.struct([("place", pa.int32()), ("others", pa.list_(pa.string()))]))


@dataclass(frozen=True)
class Manifest:
    """Where a tree is stored.

    ``leaves``: source, tree, idx (rank in the source), the columns of the rows, leaf.
    ``sources``: source, tree (rank of the source), n, depth, subroot. ``records``: digest, height,
    nodes. ``root`` is null, and all tables are empty, for a manifest of no rows.
    """

    leaves: DataFrame
    sources: DataFrame
    records: DataFrame
    root: str | None
    rounds: int
    top_rounds: int
    top_depth: int


def field_text(value: Column) -> Column:
    """A value with its length in UTF-8 bytes before it, so that no two rows read the same."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field_text(v) for v in values]), 256)


def depth_of(n: Column) -> Column:
    """Levels above ``n`` leaves: the first power of three that is not below ``n``."""
    return reduce(
        lambda a, b: a + b, [(n > FAN**level).cast("int") for level in range(_MOST_LEVELS)]
    )


def _digest(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def _rolled_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The top of each block, and its inner nodes as records."""
    for batch in batches:
        digests, heights, records = [], [], []
        for members, depth in zip(batch.column("members").to_pylist(), batch.column("depth").to_pylist()):
            level, nodes = [m["digest"] for m in members], []
            for _ in range(min(LEVELS, depth)):
                runs = [level[i : i + FAN] for i in range(0, len(level), FAN)]
                level = [_digest(run) for run in runs]
                nodes += [{"digest": d, "children": run} for d, run in zip(level, runs)]
            digests.append(level[0])
            heights.append(min(LEVELS, depth))
            records.append(nodes)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("tree"), batch.column("block"), pa.array(digests, pa.string()),
                pa.array(heights, pa.int32()), batch.column("depth"), pa.array(records, _NODE_TYPE),
            ],
            names=["tree", "block", "digest", "height", "depth", "nodes"],
        )


def _built(leaves: DataFrame, most: int) -> tuple[DataFrame, DataFrame, int]:
    """(records, tops, rounds) of trees whose leaves are (tree, idx, digest, depth).

    ``most`` is the largest depth. Every round builds the next five levels of all trees that have
    them and is written.
    """
    rounds = max(1, -(-most // LEVELS))
    nodes, records, tops = leaves, None, None
    for _ in range(rounds):
        blocks = nodes.groupBy("tree", F.floor(F.col("idx") / BLOCK).alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("members"),
            F.first("depth").alias("depth"),
        )
        built = stage(
            blocks.mapInArrow(
                _rolled_up,
                f"tree long, block long, digest string, height int, depth int, nodes {_NODES}",
            ),
            "blocks",
        )
        left = F.col("depth") - F.col("height")
        found = built.select("digest", "height", "nodes")
        done = built.where(left == 0).select("tree", "digest")
        records = found if records is None else records.union(found)
        tops = done if tops is None else tops.union(done)
        nodes = built.where(left > 0).select(
            "tree", F.col("block").alias("idx"), "digest", left.alias("depth")
        )
    return records, tops, rounds


def build_manifest(
    rows: DataFrame, leaf: Column, id_column: str = "doc_id", source_column: str = "source",
    keep: dict[str, Column] | None = None,
) -> Manifest:
    """The tree over ``rows``, whose leaf digest is ``leaf`` and which keep the columns of ``keep``.

    A null source is a source of its own before all others; rows without an id come first in their
    source. Rows with equal ids are ordered by their leaf, so copies take neighbouring places.
    Texts only enter the first pass, where their digest is taken; all further work is on digests.
    """
    narrow = stage(
        rows.select(
            F.col(source_column).cast("string").alias("source"),
            F.col(id_column).cast("long").alias("doc_id"), leaf.alias("leaf"),
            *[value.alias(name) for name, value in (keep or {}).items()],
        ),
        "leaves",
    )
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), "leaf"]
    placed = with_places(narrow, order, written=True)
    counted = placed.groupBy("source").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    sources = stage(
        with_places(counted, [F.col("source").asc_nulls_first()], "tree").withColumn(
            "depth", depth_of(F.col("n"))
        ),
        "sources",
    )
    n_sources, most = sources.agg(F.count("*"), F.coalesce(F.max("depth"), F.lit(0))).first()
    held = sources.select(F.col("source").alias("_source"), "tree", "first", "depth")
    leaves = placed.join(held, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "idx", F.col("place") - F.col("first")
    )
    records, subroots, rounds = _built(
        leaves.select("tree", "idx", F.col("leaf").alias("digest"), "depth"), most
    )
    top_depth = 0
    while FAN**top_depth < n_sources:
        top_depth += 1
    top_leaves = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), "digest",
        F.lit(top_depth).alias("depth"),
    )
    top_records, root, top_rounds = _built(top_leaves, top_depth)
    found = root.first()
    return Manifest(
        leaves.drop("_source", "place", "first", "depth"),
        sources.drop("first").join(subroots.withColumnRenamed("digest", "subroot"), "tree"),
        records.union(top_records), found["digest"] if found else None,
        rounds, top_rounds, top_depth,
    )


def _descended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per request: the node its digits lead to, and the path from there to the root."""
    for batch in batches:
        requests = batch.column("requests")
        entries, ends = requests.flatten(), requests.value_lengths().to_pylist()
        places = entries.field("idx").to_pylist()
        columns = {n: batch.column(n).to_pylist() for n in ("digest", "height", "nodes", "path")}
        rows, digests, paths, start = [], [], [], 0
        for row, count in enumerate(ends):
            children = {n["digest"]: n["children"] for n in columns["nodes"][row] or ()}
            for idx in places[start : start + count]:
                node, path = columns["digest"][row], columns["path"][row]
                for level in reversed(range(columns["height"][row] or 0)):
                    kids, digit = children[node], idx // FAN**level % FAN
                    others = [kid for i, kid in enumerate(kids) if i != digit]
                    node, path = kids[digit], [{"place": digit, "others": others}, *path]
                rows.append(row)
                digests.append(node)
                paths.append(path)
            start += count
        at = pa.array(rows, pa.int32())
        names = [entries.type.field(i).name for i in range(entries.type.num_fields)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("tree").take(at), batch.column("top").take(at),
                *[entries.field(name) for name in names],
                pa.array(digests, pa.string()), pa.array(paths, _PATH_TYPE),
            ],
            names=["tree", "top", *names, "digest", "path"],
        )


def _descend(records: DataFrame, tops: DataFrame, requests: DataFrame, rounds: int) -> DataFrame:
    """The path of every request (tree, idx, further columns) below its tree's top node.

    ``tops``: tree, block (0), depth, digest of its top node, path from there to the root. A round
    reads one block of records per node on the way, found by digest, and passes five levels.
    """
    top_round = F.greatest(F.lit(0), F.ceil(F.col("depth") / LEVELS).cast("int") - 1)
    entering = tops.select(
        "tree", "block", "digest", "path", F.col("digest").alias("top"), top_round.alias("round"),
    )
    stored = records.groupBy("digest").agg(
        F.any_value("height").alias("height"), F.any_value("nodes").alias("nodes")
    )
    frontier = None
    for level in reversed(range(rounds)):
        here = entering.where(F.col("round") == level).drop("round")
        frontier = here if frontier is None else frontier.unionByName(here)
        if level:
            unit = F.floor(F.col("idx") / BLOCK**level)
            wanted = requests.select("tree", unit.alias("idx")).distinct()
        else:
            wanted = requests
        others = [c for c in wanted.columns if c != "tree"]
        grouped = wanted.groupBy("tree", F.floor(F.col("idx") / BLOCK).alias("block")).agg(
            F.collect_list(F.struct(*others)).alias("requests")
        )
        fields = ", ".join(
            f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema if f.name != "tree"
        )
        found = (
            frontier.join(grouped, ["tree", "block"])
            .join(stored, "digest", "left")
            .mapInArrow(
                _descended,
                f"tree long, top string, {fields}, digest string, path {_PATH}",
            )
        )
        frontier = found.withColumnRenamed("idx", "block") if level else found
    return frontier


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """The path of every requested leaf.

    ``requests`` holds tree and idx, each place once, and any further columns, which stay. Adds
    ``digest`` (the leaf stored at that place), ``subroot`` (``top`` of its tree), and ``path``
    from the leaf to the root: per level the place among its run and the run's other nodes.
    """
    roots = [manifest.root] if manifest.root else []
    top = requests.sparkSession.createDataFrame(
        pa.table(
            {
                "tree": pa.array([0 for _ in roots], pa.int64()),
                "block": pa.array([0 for _ in roots], pa.int64()),
                "depth": pa.array([manifest.top_depth for _ in roots], pa.int32()),
                "digest": pa.array(roots, pa.string()),
                "path": pa.array([[] for _ in roots], _PATH_TYPE),
            }
        )
    )
    trees = requests.select(F.col("tree").alias("idx")).distinct().select(
        F.lit(0).cast("long").alias("tree"), "idx"
    )
    subtrees = _descend(manifest.records, top, trees, manifest.top_rounds)
    tops = subtrees.select(
        F.col("idx").alias("tree"), F.lit(0).cast("long").alias("block"), "digest", "path"
    ).join(manifest.sources.select("tree", "depth"), "tree")
    return _descend(manifest.records, tops, requests, manifest.rounds).withColumnRenamed(
        "top", "subroot"
    )


def proof_digest(path: Column) -> Column:
    """Digest of all nodes of a path, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(path, lambda step: step["others"])), ""), 256)


def folded(path: Column, leaf: Column) -> Column:
    """The root that follows from a leaf and the other nodes on its path."""

    def up(node: Column, step: Column) -> Column:
        left = F.slice(step["others"], F.lit(1), step["place"])
        right = F.slice(step["others"], step["place"] + 1, F.lit(FAN))
        return F.sha2(F.array_join(F.concat(left, F.array(node), right), ""), 256)

    return F.aggregate(path, leaf, up)

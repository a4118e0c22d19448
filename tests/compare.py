"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pyarrow as pa


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    return None if value is None else str(value)


def _sorted_rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(cells, key=lambda r: tuple((v is not None, v or "") for v in r))


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs, empty if nothing does."""
    ours = spark_df.toArrow()
    result = con.execute(sql)
    their_names = [d[0] for d in result.description]
    their_types = {d[0]: str(d[1]).upper() for d in result.description}
    theirs = result.fetchall()
    if sorted(ours.column_names) != sorted(their_names):
        return [f"columns {sorted(ours.column_names)} != {sorted(their_names)}"]
    found = []
    for name in ours.column_names:
        kind = _kind(ours.schema.field(name).type)
        if kind != their_types[name]:
            found.append(f"type of {name}: {kind} != {their_types[name]}")
    left = _sorted_rows(ours.column_names, list(zip(*[c.to_pylist() for c in ours.columns])))
    right = _sorted_rows(their_names, theirs)
    if len(left) != len(right):
        found.append(f"rows {len(left)} != {len(right)}")
    differing = [(a, b) for a, b in zip(left, right) if a != b]
    if differing:
        found.append(f"{len(differing)} rows differ, first {differing[0]}")
    return found


def _kind(kind: pa.DataType) -> str:
    if pa.types.is_timestamp(kind):
        return "TIMESTAMP" if kind.tz is None else "TIMESTAMP WITH TIME ZONE"
    if pa.types.is_large_string(kind) or pa.types.is_string(kind):
        return "VARCHAR"
    names = {"int64": "BIGINT", "int32": "INTEGER", "double": "DOUBLE", "bool": "BOOLEAN"}
    return names.get(str(kind), str(kind))

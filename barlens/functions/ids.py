"""Deterministic document ids, so that writing a document again replaces it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Time part of an id.
TO_THE_SECOND = "yyyyMMddHHmmss"
TO_THE_MINUTE = "yyyyMMddHHmm"


def doc_id(key: Column, at: Column, pattern: str, *parts: Column) -> Column:
    """``key_time[_part...]`` in the session time zone; missing parts are left out."""
    return F.concat_ws("_", key, F.date_format(at, pattern), *parts)

"""Checks that a table is small before it is read whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row


def small_rows(df: DataFrame, limit: int) -> list[Row] | None:
    """All rows when there are at most ``limit``, else ``None``. Never reads more than one above."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None

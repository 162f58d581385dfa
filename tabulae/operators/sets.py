"""Union by column name and distinct rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(dfs: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Stack tables matching columns by name (duplicates kept)."""
    if not dfs:
        raise ValueError("union_by_name needs at least one table")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def distinct_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Distinct rows over ``cols`` (all columns by default)."""
    return (df.select(*cols) if cols else df).distinct()

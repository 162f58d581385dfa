"""Projection, renaming, column-set rules and row filters (table -> table)."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulae.functions.clean import CLEANERS


def project(df: DataFrame, cols: list[str], renames: dict[str, str] | None = None) -> DataFrame:
    """Rename (old -> new) and then select ``cols`` in the published order."""
    if renames:
        df = df.withColumnsRenamed(renames)
    return df.select(*cols)


def suffix_columns(df: DataFrame, suffix: str) -> DataFrame:
    """Rename every column ``c`` to ``c + suffix`` (second role of a lookup)."""
    return df.select([F.col(c).alias(c + suffix) for c in df.columns])


def columns_by_rule(
    columns: Iterable[str],
    prefix: str | None = None,
    contains: str | None = None,
    exclude: Iterable[str] = (),
) -> list[str]:
    """Pick column names by a naming rule (prefix / substring / all but some)."""
    skip = set(exclude)
    out = []
    for c in columns:
        if c in skip:
            continue
        if prefix is not None and not c.startswith(prefix):
            continue
        if contains is not None and contains not in c:
            continue
        out.append(c)
    return out


def clean_columns(kind: str, cols: str | list[str]) -> Callable[[DataFrame], DataFrame]:
    """``df.transform(clean_columns('int', [...]))``: one projection, not a loop."""
    names = [cols] if isinstance(cols, str) else list(cols)
    fn = CLEANERS[kind]

    def _apply(df: DataFrame) -> DataFrame:
        return df.withColumns({c: fn(c) for c in names}) if names else df

    return _apply


def drop_all_null(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows whose columns (all of them by default) are all null."""
    return df.dropna(how="all", subset=subset)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First-n preview of a table (which rows is unspecified, as in Spark)."""
    return df.limit(n)

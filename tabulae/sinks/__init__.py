"""Table sinks: parquet (default) and header CSV, both written by the executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tabulae.sources.hadoop import delete, exists, move

FORMATS = ("parquet", "csv")


MODES = ("overwrite", "append", "ignore", "errorifexists", "error", "default")


def check_mode(mode: str, there: bool, path: str) -> bool:
    """Whether to write in ``mode``, given that data is ``there`` already."""
    if mode not in MODES:
        raise ValueError(f"unknown write mode {mode!r}; choose one of {MODES}")
    if there and mode in ("errorifexists", "error", "default"):
        raise FileExistsError(f"{path} exists; write with mode='overwrite' to replace it")
    return not (there and mode == "ignore")


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    compression: str = "zstd",
) -> None:
    """Write ``df`` to ``path``.  Overwrite by default, so a re-run succeeds;
    ``errorifexists`` (Spark's own default) refuses to touch an old table.

    An old table is replaced only when the new one is whole: the new one is
    written beside it and moved into place, so a write that fails, or a job
    that reads the very table it replaces, leaves the old one as it was.
    (Several tables that must change together: ``publish.Release``.)

    Parquet is zstd-compressed by default (smaller files and, measured on the
    establishments table, faster end to end than snappy).  CSV keeps blanks
    as they are (Spark's writer trims them otherwise) and is written in
    parallel by the executors, never through the driver.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown output format {fmt!r}; choose one of {FORMATS}")
    spark = df.sparkSession
    # a Connect session cannot rename: it has Spark's own modes
    there = getattr(spark, "_jsc", None) is not None and exists(spark, path)
    if not check_mode(mode, there, path):
        return
    dynamic = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static").lower() == "dynamic"
    swap = mode == "overwrite" and there and not (dynamic and partition_by)
    if partition_by:
        # Without this every input task would write one small file per value
        # (tasks x values files).  REBALANCE groups rows by the partition
        # columns and lets AQE split an oversized value (a state with a
        # third of the rows) across several tasks: few, evenly sized files.
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("errorifexists" if swap else mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    folder, name = _split(path)
    target = f"{folder}/.{name}.{uuid.uuid4().hex[:12]}" if swap else path
    try:
        if fmt == "parquet":
            w.option("compression", compression).parquet(target)
        else:
            w.options(
                header="true", quote='"', escape='"',
                ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
            ).csv(target)
    except BaseException:
        if swap:
            delete(spark, target)
        raise
    if swap:
        replace_folder(spark, target, path)


def _split(path: str) -> tuple[str, str]:
    folder, _, name = path.rstrip("/").rpartition("/")
    return folder or ".", name


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Move the whole folder ``new`` into the place of ``path``.

    Two renames; should the second one fail, the old folder is put back.
    """
    folder, name = _split(path)
    aside = f"{folder}/.{name}.{uuid.uuid4().hex[:12]}.old"
    move(spark, path, aside)
    try:
        move(spark, new, path)
    except BaseException:
        move(spark, aside, path)
        raise
    delete(spark, aside)
    spark.catalog.refreshByPath(path)


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = ";",
    encoding: str = "ISO-8859-1",
    header: bool = False,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> None:
    """Write raw-format delimited text (e.g. to stage or publish a registry file).

    Quotes are escaped by doubling them, and blanks are kept, so the text
    reads back exactly with ``sources.scan_delimited``.  Partitioned output
    is rebalanced like ``write_table``'s.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.options(
        sep=sep, encoding=encoding, header="true" if header else "false", quote='"', escape='"',
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
    ).csv(path)

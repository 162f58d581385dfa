"""Distributed file listing and name filters.

``binaryFile`` with only the path/size columns selected lists files without
reading their bytes; the filters are ordinary column predicates, so a listing
of millions of files is just another DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def file_name(path: str | Column) -> Column:
    p = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(p, r"([^/]+)$", 1)


def list_files(
    spark: SparkSession,
    root: str,
    suffix: str | None = None,
    contains: str | None = None,
    regex: str | None = None,
    name_glob: str | None = None,
) -> DataFrame:
    """All files under ``root`` as ``(path, name, length, modificationTime)``.

    ``suffix`` / ``contains`` / ``regex`` test the file *name*; ``name_glob``
    is pushed into the listing itself.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    df = reader.load(root).select("path", "length", "modificationTime")
    df = df.withColumn("name", file_name("path"))
    if suffix is not None:
        df = df.filter(F.col("name").endswith(suffix))
    if contains is not None:
        df = df.filter(F.col("name").contains(contains))
    if regex is not None:
        df = df.filter(F.col("name").rlike(regex))
    return df.select("path", "name", "length", "modificationTime")

"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulae.session import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    The optimizer merges projections and may copy a costly expression to each
    place that uses it; a lambda variable keeps its one value.
    """
    return F.transform(F.array(value), body)[0]


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again.

    Cuts lineage so that a lost executor costs a read, not a recomputation.
    ``options`` are those of the parquet writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(column: str, parts: int) -> Column:
    """crc32 of an id as text, modulo ``parts`` (null for a null id)."""
    return F.crc32(F.col(column).cast("string")) % parts


def sample_by_label(rows: DataFrame, label: str, each: int) -> DataFrame:
    """About ``each`` rows of every label value, at random by row content.

    Values are counted first (one row a value); a value's rows are kept with
    the probability that leaves ``each`` of them, and the first drawn always,
    so that no value is left out.  For fitting models only.
    """
    draw = F.pmod(F.xxhash64(*rows.columns), F.lit(1_000_003)) / 1_000_003.0
    drawn = rows.withColumn("__draw", draw)
    counts = drawn.groupBy(label).agg(F.count("*").alias("__n"), F.min("__draw").alias("__least"))
    return drawn.join(F.broadcast(counts), label).where(
        (F.col("__draw") * F.col("__n") < each) | (F.col("__draw") == F.col("__least"))).select(*rows.columns)

"""Joins that split their hot keys themselves.

AQE splits a skewed partition of an ordinary batch join.  It has no part in a
stream-static join, and cannot split a side whose partitioning is needed
further up.  Here a heavy-hitter sketch names the keys that hold more than
half of a partition's share, and only those are salted: the fact rows of such
a key go to many reducers, and its one lookup row is copied to each of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRACKED = 4_096     # keys that the sketch follows
_HASH, _SALT, _HEAVY = "__heavy_hash", "__heavy_salt", "__heavy"


def _hash(keys: list[str]) -> Column:
    # a null takes part by its own sign: xxhash64 alone would skip it
    return F.xxhash64(*(x for k in keys for x in (F.col(k), F.col(k).isNull())))


def _parts(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def heavy_keys(df: DataFrame, keys: list[str], parts: int | None = None) -> DataFrame:
    """Hashes of the key values that hold more than 1 / (2 * ``parts``) of the rows.

    One aggregate of bounded memory over the key columns; the result has fewer
    than 2 * ``parts`` rows.  A sketch may err at the margin, which changes
    where rows are joined and never what they are joined to.
    """
    parts = parts or _parts(df)
    return df.select(_hash(keys).alias(_HASH)).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k({_HASH}, {TRACKED // 4}, {TRACKED})").alias("top")).select(
        "n", F.inline("top")).where(F.col("count") * 2 * parts > F.col("n")).select(F.col("item").alias(_HASH))


def split_join(fact: DataFrame, dim: DataFrame, on: str | list[str], how: str = "left", null_safe: bool = False,
               salt_by: list[str] | None = None, heavy: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """Join ``fact`` to ``dim`` on ``on``, the heavy keys of ``fact`` split over ``parts`` reducers.

    The columns of ``fact`` come first, then those of ``dim`` but the keys.
    ``null_safe`` lets a null key match a null key.  ``salt_by`` names columns
    that tell the rows of a key apart (default: all; a few keep the scan
    narrow).  ``heavy`` is the result of ``heavy_keys`` where it cannot be
    taken from ``fact`` itself, as with a stream.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"split join must be 'left' or 'inner', got {how!r}")
    keys = [on] if isinstance(on, str) else list(on)
    parts = parts or _parts(fact)
    if heavy is None:
        heavy = heavy_keys(fact, keys, parts)
    marks = F.broadcast(heavy.withColumn(_HEAVY, F.lit(True)))      # fewer than 2 * parts rows
    salt = F.when(F.col(_HEAVY), F.pmod(F.xxhash64(*(salt_by or fact.columns)), F.lit(parts)).cast("int")).otherwise(F.lit(0))
    left = fact.withColumn(_HASH, _hash(keys)).join(marks, _HASH, "left").withColumn(_SALT, salt)
    renamed = {k: f"__dim_{i}" for i, k in enumerate(keys)}
    copies = F.when(F.col(_HEAVY), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    right = dim.withColumn(_HASH, _hash(keys)).join(marks, _HASH, "left").withColumn("__dim_salt", F.explode(copies)).drop(
        _HASH, _HEAVY).withColumnsRenamed(renamed)
    same = [F.col(k).eqNullSafe(F.col(r)) if null_safe else F.col(k) == F.col(r) for k, r in renamed.items()]
    joined = left.join(right, reduce(lambda a, b: a & b, [*same, F.col(_SALT) == F.col("__dim_salt")]), how)
    return joined.select(*fact.columns, *[c for c in dim.columns if c not in keys])

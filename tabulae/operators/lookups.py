"""Lookup joins of big fact tables against code tables.

Every lookup is an equi-join on a code.  Code tables are small, so the join
is a broadcast hash join — no shuffle of the fact side at all — but only
after their size is *checked*: an ordinary aggregate (one row a task is
shuffled) proves the row count and the bytes of data are within bounds.  A table
over the bound takes the shuffle path instead, where AQE splits skewed
partitions and null keys (which can never match) are spread over many
reducers rather than piling into one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Code tables of the registry hold at most a few thousand rows; the bounds
# leave room while keeping a broadcast well under executor memory.
DEFAULT_MAX_BROADCAST_ROWS = 200_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20
NULL_SALT_BUCKETS = 64
_SALT = "__tabulae_null_salt"
_STRINGY = ("string", "binary")


def _size_probe(dim: DataFrame) -> DataFrame:
    """One row: (rows, bytes) of ``dim``; a partial aggregate, so no rows travel."""
    width = [
        F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) if f.dataType.typeName() in _STRINGY else F.lit(8)
        for f in dim.schema.fields
    ]
    row_bytes = sum(width[1:], width[0]) if width else F.lit(0)
    return dim.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes).cast("long").alias("b"))


def fits_broadcast(
    dim: DataFrame,
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> bool:
    """True when ``dim`` provably has at most ``max_rows`` rows and its rows
    add up to at most ``max_bytes`` (string/binary lengths plus 8 bytes per
    other field).  One aggregate over the table; each task sends one row.

    The bound applies to the rows ``dim`` *produces*: if ``dim`` is itself
    an aggregate or a join, that work runs for the check and again for the
    broadcast, so checkpoint such a table first (as the tiered match does).
    """
    got = _size_probe(dim).first()
    return got["n"] <= max_rows and (got["b"] or 0) <= max_bytes


def fits_broadcast_all(
    dims: dict[str, DataFrame],
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> dict[str, bool]:
    """``fits_broadcast`` for several tables in one Spark job (a union of
    the aggregates), e.g. all code tables of a run."""
    if not dims:
        return {}
    probes = [_size_probe(df).select(F.lit(name).alias("t"), "n", "b") for name, df in dims.items()]
    rows = reduce(lambda a, b: a.unionByName(b), probes).collect()  # one row per table
    return {r["t"]: r["n"] <= max_rows and (r["b"] or 0) <= max_bytes for r in rows}


def coerce_key(dim: DataFrame, key: str, dtype: str, integral_decimals: bool = False) -> DataFrame:
    """Cast a text lookup key to the fact key's type; junk keys become null.

    ``'0101'`` becomes 101.  With ``integral_decimals`` a key written as a
    whole decimal (``'101.0'``, as spreadsheet exports write code columns
    that have gaps) becomes 101 too; ``'101.5'`` never matches.
    """
    k = F.col(key)
    typed = k.try_cast(dtype)
    if integral_decimals:
        d = k.try_cast("double")
        typed = F.coalesce(typed, F.when(d == F.floor(d), d.try_cast(dtype)))
    return dim.withColumn(key, typed)


def duplicate_keys(dim: DataFrame, on: str | list[str]) -> DataFrame:
    """Keys that ``dim`` holds more than once, with their row counts.

    Such a key makes a lookup return a fact row several times.  Null keys
    never match and are not reported.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return dim.dropna("any", subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def require_unique(dims: dict[str, DataFrame], show: int = 10) -> None:
    """Raise if a table (keyed by the column it is named after) has a key
    more than once; the message holds the first ``show`` of them.

    One job for all tables.  It aggregates them, so use it where they are
    written or small, as the jobs do with their code tables.
    """
    found = [duplicate_keys(df, key).select(F.lit(key).alias("t"), F.col(key).cast("string").alias("k"), "n_rows")
             for key, df in dims.items()]
    bad = reduce(lambda a, b: a.unionByName(b), found).orderBy("t", "k").limit(show).collect()
    if bad:
        raise ValueError("lookup keys come more than once, which would multiply the rows that hold them: "
                         + ", ".join(f"{r['t']}={r['k']} ({r['n_rows']} rows)" for r in bad))


def unmatched_keys(fact: DataFrame, dim: DataFrame, on: str | list[str]) -> DataFrame:
    """Fact keys without a row in ``dim``, with the number of fact rows each
    holds (a null key is reported too: it never matches).

    Facts are aggregated by key first, so a hot key is one row in the join.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).join(dim.select(*keys), keys, "left_anti")


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: str | list[str],
    how: str = "left",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    small: bool | None = None,
) -> DataFrame:
    """Join ``fact`` to the code table ``dim`` on ``on`` (USING semantics).

    The key keeps the fact side's type and value.  ``how`` is ``left``
    (unknown codes keep the row with null labels) or ``inner`` (rows with an
    unknown or null code are dropped).  ``small`` skips the size check when
    the caller has already proven (or ruled out) the bound.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("left", "inner"):
        raise ValueError(f"lookup join must be 'left' or 'inner', got {how!r}")
    if small is None:
        small = fits_broadcast(dim, max_broadcast_rows)
    if small:
        return fact.join(F.broadcast(dim), keys, how)
    if how == "inner":
        # Catalyst adds IsNotNull on the keys, so null keys never shuffle.
        return fact.join(dim, keys, how)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    salt = F.when(any_null, F.lit(1) + F.pmod(F.xxhash64(*fact.columns), F.lit(NULL_SALT_BUCKETS))).otherwise(F.lit(0))
    salted_fact = fact.withColumn(_SALT, salt.cast("long"))
    salted_dim = dim.withColumn(_SALT, F.lit(0).cast("long"))
    return salted_fact.join(salted_dim, keys + [_SALT], how).drop(_SALT)


def lookup_role(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    fact_key: str,
    rename: dict[str, str],
    how: str = "left",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    small: bool | None = None,
) -> DataFrame:
    """A code table in a second role: ``dim[key]`` matched against
    ``fact[fact_key]``, bringing ``dim``'s columns in under ``rename``.

    The broadcast side is the very same table as in the first role (only the
    output is renamed), so Spark ships it once and reuses the exchange.
    """
    if small is None:
        small = fits_broadcast(dim, max_broadcast_rows)
    if not small:
        renamed = dim.select(F.col(key).alias(fact_key), *[F.col(c).alias(n) for c, n in rename.items()])
        return lookup(fact, renamed, fact_key, how, small=False)
    role = F.broadcast(dim).alias("__role")
    joined = fact.alias("__fact").join(role, F.col(f"__fact.{fact_key}") == F.col(f"__role.{key}"), how)
    return joined.select("__fact.*", *[F.col(f"__role.{c}").alias(n) for c, n in rename.items()])

"""Tiered matching of records to a reference table (address -> coordinates).

Tier by tier, from the most to the least specific key, each record takes the
best accepted reference row for its key; the first tier that matches wins.
Each tier's reference rows are filtered by the tier's accept rule and reduced
to exactly one row per key *before* the join (an aggregate with map-side
partial combine, so a key holding a third of the rows costs no more than any
other), hence records never fan out and every tier is a many-to-one lookup.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulae.operators.heavy import split_join
from tabulae.operators.lookups import DEFAULT_MAX_BROADCAST_ROWS, fits_broadcast, lookup


@dataclass
class Tier:
    """``keys`` maps record column -> reference column; ``accept`` filters
    reference rows (``None`` accepts all).

    ``accept`` may use the reference's key columns: on a match they equal the
    record's, so "the matched address contains the record's city" is
    ``F.col("address").contains(F.col("city"))`` when the city is a key.
    """

    keys: dict[str, str]
    accept: Column | None = None
    name: str = field(default="")


def candidates(ref: DataFrame, tier: Tier) -> DataFrame:
    """Reference rows the tier accepts (rows with a null key part never match)."""
    cand = ref if tier.accept is None else ref.filter(tier.accept)
    for rc in tier.keys.values():
        cand = cand.filter(F.col(rc).isNotNull())
    return cand


def best_per_key(ref: DataFrame, tier: Tier, values: list[str], rank: list[Column], out: str) -> DataFrame:
    """One row per tier key: the ``values`` of the lowest ``rank`` row.

    A missing rank value ranks last (each field is preceded by its null
    flag; struct order would otherwise put nulls first).
    """
    cand = candidates(ref, tier)
    key_cols = [F.col(rc).alias(fc) for fc, rc in tier.keys.items()]
    order = F.struct(*[e for i, r in enumerate(rank) for e in (r.isNull().alias(f"n{i}"), r.alias(f"r{i}"))])
    return (cand.groupBy(*key_cols)
                .agg(F.min_by(F.struct(*values), order).alias(out)))


def _attach_tiers(df: DataFrame, bests: list[tuple[DataFrame, list[str], bool]], values: list[str],
                  tier_col: str) -> tuple[DataFrame, list[str]]:
    """Left-join each tier's best rows, then pick the first tier that matched."""
    slots = []
    for i, (best, keys, small) in enumerate(bests, start=1):
        df = lookup(df, best, keys, "left", small=small)
        slots.append(f"__tier{i}")
    chosen = F.coalesce(*[F.col(s) for s in slots])
    tier_no = reduce(lambda acc, i: acc.when(F.col(slots[i]).isNotNull(), F.lit(i + 1)),
                     range(1, len(slots)), F.when(F.col(slots[0]).isNotNull(), F.lit(1)))
    df = df.withColumn("__chosen", chosen).withColumn(tier_col, tier_no)
    return df, [f"__chosen.{v}" for v in values]


def tiered_match(
    records: DataFrame,
    ref: DataFrame,
    tiers: list[Tier],
    values: list[str],
    rank: list[Column],
    tier_col: str = "tier",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Records + ``values`` from the first tier that matches + ``tier_col``
    (1-based; null when no tier matched).  ``rank`` orders candidates:
    smallest first, e.g. ``[-F.col('score'), F.col('id')]``.

    Size checks never run the reduction twice: if a tier's accepted rows are
    within the broadcast bound, so is their reduction; otherwise the reduced
    table is checkpointed to the shared folder once, counted there, and
    joined from there.

    When every tier's reduction is broadcast, records are decorated in place
    (no shuffle).  Otherwise the tiers are matched on the *distinct key
    combinations* of the records — one narrow shuffle, combined map-side, so
    a hot address costs one row — and the result is attached to the records
    by a single null-safe join that splits heavy keys, instead of shuffling
    the records once per tier.
    """
    bests = []
    for i, tier in enumerate(tiers, start=1):
        best = best_per_key(ref, tier, values, rank, f"__tier{i}")
        small = fits_broadcast(candidates(ref, tier), max_broadcast_rows)
        if not small:
            best = best.checkpoint(eager=True)
            small = fits_broadcast(best, max_broadcast_rows)
        bests.append((best, list(tier.keys), small))

    if all(small for _, _, small in bests):
        out, picked = _attach_tiers(records, bests, values, tier_col)
        return out.select(*records.columns, *[F.col(p).alias(v) for p, v in zip(picked, values)], tier_col)

    key_cols = list(dict.fromkeys(k for tier in tiers for k in tier.keys))
    matched, picked = _attach_tiers(records.select(*key_cols).distinct(), bests, values, tier_col)
    matched = matched.select(*key_cols, *[F.col(p).alias(v) for p, v in zip(picked, values)], tier_col)
    matched = matched.checkpoint(eager=True)  # joined once below; cut the lineage
    # null-safe: a record with a missing key part still finds its combination
    if not fits_broadcast(matched, max_broadcast_rows):
        return split_join(records, matched, key_cols, null_safe=True)  # an address with a third of the records is split
    side = F.broadcast(matched.withColumnsRenamed({k: f"__key_{n}" for n, k in enumerate(key_cols)}))
    cond = reduce(lambda a, b: a & b, [records[k].eqNullSafe(side[f"__key_{n}"]) for n, k in enumerate(key_cols)])
    out = records.join(side, cond, "left")
    return out.select(*[records[c] for c in records.columns], *[side[v] for v in values], side[tier_col])


# FIXED VALUES: accept rules of the address service.
EXACT_SCORE, MIN_SCORE = 100, 80
PRECISE = ("PointAddress", "StreetAddress")
ADDRESS = ("rua", "cep", "bairro", "municipio", "uf")   # parts, as records name them


def address_tiers(parts: dict[str, str] | None = None, score: str = "score", quality: str = "quality",
                  address: str = "address") -> list[Tier]:
    """The three address rules, most specific first.

    1. Street, quarter, city and state: the matched address contains the city
       and scores 100, or at least 80 as a point or street address.
    2. Quarter, city and state: it contains the city and scores at least 80.
    3. Postal code, city and state: whatever it is.

    ``parts`` names the reference table's column of each of ADDRESS (default:
    the same name with ``ref_`` before it); the others are its columns too.
    """
    of = {p: f"ref_{p}" for p in ADDRESS} | (parts or {})
    s = F.col(score)
    holds_city = F.contains(F.col(address), F.col(of["municipio"]))
    precise = (s == EXACT_SCORE) | ((s >= MIN_SCORE) & F.col(quality).isin(*PRECISE))

    def keys(*names: str) -> dict[str, str]:
        return {n: of[n] for n in (*names, "municipio", "uf")}

    return [Tier(keys("rua", "bairro"), holds_city & precise, "street"),
            Tier(keys("bairro"), holds_city & (s >= MIN_SCORE), "quarter"),
            Tier(keys("cep"), None, "postal code")]


def match_addresses(records: DataFrame, ref: DataFrame, values: tuple[str, ...] = ("lat", "lng"),
                    score: str = "score", **names) -> DataFrame:
    """``records`` (columns ADDRESS) with the coordinates of the first address
    rule that holds.  Of several candidates the highest score wins, then the
    smallest values.  ``names`` are those of ``address_tiers``."""
    rank = [-F.col(score), *map(F.col, values)]
    return tiered_match(records, ref, address_tiers(score=score, **names), list(values), rank)

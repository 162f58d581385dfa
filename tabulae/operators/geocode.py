"""Address geocoding with a computed score.

Records and the rows of an address table are reduced to sets of comparable
words.  A candidate's score is how far its words agree with the record's
(0 to 100), and the three address rules are applied to that score.

Candidates are found by blocking that loses none: two word sets that agree
well enough must share one of their rarest words (the prefix of each set in
order of rarity within its city), so only those few words are joined on.
Everything runs on distinct addresses; the records themselves are joined once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulae.functions.address import address_words
from tabulae.operators.heavy import _parts, split_join
from tabulae.operators.match import ADDRESS, EXACT_SCORE, MIN_SCORE, PRECISE
from tabulae.session import parallelism, stored

OUT = ("tier", "score")


@dataclass(frozen=True)
class Scoring:
    """Shares of street and quarter in a score (they add up to 100)."""

    street: int = 70
    quarter: int = 30
    least: int = MIN_SCORE
    exact: int = EXACT_SCORE


def _set(key: Column) -> Column:
    return F.when(key == "", F.array().cast("array<string>")).otherwise(F.split(key, " "))


def _spread(df: DataFrame) -> int:
    """Tasks for rows that are few bytes and much work: by bytes alone Spark gives all of them to one task."""
    return max(3 * parallelism(df.sparkSession), _parts(df))


def _normal(df: DataFrame) -> DataFrame:
    """``df`` with place, street, quarter (sorted words, blank-joined) and code."""
    texts = F.transform(F.array("rua", "bairro", "municipio", "uf"), lambda x: F.array_join(address_words(x), " "))
    df = df.repartition(_spread(df)).withColumn("__texts", texts)       # each part is taken apart once

    street, quarter, city, state = (F.col("__texts")[i] for i in range(4))
    place = F.when((city != "") & (state != ""), F.concat_ws("|", state, city))
    code = F.regexp_replace(F.coalesce(F.col("cep").cast("string"), F.lit("")), "[^0-9]", "")
    return df.withColumns({"__place": place, "__street": street, "__quarter": quarter, "__code": F.when(code != "", F.lpad(code, 8, "0"))}).drop("__texts")


def similar_sets(left: DataFrame, right: DataFrame, key: str, num: int, den: int) -> DataFrame:
    """Pairs of word sets of one place whose agreement 2 * shared / (sizes added
    up) is ``num / den`` or more: __place, ``key``, __other, __shared, __sizes.

    ``left`` and ``right`` have distinct (__place, ``key``), the words of a set
    joined by blanks.  Exact: the prefix filter leaves no pair out.
    """
    def words(side: DataFrame) -> DataFrame:
        return side.select("__place", key, F.explode(_set(F.col(key))).alias("__word"))

    often = words(right).groupBy("__place", "__word").agg(F.count(F.lit(1)).alias("__n"))

    def prefixes(side: DataFrame, name: str) -> DataFrame:
        ranked = words(side).join(often, ["__place", "__word"], "left").groupBy("__place", key).agg(
            F.array_sort(F.collect_list(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), F.col("__word").alias("w")))).alias("__all"))
        # a partner shares at least num / (2 den - num) of the set
        must = F.expr(f"cast((size(__all) * {num} + {2 * den - num - 1}) div {2 * den - num} as int)")
        first = F.slice(F.transform("__all", lambda x: x["w"]), F.lit(1), F.size("__all") - must + 1)
        rows = ranked.select("__place", F.col(key).alias(name), F.transform("__all", lambda x: x["w"]).alias(f"{name}_set"), first.alias(f"{name}_pre"))
        return rows.withColumn("__word", F.explode(f"{name}_pre")).repartition(_spread(side), "__place", "__word")

    l, r = prefixes(left, "__l"), prefixes(right, "__r")
    lw, rw = F.col("__l_set"), F.col("__r_set")
    once = F.element_at(F.array_intersect("__l_pre", "__r_pre"), 1) == F.col("__word")      # a pair meets at its first shared word
    sizes = F.size(lw) + F.size(rw)
    fits = 2 * den * F.least(F.size(lw), F.size(rw)) >= num * sizes
    pairs = l.join(r, ["__place", "__word"]).where(fits & once).select(
        "__place", F.col("__l").alias(key), F.col("__r").alias("__other"), F.size(F.array_intersect(lw, rw)).alias("__shared"), sizes.alias("__sizes"))
    return pairs.where(2 * den * F.col("__shared") >= num * F.col("__sizes"))


def geocode(records: DataFrame, gazetteer: DataFrame, values: tuple[str, ...] = ("lat", "lng"), order: tuple[str, ...] = ("id",),
            quality: str = "quality", scoring: Scoring = Scoring()) -> DataFrame:
    """``records`` with ``values``, tier and score of the best address of ``gazetteer``.

    Both have the columns ADDRESS (street, postal code, quarter, city, state).
    City and state must agree.  Rule 1: street and quarter score ``exact``, or
    ``least`` and more on an address of precise ``quality``.  Rule 2: the
    quarter scores ``least`` or more.  Rule 3: the postal code is the same
    (no score).  The first rule that holds wins, then the highest score, then
    the smallest ``order``.  A score is the whole part of the street's and the
    quarter's shares times their agreement; two addresses without a quarter
    agree in it, and a record without a street has no rule 1.

    Nulls are parts without words; records repeat freely (each distinct address
    is scored once); a record without city or state stays unmatched; empty
    tables give empty or unmatched results.
    """
    asked = stored(_normal(records.select(*ADDRESS).distinct()), "asked")
    best = F.struct(*(x for c in order for x in (F.col(c).isNull().alias(f"n_{c}"), F.col(c).alias(f"o_{c}"))), *(F.col(v).alias(f"v_{v}") for v in values))
    known = stored(_normal(gazetteer).where("__place is not null").select(
        "__place", "__street", "__quarter", "__code", F.coalesce(F.col(quality).isin(*PRECISE), F.lit(False)).alias("__precise"), best.alias("__best")), "gazetteer")
    wants = asked.where("__place is not null")

    def distinct(df: DataFrame, key: str) -> DataFrame:
        return df.where(F.col(key) != "").select("__place", key).distinct()

    # rule 1: even with a quarter in full agreement the street must reach this much
    near = similar_sets(distinct(wants, "__street"), distinct(known, "__street"), "__street", scoring.least - scoring.quarter, scoring.street)
    reduced = known.groupBy("__place", F.col("__street").alias("__other"), F.col("__quarter").alias("__q")).agg(
        F.min("__best").alias("__any"), F.min(F.when(F.col("__precise"), F.col("__best"))).alias("__exactly"))
    both = wants.select("__place", "__street", "__quarter").distinct().join(near, ["__place", "__street"]).join(reduced, ["__place", "__other"])
    q1, q2 = _set(F.col("__quarter")), _set(F.col("__q"))
    empty = (F.col("__quarter") == "") & (F.col("__q") == "")
    scored = both.withColumns({"__qi": F.when(empty, 1).otherwise(F.size(F.array_intersect(q1, q2))), "__qs": F.when(empty, 2).otherwise(F.size(q1) + F.size(q2))}).withColumn(
        "__score", F.expr(f"cast(2 * ({scoring.street} * __shared * __qs + {scoring.quarter} * __qi * __sizes) div (__sizes * __qs) as int)"))
    taken = F.when(F.col("__score") >= scoring.exact, F.col("__any")).when(F.col("__score") >= scoring.least, F.col("__exactly"))

    def first(df: DataFrame, keys: list[str], name: str) -> DataFrame:
        return df.where("__taken is not null").groupBy(*keys).agg(F.min(F.struct((-F.col("__score")).alias("s"), F.col("__taken").alias("b"))).alias(name))

    rule1 = first(scored.withColumn("__taken", taken), ["__place", "__street", "__quarter"], "__t1")
    # rule 2
    near2 = similar_sets(distinct(wants, "__quarter"), distinct(known, "__quarter"), "__quarter", scoring.least, 100)
    of_quarter = known.groupBy("__place", F.col("__quarter").alias("__other")).agg(F.min("__best").alias("__taken"))
    rule2 = first(near2.join(of_quarter, ["__place", "__other"]).withColumn("__score", F.expr("cast(200 * __shared div __sizes as int)")), ["__place", "__quarter"], "__t2")
    rule3 = known.where("__code is not null").groupBy("__place", "__code").agg(F.min(F.struct(F.lit(None).cast("int").alias("s"), F.col("__best").alias("b"))).alias("__t3"))

    found = asked.join(rule1, ["__place", "__street", "__quarter"], "left").join(rule2, ["__place", "__quarter"], "left").join(rule3, ["__place", "__code"], "left")
    won = F.coalesce("__t1", "__t2", "__t3")
    tier = F.when(F.col("__t1").isNotNull(), 1).when(F.col("__t2").isNotNull(), 2).when(F.col("__t3").isNotNull(), 3)
    answers = stored(found.select(*ADDRESS, won.alias("__won"), tier.alias("tier")).select(
        *ADDRESS, *(F.col(f"__won.b.v_{v}").alias(v) for v in values), "tier", (-F.col("__won.s")).alias("score")), "geocoded")
    # one row for each distinct address; an address with a third of the records is split
    return split_join(records, answers, list(ADDRESS), null_safe=True)

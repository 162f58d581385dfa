"""Transliteration against expectations that do not come from the library's own table:
DuckDB's accent stripping for letters with accents, and spellings written by hand for signs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulae.catalog.standin import table
from tabulae.functions.clean import clean_text, trim_translit
from tabulae.functions.transliteration import translit

Q: dict = {}

# FIXED VALUES: signs and their usual ASCII spelling, written by hand.
SPELT = [("€", "EUR"), ("…", "..."), ("“", '"'), ("”", '"'), ("’", "'"), ("–", "-"), ("—", "--"), ("Æ", "AE"), ("æ", "ae"), ("Ø", "O"), ("ø", "o"),
         ("Þ", "Th"), ("þ", "th"), ("ß", "ss"), ("£", "PS"), ("№", "No"), ("™", "(tm)"), ("Œ", "OE"), ("œ", "oe"), ("Ł", "L"), ("ł", "l"), ("đ", "d"), ("ı", "i"),
         ("°", "deg"), ("«", "<<"), ("»", ">>"), ("×", "x"), ("²", "2"), ("¿", "?"), ("¡", "!"), ("ª", "a"), ("º", "o"), ("®", "(r)"), ("©", "(c)"), ("±", "+-"), ("µ", "u"),
         ("ő", "o"), ("š", "s"), ("Ž", "Z"), ("ǎ", "a"), ("ễ", "e"), ("Ạ", "A"), ("é", "e")]


def _sign(values, i: str, quote=lambda v: "'" + v.replace("'", "''") + "'") -> str:
    return f"CASE {i} " + " ".join(f"WHEN {n} THEN {quote(v)}" for n, v in enumerate(values)) + " END"


def _source(spark, sf):
    """Every document, with one of the signs at its end."""
    signs = F.element_at(F.array(*(F.lit(s) for s, _ in SPELT)), (F.col("doc_id") % len(SPELT)).cast("int") + 1)
    return table(spark, sf, "documents").select("doc_id", F.concat(F.lit("  "), F.col("text"), signs, F.lit(" z ")).alias("t"))


_PLAIN = f"replace(strip_accents(text), 'ß', 'ss') || {_sign([s for _, s in SPELT], f'doc_id % {len(SPELT)}')} || ' z'"
Q["translit_signs"] = (lambda spark, sf: _source(spark, sf).select("doc_id", translit(F.col("t")).alias("plain")),
                       f"SELECT doc_id, '  ' || {_PLAIN} || ' ' AS plain FROM documents")
Q["translit_trimmed"] = (lambda spark, sf: _source(spark, sf).select("doc_id", trim_translit("t").alias("plain")),
                         f"SELECT doc_id, {_PLAIN} AS plain FROM documents")
Q["translit_clean_text"] = (lambda spark, sf: _source(spark, sf).select("doc_id", clean_text("t").alias("plain")),
                            f"""SELECT doc_id, list_aggregate(list_transform(string_split({_PLAIN}, ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ') AS plain
  FROM documents""")

"""Accent transliteration to ASCII as native Spark expressions.

Registry files are ISO-8859-1, so every non-ASCII character they can hold is
in U+0080..U+00FF; trade names are UTF-8 and add typographic signs and further
Latin letters.  Both are a finite table; other scripts stay as they are and
``untransliterated`` counts them.  One-to-one letters go through a single
``translate`` (which also deletes characters mapped to nothing); the few
one-to-many entries are a fold of ``replace``, only evaluated on rows that
are still non-ASCII after the ``translate``.  Everything is native; no Python
runs per row.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: ASCII spelling of U+00A0 .. U+00FF, in code-point order
# (the usual transliteration of the Latin-1 supplement).
LATIN1_ASCII = [
    # U+00A0 .. U+00AF
    " ", "!", "C/", "PS", "$?", "Y=", "|", "SS", '"', "(c)", "a", "<<", "!", "", "(r)", "-",
    # U+00B0 .. U+00BF
    "deg", "+-", "2", "3", "'", "u", "P", "*", ",", "1", "o", ">>", " 1/4", " 1/2", " 3/4", "?",
    # U+00C0 .. U+00CF
    "A", "A", "A", "A", "A", "A", "AE", "C", "E", "E", "E", "E", "I", "I", "I", "I",
    # U+00D0 .. U+00DF
    "D", "N", "O", "O", "O", "O", "O", "x", "O", "U", "U", "U", "U", "Y", "Th", "ss",
    # U+00E0 .. U+00EF
    "a", "a", "a", "a", "a", "a", "ae", "c", "e", "e", "e", "e", "i", "i", "i", "i",
    # U+00F0 .. U+00FF
    "d", "n", "o", "o", "o", "o", "o", "/", "o", "u", "u", "u", "u", "y", "th", "y",
]

# FIXED VALUES: Latin Extended-A letters that have no canonical decomposition.
EXTENDED_A_SPECIAL = {
    "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i", "Ĳ": "IJ", "ĳ": "ij", "ĸ": "q",
    "Ŀ": "L", "ŀ": "l", "Ł": "L", "ł": "l", "ŉ": "'n", "Œ": "OE", "œ": "oe", "Ŧ": "T",
    "ŧ": "t", "ſ": "s",
}

# FIXED VALUES: typographic signs, currency signs and letters without a decomposition.
SIGNS = {
    "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2014": "--", "\u2015": "--",
    "\u2018": "'", "\u2019": "'", "\u201a": ",", "\u201b": "'", "\u201c": '"', "\u201d": '"', "\u201e": ",,", "\u201f": '"',
    "\u2020": "+", "\u2021": "++", "\u2022": "*", "\u2026": "...", "\u2030": "%0", "\u2032": "'", "\u2033": "''",
    "\u2039": "<", "\u203a": ">", "\u2044": "/", "\u20ac": "EUR", "\u2116": "No", "\u2122": "(tm)", "\u2212": "-",
    "\u0192": "f", "\u018f": "@", "\u0259": "@",
}
# Blanks of other widths become a blank; zero-width signs carry no text.
BLANKS = "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
ZERO_WIDTH = "\u200b\u200c\u200d\u200e\u200f\u2060\ufeff"
# Combining accents (decomposed text) carry no letter of their own.
COMBINING = range(0x300, 0x370)


def _build_table() -> dict[str, str]:
    table: dict[str, str] = {}
    # C1 control characters carry no text: removed.
    for cp in range(0x80, 0xA0):
        table[chr(cp)] = ""
    for i, ascii_form in enumerate(LATIN1_ASCII):
        table[chr(0xA0 + i)] = ascii_form
    table.update(SIGNS)
    table.update(dict.fromkeys(BLANKS, " "))
    table.update(dict.fromkeys(ZERO_WIDTH, ""))
    table.update((chr(cp), "") for cp in COMBINING)
    # Latin Extended-A and -B (U+0100..U+024F) and Additional (U+1E00..U+1EFF)
    # by rule: the base letter of the canonical decomposition, when it is ASCII.
    for cp in (*range(0x100, 0x250), *range(0x1E00, 0x1F00)):
        ch = chr(cp)
        if ch in EXTENDED_A_SPECIAL:
            table[ch] = EXTENDED_A_SPECIAL[ch]
            continue
        base = unicodedata.normalize("NFD", ch)[0]
        if base.isascii() and base.isalpha():
            table[ch] = base
    return table


TABLE = _build_table()

# translate(): source chars with a one-char target, then chars to delete.
_ONE = {k: v for k, v in TABLE.items() if len(v) == 1}
_DELETE = [k for k, v in TABLE.items() if v == ""]
TRANSLATE_FROM = "".join(_ONE) + "".join(_DELETE)
TRANSLATE_TO = "".join(_ONE.values())
MULTI = {k: v for k, v in TABLE.items() if len(v) > 1}


def translit(c: Column) -> Column:
    """Transliterate accented text to ASCII (null stays null).

    Text whose UTF-8 byte length is its character length is ASCII and stays as
    it is.  After ``translate`` only one-to-many characters (or ones with no
    ASCII form) can remain, so the ``replace`` chain runs only on those.
    """
    one = F.translate(c, TRANSLATE_FROM, TRANSLATE_TO)
    # a fold, not a chain of calls: written out for every column of a wide table, the chain makes
    # methods that the JVM leaves interpreted for all rows, most of which never come here
    spellings = F.array(*(F.struct(F.lit(k).alias("sign"), F.lit(v).alias("ascii")) for k, v in MULTI.items()))
    many = F.reduce(spellings, one, lambda text, s: F.replace(text, s["sign"], s["ascii"]))
    return F.when(F.octet_length(c) == F.length(c), c).when(F.octet_length(one) == F.length(one), one).otherwise(many)


def untransliterated(c: Column) -> Column:
    """How many characters of the text ``translit`` leaves outside ASCII (null: 0)."""
    return F.coalesce(F.length(F.regexp_replace(translit(c), "[\\x00-\\x7F]", "")), F.lit(0))


def translit_sql(expr: str) -> str:
    """The same mapping as portable SQL (DuckDB/ANSI ``translate``/``replace``)."""

    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    out = f"translate({expr}, {q(TRANSLATE_FROM)}, {q(TRANSLATE_TO)})"
    for k, v in MULTI.items():
        out = f"replace({out}, {q(k)}, {q(v)})"
    return out

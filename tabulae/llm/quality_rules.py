"""Line-first cleaning rules [native].

Each line is judged by punctuation, navigation and boilerplate rules; failing
lines are removed, and a document that loses too much of its text is rejected.
All of it is one expression over the row: no shuffle and no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulae.llm.common import let

SPACE = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
# Fixed phrases of web furniture, matched in lower case.
BOILERPLATE = ("cookie policy|accept cookies|we use cookies|privacy policy|terms of use|terms of service|"
               "all rights reserved|enable javascript|click here|read more|sign up|log in|sign in|"
               "subscribe to our|follow us on|share this|back to top|lorem ipsum|page not found")
MAX_LOSS = 0.5          # of the non-space characters
MAX_SYMBOLS = 0.10      # symbols to non-space characters of a line
MAX_MARKS = 0.08        # '!' and '?' to non-space characters of a line
MIN_SEPARATORS = 2      # '|', '»' or '›' in a navigation line
BOILERPLATE_CHARS = 160  # a longer line that holds such a phrase is prose
SUSPECT = "[#*$%&|<>!?»›]"  # no punctuation or navigation rule fails without one of these


def stripped(text: Column) -> Column:
    """The text without its white space."""
    return F.translate(text, SPACE, "")


def removed(text: Column, chars: str) -> Column:
    """How many of these (single-byte) characters the text has."""
    return F.octet_length(text) - F.octet_length(F.translate(text, chars, ""))


def words_of(text: Column) -> Column:
    """Maximal runs without the six white-space characters; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words that lie in a five-word window found twice or more in the array.

    Windows are compared by 64-bit hashes.  They are sorted with their places;
    equal neighbours are repeats, and each repeated start covers five words
    less what the next one covers too.
    """
    def covered(starts: Column) -> Column:
        ends = F.transform(starts, lambda p, i: F.least(F.lit(5), F.coalesce(F.get(starts, i + 1) - p, F.lit(5))))
        return F.aggregate(ends, F.lit(0).cast("long"), lambda a, x: a + x)

    def of_sorted(pairs: Column) -> Column:
        hit = F.filter(pairs, lambda x, i: (F.get(pairs, i + 1)["h"] == x["h"])
                       | (F.when(i > 0, F.get(pairs, i - 1)["h"]) == x["h"]))
        return let(F.array_sort(F.transform(hit, lambda x: x["p"])), covered)

    def of_hashes(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            let(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))), of_sorted))

    def of_words(w: Column) -> Column:
        hashes = F.transform(F.slice(w, 1, F.greatest(F.size(w) - 4, F.lit(0))),
                             lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2), F.get(w, i + 3), F.get(w, i + 4)))
        return let(hashes, of_hashes)

    return let(words, of_words)


def line_fails(line: Column) -> Column:
    """Whether a line breaks a rule (a line without words breaks none).

    Punctuation: too many symbols, too many '!' and '?'.  Navigation: parts
    parted by separators.  Boilerplate: a short line with a fixed phrase.
    Characters are only counted in lines that have one to count.
    """
    chars = F.octet_length(stripped(line))
    marked = (
        (removed(line, SYMBOLS) > MAX_SYMBOLS * chars)
        | (removed(line, "!?") > MAX_MARKS * chars)
        | (F.length(line) - F.length(F.translate(line, "|»›", "")) >= MIN_SEPARATORS)
    )
    return F.when(line.rlike(SUSPECT), marked).otherwise(F.lit(False)) | F.when(
        F.octet_length(line) <= BOILERPLATE_CHARS, F.lower(line).rlike(BOILERPLATE)).otherwise(F.lit(False))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def duplicate_lines(lines: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    worded = F.filter(lines, lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return let(worded, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def verdict(text: Column) -> Column:
    """Struct of the statistics and of ``base_failed`` and ``kept``.

    Null and empty texts have no words, fail the base rules and are not kept.
    """
    base = F.struct(
        let(words_of(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r"))).alias("w"),
        F.length(F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", "")).cast("long").alias("word_chars"),
        F.coalesce(F.regexp_count(text, F.lit(f"[{SYMBOLS}]")), F.lit(0)).cast("long").alias("n_symbols"),
        let(lines_of(text), lambda x: F.struct(
            duplicate_lines(x).alias("dup"),
            F.length(stripped(F.array_join(F.filter(x, line_fails), ""))).cast("long").alias("lost"))).alias("lines"),
    )

    def judged(b: Column) -> Column:
        failed = (b["w"]["n"] < 10) | (100 * b["w"]["r"] > 20 * b["w"]["n"])
        return F.struct(
            b["w"]["n"].alias("n_words"), b["word_chars"].alias("word_chars"), b["n_symbols"].alias("n_symbols"),
            b["lines"]["dup"].alias("n_dup_lines"), b["w"]["r"].alias("n_repeat_words"),
            failed.alias("base_failed"),
            (~failed & (b["lines"]["lost"] <= MAX_LOSS * b["word_chars"])).alias("kept"),
            b["lines"]["lost"].alias("chars_lost"),
        )

    return let(base, judged)


def clean_text(text: Column) -> Column:
    """The text without its failing lines (null stays null)."""
    return F.when(text.isNotNull(), F.array_join(F.filter(lines_of(text), lambda x: ~line_fails(x)), "\n"))


def judge_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the statistics, base_failed, kept and cleaned.

    ``cleaned`` is the text without its failing lines, of documents that are
    not kept too; the statistics are of the text as it was.  Reads doc_id and
    text only, so other columns cannot clash.  Null text has no words; repeated
    rows are judged alike; an empty table gives no row.
    """
    return docs.select("doc_id", verdict(F.col("text")).alias("__v"), clean_text(F.col("text")).alias("cleaned")).select(
        "doc_id", "__v.*", "cleaned")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with their columns, and texts without failing lines."""
    return docs.where(verdict(F.col("text"))["kept"]).withColumn("text", clean_text(F.col("text")))

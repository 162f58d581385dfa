"""Line deduplication over the whole corpus [native].

The hashes of all long lines are range-partitioned and sorted by hash,
document and position.  One streaming pass over that order marks the first
occurrence in each document, which counts a line's documents and finds its
keeper.  What comes back is, per document, a run-length compressed bitmap of
the lines that stay; texts are not moved to find it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabulae.llm.common import let, written

SPACE = " \t\n\u000b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 40      # code points of a key
MIN_DOCS = 5        # documents that hold it
TRACKED = 4_096     # hashes that the heavy-hitter sketch follows: bounds the heavy table
DROPS = "array<struct<first:int,n:int>>"
ROW = ["doc_id", "__t1", "__t2"]     # a document row: its id and 128 bits of its text


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(SPACE))
    # Most lines are ASCII, where lower() is exact and much cheaper than translate().
    return let(bare, lambda b: F.when(F.octet_length(b) == F.length(b), F.lower(b)).otherwise(F.translate(b, UPPER, LOWER)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, 128 bits of the text and the text (null: empty)."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("__t1"), F.xxhash64(F.lit(1), text).alias("__t2"), text.alias("__text"))


def _salted(lines: DataFrame) -> DataFrame:
    """``lines`` with __salt: 0, but for heavy hashes 1 and up, by document.

    A heavy hash has more than half of a partition's fair share of lines, as a
    sketch of TRACKED hashes sees it.  The salt decides only where a line is
    counted, so the sketch's error has no part in the result.
    """
    spark = lines.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    heavy = lines.agg(F.count("*").alias("n"), F.expr(f"approx_top_k(__h1, {TRACKED // 4}, {TRACKED})").alias("top")).select(
        "n", F.inline("top")).where(F.col("count") > F.col("n") / (2 * parts)).select(F.col("item").alias("__h1"), F.lit(True).alias("__heavy"))
    salt = F.when(F.col("__heavy"), F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int") + 1).otherwise(F.lit(0))
    return lines.join(F.broadcast(heavy), "__h1", "left").withColumn("__salt", salt).drop("__heavy")


def dropped_runs(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The document rows that lose lines: ROW and drops (runs of lost lines)."""
    key = line_key(F.col("line"))
    lines = written(
        _identified(docs).select(*ROW, F.posexplode(F.split("__text", "\n", -1)).alias("pos", "line"))
        .where(F.length("line") >= min_chars).select(*ROW, "pos", key.alias("key"))
        .where(F.length("key") >= min_chars)
        .select(*ROW, "pos", F.xxhash64("key").alias("__h1"), F.xxhash64(F.lit(1), "key").alias("__h2")), "lines")
    group = Window.partitionBy("__h1", "__h2", "__salt")
    before = F.lag("doc_id").over(group.orderBy("doc_id", "pos"))
    first = F.row_number().over(group.orderBy("doc_id", "pos")) == 1
    # The window's partition and order are those of the range partitioning and its sort: no further exchange.
    streamed = (_salted(lines).repartitionByRange("__h1", "__h2", "__salt").sortWithinPartitions("__h1", "__h2", "__salt", "doc_id", "pos")
                .withColumn("__new", (first | ~F.col("doc_id").eqNullSafe(before)).cast("long"))
                .withColumns({"__docs": F.sum("__new").over(group), "__keeper": F.max("doc_id").over(group)})
                .where((F.col("__salt") > 0) | (F.col("__docs") >= min_docs)))
    counted = written(streamed, "lines-counted")
    # A heavy hash was counted in salts, each with documents of its own: at most TRACKED totals.
    totals = counted.where("__salt > 0").groupBy("__h1", "__h2").agg(F.sum("__new").alias("__all"), F.max("doc_id").alias("__last"))
    heavy = counted.where("__salt > 0").join(F.broadcast(totals), ["__h1", "__h2"]).where(F.col("__all") >= min_docs).select(
        *ROW, "pos", F.col("__last").alias("__keeper"))
    lost = counted.where("__salt = 0").select(*ROW, "pos", "__keeper").unionByName(heavy).where(~F.col("doc_id").eqNullSafe(F.col("__keeper")))
    # A set: repeated rows of one document lose the same lines.
    return lost.groupBy(*ROW).agg(F.sort_array(F.collect_set("pos")).alias("__lost")).select(*ROW, _runs(F.col("__lost")).alias("drops"))


def _runs(places: Column) -> Column:
    """Runs (first, n) of ascending places."""
    def paired(firsts: Column, lasts: Column) -> Column:
        return F.zip_with(firsts, lasts, lambda a, b: F.struct(a.alias("first"), (b - a + 1).alias("n"))).cast(DROPS)

    firsts = F.filter(places, lambda p, i: (i == 0) | (F.get(places, i - 1) != p - 1))
    lasts = F.filter(places, lambda p, i: F.coalesce(F.get(places, i + 1) != p + 1, F.lit(True)))
    return paired(firsts, lasts)


def _keep_runs(drops: Column, n_lines: Column) -> Column:
    """The bitmap of kept lines, run-length compressed: lengths of kept and lost runs in turn."""
    def after(i: Column) -> Column:
        before = F.get(drops, i - 1)
        return F.when(i > 0, before["first"] + before["n"]).otherwise(F.lit(0))

    turns = F.flatten(F.transform(drops, lambda d, i: F.array(d["first"] - after(i), d["n"])))
    return F.when(F.size(drops) > 0, F.concat(turns, F.array(n_lines - after(F.size(drops))))).otherwise(F.array(n_lines))


def line_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document row: ROW, n_lines, n_dropped and keep.

    ``keep`` is the run-length compressed bitmap of the lines that stay: the
    lengths of the kept and the dropped runs in turn, a kept one first (it may
    be 0).  A line is dropped if its key (no white space at its ends, A-Z
    lower-cased) has ``min_chars`` code points or more, is found in
    ``min_docs`` documents or more, and the document is not the one with the
    largest doc_id that holds it.

    Null and empty texts are one empty line.  Rows that share a doc_id are one
    document to the count and to the keeper; rows without a doc_id are one
    document, before all others.  Repeated rows get equal bitmaps.  Keys are
    compared by 128 hashed bits.  An empty table gives no row.  Only doc_id
    and text are read, so other columns cannot clash.
    """
    rows = _identified(docs).select(*ROW, F.size(F.split("__text", "\n", -1)).alias("n_lines"))
    return _with_drops(rows, dropped_runs(docs, min_chars, min_docs)).select(
        *ROW, F.col("n_lines").cast("long").alias("n_lines"), _lost("drops").alias("n_dropped"), _keep_runs(F.col("drops"), F.col("n_lines")).alias("keep"))


def _lost(drops: str) -> Column:
    return F.aggregate(drops, F.lit(0).cast("long"), lambda a, d: a + d["n"])


def _with_drops(rows: DataFrame, drops: DataFrame) -> DataFrame:
    """``rows`` with their runs (none: an empty array).  ``drops`` has a row for each ROW at most."""
    small = written(drops, "line-drops")      # its size is then known: a small one is broadcast
    same = [rows[c].eqNullSafe(small[c]) for c in ROW]
    return rows.join(small, same, "left").drop(*(small[c] for c in ROW)).withColumn("drops", F.coalesce("drops", F.array().cast(DROPS)))


def deduplicate_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document row: doc_id, n_lines, n_dropped and the kept text.

    The rules are those of ``line_bitmaps``; the lines that stay are joined
    by line breaks.
    """
    def kept(lines: Column, drops: Column) -> Column:
        def after(i: Column) -> Column:
            before = F.get(drops, i - 1)
            return F.when(i > 0, before["first"] + before["n"]).otherwise(F.lit(0))

        parts = F.flatten(F.transform(drops, lambda d, i: F.slice(lines, after(i) + 1, d["first"] - after(i))))
        tail = after(F.size(drops))
        return F.concat(parts, F.slice(lines, tail + 1, F.size(lines) - tail))

    def result(lines: Column) -> Column:
        whole = F.when(F.size("drops") > 0, F.array_join(kept(lines, F.col("drops")), "\n")).otherwise(F.col("__text"))
        return F.struct(F.size(lines).cast("long").alias("n_lines"), whole.alias("text"))

    found = _with_drops(_identified(docs), dropped_runs(docs, min_chars, min_docs))
    return found.withColumn("__r", let(F.split("__text", "\n", -1), result)).select(
        "doc_id", "__r.n_lines", _lost("drops").alias("n_dropped"), F.col("__r.text").alias("text"))

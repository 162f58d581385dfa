"""Benchmark decontamination with one Aho-Corasick automaton.

The normalised windows of the benchmark's questions and answers form one
automaton over word numbers, a few signs a word; each normalised text is scanned once, and the hits are mapped back to character offsets of the
original.  A worker builds the automaton once and keeps it for all its tasks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulae.llm.common import written

WINDOW = 13
BASE = 64                 # signs a place of a word's number: the automaton looks through a node's children one by one
BLOCK_BYTES = 2_000_000   # benchmark text per automaton: bounds what a worker holds
# Byte table: A-Z to a-z, digits, letters and bytes over 0x7F stay, the rest become spaces.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<struct<start:long,end:long>>"


def raw(text: str) -> bytes:
    """UTF-8 of the text; a lone surrogate cannot come from Spark."""
    return text.encode("utf-8")


def words(text: str | None) -> list[bytes]:
    return raw(text).translate(_TABLE).split() if text else []


def windows(text: str | None) -> set[tuple[bytes, ...]]:
    """Normalised windows of an item, as words."""
    w = words(text)
    return {tuple(w[i:i + WINDOW]) for i in range(max(1, len(w) - WINDOW + 1))} if w else set()


class Windows(NamedTuple):
    """Signs of each word, how many a word has, and the automaton over them; its values are (words in the window, ids of the items).

    Every place of a word has signs of its own, so no match begins within a word.
    """

    signs: dict
    width: int
    found: ahocorasick.Automaton | None


def automaton(items: list[tuple]) -> Windows:
    owners: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in items:
        for w in windows(text):
            owners.setdefault(w, set()).add(str(item))
    vocabulary = sorted({x for w in owners for x in w})
    width = 1
    while BASE ** width < len(vocabulary):
        width += 1
    signs = {x: "".join(chr(1 + BASE * k + n // BASE ** k % BASE) for k in range(width)) for n, x in enumerate(vocabulary)}
    if not owners:
        return Windows(signs, width, None)
    a = ahocorasick.Automaton()
    for w, ids in owners.items():
        a.add_word("".join(map(signs.__getitem__, w)), (len(w), tuple(ids)))
    a.make_automaton()
    return Windows(signs, width, a)


def scan(text: str | None, a: Windows) -> tuple[int, list[tuple[int, int]], set[str]]:
    """(words, hit word ranges [first, last], ids of the items) of one text."""
    w = words(text)
    ranges: list[tuple[int, int]] = []
    ids: set[str] = set()
    if w and a.found is not None:
        for end, (n, own) in a.found.iter("".join(map(a.signs.get, w, repeat("\0" * a.width)))):
            last = end // a.width
            ranges.append((last - n + 1, last))
            ids.update(own)
    return len(w), ranges, ids


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def offsets(text: str, ranges: list[tuple[int, int]]) -> list[dict]:
    """Character offsets in the original of merged word ranges (end exclusive)."""
    data = raw(text)
    places = [m.span() for m in _WORD.finditer(data)]
    return [{"start": len(data[:places[lo][0]].decode()), "end": len(data[:places[hi][1]].decode())} for lo, hi in ranges]


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """Benchmark items in blocks of at most BLOCK_BYTES of text (or one item)."""
    block, held = [], 0
    for item, text in benchmark.select("item_id", "text").where(F.col("text").isNotNull()).toLocalIterator():
        size = len(raw(text))
        if block and held + size > BLOCK_BYTES:
            yield block
            block, held = [], 0
        block.append((item, text))
        held += size
    yield block


HITS = "digest string, n_words long, ranges array<struct<first:long,last:long,start:long,end:long>>, ids array<string>"
_ARROW_HITS = pa.list_(pa.struct([(x, pa.int64()) for x in ("first", "last", "start", "end")]))
_VERDICT = "digest string, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<struct<start:long,end:long>>"


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row: RESULT.

    ``spans`` are the hit passages as code-point offsets of the original text.
    A benchmark within BLOCK_BYTES of text (the usual case) is one map-only
    pass; a larger one is taken in blocks, each a pass over the texts that
    writes its hits only, which are then merged text by text.  Null and empty
    texts have no words and no hits; null or empty items have no windows;
    repeated rows are judged alike; an empty table gives no row.  A null
    item_id counts as "None".  Only doc_id and text are read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    one, verdicts = _judged(docs, benchmark)
    if verdicts is None:
        return rows.mapInArrow(_pass(one), RESULT)
    none = {"n_hit": F.lit(0).cast("long"), "n_items": F.lit(0).cast("long"), "items_sha256": F.lit(hashlib.sha256().hexdigest()),
            "contaminated": F.lit(False), "spans": F.array().cast("array<struct<start:long,end:long>>")}
    counted = rows.select("doc_id", F.md5("text").alias("digest"), "text").mapInArrow(_counts, "doc_id long, digest string, n_words long")
    return counted.join(verdicts.drop("n_words"), "digest", "left").select(
        "doc_id", "n_words", *(F.coalesce(c, value).alias(c) for c, value in none.items()))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, their columns as they are.

    Each row is judged by its own text, whatever its doc_id; only the text
    goes through a Python worker and no row is shuffled (for a benchmark over
    BLOCK_BYTES rows are joined to the contaminated texts' digests).
    """
    one, verdicts = _judged(docs, benchmark)
    if verdicts is None:
        return docs.where(~F.arrow_udf(_flags(one), "boolean")(F.col("text")))
    bad = verdicts.where("contaminated").select(F.col("digest").alias("__digest"))
    return docs.join(bad, F.md5("text") == F.col("__digest"), "left_anti")


def _judged(docs: DataFrame, benchmark: DataFrame):
    """(block, None) of a benchmark of one block, else (None, verdicts of the texts with hits)."""
    spark = docs.sparkSession
    blocks = _blocks(benchmark)
    block, following = next(blocks), next(blocks, None)
    if following is None:
        return _shared(spark, block), None
    texts = docs.select(F.md5("text").alias("digest"), "text").where(F.col("text") != "")
    hits = None
    while block is not None:
        new = written(texts.mapInArrow(_hits(_shared(spark, block)), HITS), "hits")
        hits = new if hits is None else hits.unionByName(new)
        block, following = following, next(blocks, None)
    # Copies have equal hits: sets of them are one, also before the shuffle.
    met = hits.groupBy("digest").agg(F.min("n_words").alias("n_words"), F.flatten(F.collect_set("ranges")).alias("ranges"),
                                     F.flatten(F.collect_set("ids")).alias("ids"))
    return None, written(met.mapInArrow(_merged, _VERDICT), "verdicts")


def _shared(spark, block: list[tuple]):
    return spark.sparkContext.broadcast({"items": block})


def _kept(shared) -> Windows:
    """The block's automaton; a worker keeps a broadcast value, and the automaton with it."""
    held = shared.value
    if "automaton" not in held:
        held["automaton"] = automaton(held["items"])
    return held["automaton"]


def _summary(n: int, hit: list[tuple[int, int]], ids: set[str]) -> tuple:
    """(n_hit, n_items, items_sha256, contaminated) of merged ranges."""
    n_hit = sum(b - a + 1 for a, b in hit)
    return n_hit, len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), n_hit > 0 and 20 * n_hit >= n


def _flags(shared):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        a = _kept(shared)
        for texts in batches:
            found = (scan(t, a) for t in texts.to_pylist())
            yield pa.array([_summary(n, merge(ranges), ids)[3] for n, ranges, ids in found], pa.bool_())
    return run


def _pass(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = _kept(shared)
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                n, ranges, ids = scan(text, a)
                hit = merge(ranges)
                out.append((n, *_summary(n, hit, ids), offsets(text, hit) if hit else []))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), _ARROW_SPANS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([o[k] for o in out], t) for k, t in enumerate(types))],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"])
    return run


def _hits(shared):
    """Task function: the texts that one block hits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = _kept(shared)
        for batch in batches:
            out = []
            for digest, text in zip(*(batch.column(c).to_pylist() for c in ("digest", "text"))):
                n, ranges, ids = scan(text, a)
                if ranges:
                    hit = merge(ranges)
                    out.append((digest, n, [{"first": lo, "last": hi, **at} for (lo, hi), at in zip(hit, offsets(text, hit))], sorted(ids)))
            types = (pa.string(), pa.int64(), _ARROW_HITS, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(types)],
                                             names=["digest", "n_words", "ranges", "ids"])
    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hits of several blocks made one verdict a text."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            start = {x["first"]: x["start"] for x in r["ranges"]}
            end = {x["last"]: x["end"] for x in r["ranges"]}
            hit = merge([(x["first"], x["last"]) for x in r["ranges"]])
            out.append((r["digest"], r["n_words"], *_summary(r["n_words"], hit, set(r["ids"])),
                        [{"start": start[lo], "end": end[hi]} for lo, hi in hit]))
        types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), _ARROW_SPANS)
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(types)],
                                         names=["digest", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = pa.array([len(words(t)) for t in batch.column("text").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), n], names=["doc_id", "digest", "n_words"])

"""Ranked lexical search over deduplicated bags of terms.

A document matters to the items only through the counts of their terms and
its length weight ``m``.  Documents are restricted to the items' vocabulary,
those with the same counts and the same m form a class, each class is scored
once against every item, and the best classes are expanded to their members
by ascending doc_id.  An item's best documents lie in its best classes by
(score, smallest doc_id), so as many classes as results are enough.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabulae.llm.common import written

TOP = 50
GROUP_TERMS = 300_000       # vocabulary of the items taken in one pass: bounds what a task holds
BLOCK_CELLS = 4_000_000     # terms times items, and documents times terms, of one dense product
SALTS = 64                  # parts in which the best of an item or a class are found first
EXACT = 1 << 53             # whole numbers that a double holds
NO_ID = (1 << 63) - 1       # a null doc_id comes last
# Byte table: digits, letters and bytes over 0x7F stay, A-Z in lower case, the rest become spaces.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_ID = np.dtype("<i4")


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(_TABLE).split() if text else []


def _item_groups(items: DataFrame) -> Iterator[list[tuple[int, list[bytes]]]]:
    """(item_id, distinct terms) of the items, in groups of GROUP_TERMS terms about."""
    group: list[tuple[int, list[bytes]]] = []
    held = 0
    for item, text in items.select("item_id", "text").toLocalIterator():
        own = sorted(set(terms(text)))
        if group and held + len(own) > GROUP_TERMS:
            yield group
            group, held = [], 0
        if own:
            group.append((item, own))
            held += len(own)
    if group:
        yield group


def _bags(vocabulary):
    """Task function: (doc_id, n, bag) of each document; the bag is term ids, then counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(vocabulary.value)}
        for batch in batches:
            lengths, bags = [], []
            for text in batch.column("text").to_pylist():
                found = terms(text)
                lengths.append(len(found))
                own = sorted((number[t], c) for t, c in Counter(found).items() if t in number)
                bags.append(np.array(own, _ID).T.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(bags, pa.binary())], names=["doc_id", "n", "bag"])
    return run


def _unpacked(bags: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of every entry of some bags."""
    sizes = np.array([len(b) // 8 for b in bags], np.int64)
    flat = np.frombuffer(b"".join(bags), _ID).astype(np.int64)
    row = np.repeat(np.arange(len(bags)), sizes)
    # A bag's ids are followed by its counts: entry j of row r is at twice the entries before, plus its place.
    place = np.arange(sizes.sum()) + np.repeat(np.cumsum(sizes) - sizes, sizes)
    return row, flat[place], flat[place + np.repeat(sizes, sizes)]


def _document_counts(n_terms: int):
    """Task function: (term, documents that hold it) of the task's bags."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n_terms, np.int64)
        for batch in batches:
            held += np.bincount(_unpacked(batch.column("bag").to_pylist())[1], minlength=n_terms)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(held[at], pa.int64())], names=["term", "df"])
    return run


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class _Best:
    """The best classes of each item so far: score, smallest doc_id, class."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.least = np.zeros(n_items, np.int64)     # a lower score cannot be among the best any more
        self.item = self.score = self.first = self.cls = np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, items: np.ndarray, first: np.ndarray, cls: np.ndarray) -> None:
        """Scores of classes (rows) for some items (columns)."""
        r, c = np.nonzero((scores > 0) & (scores >= self.least[items]))
        for name, more in (("item", items[c]), ("score", scores[r, c]), ("first", first[r]), ("cls", cls[r])):
            setattr(self, name, np.concatenate([getattr(self, name), more]))
        order = np.lexsort((self.cls, self.first, -self.score, self.item))
        item = self.item[order]
        start = np.flatnonzero(np.r_[True, item[1:] != item[:-1]]) if len(item) else np.zeros(0, np.int64)
        place = np.arange(len(item)) - np.repeat(start, np.diff(np.r_[start, len(item)]))
        order = order[place < self.top]
        for name in ("item", "score", "first", "cls"):
            setattr(self, name, getattr(self, name)[order])
        full = np.bincount(self.item, minlength=len(self.least)) >= self.top
        lowest = np.full(len(self.least), np.iinfo(np.int64).max)
        np.minimum.at(lowest, self.item, self.score)
        self.least = np.where(full, lowest, 0)


def _scores(shared, top: int):
    """Task function: the best classes of each item among the task's classes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value      # [(item_id, term numbers)], weight of each term
        weights = np.array(weights, np.int64)
        blocks, block, used = [], [], set()
        for k, (_, own) in enumerate(items):
            if block and len(used | set(own)) * (len(block) + 1) > BLOCK_CELLS:
                blocks.append((block, used))
                block, used = [], set()
            block.append(k)
            used = used | set(own)
        blocks.append((block, used))
        best = _Best(len(items), top)
        for batch in batches:
            bags, m = batch.column("bag").to_pylist(), batch.column("m").to_numpy()
            first, cls = batch.column("first").to_numpy(), batch.column("class").to_numpy()
            for block, used in blocks:
                columns = np.array(sorted(used), np.int64)
                column = np.full(len(weights), -1)
                column[columns] = np.arange(len(columns))
                largest = max(len(items[k][1]) for k in block) * int(weights.max(initial=0)) * 1_000_000
                kind = np.float64 if largest < EXACT else np.int64      # sums of whole numbers: either is exact
                holds = np.zeros((len(columns), len(block)), kind)
                for j, k in enumerate(block):
                    holds[column[np.array(items[k][1])], j] = 1
                step = max(1, BLOCK_CELLS // max(len(columns), len(block)))
                for at in range(0, len(bags), step):
                    row, term, tf = _unpacked(bags[at:at + step])
                    in_block = column[term] >= 0
                    row, term, tf = row[in_block], term[in_block], tf[in_block]
                    parts = np.zeros((len(bags[at:at + step]), len(columns)), kind)
                    parts[row, column[term]] = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[at:at + step][row]))
                    best.add((parts @ holds).astype(np.int64), np.array(block), first[at:at + step], cls[at:at + step])
        ids = np.array([i for i, _ in items], object)
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item, pa.int64()), pa.array(list(ids[best.item]), pa.int64()), pa.array(best.score, pa.int64()),
             pa.array(best.first, pa.int64()), pa.array(best.cls, pa.int64())], names=["item", "item_id", "score", "first", "class"])
    return run


def _leaders(rows: DataFrame, by: list[str], order: list, top: int) -> DataFrame:
    """The first ``top`` rows of each group: first of each salted part, then of all, so no task gets a whole hot group."""
    parts = rows.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    for keys in ([*by, "__salt"], by):
        parts = parts.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return parts.drop("__salt")


def _search_group(docs: DataFrame, group: list[tuple[int, list[bytes]]], top: int) -> DataFrame:
    context = docs.sparkSession.sparkContext
    vocabulary = sorted({t for _, own in group for t in own})
    number = {t: i for i, t in enumerate(vocabulary)}
    bags = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _bags(context.broadcast(vocabulary)), "doc_id long, n long, bag binary").where("n > 0"), "bags")
    total = bags.agg(F.count("*"), F.sum("n")).first()
    documents, length = total[0], total[1] or 1
    # At most one row a term of the group comes back.
    df = dict(bags.select("bag").mapInArrow(_document_counts(len(vocabulary)), "term long, df long").groupBy("term").agg(F.sum("df")).collect())
    items = [(item, [number[t] for t in own]) for item, own in group]
    shared = context.broadcast((items, [weight(documents, df.get(i, 0)) for i in range(len(vocabulary))]))
    m = F.expr(f"100 - 50 + ((50L * n * {documents}L) div {length}L)")
    keyed = bags.where(F.octet_length("bag") > 0).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("member"), m.alias("m"), "bag", F.xxhash64("bag", m).alias("h"))
    # The hash deals the documents out; equality of bag and m within it makes the class.
    classes = written(keyed.groupBy("h", "m", "bag").agg(F.min("member").alias("first"), F.count("*").alias("members"))
                      .withColumn("class", F.monotonically_increasing_id()), "classes")
    scored = classes.mapInArrow(_scores(shared, top), "item long, item_id long, score long, first long, class long")
    best = written(_leaders(scored, ["item"], [F.desc("score"), F.asc("first"), F.asc("class")], top).drop("rank"), "best-classes")
    # Broadcast: at most ``top`` classes for each item of a group.
    won = written(classes.join(F.broadcast(best.select("class").distinct()), "class"), "won-classes")
    several = won.where("members > 1").select("class", "h", "m", "bag")
    near = keyed.join(F.broadcast(several.select("h", "m").distinct()), ["h", "m"])      # 16 bytes a class
    # The members of a class that can be among an item's best: the first ``top`` by doc_id.
    few = _leaders(near, ["h", "m", "bag"], [F.asc("member")], top).select("h", "m", "bag", "member")
    members = several.join(few, ["h", "m", "bag"]).select("class", "member").unionByName(
        won.where("members = 1").select("class", F.col("first").alias("member")))
    placed = best.join(members, "class").withColumn(
        "rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc("member")))).where(F.col("rank") <= top)
    return placed.select("item_id", "rank", F.when(F.col("member") != NO_ID, F.col("member")).alias("doc_id"), "score")


def search_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` highest-scoring documents of every item: item_id, rank, doc_id, score.

    Scores are the whole-number ones of the contract: the sum over an item's
    distinct terms of w * ((10^9 tf) div (1000 tf + 20 m)).  Only scores above
    0 are returned; equal scores are ordered by ascending doc_id.

    Null and empty texts have no term and are in no count; null and empty
    items have no result.  Repeated rows and rows that share a doc_id are
    documents each; a null doc_id comes after all others, a null item_id is
    kept, and rows that share an item_id are items each.  Items are taken in
    groups of GROUP_TERMS terms, each a pass over the documents.  An empty
    table gives no row.  Only doc_id, item_id and text are read.
    """
    found = [_search_group(docs, group, top) for group in _item_groups(items)]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out

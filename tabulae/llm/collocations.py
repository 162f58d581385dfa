"""Phrase collocations by set-oriented mining of occurrence relations (SETM).

R1 has every word occurrence (chunk, place, word), sorted by place; places of
one piece are adjacent and pieces are a place apart.  From R1 on, each length
is group-counted over the whole corpus, semi-joined with its frequent groups,
and merge-joined with itself by piece and adjacent place to give the next
length.  A chunk is a run of documents of one task and language, so every
occurrence of a piece is in one chunk; counts meet in Spark, one row for a
chunk and a phrase, and no table of words or phrases is broadcast.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabulae.llm.common import written

MAX_WORDS = 3
MIN_COUNT = 10
TOP = 2000
ABSORB = 50                  # per cent: a longer phrase this often takes its parts away
CHUNK = 1_000_000            # places of a chunk, about: bounds what a task holds
BLOCK = 65_536               # places of one stored row
UND = "und"
_BREAK = b"\xff"             # no byte of UTF-8
# Byte table: A-Z to a-z, the marks and line breaks that end a piece to _BREAK, tab to space.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else 255 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))
_PLACE = np.dtype("<i4")


def tokens(text: str | None) -> list[bytes]:
    """The words of a text, with _BREAK between pieces and at its end."""
    return ((text or "").encode("utf-8").translate(_TABLE).replace(_BREAK, b" \xff ") + b" \xff").split()


def _columns(n: int) -> list[str]:
    return [f"w{i}" for i in range(1, n + 1)]


def _r1_schema() -> str:
    return "lang string, chunk long, code int, word string, c long, at binary, codes binary"


def _rk_schema(n: int) -> str:
    return "chunk long, code int, " + ", ".join(f"{c} long" for c in _columns(n)) + ", c long, at binary, codes binary"


def _batch(schema: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    """A batch whose columns not named are null."""
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _blocks(codes: np.ndarray) -> list[slice]:
    return [slice(i, i + BLOCK) for i in range(0, len(codes), BLOCK)]


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers as compressed little-endian 32-bit ones: they are stored and shuffled as bytes."""
    return zstandard.compress(numbers.astype(_PLACE).tobytes(), 1)


def _unpacked(blocks: list[bytes]) -> np.ndarray:
    return np.concatenate([np.frombuffer(zstandard.decompress(b), _PLACE) for b in blocks])


class _Chunk:
    """Occurrences of one language, in order; code 0 is the break."""

    def __init__(self):
        self.code = defaultdict()
        self.code.default_factory = self.code.__len__
        self.code[_BREAK]
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, found: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.code.__getitem__, found), _PLACE, len(found)))
        self.size += len(found)


_R1 = pa.schema([("lang", pa.string()), ("chunk", pa.int64()), ("code", pa.int32()), ("word", pa.string()),
                 ("c", pa.int64()), ("at", pa.binary()), ("codes", pa.binary())])


def _occurrences(size: int):
    """Task function: rows of R1 (blocks of codes in order of place) and of its groups (word and count)."""
    def close(lang: str, chunk: _Chunk, number: int) -> Iterator[pa.RecordBatch]:
        codes = np.concatenate(chunk.parts)
        counts = np.bincount(codes, minlength=len(chunk.code))
        blocks = [_packed(codes[s]) for s in _blocks(codes)]
        k = len(blocks)
        yield _batch(_R1, k, lang=[lang] * k, chunk=[number] * k, code=list(range(k)), codes=blocks)
        words = list(chunk.code)
        for i in range(1, len(words), BLOCK):
            part = words[i:i + BLOCK]
            n = len(part)
            yield _batch(_R1, n, lang=[lang] * n, chunk=[number] * n, code=np.arange(i, i + n, dtype=np.int32), word=[w.decode("utf-8") for w in part], c=counts[i:i + n])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        open_: dict[str, _Chunk] = {}
        held = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                chunk = open_.setdefault(lang, _Chunk())
                before = chunk.size
                chunk.add(tokens(text))
                held += chunk.size - before
                while chunk.size >= size or held >= 2 * size:     # the largest goes: many languages stay within the bound too
                    lang = max(open_, key=lambda x: open_[x].size)
                    chunk = open_.pop(lang)
                    held -= chunk.size
                    number += 1
                    yield from close(lang, chunk, number)
                    chunk = _Chunk()
        for lang, chunk in open_.items():
            number += 1
            yield from close(lang, chunk, number)
    return run


def _joined(n: int, last: bool):
    """Group function: R(n+1) of a chunk from its blocks of Rn and its frequent groups.

    The occurrences are semi-joined with the frequent groups, then merged with
    themselves: equal piece and adjacent place are places that differ by one.
    """
    schema = pa.schema([("chunk", pa.int64()), ("code", pa.int32()), *((c, pa.int64()) for c in _columns(n + 1)),
                        ("c", pa.int64()), ("at", pa.binary()), ("codes", pa.binary())])

    def run(blocks: pa.Table, frequent: pa.Table) -> pa.Table:
        if not blocks.num_rows or not frequent.num_rows:
            return schema.empty_table()
        order = np.argsort(blocks.column("code").to_numpy())
        codes = _unpacked(blocks.column("codes").take(order).to_pylist())
        places = blocks.column("at").take(order).to_pylist()      # from place to place; null: all places
        at = np.arange(len(codes), dtype=_PLACE) if places[0] is None else np.cumsum(_unpacked(places), dtype=_PLACE)
        kept = frequent.column("code").to_numpy()
        words = [frequent.column(c).to_numpy() for c in _columns(n)]
        index = np.full(max(int(codes.max(initial=0)), int(kept.max())) + 1, -1, np.int64)
        index[kept] = np.arange(len(kept))
        group = index[codes]
        at, group = at[group >= 0], group[group >= 0]
        next_to = at[1:] == at[:-1] + 1
        pair = group[:-1][next_to] * len(kept) + group[1:][next_to]
        pairs, code, count = np.unique(pair, return_inverse=True, return_counts=True)
        left, right = pairs // len(kept), pairs % len(kept)
        new = [w[left] for w in words] + [words[-1][right]]      # neighbours overlap in all words but these two
        chunk = blocks.column("chunk")[0].as_py()
        out = [_batch(schema, len(pairs), chunk=np.full(len(pairs), chunk), code=np.arange(len(pairs), dtype=np.int32),
                      c=count, **dict(zip(_columns(n + 1), new)))]
        if not last:
            at = np.diff(at[:-1][next_to], prepend=0)
            parts = _blocks(code)
            out.append(_batch(schema, len(parts), chunk=[chunk] * len(parts), code=list(range(len(parts))),
                              at=[_packed(at[s]) for s in parts], codes=[_packed(code[s]) for s in parts]))
        return pa.Table.from_batches(out, schema)
    return run


def _frequent(groups: DataFrame, keys: list[str], least: int) -> DataFrame:
    """The chunk's rows of the groups that are frequent in the corpus, with their count f."""
    return groups.withColumn("f", F.sum("c").over(Window.partitionBy(*keys))).where(F.col("f") >= least)


def _floor_score(a: Column, l: Column, r: Column) -> Column:
    """floor(10^6 a a / (l r)) in 38 digits; a is at most l and r, so the quotient is a long."""
    big = [x.cast("decimal(18,0)") for x in (a, l, r)]
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (big[0] * big[0]), big[1] * big[2])


def mine_phrases(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, chunk: int = CHUNK) -> tuple[DataFrame, list[DataFrame]]:
    """(words of each language, [frequent phrases of 1, 2, ... words]).

    The first has lang and n; phrases of length k have lang, phrase, w1..wk
    (word numbers) and f.  All counts are exact and over the whole table.
    """
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UND)).alias("lang"), "text")
    relation = written(rows.mapInArrow(_occurrences(chunk), _r1_schema()), "occurrences-1", compression="zstd")
    sizes = relation.where("word is not null").groupBy("lang").agg(F.sum("c").alias("n"))
    # A word's number is that of its first row, so all its rows agree; written once, it stays.
    first = _frequent(relation.where("word is not null").select("lang", "word", "chunk", "code", "c"), ["lang", "word"], min_count)
    kept = written(first.withColumn("__row", F.monotonically_increasing_id()).select(
        "lang", "word", "chunk", "code", "f", F.min("__row").over(Window.partitionBy("lang", "word")).alias("w1")), "frequent-1", compression="zstd")
    words = written(kept.select("lang", F.col("word").alias("phrase"), "w1", "f").distinct(), "words")
    levels = [words]
    for n in range(1, max_words):
        blocks = relation.where("codes is not null").select("chunk", "code", "at", "codes")
        survivors = kept.select("chunk", "code", *_columns(n))
        relation = written(blocks.groupBy("chunk").cogroup(survivors.groupBy("chunk")).applyInArrow(
            _joined(n, last=n + 1 == max_words), _rk_schema(n + 1)), f"occurrences-{n + 1}", compression="zstd")
        keys = _columns(n + 1)
        groups = relation.where("codes is null").select("chunk", "code", "c", *keys)
        if n + 1 < max_words:
            kept = written(_frequent(groups, keys, min_count).select("chunk", "code", "f", *keys), f"frequent-{n + 1}", compression="zstd")
            found = kept.select("f", *keys).distinct()
        else:
            found = groups.groupBy(*keys).agg(F.sum("c").alias("f")).where(F.col("f") >= min_count)
        levels.append(written(_spelled(found, words, keys), f"phrases-{n + 1}"))
    return sizes, levels


def _spelled(found: DataFrame, words: DataFrame, keys: list[str]) -> DataFrame:
    """Phrases with their language and text."""
    out = found
    for i, c in enumerate(keys):
        own = words.select(F.col("w1").alias(c), F.col("phrase").alias(f"__s{i}"), *([F.col("lang")] if i == 0 else []))
        out = out.join(own, c)
    return out.select("lang", F.concat_ws(" ", *(f"__s{i}" for i in range(len(keys)))).alias("phrase"), *keys, "f")


def _cut(phrases: DataFrame, levels: list[DataFrame], k: int) -> DataFrame:
    """Phrases of k words with a, l, r and score of their lowest cut (ties: the earliest)."""
    keys = _columns(k)
    out, cuts = phrases, []
    for j in range(1, k):
        head = levels[j - 1].select(*_columns(j), F.col("f").alias(f"__l{j}"))
        tail = levels[k - j - 1].select(*(F.col(a).alias(b) for a, b in zip(_columns(k - j), keys[j:])), F.col("f").alias(f"__r{j}"))
        out = out.join(head, _columns(j)).join(tail, keys[j:])
        l, r = F.col(f"__l{j}"), F.col(f"__r{j}")
        cuts.append(F.struct(_floor_score(F.col("f"), l, r).alias("score"), F.lit(j).alias("k"), l.alias("l"), r.alias("r")))
    best = F.array_min(F.array(*cuts)) if len(cuts) > 1 else cuts[0]
    return out.withColumn("__best", best).select("lang", "phrase", *keys, F.col("f").alias("a"), "__best.l", "__best.r", "__best.score")


def _absorbed(levels: list[DataFrame], k: int, percent: int) -> DataFrame | None:
    """The k-word phrases that lie in a longer frequent one and the longer one's largest count."""
    keys, parts = _columns(k), []
    for m in range(k + 1, len(levels) + 1):
        for i in range(m - k + 1):
            parts.append(levels[m - 1].select(*(F.col(f"w{i + j + 1}").alias(keys[j]) for j in range(k)), F.col("f").alias("__longer")))
    return reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.max("__longer").alias("__longer")) if parts else None


def mine_collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int | None = TOP,
                      absorb: int = ABSORB, chunk: int = CHUNK) -> DataFrame:
    """The ``top`` collocations of every language: lang, rank, phrase, a, l, r, n, score.

    Candidates are phrases of 2 to ``max_words`` words with ``min_count``
    occurrences or more.  The score is that of the lowest-scoring cut, and a
    candidate goes if a longer one that holds it has ``absorb`` per cent of its
    count or more.  ``top`` None returns all that are left.

    Null and empty texts have no words; a null lang is "und" and counts with
    it; repeated rows count each; an empty table gives no row.  Equal scores
    are ordered by count, then by the bytes of the phrase.  Only lang and text
    are read, so other columns cannot clash.
    """
    sizes, levels = mine_phrases(docs, max_words, min_count, chunk)
    parts = []
    for k in range(2, max_words + 1):
        scored = _cut(levels[k - 1], levels, k)
        longer = _absorbed(levels, k, absorb)
        if longer is not None:
            scored = scored.join(longer, _columns(k), "left").where(
                F.col("__longer").isNull() | (100 * F.col("__longer") < absorb * F.col("a")))
        parts.append(scored.select("lang", "phrase", "a", "l", "r", "score"))
    if not parts:
        return docs.sparkSession.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    candidates = reduce(DataFrame.unionByName, parts)
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = candidates.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

"""Collocations, line dedup and ranked search against brute force, on odd rows and on whole small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from oracle_compare import compare, duck
from tabulae.llm import collocations, line_dedup, search
from tabulae.llm.collocations import mine_collocations, mine_phrases
from tabulae.llm.line_dedup import deduplicate_lines, line_bitmaps
from tabulae.llm.queries import QUERIES, SQL
from tabulae.llm.search import search_documents

SF = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FOOTER = "  This Footer Line is on Many Pages and has over forty signs "
LONG = "\n".join(f"line {i} of a long text that nobody else has, surely" if i % 3 else FOOTER for i in range(30_000))


@pytest.mark.parametrize("name", ["op11_collocations", "op12_line_dedup", "op13_search"])
def test_whole_small_tables_equal_sql(spark, name):
    ok, message = compare(QUERIES[name](spark, SF), duck(SF), SQL[name])
    assert ok, message


# --- line dedup -----------------------------------------------------------------------
def brute_lines(rows, min_chars=40, min_docs=5):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(FOLD)

    holders = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        own = [len(holders[key(x)]) >= min_docs and d != max(holders[key(x)], key=lambda i: -1 if i is None else i) if len(key(x)) >= min_chars else False for x in lines]
        out.append((d, len(lines), sum(own), "\n".join(x for x, gone in zip(lines, own) if not gone)))
    return Counter(out)


def line_rows():
    r = [(d, f"{FOOTER}\nown text {d}\n\n{FOOTER.upper()}\r\nend") for d in range(40)]
    r += [(d, "É" + FOOTER.strip() + f"\n{d}\n") for d in range(40, 46)] + [(46, "é" + FOOTER.strip())]     # only A-Z are folded
    r += [(d, "a line of exactly forty signs, counted.." + "\n" + "a line of thirty-nine signs, counted...") for d in range(50, 56)]
    r += [(60, None), (61, ""), (62, "\n"), (None, FOOTER), (None, "x\n" + FOOTER), (3, "other text of the same id\n" + FOOTER), (3, "other text of the same id\n" + FOOTER)]
    r += [(d, "four documents only hold this very line here\nand more") for d in (70, 71, 72, 73)] + [(90, LONG), (5, LONG)]
    return r


def clashing(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema).withColumns({c: F.lit("clash") for c in ("n_lines", "keep", "drops", "pos", "line", "key", "n", "bag", "m", "h", "class", "rank", "score", "phrase", "f", "w1", "chunk", "code")})


def test_line_dedup_equals_brute_force(spark):
    rows = line_rows()
    got = Counter(tuple(r) for r in deduplicate_lines(clashing(spark, rows)).collect())
    assert got == brute_lines(rows)
    assert sum(n for (_, _, dropped, _), n in got.items() if dropped) > 40


def test_hot_lines_are_counted_in_salts_with_equal_results(spark, monkeypatch):
    rows = line_rows()
    seen = []
    salted = line_dedup._salted

    def watched(lines):
        out = salted(lines)
        seen.append({r[0] for r in out.select("__salt").distinct().collect()})
        return out

    monkeypatch.setattr(line_dedup, "_salted", watched)
    got = Counter(tuple(r) for r in deduplicate_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute_lines(rows)
    assert max(map(len, seen)) > 2      # the footer is heavy
    monkeypatch.setattr(line_dedup, "_salted", lambda lines: lines.withColumn("__salt", F.lit(0)))
    assert Counter(tuple(r) for r in deduplicate_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == got


def test_line_bitmaps_say_which_lines_stay(spark):
    rows = line_rows()
    texts = {(d, t or ""): t for d, t in rows}
    got = {}
    for r in line_bitmaps(clashing(spark, rows)).collect():
        keep = [i % 2 == 0 for i, n in enumerate(r["keep"]) for _ in range(n)]
        assert len(keep) == r["n_lines"] and keep.count(False) == r["n_dropped"]
        got.setdefault(r["doc_id"], []).append(keep)
    want = brute_lines(rows)
    for (d, _t), text in texts.items():
        kept = {"\n".join(x for x, k in zip((text or "").split("\n"), keep) if k) for keep in got[d] if len(keep) == len((text or "").split("\n"))}
        assert any(k[0] == d and k[3] in kept for k in want)
    whole = next(r["keep"] for r in line_bitmaps(spark.createDataFrame([(1, "a\nb\nc")], "doc_id long, text string")).collect())
    assert whole == [3]


def test_line_order_needs_no_exchange_after_the_range_partitioning(spark):
    docs = spark.createDataFrame(line_rows(), "doc_id long, text string")
    plans = []
    written = line_dedup.written

    def watched(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return written(df, name)

    line_dedup.written, before = watched, line_dedup.written
    try:
        deduplicate_lines(docs).collect()
    finally:
        line_dedup.written = before
    plan = dict(plans)["lines-counted"]
    assert plan.count("rangepartitioning(") == 1 and "hashpartitioning(__h1" not in plan
    assert "Python" not in plan and "Arrow" not in plan


# --- collocations ---------------------------------------------------------------------
def brute_phrases(rows, longest=3, least=10, top=2000, absorb=50):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(FOLD)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) >= 2 and a >= least}
        inside = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], a)
        scored = []
        for p, a in candidates.items():
            if p in inside and 100 * inside[p] >= absorb * a:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return Counter(out)


def phrase_rows():
    r = [("en", "New York city is big. New York, new york CITY; the\tend")] * 12 + [("en", "San Jose. San Jose. a a a a a a a a a a a a")] * 6
    r += [(None, "no language here! no language here")] * 7 + [("und", "no language")] * 3
    r += [("fr", "çà et là çà et là. \x0bÀ ET LÀ à et là\x0cx\x00y z")] * 11 + [("fr", None), ("fr", ""), ("de", " .,;\n "), ("de", "x " * 50_000)]
    return r


@pytest.mark.parametrize("chunk", [collocations.CHUNK, 50])
def test_collocations_equal_brute_force(spark, chunk):
    rows = phrase_rows()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3).withColumns({c: F.lit(1) for c in ("w1", "f", "n", "phrase", "chunk")})
    assert Counter(map(tuple, mine_collocations(df, chunk=chunk).collect())) == brute_phrases(rows)


def test_collocations_of_longer_phrases(spark):
    rows = phrase_rows()
    df = spark.createDataFrame(rows, "lang string, text string")
    got = mine_collocations(df, max_words=5, min_count=6, absorb=90, top=7)
    assert Counter(map(tuple, got.collect())) == brute_phrases(rows, 5, 6, 7, 90)
    assert mine_collocations(df, max_words=1).count() == 0


def test_collocations_of_the_small_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    want = brute_phrases(rows, least=3, top=100)
    assert Counter(map(tuple, mine_collocations(docs, min_count=3, top=100, chunk=5_000).collect())) == want
    sizes, levels = mine_phrases(docs, min_count=3)
    assert sum(r["n"] for r in sizes.collect()) == sum({(k[0], k[6]): k[6] for k in want}.values())
    assert len(levels) == 3


def test_score_is_exact_beyond_64_bits(spark):
    a, l, r = 12_345_678_901_234, 98_765_432_109_876, 55_555_555_555_555
    got = spark.range(1).select(collocations._floor_score(F.lit(a), F.lit(l), F.lit(r))).first()[0]
    assert got == 1_000_000 * a * a // (l * r)


# --- search ---------------------------------------------------------------------------
def brute_search(docs, items, top=50):
    word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    bags = [(d, Counter(w.translate(FOLD) for w in word.findall(t or ""))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        own = {w.translate(FOLD) for w in word.findall(text or "")}
        scored = []
        for d, b in bags:
            m = 100 - 50 + 50 * sum(b.values()) * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 20 * m)) for t in own if t in b)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1)]
    return Counter(out)


def search_rows():
    docs = [(d, f"Common words here, and rare{d % 7} " + "filler " * (d % 4)) for d in range(200)]
    docs += [(d, "the same copied text about whales") for d in range(300, 420)] + [(1, "the same copied text about whales")]
    docs += [(500, None), (501, ""), (502, "!!"), (None, "whales ÉTÉ été 42"), (None, "copied whales"), (503, "WHALES " * 40_000), (-5, "whales, text")]
    items = [(1, "whales and RARE3 rare3"), (2, None), (3, "!"), (4, "common text 42 Été"), (None, "été whales"), (4, "filler"), (6, "words nobody uses")]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_search_equals_brute_force(spark, monkeypatch, small):
    docs, items = search_rows()
    if small:      # several groups of items, several dense blocks
        monkeypatch.setattr(search, "GROUP_TERMS", 5)
        monkeypatch.setattr(search, "SALTS", 2)
    df = clashing(spark, docs).repartition(5)
    got = Counter(map(tuple, search_documents(df, spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))).collect()))
    assert got == brute_search(docs, items)
    few = Counter(map(tuple, search_documents(df, spark.createDataFrame(items, "item_id long, text string"), top=3).collect()))
    assert few == brute_search(docs, items, 3)


def test_search_blocks_and_whole_number_sums_are_the_same(spark):
    import numpy as np

    bags = [np.array([(0, 2), (3, 1)], "<i4").T.tobytes(), np.array([(1, 5), (2, 1), (3, 9)], "<i4").T.tobytes()]
    row, term, tf = search._unpacked(bags)
    assert list(zip(row, term, tf)) == [(0, 0, 2), (0, 3, 1), (1, 1, 5), (1, 2, 1), (1, 3, 9)]
    best = search._Best(2, 2)
    for at in range(3):
        best.add(np.array([[5, 0], [7, 1], [5, 0]]), np.array([0, 1]), np.array([9, 8, 7]) + 10 * at, np.array([0, 1, 2]) + 3 * at)
    assert list(zip(best.item, best.score, best.first)) == [(0, 7, 8), (0, 7, 18), (1, 1, 8), (1, 1, 18)]


def test_copies_are_one_class(spark, monkeypatch):
    seen = {}
    written = search.written

    def watched(df, name):
        seen[name] = written(df, name)
        return seen[name]

    monkeypatch.setattr(search, "written", watched)
    docs, items = search_rows()
    search_documents(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert seen["classes"].count() < 60 and seen["classes"].agg(F.max("members")).first()[0] >= 121


# --- empty tables ---------------------------------------------------------------------
def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    one = spark.createDataFrame([(1, "x y", "en")], "doc_id long, text string, lang string")
    items = spark.createDataFrame([(1, "x y")], "item_id long, text string")
    assert deduplicate_lines(docs).count() == line_bitmaps(docs).count() == mine_collocations(docs).count() == 0
    assert search_documents(docs, items).count() == 0
    assert search_documents(one, items.limit(0)).count() == 0
    assert [tuple(r) for r in deduplicate_lines(one).collect()] == [(1, 1, 0, "x y")]
    assert hashlib.sha256(b"").hexdigest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"

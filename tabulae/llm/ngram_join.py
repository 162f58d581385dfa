"""N-gram Jaccard join by count vectors in R-trees.

A document is the set of its distinct word shingles.  Two documents link when
their sets' Jaccard similarity reaches the threshold.

1. Equal sets become one class; the rest of the work is on classes.
2. Shingles are hashed into GROUPS groups; a class is the point of its group
   counts.  The overlap of two sets is at most the sum of the coordinate
   minima of their points.
3. Points are dealt to cells by size band and by the shingles that come first
   in one fixed order, as many as a linked pair must share one of.  A cell is
   a bounded number of points, indexed by a bulk-loaded R-tree: from the roots
   down two boxes are opened only if the summed minima of their upper corners
   allow a link, and the same bound then holds point against point.
4. Surviving pairs are verified on their whole texts.  First a spanning forest
   of each cell's closest pairs, so that a large group becomes one component
   without all its pairs; then every other surviving pair of two components.
   A cell with more such pairs than DENSE a point gives its points instead:
   their sets are compared block against block, and a spanning forest of the
   links found there is verified.  So no step writes more than a fixed number
   of pairs a point.
5. Components of the links give every document its smallest reachable doc_id.
6. Links within a component are counted block by block: each two chunks of its
   classes meet in one block, which gives a count a class and not the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulae.llm.common import written

N = 3                    # words in a shingle, unless given
NUM, DEN = 90, 100       # threshold, unless given: DEN * intersection >= NUM * union
GROUPS = 256             # coordinates of a point
CELL = 2048              # points of one cell, about
DENSE = 8                # pairs a point of a cell, of more its points are compared in blocks
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20   # classes and shingles of one chunk of a component, about
SLAB, SPARSE, PAIRS = 2048, 256, 1 << 21   # shingles multiplied out at a time; of how small a share of the pairs one is not; pairs counted at a time
LEAF, FAN = 32, 8        # points of one R-tree leaf, boxes of one inner node
COMMON_DOCS, COMMON_IN = 16384, 3   # a shingle in so many of a sample of so many is common
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_U64 = np.uint64
FOUND = "a long, b long, cell string, side int"
FEATURES = "doc_id long, text_hash long, n_shingles long, digest binary, point binary, keys array<long>"


class Rule(NamedTuple):
    """What links two documents: Jaccard similarity of their n-word shingles of num/den or more."""

    n: int = N
    num: int = NUM
    den: int = DEN

    @property
    def band(self) -> float:
        """Sizes of linked sets differ by less than this in logarithm."""
        return -math.log(self.num / self.den - 0.01)

    def prefix(self, size: int) -> int:
        """Members of a set of ``size``, first in any one order, of which a link shares one."""
        return size - -(-self.num * size // self.den) + 1

    def need(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least overlap of linked sets of these sizes: num/(num+den) of their sum, rounded up."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def links(self, both, a, b):
        """Whether sets of sizes ``a`` and ``b`` that share ``both`` members link."""
        return self.den * both >= self.num * (a + b - both)


RULE = Rule()


# -- sets and points ---------------------------------------------------------------------

def words(text: str | None) -> list[bytes]:
    """Words of the text with A-Z lowered; bytes.split parts at the six blanks."""
    return text.encode("utf-8").translate(_LOWER).split() if text else []


def shingles(text: str | None, n: int = N) -> set:
    """The set itself: distinct n-word tuples, or the whole of a shorter text."""
    w = words(text)
    if not w:
        return set()
    return set(zip(*(w[i:] for i in range(n)))) if len(w) >= n else {tuple(w)}


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U64(33))) * _U64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U64(33))) * _U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U64(33))


class Hashed(dict):
    """Word -> 64-bit hash, remembered by a worker."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def hashes(text: str | None, known: Hashed, n: int = N) -> np.ndarray:
    """Sorted 64-bit hashes of the set's members."""
    w = words(text)
    if not w:
        return np.zeros(0, np.uint64)
    x = np.fromiter(map(known.__getitem__, w), np.uint64, len(w))
    k = min(n, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            h = _mixed(h * _U64(0x9E3779B97F4A7C15) + x[i:len(w) - k + 1 + i])
    return np.unique(h)


def point(h: np.ndarray) -> bytes:
    """Group counts: all lowest bytes, then all next ones, as many planes of up to four as the largest count has."""
    return packed(np.bincount((h >> _U64(20)).astype(np.int64) % GROUPS, minlength=GROUPS))


def packed(c: np.ndarray) -> bytes:
    planes = max(1, -(-int(c.max()).bit_length() // 8))
    return b"".join((c >> (8 * k) & 255).astype(np.uint8).tobytes() for k in range(planes))


def points_of(raw: list[bytes]) -> np.ndarray:
    n = max(map(len, raw), default=GROUPS) // GROUPS
    planes = np.frombuffer(b"".join(x.ljust(n * GROUPS, b"\0") for x in raw), np.uint8).reshape(len(raw), n, GROUPS)
    out = planes[:, 0].astype(np.int32)
    for k in range(1, n):
        out += planes[:, k].astype(np.int32) << (8 * k)
    return out


def _features(common, rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        known, frequent = Hashed(), common.value
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                h = hashes(text, known, rule.n)
                at = np.searchsorted(frequent, h)
                late = frequent[np.minimum(at, len(frequent) - 1)] == h if len(frequent) else np.zeros(len(h), bool)
                order = np.concatenate([h[~late], h[late]])[:rule.prefix(len(h))] if len(h) else h
                rows.append((len(h), xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None,
                             point(h), order.view(np.int64)))
            cols = list(zip(*rows)) if rows else [[]] * 4
            types = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), *(pa.array(c, t) for c, t in zip(cols, types))],
                names=["doc_id", "text_hash", "n_shingles", "digest", "point", "keys"])
    return run


def common_shingles(docs: DataFrame, rule: Rule = RULE) -> np.ndarray:
    """Sorted hashes of shingles frequent in a bounded random sample.

    They only come last in the order the cells use, which keeps cells small;
    any order finds every link.  At most COMMON_DOCS texts are sampled, so the
    result is bounded too.
    """
    n = docs.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_003)) / 1_000_003.0
    some = docs.where(draw < min(1.0, COMMON_DOCS / max(n, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashed()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                h = hashes(text, known, rule.n)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64), pa.int64())], names=["h"])

    found = some.select("text").mapInArrow(run, "h long").groupBy("h").count().where(
        F.col("count") >= max(2, COMMON_IN * min(n, COMMON_DOCS) // COMMON_DOCS)).select("h").orderBy("h").limit(1_000_000)
    return np.sort(found.toArrow().column("h").to_numpy().astype(np.int64).view(np.uint64))


# -- the R-tree ----------------------------------------------------------------------------

need = RULE.need


class RTree:
    """Points packed into leaves by size and then by the coordinate of widest
    spread in each slice (sort-tile-recursive loading); FAN neighbours make a
    node of the level above, up to one root.

    A level is its boxes: upper corners, least sizes, largest sizes.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = self._tiled(points, sizes) if len(points) > LEAF else np.arange(len(points))
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels, box, fan = [], (self.points, self.sizes, self.sizes), LEAF
        while not self.levels or len(box[0]) > 1:
            starts = np.arange(0, len(box[0]), fan)
            box = tuple(f.reduceat(x, starts) for f, x in zip((np.maximum, np.minimum, np.maximum), box))
            self.levels.append(box)
            fan = FAN

    @staticmethod
    def _tiled(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        by_size = np.argsort(sizes, kind="stable")
        tile = LEAF * max(1, int(np.ceil(np.sqrt(len(points) / LEAF))))
        order = []
        for lo in range(0, len(by_size), tile):
            part = by_size[lo:lo + tile]
            axis = int(points[part].var(0).argmax())
            order.append(part[np.argsort(points[part, axis], kind="stable")])
        return np.concatenate(order)

    def boxes(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Boxes of a level; a lower tree's root stands for the levels it has not."""
        return self.levels[min(level, len(self.levels) - 1)]

    def below(self, level: int, at: np.ndarray) -> np.ndarray:
        """Numbers of the boxes of ``level`` in each box ``at`` of the level above, one row each (some past the end)."""
        return at[:, None] if level + 1 >= len(self.levels) else at[:, None] * FAN + np.arange(FAN)

    def leaf_pairs(self, other: "RTree", rule: Rule) -> Iterator[tuple[int, int]]:
        """Leaves that may hold a pair, found from the roots down."""
        top = max(len(self.levels), len(other.levels)) - 1
        a = b = np.zeros(1, np.int64)
        for level in range(top, -1, -1):
            (corner, low, high), (corner2, low2, high2) = self.boxes(level), other.boxes(level)
            if level < top:
                i, j = self.below(level, a), other.below(level, b)
                shape = (len(a), i.shape[1], j.shape[1])
                a, b = np.broadcast_to(i[:, :, None], shape).ravel(), np.broadcast_to(j[:, None, :], shape).ravel()
                there = (a < len(low)) & (b < len(low2)) & ((a <= b) if other is self else True)
                a, b = a[there], b[there]
            # Least need of a pair of the two boxes, and sizes that can meet at all.
            fits = (rule.den * high[a] >= rule.num * low2[b]) & (rule.den * high2[b] >= rule.num * low[a])
            a, b = a[fits], b[fits]
            fits = np.minimum(corner[a], corner2[b]).sum(1) >= rule.need(low[a], low2[b])
            a, b = a[fits], b[fits]
        return zip(a.tolist(), b.tolist())

    def pairs(self, other: "RTree", rule: Rule = RULE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(places here, places in ``other``, bounds) of the pairs that may link.

        A tree against itself gives each pair once.
        """
        for a, b in self.leaf_pairs(other, rule):
            s, t = slice(a * LEAF, (a + 1) * LEAF), slice(b * LEAF, (b + 1) * LEAF)
            n, m = self.sizes[s], other.sizes[t]
            least = np.minimum(self.points[s][:, None, :], other.points[t][None, :, :]).sum(2)
            ok = least >= rule.need(n[:, None], m[None, :])
            if other is self and a == b:
                ok &= np.arange(len(n))[:, None] < np.arange(len(m))[None, :]
            i, j = np.nonzero(ok)
            if len(i):
                yield self.order[i + s.start], other.order[j + t.start], least[i, j]


def forest(n: int, i: np.ndarray, j: np.ndarray, near: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the graph's nearest edges (Prim on the dense matrix)."""
    if len(i) == 1:
        return [(int(i[0]), int(j[0]))]
    w = np.zeros((n, n), np.float32)
    w[i, j] = w[j, i] = near
    best, via, todo = np.zeros(n, np.float32), np.full(n, -1), np.ones(n, bool)
    todo[np.setdiff1d(np.arange(n), np.union1d(i, j))] = False
    out = []
    while todo.any():
        at = int(np.where(todo, best, -1).argmax())
        if via[at] >= 0:
            out.append((int(via[at]), at))
        todo[at] = False
        closer = w[at] > best
        best[closer], via[closer] = w[at][closer], at
    return out


def cell_pairs(reps: np.ndarray, sizes: np.ndarray, points: np.ndarray, chunks: np.ndarray,
               cell_a: int, cell_b: int, comps: np.ndarray | None = None, rule: Rule = RULE) -> tuple[list[tuple[int, int]], np.ndarray]:
    """(pairs of one cell that may link, lower class first; places to compare in blocks).

    Without ``comps`` a spanning forest of them; with ``comps`` every pair of
    two components, or the places of those points if the pairs are many.
    """
    none = np.zeros(0, np.int64)
    places = [np.flatnonzero(chunks == c) for c in ((cell_a,) if cell_a == cell_b else (cell_a, cell_b))]
    if not all(map(len, places)):
        return [], none
    trees = [RTree(points[at], sizes[at]) for at in places]
    found = []
    for x, y, least in trees[0].pairs(trees[-1], rule):
        x, y = places[0][x], places[-1][y]
        if comps is not None:
            apart = comps[x] != comps[y]
            x, y, least = x[apart], y[apart], least[apart]
        found.append((x, y, least))
    if not sum(len(x) for x, _, _ in found):
        return [], none
    i, j, least = (np.concatenate(x) for x in zip(*found))
    if comps is None:
        edges = forest(len(reps), i, j, least / (sizes[i] + sizes[j] - least))
        i, j = np.array(edges, np.int64).T
    elif len(i) > DENSE * len(reps):
        return [], np.union1d(i, j)
    return list(zip(np.minimum(reps[i], reps[j]).tolist(), np.maximum(reps[i], reps[j]).tolist())), none


def _cells(rule: Rule):
    """Candidate pairs of each cell, from rows that are sorted by cell.

    Cells of two points (most of them) are compared all at once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            ends = _ends(held)
            if len(ends) > 1:             # the last cell may go on in the next batch
                done, held = held.slice(0, ends[-2]), held.slice(ends[-2])
                yield _found(*_of_cells(done, rule))
        if held is not None and held.num_rows:
            yield _found(*_of_cells(held, rule))
    return run


def _found(pairs: list[tuple[int, int]], dense: list[tuple[int, int, str, int]]) -> pa.RecordBatch:
    """FOUND: pairs (a, b) without a cell, then points (rep, comp, cell, side) of dense cells."""
    rows = [(a, b, None, None) for a, b in pairs] + dense
    types = (pa.int64(), pa.int64(), pa.string(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=["a", "b", "cell", "side"])


def _ends(table: pa.Table) -> np.ndarray:
    """Row after the last of each cell."""
    ids = [table.column(c).to_numpy() for c in ("key", "band", "cell_a", "cell_b")]
    new = np.zeros(max(table.num_rows - 1, 0), bool)
    for x in ids:
        new |= x[1:] != x[:-1]
    return np.append(np.flatnonzero(new) + 1, table.num_rows)


def _of_cells(table: pa.Table, rule: Rule) -> tuple[list[tuple[int, int]], list[tuple[int, int, str, int]]]:
    ends = _ends(table)
    starts = np.append(0, ends[:-1])
    rep, n, chunk = (table.column(c).to_numpy().astype(np.int64) for c in ("rep", "n", "chunk"))
    a, b = (table.column(c).to_numpy() for c in ("cell_a", "cell_b"))
    comp = table.column("comp").to_numpy() if "comp" in table.column_names else None
    raw = table.column("point").to_pylist()
    key, band = (table.column(c).to_numpy() for c in ("key", "band"))
    out: list[tuple[int, int]] = []
    dense: list[tuple[int, int, str, int]] = []
    two = starts[(ends - starts == 2) & (a[starts] == b[starts])]
    for lo in range(0, len(two), 4096):
        x = two[lo:lo + 4096]
        least = np.minimum(points_of([raw[i] for i in x]), points_of([raw[i + 1] for i in x])).sum(1)
        ok = (least >= rule.need(n[x], n[x + 1])) & (comp is None or comp[x] != comp[x + 1])
        out += zip(np.minimum(rep[x], rep[x + 1])[ok].tolist(), np.maximum(rep[x], rep[x + 1])[ok].tolist())
    for lo, hi in zip(starts, ends):
        if hi - lo > 2 or hi - lo == 2 and a[lo] != b[lo]:
            order = lo + np.argsort(rep[lo:hi], kind="stable")
            pairs, many = cell_pairs(rep[order], n[order], points_of([raw[i] for i in order]), chunk[order],
                                     a[lo], b[lo], None if comp is None else comp[order], rule)
            out += pairs
            at, cell = order[many], f"{key[lo]}:{band[lo]}:{a[lo]}:{b[lo]}"
            dense += [(r, c, cell, int(s)) for r, c, s in zip(rep[at].tolist(), comp[at].tolist() if len(at) else (), chunk[at] != a[lo])]
    return out, dense


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else ((), ()))], names=["a", "b"])


def candidates(cells: DataFrame, points: DataFrame, rule: Rule = RULE) -> DataFrame:
    """FOUND: distinct candidate pairs (a, b) of all cells, and the points of dense cells.

    ``points``: rep, n, point; with a column comp, every pair of two
    components, else a spanning forest of each cell (and no cell is dense).
    """
    at = ["key", "band", "cell_a", "cell_b"]
    dealt = cells.join(points, "rep").repartition(*at).sortWithinPartitions(*at)
    return dealt.mapInArrow(_cells(rule), FOUND).distinct()


# -- verification and components ----------------------------------------------------------

def _verify(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, mine = None, set()
        for batch in batches:
            out = []
            for a, b, ta, tb in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))):
                if a != last:
                    last, mine = a, shingles(ta, rule.n)
                other = shingles(tb, rule.n)
                if rule.links(len(mine & other), len(mine), len(other)):
                    out.append((a, b))
            yield _pairs(out)
    return run


def verified(pairs: DataFrame, texts: DataFrame, rule: Rule = RULE) -> DataFrame:
    """The pairs whose texts do link.  ``texts``: rep, text."""
    ta = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    tb = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(tb, "b").join(ta, "a").mapInArrow(_verify(rule), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable, for nodes that have an edge.

    Large-star and small-star steps by turns until nothing changes; each step
    is a few aggregates over at most the number of edges, written down.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    mark = _mark(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))      # at most the edges; made distinct below
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            down.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        new = written(small, "edges")
        before, mark = mark, _mark(new)
        if mark == before:
            return new.groupBy("u").agg(F.min("v").alias("comp")).withColumnRenamed("u", "node").unionByName(
                new.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
        edges = new


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and an order-free checksum."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


# -- number of links -----------------------------------------------------------------------

def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Shared members of each set of ``a`` with each of ``b``.

    Members of many sets are multiplied out, some at a time; of the others the
    pairs of sets are counted.
    """
    out = np.zeros((len(a), len(b)), np.int64)
    ids, place = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    cut = sum(map(len, a))
    sides = []
    for sets, at in ((a, place[:cut]), (b, place[cut:])):
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        order = np.argsort(at, kind="stable")
        sides.append((owner[order], np.searchsorted(at[order], np.arange(len(ids) + 1))))
    (oa, sa), (ob, sb) = sides
    na, nb = np.diff(sa), np.diff(sb)
    rare = SPARSE * na * nb < out.size
    few = np.flatnonzero(rare & (na * nb > 0))
    ends = np.cumsum(na[few] * nb[few])
    for part in np.split(few, np.flatnonzero(np.diff(ends // PAIRS)) + 1):
        n = na[part] * nb[part]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)      # place within the member's pairs
        i, j = oa[np.repeat(sa[part], n) + k // np.repeat(nb[part], n)], ob[np.repeat(sb[part], n) + k % np.repeat(nb[part], n)]
        out += np.bincount(i * len(b) + j, minlength=out.size).reshape(out.shape)
    many = np.flatnonzero(~rare & (na * nb > 0))
    for lo in range(0, len(many), SLAB):
        some = many[lo:lo + SLAB]
        x, y = np.zeros((len(a), len(some)), np.float32), np.zeros((len(b), len(some)), np.float32)
        for m, o, s in ((x, oa, sa), (y, ob, sb)):
            n = s[some + 1] - s[some]
            col = np.repeat(np.arange(len(some)), n)
            m[o[np.repeat(s[some] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())], col] = 1
        out += (x @ y.T).astype(np.int64)      # below 2**24, so exact
    return out


def _block(rule: Rule):
    known = Hashed()

    def run(table: pa.Table) -> pa.Table:
        rep, chunk = table.column("rep").to_numpy(), table.column("chunk").to_numpy()
        a, b = table.column("block_a")[0].as_py(), table.column("block_b")[0].as_py()
        sets = [hashes(t, known, rule.n) for t in table.column("text").to_pylist()]
        ia, ib = np.flatnonzero(chunk == a), np.flatnonzero(chunk == b)
        size = np.array([len(x) for x in sets], np.int64)
        linked = rule.links(overlaps([sets[i] for i in ia], [sets[i] for i in ib]), size[ia][:, None], size[ib][None, :])
        if a == b:
            np.fill_diagonal(linked, False)
        count = np.zeros(len(rep), np.int64)
        count[ia] += linked.sum(1)
        if a != b:
            count[ib] += linked.sum(0)
        return pa.table({"rep": pa.array(rep, pa.int64()), "n_links": pa.array(count, pa.int64())})
    return run


def link_counts(comps: DataFrame, links: DataFrame, texts: DataFrame, rule: Rule = RULE) -> DataFrame:
    """(rep, n_links): how many other classes link with each that has a link.

    ``comps``: rep, n, comp of the classes; ``links``: the verified pairs,
    which join the components; ``texts``: rep, text.  In a component of two
    the pairs are all there; larger ones are compared in blocks.
    """
    sizes = comps.groupBy("comp").agg(F.count("*").alias("members"), F.sum(F.col("n").cast("long")).alias("total"))
    large = sizes.where("members > 2").select("comp", F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int").alias("chunks"))
    own = comps.join(large, "comp").withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    met = own.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "rep", "comp", "chunk", F.least("chunk", "with").alias("block_a"), F.greatest("chunk", "with").alias("block_b"))
    counted = met.join(texts, "rep").groupBy("comp", "block_a", "block_b").applyInArrow(_block(rule), "rep long, n_links long")
    pairs = links.select(F.explode(F.array("a", "b")).alias("rep")).join(own.select("rep"), "rep", "left_anti")
    return counted.unionByName(pairs.withColumn("n_links", F.lit(1).cast("long"))).groupBy("rep").agg(F.sum("n_links").alias("n_links"))


# -- dense cells ---------------------------------------------------------------------------

def _dense_block(rule: Rule):
    known = Hashed()

    def run(table: pa.Table) -> pa.Table:
        rep, comp, part = (table.column(c).to_numpy() for c in ("rep", "comp", "part"))
        a, b = table.column("block_a")[0].as_py(), table.column("block_b")[0].as_py()
        sets = [hashes(t, known, rule.n) for t in table.column("text").to_pylist()]
        ia, ib = np.flatnonzero(part == a), np.flatnonzero(part == b)
        size = np.array([len(x) for x in sets], np.int64)
        linked = rule.links(overlaps([sets[i] for i in ia], [sets[i] for i in ib]), size[ia][:, None], size[ib][None, :])
        linked &= comp[ia][:, None] != comp[ib][None, :]
        i, j = np.nonzero(np.triu(linked) if a == b else linked)
        edges = forest(len(rep), ia[i], ib[j], np.ones(len(i), np.float32)) if len(i) else []
        return pa.table(_pairs([(min(rep[x], rep[y]), max(rep[x], rep[y])) for x, y in edges]))
    return run


def dense_pairs(dense: DataFrame, sizes: DataFrame, texts: DataFrame, rule: Rule = RULE) -> DataFrame:
    """(a, b): a spanning forest of the links of two components in each block of each dense cell.

    ``dense``: rep, comp, cell, side; ``sizes``: rep, n; ``texts``: rep, text.
    A cell (or each of its two sides) is cut into parts of a bounded number of
    classes and shingles, and each two parts that can meet are a block.
    """
    sized = dense.join(sizes, "rep")
    by_side = sized.groupBy("cell", "side").agg(F.count("*").alias("members"), F.sum(F.col("n").cast("long")).alias("total"))
    parts = by_side.groupBy("cell").agg(F.max("side").alias("two"), F.max(F.greatest(
        F.ceil(F.col("members") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES))).cast("int").alias("parts"))
    own = sized.join(parts, "cell").withColumn("part", F.col("side") * F.col("parts") + F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    first = F.when((F.col("two") == 1) & (F.col("side") == 0), F.col("parts")).otherwise(0)      # the other side's, or one's own
    met = own.withColumn("with", F.explode(F.sequence(first, first + F.col("parts") - 1))).select(
        "rep", "comp", "cell", "part", F.least("part", "with").alias("block_a"), F.greatest("part", "with").alias("block_b"))
    return met.join(texts, "rep").groupBy("cell", "block_a", "block_b").applyInArrow(_dense_block(rule), "a long, b long").distinct()


# -- the operator ---------------------------------------------------------------------------

def _cell_rows(classes: DataFrame, rule: Rule) -> DataFrame:
    """(key, band, cell_a, cell_b, chunk, rep): every class once per cell that it is in."""
    band = F.floor(F.log("n") / rule.band).cast("int")
    keys = classes.select("rep", band.alias("band"), F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    # Linked sets are of one size band or of two neighbours: each class is in its own and the next.
    banded = keys.join(shared, "key").withColumn("band", F.explode(F.array("band", F.col("band") + 1)))
    alike = banded.groupBy("key", "band").agg(
        F.count("*").alias("members"), F.bit_xor(F.xxhash64("rep")).alias("x1"),
        F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("x2")).where("members > 1")
    # Cells of just the same classes are one cell.
    once = alike.groupBy("members", "x1", "x2").agg(F.min(F.struct("key", "band")).alias("at")).select("at.*", "members")
    member = banded.join(once, ["key", "band"]).withColumn("chunks", F.ceil(F.col("members") / CELL).cast("int"))
    # A larger cell is cut into chunks by random; each two chunks meet in a cell of their own.
    chunk = F.pmod(F.xxhash64("rep", "key"), F.col("chunks")).cast("int")
    spread = member.withColumn("chunk", chunk).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return spread.select("key", "band", F.least("chunk", "with").alias("cell_a"), F.greatest("chunk", "with").alias("cell_b"), "chunk", "rep")


def join_documents(docs: DataFrame, n: int = N, num: int = NUM, den: int = DEN) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id, n_links.

    Documents link whose sets of n-word shingles have a Jaccard similarity of
    num/den or more.

    ``component_id`` is the smallest doc_id that links reach, the document's
    own included; ``n_links`` counts the links of its class with classes of
    other sets (copies are not counted).  Null and empty texts and texts without words
    have no shingles and link with nothing: their component is their own
    doc_id.  Rows that share a doc_id are one document.  Rows without a doc_id
    take no part and have a null component.  An empty table gives no row.
    Only doc_id and text are read.
    """
    spark, rule = docs.sparkSession, Rule(n, num, den)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    common = spark.sparkContext.broadcast(common_shingles(rows, rule))
    feats = written(rows.mapInArrow(_features(common, rule), FEATURES), "features")
    usable = feats.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    # A class is one set; rep is its number, own the row that stands for it.
    classes = written(usable.groupBy("digest").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("own"), F.first("n_shingles").cast("int").alias("n"),
        F.first("point").alias("point"), F.first("keys").alias("keys")).withColumn("rep", F.monotonically_increasing_id()), "classes")
    cells = written(_cell_rows(classes, rule), "cells")
    points = classes.select("rep", "n", "point")
    pairs = written(candidates(cells, points, rule).select("a", "b"), "pairs")
    # Every class with a partner in a cell is in that cell's forest, so these texts do for both rounds.
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct().join(classes, "rep").select("rep", "own.doc_id", "own.text_hash")
    texts = written(rows.join(wanted, ["doc_id", "text_hash"]).groupBy("rep").agg(F.min("text").alias("text")), "texts")
    first = written(verified(pairs, texts, rule), "links")
    comps = texts.select("rep").join(components(first).withColumnRenamed("node", "rep"), "rep", "left").select(
        "rep", F.coalesce("comp", "rep").alias("comp"))
    apart = written(candidates(cells, points.join(comps, "rep"), rule), "pairs")
    dense = apart.where("cell is not null").select(F.col("a").alias("rep"), F.col("b").alias("comp"), "cell", "side")
    more = apart.where("cell is null").select("a", "b").unionByName(dense_pairs(dense, points.select("rep", "n"), texts, rule)).distinct()
    links = first.unionByName(written(verified(more, texts, rule), "links"))
    # Rows of one doc_id with different sets are one document: their classes meet.
    several = usable.groupBy("doc_id").agg(F.min("digest").alias("d1"), F.max("digest").alias("d2")).where("d1 != d2").select("doc_id")
    met = usable.join(several, "doc_id", "left_semi").join(classes.select("digest", "rep"), "digest").select("doc_id", "rep")
    same = met.join(met.groupBy("doc_id").agg(F.min("rep").alias("a")), "doc_id").select("a", F.col("rep").alias("b"))
    nodes = written(components(links.unionByName(same)).withColumnRenamed("node", "rep"), "components")
    comp = classes.select("digest", "rep", F.col("own.doc_id").alias("least")).join(
        nodes, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    smallest = comp.groupBy("comp").agg(F.min("least").alias("component_id"))
    ends = link_counts(nodes.join(classes.select("rep", "n"), "rep"), links, texts, rule)
    named = comp.join(smallest, "comp").join(ends, "rep", "left").select(
        "digest", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    known = F.col("doc_id").isNotNull()
    return feats.join(named, "digest", "left").select(
        "doc_id", "n_shingles",
        F.when(known, F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.when(known, F.coalesce("n_links", F.lit(0))).alias("n_links"))


def keep_first(docs: DataFrame, n: int = N, num: int = NUM, den: int = DEN) -> DataFrame:
    """One document of each component, the one of the smallest doc_id, as it is.

    Of rows that share that doc_id the one of the smallest text stays; rows
    without a doc_id all stay.
    """
    gone = join_documents(docs, n, num, den).where("doc_id != component_id").select(F.col("doc_id").alias("__gone")).distinct()
    left = docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
    columns = docs.columns
    whole = F.struct(F.coalesce("text", F.lit("")).alias("__order"), *columns)
    once = left.where("doc_id is not null").groupBy("doc_id").agg(F.min(whole).alias("__row")).select(
        *(F.col("__row")[c].alias(c) for c in columns))
    return once.unionByName(left.where("doc_id is null"))

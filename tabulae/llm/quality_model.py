"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded and convolved by learned filters.  Each filter is
max-pooled over overlapping chunks that cover the whole document, a hidden
layer judges each chunk, and the worst chunk decides the document's one
probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulae.llm.common import fold, sample_by_label, written

WIDTH, STRIDE = 8, 2       # of a filter, in bytes
HALF = 128                 # a chunk is two halves; chunks overlap by one
EMBED, FILTERS, HIDDEN = 4, 32, 16
BLOCK = 1 << 19            # bytes convolved at a time
FIT_ROWS = 2000            # sampled labelled rows per class, about
FIT_CHARS = 8_000          # a longer text is fitted in pieces of so many, which overlap by half
STEPS, BATCH, RATE = 1000, 32, 4e-3
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
RESULT = "doc_id long, score double"


def start(seed: int = 5) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    shapes = {"e": (256, EMBED), "w": (WIDTH * EMBED, FILTERS), "b": (FILTERS,), "v": (FILTERS + 1, HIDDEN), "c": (HIDDEN,), "u": (HIDDEN,), "a": (1,)}
    scale = {"e": 0.5, "w": 0.25, "v": 0.3, "u": 0.3}
    return {k: (r.normal(0, scale.get(k, 0.0) or 1e-9, s)).astype(np.float32) for k, s in shapes.items()}


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the texts, each padded by zeros to whole halves; halves of each)."""
    halves = np.array([max(1, -(-len(t) // HALF)) for t in texts])
    data = np.zeros(int(halves.sum()) * HALF + WIDTH, np.uint8)
    at = 0
    for t, h in zip(texts, halves):
        data[at:at + len(t)] = np.frombuffer(t, np.uint8)
        at += int(h) * HALF
    return data, halves


def convolved(m: dict, data: np.ndarray) -> np.ndarray:
    """Filter responses at each stride of ``len(data) - WIDTH`` bytes."""
    x = m["e"][data]
    n = (len(data) - WIDTH) // STRIDE
    view = np.lib.stride_tricks.as_strided(x, (n, WIDTH * EMBED), (x.strides[0] * STRIDE, x.strides[1]))
    return view @ m["w"] + m["b"]


def pooled(m: dict, data: np.ndarray, halves: np.ndarray) -> np.ndarray:
    """Largest response of each filter in each half.

    A window that runs from a text's padding into the next text is replaced
    by the window of zeros.
    """
    last = np.cumsum(halves) * (HALF // STRIDE)
    zero = np.tile(m["e"][0], WIDTH) @ m["w"] + m["b"]
    out, step = [], BLOCK // HALF * (HALF // STRIDE)
    total = int(last[-1])
    for lo in range(0, total, step):
        hi = min(total, lo + step)
        y = convolved(m, data[lo * STRIDE:hi * STRIDE + WIDTH])
        ends = last[(last > lo) & (last <= hi)] - lo
        for back in range(1, WIDTH // STRIDE):
            y[ends - back] = zero
        out.append(y.reshape(-1, HALF // STRIDE, FILTERS).max(1))
    return np.concatenate(out)


def chunks(halves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first half, second half, first chunk of each text) of the chunks."""
    n = np.maximum(halves - 1, 1)
    begin = np.cumsum(halves) - halves
    first_chunk = np.cumsum(n) - n
    first = np.arange(int(n.sum())) - np.repeat(first_chunk, n) + np.repeat(begin, n)
    return first, first + np.repeat((halves > 1).astype(int), n), first_chunk


def hidden(m: dict, pool: np.ndarray, fill: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = np.concatenate([np.maximum(pool, 0), fill[:, None]], 1)
    return x, np.maximum(x @ m["v"] + m["c"], 0)


def badness(m: dict, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(logit of each text's worst chunk, that chunk's first and second half, fill, bytes)."""
    data, halves = laid_out(texts)
    pool = pooled(m, data, halves)
    first, second, first_chunk = chunks(halves)
    sizes = np.repeat(np.array([len(t) for t in texts]), np.maximum(halves - 1, 1))
    begin = np.repeat(np.cumsum(halves) - halves, np.maximum(halves - 1, 1))
    fill = np.clip((sizes - (first - begin) * HALF) / (2 * HALF), 0, 1).astype(np.float32)
    z = hidden(m, np.maximum(pool[first], pool[second]), fill)[1] @ m["u"] + m["a"][0]
    top = np.maximum.reduceat(z, first_chunk)
    n = np.maximum(halves - 1, 1)
    at = np.array([s + int(z[s:s + k].argmax()) for s, k in zip(first_chunk, n)])
    return top, first[at], second[at], fill[at], data


def gradient(m: dict, texts: list[bytes], bad: np.ndarray) -> dict[str, np.ndarray]:
    """Of the log loss, through each text's worst chunk and each filter's best window."""
    z, first, second, fill, data = badness(m, texts)
    span = np.arange(2 * HALF // STRIDE) * STRIDE
    starts = first[:, None] * HALF + np.where((second > first)[:, None], span, span % HALF)
    ends = np.cumsum([max(1, -(-len(t) // HALF)) for t in texts]) * HALF
    at = starts[:, :, None] + np.arange(WIDTH)                                  # text, place, byte
    window = np.where(at < ends[:, None, None], data[at], 0)
    x = m["e"][window].reshape(len(texts), len(span), -1)
    y = x @ m["w"] + m["b"]
    best = y.argmax(1)                                                          # text, filter
    pool = np.take_along_axis(y, best[:, None, :], 1)[:, 0]
    inp, h = hidden(m, pool, fill)
    dz = ((1 / (1 + np.exp(-z))) - bad).astype(np.float32) / len(texts)
    g = {"a": dz.sum(keepdims=True), "u": h.T @ dz}
    dh = np.outer(dz, m["u"]) * (h > 0)
    g |= {"c": dh.sum(0), "v": inp.T @ dh}
    dp = (dh @ m["v"].T)[:, :-1] * (pool > 0)
    chosen = np.take_along_axis(x, best[:, :, None], 1)                         # text, filter, window
    g |= {"b": dp.sum(0), "w": np.einsum("tf,tfk->kf", dp, chosen)}
    dx = (dp[:, :, None] * m["w"].T[None]).reshape(-1, EMBED)
    g["e"] = np.zeros_like(m["e"])
    np.add.at(g["e"], np.take_along_axis(window, best[:, :, None], 1).reshape(-1), dx)
    return g


def fit(texts: list[bytes], bad: np.ndarray, seed: int = 5) -> dict[str, np.ndarray]:
    """Adam on the log loss, classes weighted by sampling alone."""
    m, r = start(seed), np.random.default_rng(seed)
    s1, s2, t = {k: np.zeros_like(v) for k, v in m.items()}, {k: np.zeros_like(v) for k, v in m.items()}, 0
    epochs = -(-STEPS // -(-len(texts) // BATCH))
    steps = epochs * -(-len(texts) // BATCH)
    for _ in range(epochs):
        order = r.permutation(len(texts))
        for lo in range(0, len(order), BATCH):
            some = order[lo:lo + BATCH]
            t += 1
            rate = RATE * (1 - t / (steps + 1)) ** 0.5
            for k, g in gradient(m, [texts[i] for i in some], bad[some]).items():
                s1[k] = 0.9 * s1[k] + 0.1 * g
                s2[k] = 0.99 * s2[k] + 0.01 * g * g
                m[k] = (m[k] - rate * (s1[k] / (1 - 0.9 ** t)) / (np.sqrt(s2[k] / (1 - 0.99 ** t)) + 1e-8)).astype(np.float32)
    return m


def fit_quality(docs: DataFrame, labels: DataFrame) -> dict[str, np.ndarray] | None:
    """The network fitted on a bounded sample of the labelled rows, None without labels of both classes."""
    known = labels.where(F.col("quality").isin(0, 1) & (fold("doc_id", FOLDS) != HELD_OUT)).select("doc_id", "quality")
    some = sample_by_label(known, "quality", FIT_ROWS)
    last = F.greatest(F.ceil(F.length("text") / (FIT_CHARS // 2)) - 2, F.lit(0)).cast("int")
    rows = docs.select("doc_id", "text").join(F.broadcast(some.distinct()), "doc_id").where(F.col("text").isNotNull()).select(
        "doc_id", "quality", "text", F.explode(F.sequence(F.lit(0), last)).alias("piece")).select(
        "doc_id", "quality", "piece", F.expr(f"substring(text, piece * {FIT_CHARS // 2} + 1, {FIT_CHARS})").alias("text"))
    # Pieces of long texts may be many: sampled again, so that a class stays bounded.
    pieces = sample_by_label(written(rows, "pieces"), "quality", 2 * FIT_ROWS).select("text", "quality")
    got = sorted((r[0].encode("utf-8"), r[1]) for r in pieces.collect())
    bad = np.array([1 - q for _, q in got], np.float32)
    return fit([t for t, _ in got], bad) if got and 0 < bad.sum() < len(bad) else None


def score(m: dict | None, texts: list[bytes]) -> np.ndarray:
    if m is None:
        return np.full(len(texts), 0.5)
    out = np.empty(len(texts))
    lo = 0
    while lo < len(texts):      # as many texts at a time as fit a block, one at least
        hi, held = lo, 0
        while hi < len(texts) and (hi == lo or held + len(texts[hi]) <= BLOCK):
            held += len(texts[hi])
            hi += 1
        z = np.clip(badness(m, texts[lo:hi])[0], -60, 60)
        out[lo:hi] = 1 / (1 + np.exp(z))
        lo = hi
    return out


def score_quality(docs: DataFrame, labels: DataFrame, model: dict | None = None) -> DataFrame:
    """One row per document row: doc_id and score (0 to 1, higher is better).

    Map-only after the fit; every byte of every text is covered.  Null texts
    are scored as empty ones; without labels every score is 0.5.  Repeated
    rows get the same score; an empty table gives no row.  Reads doc_id and
    text, and doc_id and quality of the labels.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model or fit_quality(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode("utf-8") for t in batch.column("text").to_pylist()]
            scores = score(shipped.value, texts) if texts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)

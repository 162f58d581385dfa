"""Language identification by multilingual mixture inference.

A language is a distribution over hashed byte trigrams.  A document is a
mixture of languages: expectation-maximisation estimates the proportions, and
the set of languages is the one of highest likelihood less a penalty for each
further language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulae.llm.common import fold, sample_by_label

BITS = 15
FIT_ROWS = 600          # sampled labelled rows per language, about
FIT_CHARS = 20_000      # a longer text is counted in pieces of so many
FIT_LABELS = 200        # counted at a time by a worker
SMOOTHING = 0.5
STEPS = 12              # of expectation-maximisation
PENALTY = 6.0           # times log(trigrams), for each further language
TEMPER = 3.0            # overlapping trigrams count as a third of their number
FOLDS, HELD_OUT = 3, 1
RESULT = "doc_id long, lang_pred string, score double, proportions map<string,double>"
_TABLE = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of the lower-cased letters; the rest counts as spaces."""
    data = b" " + b" ".join(text.lower().encode("utf-8").translate(_TABLE).split()) + b" "
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    code = b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))
    return (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def fit(rows: list[tuple[str, str]]) -> tuple[list[str], np.ndarray]:
    """(languages, probabilities per language and trigram)."""
    counts: dict[str, np.ndarray] = {}
    for lang, text in rows:
        count(counts, lang, text)
    return smoothed(counts)


def count(counts: dict[str, np.ndarray], lang: str, text: str) -> None:
    """Adds the trigrams of the whole text; its pieces overlap by two characters."""
    own = counts.setdefault(lang, np.zeros(1 << BITS, np.int64))
    for lo in range(0, len(text), FIT_CHARS):
        own += np.bincount(trigrams(text[max(0, lo - 2):lo + FIT_CHARS]), minlength=1 << BITS)


def smoothed(counts: dict[str, np.ndarray]) -> tuple[list[str], np.ndarray]:
    langs = sorted(counts)
    p = np.array([counts[x] for x in langs], float).reshape(-1, 1 << BITS) + SMOOTHING
    return langs, p / p.sum(1, keepdims=True)


def mix(p: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, float]:
    """(proportions, log-likelihood) of the mixture of the rows of ``p``."""
    w = np.full(len(p), 1.0 / len(p))
    n = c.sum()
    for _ in range(STEPS):
        w = w * (p @ (c / (w @ p))) / n
    return w, float(c @ np.log(w @ p))


def infer(text: str, probs: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, float]:
    """(proportions over all languages, score of the largest)."""
    grams = np.bincount(trigrams(text), minlength=1 << BITS)
    used = np.flatnonzero(grams)
    c, p = grams[used].astype(float), probs[:, used]
    single = logs[:, used] @ c
    first = int(single.argmax())
    out = np.zeros(len(probs))
    out[first] = 1.0
    penalty = PENALTY * np.log(c.sum() + 1) * TEMPER
    if len(probs) > 1:
        w, full = mix(p, c)
        # No set can beat one language unless all languages together gain one penalty.
        if full - single[first] > penalty:
            order, best = np.argsort(-w, kind="stable"), single[first]
            for k in range(2, len(probs) + 1):
                some, value = mix(p[order[:k]], c)
                if value - penalty * (k - 1) > best:
                    best = value - penalty * (k - 1)
                    out[:] = 0.0
                    out[order[:k]] = some
    odds = np.exp((single - single.max()) / TEMPER)
    top = int(out.argmax())
    sure = odds[top] / odds.sum() if out[top] == 1.0 else 1.0
    return out, float(min(1.0, out[top] * sure))


def fit_languages(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """The model of a bounded sample of the labelled rows outside the held-out fold.

    Every value of lang that has a text with a letter there is learnt.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (fold("doc_id", FOLDS) != HELD_OUT))
    rows = sample_by_label(known.select("doc_id", "lang", "text"), "lang", FIT_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                count(counts, lang, text)
                if len(counts) > FIT_LABELS:
                    yield from _counted(counts)
                    counts.clear()
        yield from _counted(counts)

    sums = rows.select("lang", "text").mapInArrow(run, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    whole: dict[str, np.ndarray] = {}
    for batch in sums.to_batches():
        lang, gram, n = batch.column("lang").dictionary_encode(), batch.column("gram").to_numpy(), batch.column("n").to_numpy()
        at = lang.indices.to_numpy()
        for i, name in enumerate(lang.dictionary.to_pylist()):
            whole.setdefault(name, np.zeros(1 << BITS, np.int64))[gram[at == i]] = n[at == i]
    return smoothed(whole)


def _counted(counts: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for lang, c in counts.items():
        used = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(c[used], pa.int64())], names=["lang", "gram", "n"])


def identify_languages(docs: DataFrame, model: tuple[list[str], np.ndarray] | None = None) -> DataFrame:
    """One row per document row: RESULT; map-only after the fit.

    ``lang_pred`` is the language of the largest proportion.  Null texts and
    texts without a letter are ``und`` with score 0 and no proportions; so is
    every text if there is nothing to learn from.  Repeated rows are judged
    alike; an empty table gives no row.  Reads doc_id, text and, for the fit,
    lang.
    """
    langs, probs = model or fit_languages(docs)
    shipped = docs.sparkSession.sparkContext.broadcast((langs, probs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, p = shipped.value
        logs = np.log(p)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                if not names or not has_letter(text):
                    rows.append(("und", 0.0, []))
                    continue
                w, score = infer(text, p, logs)
                rows.append((names[int(w.argmax())], score, [(names[i], float(w[i])) for i in np.flatnonzero(w > 1e-6)]))
            cols = list(zip(*rows)) if rows else [[]] * 3
            types = (pa.string(), pa.float64(), pa.map_(pa.string(), pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, types))],
                                             names=["doc_id", "lang_pred", "score", "proportions"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)

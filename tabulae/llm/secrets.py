"""Secrets in texts: fixed patterns, and a token-efficiency test.

Random strings cost a subword vocabulary many tokens: a run of key characters
with few characters per token is reported, unless it is a digest, an
identifier or another thing known to look random.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "token")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_=-])")
# Known harmless forms: digests (MD5, SHA-1, SHA-2), UUIDs, numbers, dates,
# and one word with a capital, which is no more mixed than in lower case.  Names of several words have many characters a token.
_HARMLESS = re.compile(
    r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})"
    r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
    r"|(?:sha(?:1|256|384|512)|md5)-\S+"
    r"|[0-9+/_=-]+"
    r"|[A-Z][a-z]+")
MIN_MIXED = 2            # of: lower case, upper case, digits
MAX_CHARS_PER_TOKEN = 2.2  # of random base-62 text it is about 1.6, of words 3 or more
RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_token long"


def vocabulary():
    """The tiktoken vocabulary of the public byte-level BPE."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, per kind leftmost and apart."""
    out = [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    out += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def random_spans(text: str, taken: list[tuple[int, int, str]], vocab) -> list[tuple[int, int, str]]:
    """Runs outside ``taken`` that the vocabulary encodes with few characters a token."""
    out = []
    for m in _RUN.finditer(text):
        run = m[0]
        mixed = bool(re.search("[a-z]", run)) + bool(re.search("[A-Z]", run)) + bool(re.search("[0-9]", run))
        if mixed < MIN_MIXED or _HARMLESS.fullmatch(run) or any(s < m.end() and m.start() < e for s, e, _ in taken):
            continue
        if len(run) < MAX_CHARS_PER_TOKEN * len(vocab.encode_ordinary(run)):
            out.append((*m.span(), "token"))
    return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vocab = vocabulary()
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            base = base_spans(text or "")
            more = random_spans(text or "", base, vocab)
            kinds = [k for _, _, k in base]
            rows.append((*(kinds.count(k) for k in KINDS[:3]), hashlib.sha256(joined(base).encode()).hexdigest(),
                         joined(base + more), len(more)))
        cols = list(zip(*rows)) if rows else [[]] * 6
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, types))],
                                         names=[c.split()[0] for c in RESULT.split(", ")])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document row: RESULT; map-only.

    Spans are ``kind:start:end`` over the whole match, in code points, end
    exclusive, ordered by start, then kind as in KINDS.  ``base_sha256`` is
    over the fixed patterns' spans, ``spans`` holds those of the token test
    too.  Null and empty texts have none; repeated rows are scanned alike; an
    empty table gives no row.  Only doc_id and text are read.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan, RESULT)

"""Token sequences packed by first-fit decreasing in randomised groups.

Each text is tokenised once and cut at multiples of the sequence length; the
full pieces are sequences by themselves.  The remainders (one a document at
most) are dealt to random groups of a set size, and each group is packed by
first-fit decreasing with a tournament tree over the bins' free room.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulae.llm.common import written

LENGTH = 2048
END_ID = 1
GROUP = 8192            # remainders in a random group, about
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def tokenizer_path() -> str:
    """Where the public tokenizer's file is on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of texts by a byte-level BPE file of the tokenizers library.

    The file's vocabulary lists its merges in order, so the same ids come from
    tiktoken with the vocabulary as ranks, in a third of the time.  That is
    used for texts up to U+02C1, where the two libraries' tables of letters,
    numbers and blanks cannot differ; the tokenizers library takes the others.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # Byte-level files write each byte as one character: the printable ones as they are, the rest from U+0100 on.
        signs = set(ByteLevel.alphabet())
        plain = [b for b in range(256) if chr(b) in signs]
        byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
        special = set(map(str, self.tokenizer.get_added_tokens_decoder().values()))
        ranks = {bytes(byte_of[c] for c in token): rank for token, rank in self.tokenizer.get_vocab(with_added_tokens=False).items()
                 if token not in special}
        self.ranked = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.other = re.compile("[\u02c2-\U0010ffff]").search

    def ids(self, text: str) -> bytes:
        """Ids as little-endian 32-bit bytes."""
        if not self.other(text):
            try:
                return self.ranked.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
            except ValueError:      # its pattern gives up on runs of a million blanks
                pass
        found = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)
        return found.astype("<u4").tobytes()


def pieces(ids: bytes) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of the cuts of one document's ids."""
    step = 4 * LENGTH
    return [(i // 4, len(part) // 4, zlib.crc32(part)) for i in range(0, len(ids), step) for part in (ids[i:i + step],)]


def _tokenise(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path or tokenizer_path())
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encoder.ids(text or "") + end
                rows += [(doc, s, n, crc, len(ids) // 4) for s, n, crc in pieces(ids)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
    return run


def first_fit_decreasing(lengths: np.ndarray, room: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item; ties keep their order.

    A tournament tree holds the free room of the bins; each inner node holds
    the most room below it, so the first bin with room is found in one walk
    down and mended in one walk up.
    """
    n = len(lengths)
    leaves = 1 << max(0, (n - 1).bit_length())
    tree = [room] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for item in np.argsort(-lengths, kind="stable"):
        need = int(lengths[item])
        at = 1
        while at < leaves:
            at *= 2
            if tree[at] < need:
                at += 1
        bins[item], offsets[item] = at - leaves, room - tree[at]
        tree[at] -= need
        while at > 1:
            at //= 2
            tree[at] = max(tree[2 * at], tree[2 * at + 1])
    return bins, offsets


def _pack(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["__uid"], kind="stable")
    bins, offsets = first_fit_decreasing(group["length"].to_numpy())
    return group.assign(__bin=bins, offset=offsets)


def pack_documents(docs: DataFrame, path: str | None = None, seed: int = 23) -> DataFrame:
    """One row per piece: PIECE, sequence_id and offset.

    ``ids_crc32`` is over the piece's ids as little-endian 32-bit numbers;
    every document ends with id 1.  Sequences hold at most LENGTH ids, and the
    pieces of one are gapless from offset 0.  Null and empty texts have the
    one id 1; repeated rows are packed each; a null doc_id is kept; an empty
    table gives no row.  ``path`` is the tokenizer's file on the executors
    (None: the installed public one).  Only doc_id and text are read.
    """
    cut = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_tokenise(path), PIECE)
                  .withColumn("__uid", F.monotonically_increasing_id()), "pieces")
    full = cut.where(F.col("length") == LENGTH)
    rest = cut.where(F.col("length") < LENGTH)
    groups = max(1, round(rest.count() / GROUP))
    # Even sequence ids: full pieces, by their unique row; odd ones: a group's bins.
    alone = full.withColumn("sequence_id", 2 * F.col("__uid")).withColumn("offset", F.lit(0).cast("long"))
    packed = rest.withColumn("__group", F.pmod(F.xxhash64(F.lit(seed), "__uid"), F.lit(groups)))
    columns = ", ".join(f"{c} long" for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "__uid", "__group", "__bin", "offset"))
    binned = packed.groupBy("__group").applyInPandas(_pack, columns).withColumn(
        "sequence_id", 2 * (F.col("__bin") * groups + F.col("__group")) + 1)
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return alone.select(*keep).unionByName(binned.select(*keep))

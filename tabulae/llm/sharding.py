"""Shards of near-equal bytes by histogram sort [native].

Every row gets a 63-bit key hashed from its content and its place.  The exact
bytes below candidate boundaries are counted in one aggregate per round: the
first round's candidates are the 4096 equal steps of the key space, each later
round splits only the steps that hold an unsettled splitter into 256.  When
every splitter is within tolerance the rows are exchanged once.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabulae.llm.common import written

KEY_BITS = 63
FIRST_BITS = 12      # candidates of the first round: 2**12
NEXT_BITS = 8        # each unsettled step is split in 2**8
TOLERANCE = 0.0005   # of a shard's bytes
ROWS_PER_RUN = 20_000  # rows numbered by one window group, about


def find_splitters(narrow: DataFrame, shards: int, total: int) -> list[int]:
    """The ``shards - 1`` smallest keys of shards 1.. (ascending).

    ``narrow`` has ``__key`` and ``size``.  What reaches the driver in a round
    is at most 2**FIRST_BITS or (shards - 1) * 2**NEXT_BITS counts.
    """
    targets = [total * i / shards for i in range(1, shards)]
    slack = TOLERANCE * total / shards
    best: list[tuple[float, int]] = [(float("inf"), 0)] * len(targets)
    level = FIRST_BITS
    steps: dict[int, int] = {0: 0}     # open step -> bytes below it
    width = FIRST_BITS
    while True:
        shift = KEY_BITS - level
        step = F.shiftright("__key", shift)
        rows = narrow
        if level > FIRST_BITS:
            rows = rows.where(F.shiftright("__key", shift + width).isin(list(steps)))
        found = rows.groupBy(step.alias("s")).agg(F.sum("size"), F.min("__key") == F.max("__key")).collect()
        counted = {r[0]: r[1] for r in found}
        settled = {r[0] for r in found if r[2]}     # one key: there is no boundary within
        edges: list[tuple[int, int, int]] = []       # step, bytes below it, bytes below the next
        for parent, below in steps.items():
            mine = sorted(s for s in counted if level == FIRST_BITS or s >> width == parent)
            for s in mine:
                edges.append((s, below, below + counted[s]))
                below += counted[s]
        open_steps: dict[int, int] = {}
        for i, t in enumerate(targets):
            for s, lo, hi in edges:
                for gap, key in ((abs(lo - t), s << shift), (abs(hi - t), (s + 1) << shift)):
                    if gap < best[i][0]:
                        best[i] = (gap, key)
                if lo < t < hi and best[i][0] > slack and s not in settled:
                    open_steps[s] = lo
        if not open_steps or level == KEY_BITS:
            return sorted(key for _gap, key in best)
        steps, width = open_steps, min(NEXT_BITS, KEY_BITS - level)
        level += width


def shard_of(key: Column, splitters: list[int]) -> Column:
    """Number of splitters at or below the key."""
    return reduce(lambda a, s: a + (key >= F.lit(s)).cast("int"), splitters, F.lit(0))


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 17, carry: tuple[str, ...] = ()) -> DataFrame:
    """Deal documents to ``shards`` shards whose total sizes are near equal.

    Returns doc_id, size (UTF-8 bytes of the text plus 16), text_crc32, shard
    and slot (gapless from 0 in each shard), and the columns named in
    ``carry``, for example the text, in the one exchange.  Other columns of
    ``docs`` are not read, so their names cannot clash.

    Null text has no bytes (size 16, the checksum of the empty text); a null
    doc_id is kept.  Rows equal in every column are dealt apart, as the key
    also holds the row's place in the scan.  An empty table gives no row.
    With fewer rows than shards, some shards stay empty.
    """
    text = F.coalesce("text", F.lit(""))
    narrow = written(
        docs.select(
            "doc_id", *carry, text.alias("__text"), F.monotonically_increasing_id().alias("__uid"),
        ).select(
            "doc_id", *carry, "__uid",
            (F.octet_length("__text") + 16).cast("long").alias("size"),
            F.crc32("__text").alias("text_crc32"),
            F.xxhash64(F.lit(seed), "doc_id", "__text", "__uid").bitwiseAND(F.lit((1 << KEY_BITS) - 1)).alias("__key"),
        ), "shards")
    n, total = narrow.agg(F.count("*"), F.sum("size")).first()
    splitters = find_splitters(narrow, shards, total) if n else []
    # Rows are numbered in runs: a run is one shard's part of an equal step of the key space.
    bits = min(KEY_BITS, max(0, math.ceil(math.log2(max(n, 1) / ROWS_PER_RUN))))
    dealt = narrow.withColumn("shard", shard_of(F.col("__key"), splitters)).withColumn(
        "__run", F.shiftright("__key", KEY_BITS - bits))
    before = Window.partitionBy("shard").orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    runs = dealt.groupBy("shard", "__run").agg(F.count("*").alias("__n")).select(
        "shard", "__run", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    within = Window.partitionBy("shard", "__run").orderBy("__key", "__uid")
    return dealt.join(runs, ["shard", "__run"]).select(
        "doc_id", *carry, "size", "text_crc32", "shard",
        (F.col("__first") + F.row_number().over(within) - 1).alias("slot"))

"""Ledgered ingestion: replays publish once, deliveries again replace, crashes are gone on with."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tabulae.plans import registry as R
from tabulae.sinks import write_table
from tabulae.streaming import ledger as L
from tabulae.streaming.registry import run_ledgered
from test_golden_registry import make_raw

COLS = ["id", "v"]


def put(folder, name, *rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.writelines(f"{a};{b}\n" for a, b in rows)


def rows(spark, root):
    return sorted(tuple(r) for r in L.published(spark, root).select(*COLS).collect())


def test_each_file_is_published_once(spark, tmp):
    landing, root = f"{tmp}/landing", f"{tmp}/root"
    os.makedirs(landing)
    L.ingest_files(spark, landing, root, COLS)       # nothing there yet
    assert L.ledger(spark, root).count() == 0
    for i in range(7):
        put(f"{landing}/d{i % 2}", f"f{i}.csv", (i, "x"))
    put(landing, "x.zip", ("no", "table"))
    L.ingest_files(spark, landing, root, COLS, max_files=2)
    assert rows(spark, root) == [(str(i), "x") for i in range(7)]
    L.ingest_files(spark, landing, root, COLS, max_files=2)
    put(landing, "late.csv", (8, "y"))
    os.utime(f"{landing}/late.csv", (10, 10))        # an old time stamp is no reason to miss it
    L.ingest_files(spark, landing, root, COLS)
    assert rows(spark, root) == [*((str(i), "x") for i in range(7)), ("8", "y")]
    files = L.ledger(spark, root)
    assert files.count() == 8 and files.select("path").distinct().count() == 8


def test_delivery_again(spark, tmp):
    landing, root = f"{tmp}/landing", f"{tmp}/root"
    put(landing, "a.csv", (1, "old"), (2, "old"))
    put(landing, "b.csv", (3, "b"))
    L.ingest_files(spark, landing, root, COLS)
    time.sleep(0.01)
    put(landing, "a.csv", (1, "new"))
    L.ingest_files(spark, landing, root, COLS)       # without overwrite the first delivery stays
    assert rows(spark, root) == [("1", "old"), ("2", "old"), ("3", "b")]
    L.ingest_files(spark, landing, root, COLS, overwrite=True)
    assert rows(spark, root) == [("1", "new"), ("3", "b")]
    put(landing, "a.csv", (1, "newest"), (9, "newest"))
    L.ingest_files(spark, landing, root, COLS, overwrite=True)
    L.ingest_files(spark, landing, root, COLS, overwrite=True)
    assert rows(spark, root) == [("1", "newest"), ("3", "b"), ("9", "newest")]


@pytest.mark.parametrize("at", ["before rows", "between rows and ledger", "after ledger"])
def test_replayed_batch_publishes_once(spark, tmp, monkeypatch, at):
    landing, root = f"{tmp}/landing", f"{tmp}/root"
    for i in range(6):
        put(landing, f"f{i}.csv", (i, "x"))
    calls = []
    write = write_table

    def flaky(df, path, **kw):
        calls.append(path)
        if len(calls) == 3 and at == "before rows" or len(calls) == 4 and at == "between rows and ledger":
            raise RuntimeError("lost")
        write(df, path, **kw)
        if len(calls) == 4 and at == "after ledger":
            raise RuntimeError("lost")

    monkeypatch.setattr(L, "write_table", flaky)
    with pytest.raises(Exception, match="lost"):
        L.ingest_files(spark, landing, root, COLS, max_files=2)
    monkeypatch.setattr(L, "write_table", write)
    finished = rows(spark, root)
    assert 0 < len(finished) < (7 if at == "after ledger" else 6)      # only whole batches are read
    put(landing, "f6.csv", (6, "x"))
    L.ingest_files(spark, landing, root, COLS, max_files=2)
    assert rows(spark, root) == [(str(i), "x") for i in range(7)]
    files = L.ledger(spark, root)
    assert files.count() == files.select("path").distinct().count() == 7


def test_rows_are_joined_only_where_a_delivery_was_replaced(spark, tmp):
    landing, root = f"{tmp}/landing", f"{tmp}/root"
    put(landing, "a.csv", (1, "x"))
    L.ingest_files(spark, landing, root, COLS)
    df = L.published(spark, root)
    df.collect()
    assert "SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString()


def test_register_through_the_ledger(spark, tmp):
    make_raw(f"{tmp}/raw")
    batch = R.run(spark, f"{tmp}/raw", f"{tmp}/batch")
    out = run_ledgered(spark, f"{tmp}/raw", f"{tmp}/batch", f"{tmp}/inc")
    assert out == run_ledgered(spark, f"{tmp}/raw", f"{tmp}/batch", f"{tmp}/inc")      # again: nothing new
    for name, root in out.items():
        want = spark.read.parquet(batch[name])
        got = L.published(spark, root).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
    assert L.published(spark, out["empresas"]).where(F.col("cnpj").isNull()).count() == 0

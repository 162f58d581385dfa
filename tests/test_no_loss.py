"""Inputs that once lost rows, columns or files without an error."""

import os
import time
import zipfile

import pytest

from tabulae.operators.lookups import fits_broadcast
from tabulae.schemas import string_schema
from tabulae.session import ensure_checkpoint_dir
from tabulae.sources.archives import unpack_archives
from tabulae.sources.delimited import scan_header_groups
from tabulae.streaming.ingest import ingest_available


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def test_old_file_delivered_late_is_ingested(spark, tmp):
    src, schema = f"{tmp}/in", string_schema(["a", "b"])
    _write(f"{src}/one.csv", '"1";"x"\n')
    ingest_available(spark, src, schema, f"{tmp}/out", f"{tmp}/ck")
    old = _write(f"{src}/two.csv", '"2";"y"\n')
    os.utime(old, (time.time() - 30 * 86400,) * 2)
    ingest_available(spark, src, schema, f"{tmp}/out", f"{tmp}/ck")
    assert sorted(r["a"] for r in spark.read.parquet(f"{tmp}/out").collect()) == ["1", "2"]


def test_archive_among_the_files_is_not_data(spark, tmp):
    _write(f"{tmp}/in/one.csv", '"1";"x"\n')
    with zipfile.ZipFile(f"{tmp}/in/X.SIMPLES.zip", "w") as z:
        z.writestr("m", "a;b\nc;d\n" * 50)
    ingest_available(spark, f"{tmp}/in", string_schema(["a", "b"]), f"{tmp}/out", f"{tmp}/ck")
    assert [tuple(r) for r in spark.read.parquet(f"{tmp}/out").collect()] == [("1", "x")]


def test_header_of_any_length(spark, tmp):
    names = [f"column_with_a_rather_long_name_to_fill_it_up_beyond_one_megabyte_so_that_it_was_cut_before_{i:07d}" for i in range(11_000)]
    path = _write(f"{tmp}/wide.csv", ",".join(names) + "\n" + ",".join(["1"] * len(names)) + "\n")
    df, = scan_header_groups(spark, [path])
    assert df.columns == names


def test_header_with_a_line_break_in_quotes(spark, tmp):
    path = _write(f"{tmp}/h.csv", 'X,"Y\n2",Z\n1,2,3\n')
    df, = scan_header_groups(spark, [path])
    assert df.columns == ["X", "Y\n2", "Z"] and [tuple(r) for r in df.collect()] == [("1", "2", "3")]


def test_blank_first_line_keeps_the_rows(spark, tmp):
    path = _write(f"{tmp}/b.csv", "\nA,B\n1,2\n3,4\n")
    df, = scan_header_groups(spark, [path])
    assert df.columns == ["A", "B"] and sorted(tuple(r) for r in df.collect()) == [("1", "2"), ("3", "4")]


def test_archives_of_one_name_do_not_overwrite_each_other(spark, tmp):
    for d in ("a", "b"):
        os.makedirs(f"{tmp}/in/{d}")
        with zipfile.ZipFile(f"{tmp}/in/{d}/X.zip", "w") as z:
            z.writestr("m.txt", d)
    paths = [r["path"] for r in unpack_archives(spark, f"{tmp}/in", f"{tmp}/out").collect()]
    assert len(set(paths)) == 2
    assert sorted(open(p.removeprefix("file://").removeprefix("file:")).read() for p in paths) == ["a", "b"]


def test_size_check_sends_no_rows_to_one_task(spark, monkeypatch):
    from tabulae.operators import lookups

    plan = lookups._size_probe(spark.range(1000))._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan and "partial_count" in plan
    assert fits_broadcast(spark.range(10), max_rows=10) and not fits_broadcast(spark.range(11), max_rows=10)


def test_scratch_must_be_shared_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="shared folder"):
        ensure_checkpoint_dir(Session())

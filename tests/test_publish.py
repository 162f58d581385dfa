"""Safe overwrite, write modes, releases and runs that go on where one was stopped."""

import json
import os
import subprocess
import sys
import textwrap
import time

import pytest
from pyspark.sql import functions as F

from tabulae.plans import registry as R
from tabulae.sinks import write_table
from tabulae.sinks.publish import Release, current, read_published
from tabulae.sources.hadoop import children, read_text, write_text
from test_golden_registry import make_raw

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def failing(spark, n=100):
    """Rows of which the last ones cannot be computed."""
    return spark.range(0, n, 1, 4).withColumn("x", F.when(F.col("id") == n - 1, F.raise_error(F.lit("injected"))).otherwise(F.lit("y")))


def test_a_failed_write_leaves_the_old_table(spark, tmp):
    path = f"{tmp}/t"
    write_table(spark.range(5), path)
    with pytest.raises(Exception, match="injected"):
        write_table(failing(spark), path)
    assert ids(spark.read.parquet(path)) == [0, 1, 2, 3, 4]
    assert os.listdir(tmp) == ["t"]        # nothing is left beside it


def test_a_table_can_be_rewritten_from_itself(spark, tmp):
    for fmt, read in (("parquet", spark.read.parquet), ("csv", lambda p: spark.read.option("header", "true").schema("id long").csv(p))):
        path = f"{tmp}/{fmt}"
        write_table(spark.range(5), path, fmt=fmt)
        write_table(read(path).select((F.col("id") + 1).alias("id")), path, fmt=fmt)
        assert ids(read(path)) == [1, 2, 3, 4, 5]


def test_write_modes(spark, tmp):
    path = f"{tmp}/t"
    write_table(spark.range(2), path, mode="errorifexists")
    for mode in ("errorifexists", "error", "default"):
        with pytest.raises(FileExistsError, match="mode='overwrite'"):
            write_table(spark.range(9), path, mode=mode)
    write_table(spark.range(9), path, mode="ignore")
    assert ids(spark.read.parquet(path)) == [0, 1]
    write_table(spark.range(2, 4), path, mode="append")
    assert ids(spark.read.parquet(path)) == [0, 1, 2, 3]
    write_table(spark.range(1), path, mode="overwrite")
    assert ids(spark.read.parquet(path)) == [0]
    with pytest.raises(ValueError, match="unknown write mode"):
        write_table(spark.range(1), path, mode="replace")


def test_dynamic_partition_overwrite_keeps_the_other_partitions(spark, tmp):
    path = f"{tmp}/t"
    write_table(spark.range(6).withColumn("p", F.col("id") % 2), path, partition_by=["p"])
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_table(spark.range(10, 11).withColumn("p", F.lit(0)), path, partition_by=["p"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert ids(spark.read.parquet(path)) == [1, 3, 5, 10]


def test_pointer_is_replaced_in_one_step(spark, tmp):
    path = f"{tmp}/sub/p.json"
    assert read_text(spark, path) is None and children(spark, f"{tmp}/sub") == []
    write_text(spark, path, "één")
    write_text(spark, path, "twee")
    assert read_text(spark, path) == "twee" and children(spark, f"{tmp}/sub") == ["p.json"]


def test_release_is_published_by_its_commit_only(spark, tmp):
    first = Release(spark, tmp, "run 1")
    first.write("a", "a1", lambda: spark.range(1))
    assert current(spark, tmp) is None
    with pytest.raises(FileNotFoundError):
        read_published(spark, tmp, "a")
    first.write("b", "b1", lambda: spark.range(2))
    first.commit()
    assert ids(read_published(spark, tmp, "a")) == [0] and ids(read_published(spark, tmp, "b")) == [0, 1]

    second = Release(spark, tmp, "run 2")
    second.write("a", "a2", lambda: spark.range(10, 12))
    with pytest.raises(Exception, match="injected"):
        second.write("b", "b2", lambda: failing(spark))
    # stopped: readers have the first release, both tables of it
    assert ids(read_published(spark, tmp, "a")) == [0] and ids(read_published(spark, tmp, "b")) == [0, 1]

    again = Release(spark, tmp, "run 2")
    assert again.version == second.version
    again.write("a", "a2", lambda: pytest.fail("a is whole"))
    again.write("b", "b2", lambda: spark.range(20, 22))
    assert again.written == ["b"]
    again.commit()
    assert ids(read_published(spark, tmp, "a")) == [10, 11] and ids(read_published(spark, tmp, "b")) == [20, 21]

    third = Release(spark, tmp, "run 3")
    third.write("a", "a3", lambda: spark.range(3))
    third.write("b", "b2", lambda: pytest.fail("b has not changed"))
    third.commit()
    assert ids(read_published(spark, tmp, "a")) == [0, 1, 2] and ids(read_published(spark, tmp, "b")) == [20, 21]
    # the release before stays for its readers, the one before that is gone
    assert children(spark, f"{tmp}/_versions") == sorted({second.version, third.version})


def test_release_modes_and_other_runs(spark, tmp):
    stopped = Release(spark, tmp, "run 1")
    stopped.write("a", "a1", lambda: spark.range(1))
    other = Release(spark, tmp, "run 2")       # another run does not go on with it
    assert other.version != stopped.version and children(spark, f"{tmp}/_versions") == [other.version]
    other.write("a", "a1", lambda: spark.range(2))
    other.commit()
    with pytest.raises(FileExistsError):
        Release(spark, tmp, "run 3", mode="errorifexists")
    ignored = Release(spark, tmp, "run 3", mode="ignore")
    assert ignored.write("a", "a9", lambda: pytest.fail("ignored")) == other.tables["a"]
    assert ignored.commit() == other.tables and ids(read_published(spark, tmp, "a")) == [0, 1]


def modified(root):
    """Time stamps of all data files below a folder."""
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_register_release_goes_on_and_reuses(spark, tmp, monkeypatch):
    raw, out = f"{tmp}/raw", f"{tmp}/out"
    make_raw(raw)
    plain = R.run(spark, raw, f"{tmp}/plain")
    estab = R.establishments_table
    monkeypatch.setattr(R, "establishments_table", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        R.run(spark, raw, out, release=True)
    assert current(spark, out) is None
    before = modified(out)
    assert before
    monkeypatch.setattr(R, "establishments_table", estab)
    paths = R.run(spark, raw, out, release=True)
    after = modified(out)
    assert {k: after[k] for k in before} == before and len(after) > len(before)      # nothing was written twice
    for name, path in plain.items():
        assert sorted(map(str, spark.read.parquet(path).collect())) == sorted(map(str, read_published(spark, out, f"df_{name}").collect())), name
        assert paths[name] == current(spark, out)["tables"][f"df_{name}"]

    # a run on the same files writes nothing; one more company file rebuilds that table alone
    R.run(spark, raw, out, release=True)
    assert {k: v for k, v in modified(out).items() if k in after} == after
    old = dict(current(spark, out)["tables"])
    source = next(os.path.join(d, f) for d, _, names in os.walk(raw) for f in names if f.endswith("EMPRECSV"))
    os.makedirs(f"{raw}/more")
    with open(source, "rb") as a, open(f"{raw}/more/K9.EMPRECSV", "wb") as b:
        records = b.write(a.read()) and len(a.seek(0) or a.readlines())
    R.run(spark, raw, out, release=True)
    new = current(spark, out)["tables"]
    assert {k for k in old if old[k] != new[k]} == {"df_empresas"}
    assert read_published(spark, out, "df_empresas").count() == records + spark.read.parquet(plain["empresas"]).count()


KILLED = textwrap.dedent('''
    import sys, time
    sys.path.insert(0, {repo!r})
    from tabulae.session import local_session
    from tabulae.sinks import write_table

    def slow(batches):
        for batch in batches:
            time.sleep(0.5)
            yield batch

    spark = local_session(2, 2)
    print("writing", flush=True)
    write_table(spark.range(0, 400, 1, 400).mapInPandas(slow, "id long"), {path!r})
''')


def test_a_killed_writer_leaves_the_old_table(spark, tmp):
    """The whole process is killed in the middle of the write."""
    path = f"{tmp}/t"
    write_table(spark.range(5), path)
    writer = subprocess.Popen([sys.executable, "-c", KILLED.format(repo=REPO, path=path)], stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, start_new_session=True)
    try:
        assert writer.stdout.readline().strip() == b"writing"
        end = time.time() + 60
        while time.time() < end and not any(n.startswith(".t.") for n in os.listdir(tmp)):
            time.sleep(0.2)
        assert any(n.startswith(".t.") for n in os.listdir(tmp))       # it is writing beside the table
    finally:
        os.killpg(writer.pid, 9)
        writer.wait()
    assert ids(spark.read.parquet(path)) == [0, 1, 2, 3, 4]
    write_table(spark.range(2), path)
    assert ids(spark.read.parquet(path)) == [0, 1]


def test_quarantine_of_the_register(spark, tmp):
    raw = f"{tmp}/raw"
    make_raw(raw)
    with open(f"{raw}/F.BAD.D1.PAISCSV", "w", encoding="latin-1") as f:
        f.write('"901";"Terra é"\n"902"\n"903";"x";"y";"z"\n"904;never closed\n')
    out = R.run(spark, raw, f"{tmp}/out", quarantine=True)
    bad = spark.read.parquet(out["malformed"]).where("table = 'pais'")
    assert sorted((r["record"], r["problem"]) for r in bad.collect()) == [
        ('"902"', "short"), ('"903";"x";"y";"z"', "long"), ('"904;never closed', "quotes")]
    assert {r["file"].rsplit("/", 1)[1] for r in bad.collect()} == {"F.BAD.D1.PAISCSV"}
    assert spark.read.parquet(out["pais"]).where("cod_pais between 901 and 904").count() == 3      # kept as far as they could be read


def test_malformed_records_are_counted_while_written(spark, tmp):
    from tabulae.sources.delimited import MALFORMED, count_malformed, scan_delimited

    with open(f"{tmp}/t.csv", "w") as f:
        f.write("1;a\n2\n3;b;c\n4;\"d;e\"\n5;\"say \"\"x;y\"\"\"\n")
    rows, seen = count_malformed(scan_delimited(spark, f"{tmp}/t.csv", ["id", "v"], checked=True))
    write_table(rows.where(F.col(MALFORMED).isNull()).drop(MALFORMED), f"{tmp}/out")
    assert seen.get == {"records": 5, "malformed": 2}
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp}/out").collect()) == [("1", "a"), ("4", "d;e"), ("5", 'say "x;y"')]
    assert json.dumps(seen.get)

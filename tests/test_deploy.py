"""Workers need no installed copy of the package: functions handed to
Python workers are shipped by value.  Run from a directory where the
package cannot be imported from disk."""

import os
import subprocess
import sys
import tempfile
import textwrap

SCRIPT = textwrap.dedent('''
    import sys
    sys.path.insert(0, {repo!r})  # the driver finds the package; workers do not
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
             .config("spark.checkpoint.dir", {ckpt!r}).getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    import __spark_entry__ as E
    q = E.queries()
    print("counts", q["trade_job"](spark, {sf!r}).count(), q["unpack_archives"](spark, {sf!r}).count())
''')


def test_workers_need_no_installed_package(tmp):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    elsewhere = tempfile.mkdtemp(prefix="tabulae-elsewhere-")
    code = SCRIPT.format(repo=repo, ckpt=f"{tmp}/ckpt", sf="/root/testdata/sf0.001")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    proc = subprocess.run([sys.executable, "-c", code], cwd=elsewhere, env=env,
                          capture_output=True, text=True, timeout=600)
    assert proc.returncode == 0, proc.stderr[-3000:]
    line = [ln for ln in proc.stdout.splitlines() if ln.startswith("counts")][-1]
    trade, docs = map(int, line.split()[1:])
    assert trade > 0 and docs == 200


LOAD_BY_PATH = textwrap.dedent('''
    import importlib.util
    spec = importlib.util.spec_from_file_location("entry_mod", {entry!r})
    E = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(E)  # no sys.path change by the caller
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
             .config("spark.checkpoint.dir", {ckpt!r}).getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    print("counts", E.entry(spark).count(), E.queries()["trade_job"](spark, {sf!r}).count())
''')


def test_entry_loaded_by_path_from_elsewhere(tmp):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = LOAD_BY_PATH.format(entry=f"{repo}/__spark_entry__.py", ckpt=f"{tmp}/ckpt", sf="/root/testdata/sf0.001")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    proc = subprocess.run([sys.executable, "-c", code], cwd=tempfile.mkdtemp(prefix="tabulae-elsewhere-"), env=env,
                          capture_output=True, text=True, timeout=600)
    assert proc.returncode == 0, proc.stderr[-3000:]
    entry_rows, trade = map(int, [ln for ln in proc.stdout.splitlines() if ln.startswith("counts")][-1].split()[1:])
    assert entry_rows == 150 and trade > 0

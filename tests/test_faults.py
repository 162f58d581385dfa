"""Task failure: a lost extraction task is re-run and the result is unchanged.

Runs in its own process with ``local[2,4]`` (tasks retried up to 4 times).
"""

import json
import os
import subprocess
import sys
import textwrap
import zipfile

SCRIPT = textwrap.dedent('''
    import json, sys
    sys.path.insert(0, {repo!r})
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
             .config("spark.checkpoint.dir", {ckpt!r}).getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    import tabulae.sources.archives as A

    clean = A._extractor

    def flaky(dest):
        inner = clean(dest)
        def run(batches):
            from pyspark import TaskContext
            ctx = TaskContext.get()
            for out in inner(batches):
                if ctx.attemptNumber() == 0:
                    raise RuntimeError("injected: executor lost after writing")
                yield out
        return run

    A._extractor = flaky
    manifest = A.unpack_archives(spark, {zips!r}, {out!r})
    print(json.dumps(sorted([r.member, r.bytes] for r in manifest.collect())))
''')


def test_lost_extraction_task_is_rerun(tmp):
    os.makedirs(f"{tmp}/zips")
    for i in range(3):
        with zipfile.ZipFile(f"{tmp}/zips/a{i}.zip", "w", zipfile.ZIP_DEFLATED) as zf:
            zf.writestr(f"m{i}.EMPRECSV", f'"{i}";"x"\n' * (1000 * (i + 1)))
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = SCRIPT.format(repo=repo, ckpt=f"{tmp}/ckpt", zips=f"{tmp}/zips", out=f"{tmp}/out")
    proc = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert proc.returncode == 0, proc.stderr[-2000:]
    got = json.loads(proc.stdout.strip().splitlines()[-1])
    assert got == [[f"m{i}.EMPRECSV", len(f'"{i}";"x"\n') * 1000 * (i + 1)] for i in range(3)]
    for i in range(3):
        published = [n for n in os.listdir(f"{tmp}/out/a{i}") if not n.startswith(".")]
        assert f"m{i}.EMPRECSV" in published
        with open(f"{tmp}/out/a{i}/m{i}.EMPRECSV") as fh:
            assert fh.read() == f'"{i}";"x"\n' * (1000 * (i + 1))

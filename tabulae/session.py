"""Session helpers: a test/bench session and a shared scratch location.

Library functions never build their own session; they take the caller's.
Scratch data (staged raw files, archives, stream checkpoints) always lives
under the cluster's ``spark.checkpoint.dir`` so every executor sees it and a
lost executor's work can be recomputed from it.  Only when that setting is
absent (local tests) do we pick a local directory ourselves.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "tabulae") -> SparkSession:
    """A local session for tests and the bench (no UI, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # wide cleaning projections generate methods over HotSpot's 8000-byte
        # JIT limit; let them compile instead of running interpreted
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.executor.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None where there is none (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def parallelism(spark: SparkSession) -> int:
    """Cores the cluster offers (falls back to the shuffle partition count)."""
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    root = spark.conf.get(_CKPT_KEY, None)
    if root:
        return root
    sc = _context(spark)
    if sc is None:
        return None
    return sc.getConf().get(_CKPT_KEY, None) or sc.getCheckpointDir() or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint root, creating a local one only if none is set.

    ``DataFrame.checkpoint`` needs the context's directory set too; it is
    pointed at the configured shared folder when that is known.
    """
    sc = _context(spark)
    root = checkpoint_root(spark)
    if not root:
        master = sc.master if sc is not None else "unknown"
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"{_CKPT_KEY} must name a shared folder: the master is {master}, and a local folder is not seen by every executor")
        root = tempfile.mkdtemp(prefix="tabulae-ckpt-")  # local tests only
        spark.conf.set(_CKPT_KEY, root)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


_SCRATCH_MADE: list[str] = []


def _remove_scratch() -> None:
    """At interpreter exit, delete the scratch folders this process created.

    Nothing outlives the process that made them (a DataFrame cannot leave
    it), so they are only disk space by then.  Best effort: a path that is
    gone or unreachable is skipped.
    """
    from tabulae.sources.fs import filesystem

    while _SCRATCH_MADE:
        uri = _SCRATCH_MADE.pop()
        try:
            fs, path = filesystem(uri)
            fs.delete_dir(path)
        except Exception:  # noqa: BLE001 - cleanup must never fail the exit
            pass


atexit.register(_remove_scratch)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory URI under the shared checkpoint root
    (removed when this Python process exits)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/tabulae-scratch/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH_MADE.append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: computed
    once, its size known to the planner, its lineage cut."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme so Python's own file APIs can use the path."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return uri


def is_local(uri: str) -> bool:
    return uri.startswith("/") or uri.startswith("file:") or os.path.isabs(uri)

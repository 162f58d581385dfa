"""New-files-only ingestion with a ledger of its own.

A run has two steps::

    queue    files in the landing folder that were never queued (or, with
             ``overwrite``, lie there with another size or time stamp) are
             added to <root>/queue, some hundred files to an entry
    drain    a stream over the queue publishes one entry a micro-batch:
             rows to <root>/data/batch=<id>, then the files' names to
             <root>/ledger/batch=<id>

What is new is found by an anti join on the executors, so no map of all files
ever seen is kept by the driver; a micro-batch names at most ``max_files``.
Both folders of a batch are overwritten by its id: a batch that is replayed
after a crash publishes once.  A batch counts when its ledger entry is there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulae.sinks import write_table
from tabulae.sources.delimited import scan_delimited
from tabulae.sources.files import list_files
from tabulae.sources.hadoop import children
from tabulae.session import stored

FILE = "_file"                     # the published rows' source file, not shown to readers
QUEUE = "path string, length long, modified timestamp, slot int"
LEDGER = "path string, length long, modified timestamp, batch long"
MAX_FILES = 500


def _queued(spark: SparkSession, root: str) -> DataFrame:
    if not children(spark, f"{root}/queue"):
        return spark.createDataFrame([], QUEUE)
    return spark.read.schema(QUEUE).option("recursiveFileLookup", "true").parquet(f"{root}/queue")


def queue_new_files(spark: SparkSession, landing: str, root: str, file_glob: str | None = None, overwrite: bool = False,
                    max_files: int = MAX_FILES) -> None:
    """Add the landing folder's files that are not queued yet to the queue.

    A file is its path: it is new when the path never was queued.  With
    ``overwrite`` a queued path whose size or time stamp has changed is new
    again.  Archives are left out.
    """
    found = list_files(spark, landing, name_glob=file_glob).where(~F.lower("name").endswith(".zip")).select(
        "path", "length", F.col("modificationTime").alias("modified"))
    same = ["path", "length", "modified"] if overwrite else ["path"]
    new = stored(found.join(_queued(spark, root).select(*same).distinct(), same, "left_anti"), "new-files")
    n = new.count()
    if n:
        slots = -(-n // max_files)
        # an entry is one file of the queue: the stream takes one a micro-batch
        new.withColumn("slot", F.pmod(F.xxhash64("path"), F.lit(slots)).cast("int")).repartitionByRange(slots, "slot").write.mode(
            "append").option("compression", "zstd").option("maxRecordsPerFile", str(2 * max_files)).parquet(f"{root}/queue")


def drain_queue(spark: SparkSession, root: str, read: Callable[[list[str]], DataFrame]) -> None:
    """Publish every queue entry that is not published yet, one a micro-batch.

    ``read`` makes the rows of some files, with their path in the column FILE.
    """
    def publish(entry: DataFrame, batch: int) -> None:
        paths = sorted(r["path"] for r in entry.select("path").distinct().collect())      # at most an entry's files
        if not paths:
            return
        write_table(read(paths), f"{root}/data/batch={batch}")
        write_table(entry.select("path", "length", "modified"), f"{root}/ledger/batch={batch}")

    if not children(spark, f"{root}/queue"):
        return
    # The source's own record is of queue entries (one for hundreds of files), so it may go back without an end.
    entries = spark.readStream.schema(QUEUE).options(maxFilesPerTrigger="1", maxFileAge="36500d").parquet(f"{root}/queue")
    stream = entries.writeStream.foreachBatch(publish).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    stream.awaitTermination()


def ingest_files(spark: SparkSession, landing: str, root: str, cols: list[str], transform: Callable[[DataFrame], DataFrame] | None = None,
                 file_glob: str | None = None, overwrite: bool = False, max_files: int = MAX_FILES,
                 options: dict[str, str] | None = None, multiline: bool = False) -> None:
    """Publish the landing folder's new delimited files under ``root``.

    ``transform`` is given the raw columns ``cols`` and FILE, and must keep
    FILE.  Run it again after a failure: finished batches are not repeated, an
    unfinished one is.  ``published`` reads the result.
    """
    def read(paths: list[str]) -> DataFrame:
        raw = scan_delimited(spark, paths, cols, options=options, multiline=multiline).withColumn(FILE, F.col("_metadata.file_path"))
        return transform(raw) if transform else raw

    queue_new_files(spark, landing, root, file_glob, overwrite, max_files)
    drain_queue(spark, root, read)


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """The files published so far and the batch of each (LEDGER)."""
    if not children(spark, f"{root}/ledger"):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("basePath", f"{root}/ledger").parquet(f"{root}/ledger")


def published(spark: SparkSession, root: str) -> DataFrame:
    """The published rows: of every file those of its latest delivery.

    Batches without a ledger entry are not read.  Only deliveries that a later
    one replaced are joined against; where none is, rows are not shuffled.
    """
    entries = ledger(spark, root)
    latest = entries.groupBy("path").agg(F.max("batch").alias("latest"))
    replaced = stored(entries.join(latest, "path").where(F.col("batch") < F.col("latest")).select(F.col("path").alias(FILE), "batch"), "replaced")
    rows = spark.read.option("basePath", f"{root}/data").parquet(f"{root}/data").withColumn("batch", F.col("batch").cast("long"))
    rows = rows.join(F.broadcast(entries.select("batch").distinct()), "batch", "left_semi")      # one number for each micro-batch
    return rows.join(replaced, [FILE, "batch"], "left_anti").drop(FILE, "batch")

"""Zip archives as a distributed source: list members, unpack in parallel.

One task per (archive, member): the member is streamed from the archive to
its destination in fixed-size chunks, so memory stays flat whatever the
member size.  Each member is written under a unique temporary name and moved
into place, so a lost, retried or speculative task never leaves a torn file.
Member names are checked: none may leave the destination folder.  File
access goes through ``pyarrow.fs``, which reaches local, HDFS and
object-store paths alike.
"""

from __future__ import annotations

import posixpath
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulae.sources.files import list_files
from tabulae.session import parallelism
from tabulae.sources.fs import filesystem as _fs

CHUNK = 8 << 20  # bytes per copy step

MEMBER_SCHEMA = "archive string, member string, size long"
EXTRACT_SCHEMA = "archive string, member string, path string, bytes long"
PACK_SCHEMA = "source string, archive string, bytes long"


def safe_member(name: str) -> str:
    """The member's relative path, refusing absolute paths and ``..`` escapes."""
    norm = posixpath.normpath(name.replace("\\", "/"))
    if norm.startswith("/") or norm == ".." or norm.startswith("../") or ":" in norm.split("/", 1)[0]:
        raise ValueError(f"archive member escapes the destination: {name!r}")
    return norm


def _hidden_partial(target: str) -> str:
    """A unique temporary name next to ``target`` that starts with a dot:
    Spark's file listing skips such names, so a leftover from a crashed task
    is never read as data, whatever name rule a reader applies."""
    folder, name = target.rsplit("/", 1)
    return f"{folder}/.{name}.partial-{uuid.uuid4().hex}"


def _stem(name: str) -> str:
    return name[:-4] if name.lower().endswith(".zip") else name


def _list_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for uri in pdf["path"]:
            fs, path = _fs(uri)
            with fs.open_input_file(path) as raw, zipfile.ZipFile(raw) as zf:
                rows += [(uri, info.filename, info.file_size) for info in zf.infolist() if not info.is_dir()]
        if rows:
            yield pd.DataFrame(rows, columns=["archive", "member", "size"])


def list_members(spark: SparkSession, archive_root: str, suffix: str = ".zip") -> DataFrame:
    """``(archive, member, size)`` of every archive below ``archive_root``."""
    archives = list_files(spark, archive_root, suffix=suffix).select("path")
    # reading a central directory is cheap: spread over the cluster's cores
    n = parallelism(spark)
    return archives.repartition(n, F.col("path")).mapInPandas(_list_members, MEMBER_SCHEMA)


def _folder(archive: Column, root: str) -> Column:
    """Folder for an archive's members: its place below the root, without its suffix."""
    base = F.lit(root.rstrip("/") + "/")
    at = F.locate(root.rstrip("/") + "/", archive)
    below = F.when(at > 0, F.substring(archive, at + F.length(base), F.length(archive))).otherwise(F.substring_index(archive, "/", -1))
    return F.regexp_replace(below, r"\.[^./]*$", "")


def _extractor(dest_root: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out_fs, out_base = _fs(dest_root)
        for pdf in batches:
            rows = []
            for archive, member, folder in zip(pdf["archive"], pdf["member"], pdf["folder"]):
                in_fs, in_path = _fs(archive)
                relative = safe_member(member)
                target = f"{out_base.rstrip('/')}/{folder}/{relative}"
                out_fs.create_dir(target.rsplit("/", 1)[0], recursive=True)
                written = 0
                # a retried or speculative copy of this task writes its own
                # temporary file; the move publishes only complete members
                partial = _hidden_partial(target)
                with in_fs.open_input_file(in_path) as raw, zipfile.ZipFile(raw) as zf, \
                        zf.open(member) as src, out_fs.open_output_stream(partial) as dst:
                    while chunk := src.read(CHUNK):
                        dst.write(chunk)
                        written += len(chunk)
                out_fs.move(partial, target)
                rows.append((archive, member, f"{dest_root.rstrip('/')}/{folder}/{relative}", written))
            if rows:
                yield pd.DataFrame(rows, columns=["archive", "member", "path", "bytes"])
    return run


def unpack_archives(spark: SparkSession, archive_root: str, dest_root: str, suffix: str = ".zip") -> DataFrame:
    """Unpack every archive into ``dest_root/<archive name>/``, one task per
    member; returns the manifest ``(archive, member, path, bytes)``.

    The manifest is checkpointed to the shared folder, which both runs the
    extraction exactly once and cuts the lineage for readers of the files.
    """
    members = list_members(spark, archive_root, suffix).withColumn(
        "folder", _folder(F.col("archive"), _fs(archive_root)[1])).checkpoint(eager=True)
    # One member per task.  The member list is tiny, so a plain
    # repartition(col) would be coalesced by AQE into a single task; an
    # explicit range partitioning with one range per member is kept as is.
    n = max(1, members.count())
    extracted = (members.repartitionByRange(n, F.col("archive"), F.col("member"))
                 .mapInPandas(_extractor(dest_root), EXTRACT_SCHEMA))
    return extracted.checkpoint(eager=True)


def _packer(dest_root: str, member_suffix: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out_fs, out_base = _fs(dest_root)
        out_fs.create_dir(out_base, recursive=True)
        for pdf in batches:
            rows = []
            for uri in pdf["path"]:
                in_fs, in_path = _fs(uri)
                name = in_path.rsplit("/", 1)[-1]
                stem = name.rsplit(".", 1)[0]
                target = f"{out_base.rstrip('/')}/{stem}.zip"
                partial = _hidden_partial(target)
                with in_fs.open_input_stream(in_path) as src, out_fs.open_output_stream(partial) as raw, \
                        zipfile.ZipFile(raw, "w", compression=zipfile.ZIP_DEFLATED) as zf, \
                        zf.open(stem + member_suffix, "w", force_zip64=True) as dst:
                    while chunk := src.read(CHUNK):
                        dst.write(chunk)
                out_fs.move(partial, target)
                rows.append((uri, f"{dest_root.rstrip('/')}/{stem}.zip", out_fs.get_file_info(target).size))
            if rows:
                yield pd.DataFrame(rows, columns=["source", "archive", "bytes"])
    return run


def pack_files(spark: SparkSession, src_root: str, dest_root: str, suffix: str = ".csv", member_suffix: str = "") -> DataFrame:
    """Zip every ``suffix`` file below ``src_root`` into its own archive
    (member name = file stem + ``member_suffix``), one task per file."""
    files = list_files(spark, src_root, suffix=suffix).select("path").checkpoint(eager=True)
    n = max(1, files.count())
    packed = files.repartitionByRange(n, F.col("path")).mapInPandas(_packer(dest_root, member_suffix), PACK_SCHEMA)
    return packed.checkpoint(eager=True)

"""Publishing several tables as one release.

A published root holds versions and one pointer::

    <root>/_versions/<id>/<table>/...      data, written once
    <root>/_versions/<id>/<table>.json     its fingerprint, written when the table is whole
    <root>/_current.json                   which folder each table is read from

The pointer is replaced last and in one step, so readers see all tables of
the old release or all of the new one, whenever a run stops.  A stopped run
leaves an unfinished version; the next run goes on with it and skips the
tables that are whole and whose inputs are the same.  A table whose inputs did
not change since the published release is not written at all: the new pointer
names its old folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabulae.sinks import check_mode, write_table
from tabulae.sources.hadoop import children, delete, read_text, write_text

POINTER, VERSIONS = "_current.json", "_versions"
KEEP = 2        # releases whose folders stay: readers of the one before can finish


def current(spark: SparkSession, root: str) -> dict | None:
    """The published release: version, tables {name: path} and fingerprints; None if there is none."""
    text = read_text(spark, f"{root}/{POINTER}")
    return json.loads(text) if text else None


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the published release."""
    release = current(spark, root)
    if release is None or table not in release["tables"]:
        raise FileNotFoundError(f"no published table {table!r} under {root}")
    return spark.read.parquet(release["tables"][table])


class Release:
    """One run's release of ``root``; ``commit`` publishes it.

    ``mode`` is as for a table: ``overwrite`` replaces the published release,
    ``errorifexists`` (or ``error``) refuses if there is one, ``ignore`` then
    does nothing.  A run is one of a kind by ``fingerprint``: an unfinished
    version of the same one is taken up, one of another is removed.
    """

    def __init__(self, spark: SparkSession, root: str, fingerprint: str, mode: str = "overwrite"):
        self.spark, self.root = spark, root.rstrip("/")
        self.old = current(spark, self.root)
        self.skip = not check_mode(mode, self.old is not None, self.root)
        self.tables: dict[str, str] = {}
        self.fingerprints: dict[str, str] = {}
        self.written: list[str] = []       # tables that this run wrote itself
        if self.skip:
            return
        folder = f"{self.root}/{VERSIONS}"
        published = set(self.old["kept"]) if self.old else set()
        self.version = None
        for name in children(spark, folder):
            if name in published or name.startswith("."):
                continue
            if read_text(spark, f"{folder}/{name}/run.json") == json.dumps(fingerprint) and self.version is None:
                self.version = name
            else:
                delete(spark, f"{folder}/{name}")
        if self.version is None:
            number = int(self.old["version"].split("-")[0]) + 1 if self.old else 1
            self.version = f"{number:06d}-{uuid.uuid4().hex[:8]}"
            write_text(spark, f"{folder}/{self.version}/run.json", json.dumps(fingerprint))
        self.folder = f"{folder}/{self.version}"

    def write(self, table: str, fingerprint: str, build: Callable[[], DataFrame], **options) -> str:
        """The path of ``table``, built and written unless a whole one with this fingerprint is there."""
        if self.skip:
            return self.old["tables"][table]
        self.fingerprints[table] = fingerprint
        if self.old and self.old["fingerprints"].get(table) == fingerprint:
            self.tables[table] = self.old["tables"][table]
            return self.tables[table]
        path = f"{self.folder}/{table}"
        self.tables[table] = path
        if read_text(self.spark, f"{path}.json") != json.dumps(fingerprint):
            delete(self.spark, path)        # what a stopped run left
            write_table(build(), path, mode="errorifexists", **options)
            write_text(self.spark, f"{path}.json", json.dumps(fingerprint))
            self.written.append(table)
        return path

    def commit(self) -> dict[str, str]:
        """Publish: replace the pointer, then remove versions that nothing needs."""
        if self.skip:
            return dict(self.old["tables"])
        # Tables that this run did not touch stay published as they are.
        tables = {**(self.old["tables"] if self.old else {}), **self.tables}
        fingerprints = {**(self.old["fingerprints"] if self.old else {}), **self.fingerprints}
        used = {p.split(f"/{VERSIONS}/")[-1].split("/")[0] for p in tables.values()}
        before = {p.split(f"/{VERSIONS}/")[-1].split("/")[0] for p in self.old["tables"].values()} if self.old and KEEP > 1 else set()
        kept = sorted(used | before | {self.version})
        write_text(self.spark, f"{self.root}/{POINTER}", json.dumps(
            {"version": self.version, "tables": tables, "fingerprints": fingerprints, "kept": kept}, indent=1))
        for name in children(self.spark, f"{self.root}/{VERSIONS}"):
            if name not in kept:
                delete(self.spark, f"{self.root}/{VERSIONS}/{name}")
        return tables

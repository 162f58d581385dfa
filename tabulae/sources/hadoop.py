"""Small file-system actions through Spark's own Hadoop client, so they work
on every path that Spark can read (metadata only, never table rows)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, uri: str):
    return spark._jvm.org.apache.hadoop.fs.Path(uri)


def _fs(spark: SparkSession, uri: str):
    return _path(spark, uri).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, uri: str) -> bool:
    return _fs(spark, uri).exists(_path(spark, uri))


def children(spark: SparkSession, uri: str) -> list[str]:
    """Names in a folder, sorted ([] if there is none)."""
    if not exists(spark, uri):
        return []
    return sorted(s.getPath().getName() for s in _fs(spark, uri).listStatus(_path(spark, uri)))


def delete(spark: SparkSession, uri: str) -> None:
    _fs(spark, uri).delete(_path(spark, uri), True)


def move(spark: SparkSession, src: str, dst: str) -> None:
    """Rename a file or folder; ``dst`` must not exist."""
    fs = _fs(spark, src)
    fs.mkdirs(_path(spark, dst).getParent())
    if fs.exists(_path(spark, dst)) or not fs.rename(_path(spark, src), _path(spark, dst)):
        raise OSError(f"cannot rename {src} to {dst}")


def read_text(spark: SparkSession, uri: str) -> str | None:
    """A small text file, or None if there is none."""
    if not exists(spark, uri):
        return None
    stream = _fs(spark, uri).open(_path(spark, uri))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, uri: str, text: str) -> None:
    """Replace a small text file in one step: written beside it, then renamed
    over it, so a reader sees the old text or the new one."""
    import uuid

    beside = f"{uri.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.tmp"
    fs = _fs(spark, uri)
    stream = fs.create(_path(spark, beside), True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    options = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, uri).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(_path(spark, beside)), fs.makeQualified(_path(spark, uri)), options)

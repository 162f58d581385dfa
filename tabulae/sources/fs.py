"""Filesystem access from Python for paths Spark also uses (local, HDFS, S3...)."""

from __future__ import annotations


def filesystem(uri: str):
    """``(pyarrow FileSystem, path)`` for a Spark-style path or URI."""
    import pyarrow.fs as pafs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def rename_parts(folder: str, name_fmt: str, suffix: str = "") -> list[str]:
    """Rename the ``part-*`` files Spark wrote in ``folder`` to
    ``name_fmt.format(i)`` (same folder).  Metadata only: files are moved,
    not copied, and the listing is one folder of writer outputs."""
    import pyarrow.fs as pafs

    fs, base = filesystem(folder)
    infos = fs.get_file_info(pafs.FileSelector(base))
    parts = sorted(i.path for i in infos if i.type == pafs.FileType.File and i.base_name.startswith("part-")
                   and i.base_name.endswith(suffix))
    out = []
    for n, src in enumerate(parts):
        dst = f"{base.rstrip('/')}/{name_fmt.format(n)}"
        fs.move(src, dst)
        out.append(dst)
    return out

"""Delimited-text sources: headerless registry files and header CSVs.

The schema is declared, never inferred (no extra pass over the data), and
applied positionally by the CSV reader itself — so columns come out named
even though the files carry no header.  Plain (single-line) CSV stays
splittable: a 100 GB file is read by hundreds of tasks in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tabulae.schemas import REGISTRY_READ_OPTIONS, string_schema
from tabulae.session import parallelism, stored
from tabulae.sources.files import list_files
from tabulae.sources.fs import filesystem

# Writers and readers keep blanks exactly as they are.
MALFORMED = "_malformed"
_KEEP_BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def scan_delimited(
    spark: SparkSession,
    paths: str | list[str],
    cols: list[str],
    options: dict[str, str] | None = None,
    file_glob: str | None = None,
    recursive: bool = False,
    multiline: bool = False,
    checked: bool = False,
) -> DataFrame:
    """Read headerless delimited text as all-string columns ``cols``.

    A record with too few fields has nulls at its end, one with too many
    loses the surplus.  With ``checked`` such records also hold their whole
    text in the column MALFORMED (null for sound ones); ``sound_and_malformed``
    and ``count_malformed`` go on from there.

    ``file_glob`` keeps only files whose *name* matches (e.g. ``*EMPRECSV``);
    with ``recursive`` every directory below ``paths`` is searched, which
    finds the files whether they sit at the root or one directory per
    unpacked archive.
    """
    opts = dict(REGISTRY_READ_OPTIONS if options is None else options)
    opts.update(_KEEP_BLANKS)
    opts["header"] = "false"
    opts["mode"] = "PERMISSIVE"
    if multiline:
        opts["multiLine"] = "true"
    if file_glob:
        opts["pathGlobFilter"] = file_glob
    if recursive:
        opts["recursiveFileLookup"] = "true"
    if checked:
        # a parser that skips fields cannot count them
        opts.update(columnNameOfCorruptRecord=MALFORMED, columnPruning="false")
    schema = string_schema([*cols, MALFORMED] if checked else cols)
    return spark.read.schema(schema).options(**opts).csv(paths if isinstance(paths, list) else [paths])


def count_malformed(checked: DataFrame, name: str = "malformed") -> tuple[DataFrame, Observation]:
    """``checked`` with its record counts observed while it is written.

    After the one action that runs it, ``observation.get`` has ``records`` and
    ``malformed``: the count takes no pass of its own.
    """
    seen = Observation(name)
    return checked.observe(seen, F.count(F.lit(1)).alias("records"), F.count(MALFORMED).alias("malformed")), seen


def malformed_records(checked: DataFrame, cols: list[str], sep: str) -> DataFrame:
    """The records of a checked scan that are not sound: file, first_field, record, problem.

    ``problem`` is ``quotes`` (a quoted field is not closed), ``short`` or
    ``long`` (too few or too many fields).  A last field that is not closed is
    read to the end of its line and has its record sound.
    """
    # quoted fields removed, what is left are the separators between fields; a doubled quote is one sign
    bare = F.regexp_replace(MALFORMED, '"(?:[^"]|"")*+"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + F.lit(1)
    problem = F.when(F.contains(bare, F.lit('"')), "quotes").when(fields < len(cols), "short").when(fields > len(cols), "long").otherwise("other")
    return checked.where(F.col(MALFORMED).isNotNull()).select(
        F.col("_metadata.file_path").alias("file"), F.col(cols[0]).alias("first_field"),
        # Spark refuses to read the text of a record alone: the second column keeps a field in the scan
        F.coalesce(MALFORMED, cols[0]).alias("record"), problem.alias("problem"))


def sound_and_malformed(spark: SparkSession, paths: str | list[str], cols: list[str], **scan) -> tuple[DataFrame, DataFrame]:
    """(sound records as ``cols``, malformed ones as in ``malformed_records``).

    ``scan`` are the arguments of ``scan_delimited``.  Nothing is lost: every
    record is in one of the two.
    """
    checked = scan_delimited(spark, paths, cols, checked=True, **scan)
    sep = {**REGISTRY_READ_OPTIONS, **(scan.get("options") or {})}.get("sep", ",")
    return checked.where(F.col(MALFORMED).isNull()).select(*cols), malformed_records(checked, cols, sep)


def scan_header_csv(
    spark: SparkSession,
    paths: str | list[str],
    cols: list[str] | None = None,
    sep: str = ",",
    encoding: str = "UTF-8",
    multiline: bool = False,
) -> DataFrame:
    """Read header CSV as strings; ``cols`` keeps only the named columns.

    No ``inferSchema``: types are decided by the cleaners, not by a sampling
    pass over the data.
    """
    opts = {"header": "true", "sep": sep, "encoding": encoding, "quote": '"', "escape": '"', **_KEEP_BLANKS}
    if multiline:
        opts["multiLine"] = "true"
    df = spark.read.options(**opts).csv(paths if isinstance(paths, list) else [paths])
    return df.select(*cols) if cols else df


def csv_to_parquet(spark: SparkSession, src: str | list[str], dst: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Convert header CSV to parquet (overwrite) and return the parquet table."""
    from tabulae.sinks import write_table

    write_table(scan_header_csv(spark, src, sep=sep, encoding=encoding), dst)
    return spark.read.parquet(dst)


# --- header files in groups --------------------------------------------------

HEADER_SCHEMA = "path string, header string"
_CHUNK = 1 << 16


def first_record(stream, encoding: str) -> str:
    """The first record that is not a blank line, of any length; a line break
    within quotes belongs to it."""
    data, end = b"", -1
    while True:
        chunk = stream.read(_CHUNK)
        data = (data + chunk).lstrip(b"\r\n") if end < 0 else data
        line = data.removeprefix(b"\xef\xbb\xbf")
        while line[:1] in (b"\r", b"\n"):
            data = line = line.lstrip(b"\r\n")
        end = data.find(b"\n")
        while end >= 0 and data.count(b'"', 0, end) % 2:
            end = data.find(b"\n", end + 1)
        if end >= 0 or not chunk:
            break
        end = -1
    record = data[:end] if end >= 0 else data
    # exports often start with a byte-order mark: not part of the name
    return record.rstrip(b"\r\n").decode(encoding).lstrip("\ufeff")


def _header_reader(encoding: str):
    def run(batches):
        import pandas as pd

        for pdf in batches:
            out = []
            for uri in pdf["path"]:
                fs, path = filesystem(uri)
                with fs.open_input_stream(path) as fh:
                    out.append((uri, first_record(fh, encoding)))
            yield pd.DataFrame(out, columns=["path", "header"])
    return run


def read_headers(spark: SparkSession, paths: list[str], encoding: str = "UTF-8") -> dict[str, str]:
    """Header record of every file, read in parallel (one small task per chunk
    of files).  Returns ``{path: header}``; a file without records has ``""``."""
    if not paths:
        return {}
    n = max(1, min(len(paths), parallelism(spark)))
    listing = spark.createDataFrame([(p,) for p in paths], "path string").repartition(n)
    rows = listing.mapInPandas(_header_reader(encoding), HEADER_SCHEMA).collect()  # one row per file
    return {r["path"]: r["header"] for r in rows}


def header_names(header: str, sep: str = ",") -> list[str]:
    import csv

    return next(csv.reader(header.splitlines(keepends=True), delimiter=sep, quotechar='"'))


def _picked(parsed: Column, names: list[str], cols: list[str]) -> Column:
    """``cols`` of a parsed record, and whether any field holds something; parsed once."""
    return F.transform(F.array(parsed), lambda p: F.struct(
        F.coalesce(*(p[n] for n in names)).isNotNull().alias("any"), *(p[c].alias(c) for c in cols)))[0]


_TEXT_ENCODINGS = ("UTF-8", "ISO-8859-1", "US-ASCII")     # those that end a line by the byte of a line feed


def scan_by_header(
    spark: SparkSession,
    root: str,
    cols: list[str],
    sep: str = ",",
    encoding: str = "UTF-8",
    contains: str | None = None,
    drop_empty: bool = False,
) -> DataFrame:
    """``cols`` of all header CSV files under ``root``, whatever their layouts.

    Every file's header is read on the executors and stays there; the driver
    learns the distinct headers, to plan one parser for each.  One splittable
    scan reads the lines of all files, and a line is parsed by its file's
    header.  ``contains`` keeps files with that text in their names; archives
    are left out.  ``drop_empty`` drops records whose fields are all null, as
    judged on every column the file has.  A line equal to its file's header
    is none of its records.  Records are lines: for line breaks in quotes
    read the files with ``scan_header_groups``.
    """
    if encoding.upper() not in _TEXT_ENCODINGS:
        raise ValueError(f"lines of {encoding} text cannot be read in parts; choose one of {_TEXT_ENCODINGS}")
    files = list_files(spark, root, contains=contains).where(~F.lower("name").endswith(".zip")).select("path")
    headers = stored(files.repartition(parallelism(spark)).mapInPandas(_header_reader(encoding), HEADER_SCHEMA).where(F.trim("header") != ""), "headers")
    layouts = sorted(r["header"] for r in headers.select("header").distinct().collect())     # a row for each layout
    for header in layouts:
        missing = [c for c in cols if c not in header_names(header, sep)]
        if missing or "\n" in header:
            raise ValueError(f"header {header!r} under {root} " + (f"lacks the columns {missing}" if missing else "has a line break"))
    if not layouts:
        return spark.createDataFrame([], string_schema(cols))
    from tabulae.operators.lookups import fits_broadcast

    value = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding.upper())
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{contains}*" if contains else "*").text(root).select(
        F.col("_metadata.file_path").alias("path"), F.regexp_replace(value, "^\ufeff", "").alias("line"))
    known = headers.withColumn("layout", F.array_position(F.array(*map(F.lit, layouts)), F.col("header")))
    known = F.broadcast(known) if fits_broadcast(known) else known
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", **_KEEP_BLANKS}
    records = None
    for i, header in enumerate(layouts, start=1):
        names = header_names(header, sep)
        parsed = F.from_csv("line", ", ".join(f"`{n}` STRING" for n in names), options)
        picked = _picked(parsed, names, cols)
        records = F.when(F.col("layout") == i, picked) if records is None else records.when(F.col("layout") == i, picked)
    rows = lines.join(known, "path").where((F.col("line") != F.col("header")) & (F.trim("line") != "")).select(records.alias("r"))
    return (rows.where("r.any") if drop_empty else rows).select(*(F.col("r")[c].alias(c) for c in cols))


def scan_header_groups(
    spark: SparkSession,
    paths: list[str],
    sep: str = ",",
    encoding: str = "UTF-8",
    multiline: bool = False,
) -> list[DataFrame]:
    """Header CSV files, one scan per distinct header.

    Files sharing a header are read by a single scan with an explicit
    all-string schema (no per-file inference job); each file's own header
    line is skipped.  Files whose columns differ (order or set) land in
    different scans, to be stacked by name.
    """
    groups: dict[str, list[str]] = {}
    for path, header in read_headers(spark, paths, encoding).items():
        if header.strip():  # an empty file has no header and no rows
            groups.setdefault(header, []).append(path)
    out = []
    for header, group in sorted(groups.items()):
        opts = {"header": "true", "sep": sep, "encoding": encoding, "quote": '"', "escape": '"', **_KEEP_BLANKS}
        if multiline or "\n" in header:
            opts["multiLine"] = "true"
        schema = string_schema(header_names(header, sep))
        out.append(spark.read.schema(schema).options(**opts).csv(sorted(group)))
    return out

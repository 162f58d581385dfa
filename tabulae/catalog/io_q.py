"""Sources, sinks and file-level jobs: whole test tables written out in the
raw formats under the shared scratch folder, then read back by the library.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulae.catalog import registry_q
from tabulae.catalog.standin import Standin, table
from tabulae.operators.columns import preview
from tabulae.operators.ingest import new_only
from tabulae.operators.links import base_name, link_manifest, registry_manifest, trade_manifest, year_filter
from tabulae.session import scratch_path
from tabulae.sinks import write_delimited, write_table
from tabulae.sources.delimited import csv_to_parquet, scan_delimited, scan_header_csv
from tabulae.sources.files import list_files

Q: dict = {}


def reg(name, sql=None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]
DOC_SQL = ("SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars "
           "FROM documents")


def _documents(spark, sf):
    return table(spark, sf, "documents").select(*[F.col(c).cast("string").alias(c) for c in DOC_COLS])


@reg("scan_headerless", DOC_SQL)
def q_scan_headerless(spark, sf):
    path = scratch_path(spark, "raw-documents")
    write_delimited(_documents(spark, sf), path)  # ';' ISO-8859-1, no header
    return scan_delimited(spark, path, DOC_COLS, multiline=True)


@reg("scan_glob", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents")
def q_scan_glob(spark, sf):
    path = scratch_path(spark, "raw-documents-parts")
    write_delimited(_documents(spark, sf), path, partition_by=["lang"])  # one directory per part
    return scan_delimited(spark, path, ["doc_id", "text", "source", "n_chars"], file_glob="part-*",
                          recursive=True, multiline=True)


@reg("scan_quoted", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, concat('\"', text, '\\') AS text FROM documents")
def q_scan_quoted(spark, sf):
    path = scratch_path(spark, "raw-quoted")
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"),
                                                F.concat(F.lit('"'), "text", F.lit("\\")).alias("text"))
    write_delimited(docs, path)
    return scan_delimited(spark, path, ["doc_id", "text"], multiline=True)


PART_SQL = "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name FROM part"


def _part_csv(spark, sf):
    path = scratch_path(spark, "header-part")
    part = table(spark, sf, "part").select(*[F.col(c).cast("string").alias(c) for c in
                                             ("p_partkey", "p_name", "p_brand", "p_type", "p_size")])
    write_delimited(part, path, sep=";", encoding="UTF-8", header=True)
    return path


@reg("scan_header_csv", PART_SQL)
def q_scan_header_csv(spark, sf):
    return scan_header_csv(spark, _part_csv(spark, sf), ["p_partkey", "p_name"], sep=";")


@reg("csv_to_parquet", PART_SQL)
def q_csv_to_parquet(spark, sf):
    out = scratch_path(spark, "part-parquet")
    return csv_to_parquet(spark, _part_csv(spark, sf), out, sep=";").select("p_partkey", "p_name")


@reg("discover_files", "SELECT DISTINCT lang FROM documents")
def q_discover_files(spark, sf):
    path = scratch_path(spark, "by-lang")
    # every task writes its own file per language folder: no funnel through
    # one task for a dominant language
    write_delimited(_documents(spark, sf), path, partition_by=["lang"])
    files = list_files(spark, path, suffix=".csv", contains="part-")
    return files.select(F.regexp_extract("path", r"lang=([^/]+)/", 1).alias("lang")).distinct()


@reg("sink_parquet", registry_q.SQL_REGISTRY_COMPANIES)
def q_sink_parquet(spark, sf):
    path = scratch_path(spark, "df_empresas")
    df = registry_q.q_registry_companies(spark, sf)
    write_table(df, path)
    write_table(df, path)  # a re-run overwrites instead of failing
    return spark.read.parquet(path)


@reg("sink_csv", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang FROM documents")
def q_sink_csv(spark, sf):
    path = scratch_path(spark, "documents-csv")
    write_table(table(spark, sf, "documents").select("doc_id", "text", "lang"), path, fmt="csv")
    return scan_header_csv(spark, path, multiline=True)


# which rows a preview shows is open, so: how many it shows, and how many of them are not the table's
@reg("preview_limit", "SELECT least(count(*), 5) AS n_rows, CAST(0 AS BIGINT) AS n_strangers FROM orders")
def q_preview_limit(spark, sf):
    df = registry_q.q_registry_simples(spark, sf)
    both = preview(df, 5).withColumns({"shown": F.lit(1), "held": F.lit(0)}).unionByName(
        df.withColumns({"shown": F.lit(0), "held": F.lit(1)}))
    rows = both.groupBy(*df.columns).agg(F.sum("shown").alias("shown"), F.sum("held").alias("held"))
    return rows.agg(F.sum("shown").alias("n_rows"), F.sum(F.greatest(F.col("shown") - F.col("held"), F.lit(0))).alias("n_strangers"))


@reg("ingest_new_only", "SELECT d.doc_id, d.lang, d.source FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id")
def q_ingest_new_only(spark, sf):
    return new_only(table(spark, sf, "documents").select("doc_id", "lang", "source"), table(spark, sf, "labels"), "doc_id")


@reg("link_manifest", "SELECT page_id, unnest(regexp_extract_all(html, "
                      "'(?i)<a\\s(?:[^>]*?\\s)?href=[\"'']([^\"'']+)[\"'']', 1)) AS link FROM pages")
def q_link_manifest(spark, sf):
    return link_manifest(table(spark, sf, "pages"), keep=["page_id"])


def _index_html(group: str, everywhere: str) -> str:
    """Pages whose links to words with t are yearly files and with w are archives."""
    mun = f"""regexp_replace(html, 'href="/(t[a-z]*)"', concat('href="/mun/EXP_', CAST(2010 + page_id % 20 AS STRING), '_{group}.csv"'){everywhere})"""
    return f"""regexp_replace({mun}, 'href="/(w[a-z]*)"', 'href="/reg/{group}.zip"'{everywhere})"""


INDEX = Standin("pages", [("page_id", "page_id"), ("html", (_index_html("$1", ""), _index_html("\\1", ", 'g'")))])
_LINKS_SQL = (f"SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\\s(?:[^>]*?\\s)?href=[\"'']([^\"'']+)[\"'']', 1)) AS link "
              f"FROM ({INDEX.sql()}) i")


@reg("manifest_trade", f"""SELECT * FROM (SELECT page_id, link, regexp_extract(link, 'mun/(.+)', 1) AS name,
  TRY_CAST(regexp_extract(link, 'mun/.*?([0-9]{{4}})', 1) AS INTEGER) AS year FROM ({_LINKS_SQL}) l
  WHERE link LIKE '%.csv' AND contains(link, 'mun')) m WHERE year BETWEEN 2016 AND 2021""")
def q_manifest_trade(spark, sf):
    return trade_manifest(INDEX.df(spark, sf), keep=["page_id"])


@reg("manifest_registry", f"""SELECT page_id, link, regexp_extract(link, '([^/]+)$', 1) AS name FROM ({_LINKS_SQL}) l
  WHERE link LIKE '%.zip'""")
def q_manifest_registry(spark, sf):
    return registry_manifest(INDEX.df(spark, sf), keep=["page_id"])


@reg("year_filter", "SELECT page_id, url, year FROM (SELECT page_id, url, TRY_CAST(regexp_extract(url, '[0-9]{3}', 0) AS INTEGER) "
                    "AS year FROM pages) p WHERE year BETWEEN 200 AND 700")
def q_year_filter(spark, sf):
    return year_filter(table(spark, sf, "pages").select("page_id", "url"), "url", 200, 700, digits=3)


@reg("base_name", "SELECT page_id, regexp_extract(url, 'example\\.[a-z]+/(.+)', 1) AS base FROM pages")
def q_base_name(spark, sf):
    return table(spark, sf, "pages").select("page_id", base_name("url", r"example\.[a-z]+/").alias("base"))

"""Re-aimed jobs on whole test tables: tiered match, archive unpacking,
new-files-only streaming ingestion."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulae import schemas as S
from tabulae.catalog import registry_q as RQ
from tabulae.catalog.io_q import DOC_COLS, DOC_SQL, _documents
from tabulae.catalog.standin import Standin
from tabulae.operators.match import Tier, address_tiers, tiered_match
from tabulae.plans import registry as R
from tabulae.schemas import string_schema
from tabulae.session import scratch_path
from tabulae.sinks import write_delimited
from tabulae.sources.archives import pack_files, unpack_archives
from tabulae.sources.records import scan_records
from tabulae.streaming.ingest import ingest_available

Q: dict = {}

# --- R1: customers matched to supplier "addresses" in three tiers -----------
GAZ = Standin("supplier", [
    ("id", "s_suppkey"),
    ("g_nation", "s_nationkey"),
    ("g_band", "CAST(floor(s_acctbal / 1000) AS BIGINT)"),
    ("address", "CASE WHEN s_suppkey % 5 = 0 THEN 'road 1' ELSE concat('road 1, city ', lpad(CAST(s_nationkey AS STRING), 3, '0')) END"),
    ("g_city", "concat('city ', lpad(CAST(s_nationkey AS STRING), 3, '0'))"),
    ("score", "CAST(s_suppkey % 41 + 60 AS INT)"),
    ("quality", "CASE s_suppkey % 3 WHEN 0 THEN 'PointAddress' WHEN 1 THEN 'StreetAddress' ELSE 'Locality' END"),
    ("lat", "s_acctbal / 100"),
    ("lng", "CAST(s_suppkey AS DOUBLE) / 7"),
])
CUST = Standin("customer", [
    ("c_custkey", "c_custkey"),
    ("k_nation", "c_nationkey"),
    ("k_band", "CAST(floor(c_acctbal / 1000) AS BIGINT)"),
])


def q_tiered_match(spark, sf):
    street, quarter, _code = address_tiers({"municipio": "g_city"})  # the accept rules of the shipped preset
    tiers = [
        Tier({"k_nation": "g_nation", "k_band": "g_band"}, street.accept),
        Tier({"k_nation": "g_nation"}, quarter.accept),
        Tier({"k_band": "g_band"}),
    ]
    return tiered_match(CUST.df(spark, sf), GAZ.df(spark, sf), tiers, ["lat", "lng"], [-F.col("score"), F.col("id")])


def _best(keys: str, where: str, alias: str) -> str:
    return (f"{alias} AS (SELECT {keys}, lat, lng FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
            f"ORDER BY score DESC, id) AS rn FROM g WHERE {where}) x WHERE rn = 1)")


SQL_TIERED = f"""
WITH g AS ({GAZ.sql()}), c AS ({CUST.sql()}),
{_best('g_nation, g_band', "contains(address, g_city) AND (score = 100 OR (score >= 80 AND quality IN ('PointAddress', 'StreetAddress')))", 't1')},
{_best('g_nation', "contains(address, g_city) AND score >= 80", 't2')},
{_best('g_band', 'TRUE', 't3')},
m AS (
  SELECT c.*, CASE WHEN t1.lat IS NOT NULL THEN 1 WHEN t2.lat IS NOT NULL THEN 2 WHEN t3.lat IS NOT NULL THEN 3 END AS tier,
         t1.lat AS lat1, t1.lng AS lng1, t2.lat AS lat2, t2.lng AS lng2, t3.lat AS lat3, t3.lng AS lng3
  FROM c LEFT JOIN t1 ON c.k_nation = t1.g_nation AND c.k_band = t1.g_band
         LEFT JOIN t2 ON c.k_nation = t2.g_nation
         LEFT JOIN t3 ON c.k_band = t3.g_band)
SELECT c_custkey, k_nation, k_band,
       CASE tier WHEN 1 THEN lat1 WHEN 2 THEN lat2 WHEN 3 THEN lat3 END AS lat,
       CASE tier WHEN 1 THEN lng1 WHEN 2 THEN lng2 WHEN 3 THEN lng3 END AS lng,
       tier
FROM m
"""
Q["tiered_match"] = (q_tiered_match, SQL_TIERED)


# --- R6: documents -> raw files -> zip archives -> unpacked -> scanned ----------
ARCHIVED_BYTES = 64 << 20      # text of one archive, about


def q_unpack_archives(spark, sf):
    raw = scratch_path(spark, "to-pack")
    docs = _documents(spark, sf)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    write_delimited(docs.repartition(max(4, -(-size // ARCHIVED_BYTES))), raw)
    archives = scratch_path(spark, "archives")
    pack_files(spark, raw, archives, suffix=".csv", member_suffix=".DOCSCSV")
    dest = scratch_path(spark, "unpacked")
    unpack_archives(spark, archives, dest)
    # a member of any size is read by many tasks
    return scan_records(spark, dest, DOC_COLS, file_glob="*DOCSCSV", recursive=True)


Q["unpack_archives"] = (q_unpack_archives, DOC_SQL)


# --- R5 as a stream: three deliveries, each ingested exactly once ---------------
def q_ingest_stream(spark, sf):
    landing = scratch_path(spark, "landing")
    sink = scratch_path(spark, "ingested")
    ckpt = scratch_path(spark, "ingest-ckpt")
    docs = _documents(spark, sf)
    # one delivery per language (a handful of values), each ingested on arrival;
    # together they are the whole table
    langs = sorted(r["lang"] for r in docs.select("lang").distinct().collect())
    for n, lang in enumerate(langs):
        write_delimited(docs.where(F.col("lang") == lang), f"{landing}/delivery={n}")
        ingest_available(spark, landing, string_schema(DOC_COLS), sink, ckpt, multiline=True)
    return spark.read.parquet(sink).select(*DOC_COLS)


Q["ingest_stream"] = (q_ingest_stream, DOC_SQL)


# --- R5 + C3 as a stream: deliveries of raw company rows cleaned on arrival ---
def q_ingest_stream_companies(spark, sf):
    landing = scratch_path(spark, "landing-companies")
    sink = scratch_path(spark, "companies-stream")
    ckpt = scratch_path(spark, "companies-ckpt")
    natju, quals = RQ.codes(spark, sf, "nation", "natju"), RQ.codes(spark, sf, "region", "quals")
    raw = RQ.COMPANIES.df(spark, sf)
    # one delivery per company-size code ("0".."5" in the stand-in): the whole table
    for n, size in enumerate(["0", "1", "2", "3", "4", "5"]):
        write_delimited(raw.where(F.col("porte") == size), f"{landing}/delivery={n}")
        # stream-static joins: the code tables are checked and broadcast as in batch
        ingest_available(spark, landing, string_schema(S.COMPANY_COLS), sink, ckpt,
                         transform=lambda s: R.companies_table(s, natju, quals))
    return spark.read.parquet(sink)


Q["ingest_stream_companies"] = (q_ingest_stream_companies, RQ.SQL_REGISTRY_COMPANIES)

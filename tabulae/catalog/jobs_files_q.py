"""The two file-level jobs end to end: stand-in raw files are staged in the
true raw layouts under the shared folder, the job runs on them, and every
published table is read back: its rows are counted and its values summed up
in a checksum."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulae import schemas as S
from tabulae.catalog import registry_q as RQ
from tabulae.catalog import trade_q as TQ
from tabulae.catalog.sqlgen import s_digest
from tabulae.plans import registry as R
from tabulae.plans import trade as T
from tabulae.session import scratch_path
from tabulae.sinks import write_delimited
from tabulae.sources.fs import rename_parts

# the same tables by published name, in the order they are published
_CODES = {S.CODE_TABLES[m]: t for m, t in RQ.CODE_SOURCES.items()}


def _stage(df, folder: str, name_fmt: str, **opts) -> None:
    write_delimited(df, folder, **opts)
    rename_parts(folder, name_fmt, suffix=".csv")


def digest(name: str, df: DataFrame) -> DataFrame:
    """One row: table name, rows, and an order-free checksum of all columns."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in df.columns])
    part = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(part), F.lit(0)).cast("long").alias("checksum")).select(
        F.lit(name).alias("published"), "n_rows", "checksum")


def _digests(spark, paths: dict[str, str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [digest(name, spark.read.parquet(path)) for name, path in paths.items()])


def stage_register(spark, sf, raw: str) -> None:
    """Stand-ins of all raw register files under ``raw``."""
    for marker, tbl in RQ.CODE_SOURCES.items():
        name = RQ.S.CODE_TABLES[marker]
        _stage(RQ._code_standin(tbl, name).df(spark, sf), f"{raw}/codes-{marker}", "F.K03200$Z.D10710.{:03d}." + marker + "CSV")
    _stage(RQ.SIMPLES.df(spark, sf), f"{raw}/simples", "F.K03200$W.SIMPLES.CSV.D10911.{:03d}")
    for st, marker in ((RQ.COMPANIES, "EMPRECSV"), (RQ.PARTNERS, "SOCIOCSV"), (RQ.ESTAB, "ESTABELECSV")):
        _stage(st.df(spark, sf), f"{raw}/K3241.K03200Y0.D10710.{marker}", "K3241.K03200Y{:03d}.D10710." + marker)


def q_registry_job(spark, sf):
    raw, out = scratch_path(spark, "registry-raw"), scratch_path(spark, "registry-trusted")
    stage_register(spark, sf, raw)
    paths = R.run(spark, raw, out)
    return _digests(spark, paths)


def q_trade_job(spark, sf):
    raw, out = scratch_path(spark, "trade-raw"), scratch_path(spark, "trade-out")
    opts = dict(sep=",", encoding="UTF-8", header=True)
    for flow, flag in (("EXP", "A"), ("IMP", "R")):
        _stage(TQ.fact_standin(flag, "F").df(spark, sf), f"{raw}/mun/{flow}_F", flow + "_{:03d}_F_MUN.csv", **opts)
        _stage(TQ.fact_standin(flag, "O", reverse=True).df(spark, sf), f"{raw}/mun/{flow}_O", flow + "_{:03d}_O_MUN.csv", **opts)
    # the third return flag is one more export "year" (same header as the first file)
    _stage(TQ.fact_standin("N").df(spark, sf), f"{raw}/mun/EXP_N", "EXP_{:03d}_N_MUN.csv", **opts)
    write_delimited(TQ.MUN.df(spark, sf), f"{raw}/aux_tables/UF_MUN.csv", **opts)
    write_delimited(TQ.PAIS.df(spark, sf), f"{raw}/aux_tables/PAIS.csv", **opts)
    prod = TQ.PROD.df(spark, sf)
    write_delimited(prod.unionByName(prod), f"{raw}/aux_tables/NCM_SH.csv", **opts)
    # headings are cut to six digits: of a million products and more, some share one
    paths = T.run(spark, raw, out, repeated=("SH4",))
    return _digests(spark, paths)


_REGISTRY = {name: (RQ._code_sql(t, name), [f"cod_{name}", f"nome_{name}"]) for name, t in _CODES.items()} | {
    "simples": (RQ.SQL_REGISTRY_SIMPLES, S.SIMPLES_COLS),
    "empresas": (RQ.companies_sql(natju="nation", quals="nation"), S.COMPANY_OUT),
    "socios": (RQ.SQL_REGISTRY_PARTNERS, S.PARTNER_OUT),
    "estab": (RQ.SQL_REGISTRY_ESTABLISHMENTS, S.ESTAB_OUT),
}
_TRADE = {
    "exp": TQ._flow_sql([TQ.fact_standin("A", "F"), TQ.fact_standin("A", "O", True), TQ.fact_standin("N")]),
    "imp": TQ._flow_sql([TQ.fact_standin("R", "F"), TQ.fact_standin("R", "O", True)]),
}

QUERIES = {
    "registry_job": (q_registry_job, " UNION ALL ".join(s_digest(n, sql, cols) for n, (sql, cols) in _REGISTRY.items())),
    "trade_job": (q_trade_job, " UNION ALL ".join(s_digest(n, sql, S.TRADE_OUT) for n, sql in _TRADE.items())),
}

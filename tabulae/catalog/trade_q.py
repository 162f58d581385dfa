"""Trade pipelines on stand-ins: lineitem as fact files, supplier / nation /
part (duplicated to a finer grain) as the three lookup files."""

from __future__ import annotations

from tabulae import schemas as S
from tabulae.catalog.sqlgen import s_int, s_trim, s_trim_translit
from tabulae.catalog.standin import Standin
from tabulae.plans import trade as T

STR = "STRING"


def _null_row(e: str) -> str:
    # every 97th order's rows are entirely empty (dropped by the all-null filter)
    return f"CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE {e} END"


_FACT_EXPRS = [
    ("CO_ANO", f"CAST(year(l_shipdate) AS {STR})"),
    ("CO_MES", f"lpad(CAST(month(l_shipdate) AS {STR}), 2, '0')"),
    ("SH4", f"CAST(l_partkey AS {STR})"),
    ("CO_PAIS", f"CAST(l_orderkey % 30 AS {STR})"),
    ("SG_UF_MUN", "concat('U', l_linestatus)"),
    ("CO_MUN", f"CAST(l_suppkey AS {STR})"),
    ("KG_LIQUIDO", f"CAST(CAST(l_quantity AS BIGINT) AS {STR})"),
    ("VL_FOB", f"CAST(CAST(round(l_extendedprice) AS BIGINT) AS {STR})"),
    ("CO_UNIDADE", "'10'"),
]


def fact_standin(flag: str, status: str | None = None, reverse: bool = False) -> Standin:
    """One "file": the lineitem rows of a return flag (and line status)."""
    cols = [(n, _null_row(e)) for n, e in _FACT_EXPRS]
    if reverse:  # a later file with its columns in another order
        cols = cols[::-1]
    where = f"l_returnflag = '{flag}'" + (f" AND l_linestatus = '{status}'" if status else "")
    return Standin("lineitem", cols, where=where)


MUN = Standin("supplier", [("CO_MUN_GEO", f"CAST(s_suppkey AS {STR})"), ("NO_MUN_MIN", "concat(' ', s_name, ' ')")])
PAIS = Standin("nation", [("CO_PAIS", f"CAST(n_nationkey AS {STR})"), ("NO_PAIS", "concat(n_name, '  ')")])
PROD = Standin("part", [
    ("CO_SH4", f"lpad(CAST(p_partkey AS {STR}), 6, '0')"),
    ("NO_SH4_POR", "concat(' ', p_name)"),
    ("CO_SH2", "p_brand"),
    ("NO_SH2_POR", "concat(p_type, ' ')"),
    ("CO_NCM_SECROM", f"CAST(p_size AS {STR})"),
    ("NO_SEC_POR", f"concat(' sec ', CAST(p_size AS {STR}))"),
])


def lookups(spark, sf):
    prod_raw = PROD.df(spark, sf)
    prod_raw = prod_raw.unionByName(prod_raw)  # one row per NCM code: finer than SH4
    return T.municipalities(MUN.df(spark, sf)), T.countries(PAIS.df(spark, sf)), T.products(prod_raw)


def _flow(spark, sf, flag: str):
    files = [fact_standin(flag, "F").df(spark, sf), fact_standin(flag, "O", reverse=True).df(spark, sf)]
    return T.flow(files, *lookups(spark, sf))


def q_trade_flow_exp(spark, sf):
    return _flow(spark, sf, "A")


def q_trade_flow_imp(spark, sf):
    return _flow(spark, sf, "R")


def q_trade_file(spark, sf):
    # one file: all rows of the third return flag (A and R make the two flows)
    return T.flow([fact_standin("N").df(spark, sf)], *lookups(spark, sf))


def q_trade_dims(spark, sf):
    return lookups(spark, sf)[2]


_PROD_SQL = f"""SELECT DISTINCT CO_SH4 AS SH4, {s_trim('NO_SH4_POR')} AS nome_sh4, CO_SH2 AS SH2,
  {s_trim('NO_SH2_POR')} AS nome_sh2, CO_NCM_SECROM AS secao, {s_trim('NO_SEC_POR')} AS nome_secao
  FROM ({PROD.sql()} UNION ALL {PROD.sql()}) p"""


def _flow_sql(parts: list[Standin]) -> str:
    cols = [n for n, _ in _FACT_EXPRS]
    stacked = " UNION ALL ".join(f"SELECT {', '.join(cols)} FROM ({p.sql()}) x" for p in parts)
    return f"""
WITH raw AS ({stacked}),
f AS (
  SELECT {s_int('CO_ANO')} AS ano, {s_int('CO_MES')} AS mes, {s_int('CO_MUN')} AS cod_municipio, SG_UF_MUN AS uf,
         {s_int('CO_PAIS')} AS cod_pais, {s_int('SH4')} AS SH4,
         {s_int('KG_LIQUIDO', 'BIGINT')} AS KG_LIQUIDO, {s_int('VL_FOB', 'BIGINT')} AS VL_FOB
  FROM raw WHERE coalesce({', '.join(cols)}) IS NOT NULL),
mun AS (SELECT {s_int('CO_MUN_GEO')} AS k, {s_trim_translit('NO_MUN_MIN')} AS nome_municipio FROM ({MUN.sql()}) m),
pais AS (SELECT {s_int('CO_PAIS')} AS k, {s_trim_translit('NO_PAIS')} AS nome_pais FROM ({PAIS.sql()}) c),
prod AS (SELECT DISTINCT {s_int('SH4')} AS k, nome_sh4, SH2, nome_sh2, secao, nome_secao FROM ({_PROD_SQL}) p)
SELECT f.ano, f.mes, f.cod_municipio, mun.nome_municipio, f.uf, f.cod_pais, pais.nome_pais,
       f.SH4, prod.nome_sh4, prod.SH2, prod.nome_sh2, prod.secao, prod.nome_secao, f.KG_LIQUIDO, f.VL_FOB
FROM f JOIN mun ON f.cod_municipio = mun.k JOIN pais ON f.cod_pais = pais.k JOIN prod ON f.SH4 = prod.k
"""


assert S.TRADE_OUT[0] == "ano"

QUERIES = {
    "trade_dims": (q_trade_dims, _PROD_SQL),
    "trade_file": (q_trade_file, _flow_sql([fact_standin("N")])),
    "trade_flow_exp": (q_trade_flow_exp, _flow_sql([fact_standin("A", "F"), fact_standin("A", "O", True)])),
    "trade_flow_imp": (q_trade_flow_imp, _flow_sql([fact_standin("R", "F"), fact_standin("R", "O", True)])),
}

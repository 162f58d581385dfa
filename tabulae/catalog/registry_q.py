"""Register pipelines on stand-ins derived from the TPC-H-like tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulae import schemas as S
from tabulae.catalog.sqlgen import (
    s_blank_sentinel, s_clean_text, s_date8, s_decimal_comma, s_decode, s_int,
    s_pad, s_repair_email, s_upper_trim,
)
from tabulae.catalog.standin import Standin, d8
from tabulae.plans import registry as R

STR = "STRING"


def _code_standin(table: str, name: str) -> Standin:
    """A code table stand-in: zero-padded key text, blank-padded name."""
    key, label = {"nation": ("n_nationkey", "n_name"), "region": ("r_regionkey", "r_name")}[table]
    return Standin(table, [
        (f"cod_{name}", f"lpad(CAST({key} AS {STR}), 3, '0')"),
        (f"nome_{name}", f"concat(' ', lower({label}), ' ')"),
    ])


def _code_sql(table: str, name: str) -> str:
    st = _code_standin(table, name)
    return (f"SELECT {s_int(f'cod_{name}')} AS cod_{name}, {s_clean_text(f'nome_{name}')} AS nome_{name} "
            f"FROM ({st.sql()}) c")


def codes(spark: SparkSession, sf_dir: str, table: str, name: str) -> DataFrame:
    return R.code_table(_code_standin(table, name).df(spark, sf_dir), name)


# --- C1 dim_codes: the six code tables, nation or region as their raw files ------

CODE_SOURCES = {"CNAE": "region", "MUNIC": "nation", "NATJU": "nation", "PAIS": "region", "QUALS": "nation", "MOTI": "region"}


def q_dim_codes(spark, sf_dir):
    tables = [(S.CODE_TABLES[m], codes(spark, sf_dir, t, S.CODE_TABLES[m])) for m, t in CODE_SOURCES.items()]
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(n).alias("tabela"), F.col(f"cod_{n}").alias("cod"), F.col(f"nome_{n}").alias("nome")) for n, df in tables])


SQL_DIM_CODES = " UNION ALL ".join(
    f"SELECT '{n}' AS tabela, cod_{n} AS cod, nome_{n} AS nome FROM ({_code_sql(t, n)}) t_{n}"
    for n, t in ((S.CODE_TABLES[m], t) for m, t in CODE_SOURCES.items()))

# --- C2 simples ----------------------------------------------------------------

SIMPLES = Standin("orders", [
    ("cnpj", f"CAST(o_custkey AS {STR})"),
    ("opcao_simples", "CASE WHEN o_orderstatus = 'F' THEN 'S' ELSE 'N' END"),
    ("data_inclusao_simples", d8("o_orderdate")),
    ("data_exclusao_simples", "CASE WHEN o_orderkey % 3 = 0 THEN '00000000' ELSE '20211231' END"),
    ("opcao_mei", "CASE WHEN o_orderkey % 2 = 0 THEN 'S' ELSE 'N' END"),
    ("data_inclusao_mei", (f"CASE WHEN o_orderkey % 5 = 0 THEN '0' ELSE {d8('o_orderdate')[0]} END",
                           f"CASE WHEN o_orderkey % 5 = 0 THEN '0' ELSE {d8('o_orderdate')[1]} END")),
    ("data_exclusao_mei", "CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE '20211301' END"),
])


def q_registry_simples(spark, sf_dir):
    return R.simples_table(SIMPLES.df(spark, sf_dir))


SQL_REGISTRY_SIMPLES = f"""
SELECT {s_pad('cnpj', 8)} AS cnpj, opcao_simples,
       {s_date8('data_inclusao_simples')} AS data_inclusao_simples,
       {s_date8('data_exclusao_simples')} AS data_exclusao_simples,
       opcao_mei,
       {s_date8('data_inclusao_mei')} AS data_inclusao_mei,
       {s_date8('data_exclusao_mei')} AS data_exclusao_mei
FROM ({SIMPLES.sql()}) r
"""

# --- C3 companies ----------------------------------------------------------------

COMPANIES = Standin("customer", [
    ("cnpj", f"CAST(c_custkey AS {STR})"),
    ("razao_social", "concat(' ', lower(c_name), '  ')"),
    ("cod_natju", f"CAST(c_nationkey AS {STR})"),
    ("cod_quals", f"CAST(c_nationkey % 7 AS {STR})"),
    ("capital_social", f"replace(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS {STR}), '.', ',')"),
    ("porte", f"CAST(c_custkey % 6 AS {STR})"),
    ("ente_fed_resp", "c_mktsegment"),
])


def q_registry_companies(spark, sf_dir):
    return R.companies_table(
        COMPANIES.df(spark, sf_dir),
        codes(spark, sf_dir, "nation", "natju"),
        codes(spark, sf_dir, "region", "quals"),
    )


def companies_sql(natju: str = "nation", quals: str = "region") -> str:
    """The published companies, decoded against these tables as code tables."""
    return f"""
WITH raw AS ({COMPANIES.sql()}),
natju AS ({_code_sql(natju, 'natju')}),
quals AS ({_code_sql(quals, 'quals')}),
e AS (
  SELECT {s_pad('cnpj', 8)} AS cnpj,
         {s_clean_text('razao_social')} AS razao_social,
         {s_decimal_comma('capital_social')} AS capital_social,
         {s_int('porte')} AS porte,
         {s_decode('porte', S.COMPANY_SIZE_LABELS)} AS nome_porte,
         {s_clean_text('ente_fed_resp')} AS ente_fed_resp,
         {s_int('cod_natju')} AS cod_natju,
         {s_int('cod_quals')} AS cod_quals
  FROM raw)
SELECT e.cnpj, e.razao_social, e.capital_social, e.porte, e.nome_porte, e.ente_fed_resp,
       e.cod_natju, natju.nome_natju, e.cod_quals, quals.nome_quals
FROM e LEFT JOIN natju ON e.cod_natju = natju.cod_natju
       LEFT JOIN quals ON e.cod_quals = quals.cod_quals
"""


SQL_REGISTRY_COMPANIES = companies_sql()

# --- C4 partners -------------------------------------------------------------------

PARTNERS = Standin("orders", [
    ("cnpj_empresa", f"CAST(o_custkey AS {STR})"),
    ("id_socio", f"CAST(o_orderkey % 4 AS {STR})"),
    ("nome_socio", "concat(lower(o_orderpriority), ' ')"),
    ("cpf_cnpj_socio", f"concat('***', lpad(CAST(o_orderkey % 1000000 AS {STR}), 6, '0'), '**')"),
    ("cod_quals", f"CAST(o_custkey % 30 AS {STR})"),
    ("data_entrada_sociedade", (f"CASE WHEN o_orderkey % 7 = 0 THEN '00000000' ELSE {d8('o_orderdate')[0]} END",
                                f"CASE WHEN o_orderkey % 7 = 0 THEN '00000000' ELSE {d8('o_orderdate')[1]} END")),
    ("cod_pais", f"CAST(o_orderkey % 6 AS {STR})"),
    ("num_rep_legal", f"CAST(o_orderkey AS {STR})"),
    ("nome_rep_legal", "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE concat('  rep ', o_orderstatus) END"),
    ("cod_quals_rep_legal", f"CAST(o_orderkey % 30 AS {STR})"),
    ("faixa_etaria", f"CAST(o_orderkey % 11 AS {STR})"),
])


def q_registry_partners(spark, sf_dir):
    return R.partners_table(
        PARTNERS.df(spark, sf_dir),
        codes(spark, sf_dir, "nation", "quals"),
        codes(spark, sf_dir, "region", "pais"),
    )


SQL_REGISTRY_PARTNERS = f"""
WITH raw AS ({PARTNERS.sql()}),
quals AS ({_code_sql('nation', 'quals')}),
pais AS ({_code_sql('region', 'pais')}),
e AS (
  SELECT {s_pad('cnpj_empresa', 8)} AS cnpj_empresa,
         {s_clean_text('nome_socio')} AS nome_socio,
         cpf_cnpj_socio,
         {s_decode('id_socio', S.PARTNER_KIND_LABELS)} AS id_socio,
         {s_decode('faixa_etaria', S.AGE_BAND_LABELS)} AS faixa_etaria,
         {s_int('cod_quals')} AS cod_quals,
         {s_date8('data_entrada_sociedade')} AS data_entrada_sociedade,
         {s_int('cod_pais')} AS cod_pais,
         num_rep_legal,
         {s_clean_text('nome_rep_legal')} AS nome_rep_legal,
         {s_int('cod_quals_rep_legal')} AS cod_quals_rep_legal
  FROM raw)
SELECT e.cnpj_empresa, e.nome_socio, e.cpf_cnpj_socio, e.id_socio, e.faixa_etaria,
       e.cod_quals, q1.nome_quals, e.data_entrada_sociedade, e.cod_pais, p.nome_pais,
       e.num_rep_legal, e.nome_rep_legal, e.cod_quals_rep_legal, q2.nome_quals AS nome_quals_rep_legal
FROM e LEFT JOIN quals q2 ON e.cod_quals_rep_legal = q2.cod_quals
       LEFT JOIN quals q1 ON e.cod_quals = q1.cod_quals
       LEFT JOIN pais p ON e.cod_pais = p.cod_pais
"""

# --- C5 establishments ----------------------------------------------------------------

_SHIP = d8("l_shipdate")
ESTAB = Standin("lineitem", [
    ("cnpj", f"CAST(l_orderkey AS {STR})"),
    ("cnpj_ordem", f"lpad(CAST(l_linenumber AS {STR}), 4, '0')"),
    ("cnpj_dv", f"lpad(CAST(l_partkey % 100 AS {STR}), 2, '0')"),
    ("id_matriz", f"lpad(CAST(l_linenumber AS {STR}), 2, '0')"),
    ("nome_fantasia", "concat(' loja ', lower(l_returnflag), l_linestatus)"),
    ("situacao_cadastral", f"CAST(l_linenumber % 4 AS {STR})"),
    ("data_situacao_cadastral", _SHIP),
    ("motivo_situacao_cadastral", f"CAST(l_suppkey % 60 AS {STR})"),
    ("nome_cidade_ext", "CASE WHEN l_linenumber = 7 THEN 'exterior' ELSE NULL END"),
    ("cod_pais", f"CAST(l_partkey % 6 AS {STR})"),
    ("data_inicio_atividades", (f"CASE WHEN l_orderkey % 5 = 0 THEN '0' ELSE {_SHIP[0]} END",
                                f"CASE WHEN l_orderkey % 5 = 0 THEN '0' ELSE {_SHIP[1]} END")),
    ("cnae_primario", f"CAST(l_partkey AS {STR})"),
    ("cnae_secundario", f"concat(CAST(l_partkey AS {STR}), ',', CAST(l_suppkey AS {STR}))"),
    ("tipo_logradouro", "CASE WHEN l_linenumber % 2 = 0 THEN 'RUA' ELSE 'avenida' END"),
    ("logradouro", f"concat('  rua ', CAST(l_suppkey AS {STR}))"),
    ("numero", f"CASE WHEN l_linestatus = 'F' THEN 'S/N' WHEN l_linenumber = 3 THEN 'S/N B' "
               f"WHEN l_linenumber = 5 THEN NULL ELSE CAST(l_linenumber AS {STR}) END"),
    ("complemento", "CASE WHEN l_linenumber = 1 THEN 'sala 1' ELSE NULL END"),
    ("bairro", "concat('bairro ', l_returnflag)"),
    ("cep", f"lpad(CAST(l_orderkey % 100000 AS {STR}), 8, '0')"),
    ("uf", "concat(' ', lower(l_returnflag), ' ')"),
    ("cod_mun", f"CAST(l_suppkey % 30 AS {STR})"),
    ("ddd_1", "'11'"),
    ("telefone_1", f"CAST(l_orderkey % 100000000 AS {STR})"),
    ("ddd_2", f"CAST(NULL AS {STR})"),
    ("telefone_2", f"CAST(NULL AS {STR})"),
    ("ddd_fax", f"CAST(NULL AS {STR})"),
    ("fax", f"CAST(NULL AS {STR})"),
    ("correio_eletronico", f"concat(' Loja', CAST(l_orderkey AS {STR}), '''', 'EXAMPLE.COM ')"),
    ("situacao_especial", f"CAST(NULL AS {STR})"),
    ("data_situacao_especial", f"CAST(NULL AS {STR})"),
])


def q_registry_establishments(spark, sf_dir):
    return R.establishments_table(
        ESTAB.df(spark, sf_dir),
        codes(spark, sf_dir, "nation", "mun"),
        codes(spark, sf_dir, "region", "pais"),
    )


def _estab_select() -> str:
    exprs = []
    for c in S.ESTAB_COLS:
        if c in R.ESTAB_INT:
            e = s_int(c)
        elif c in R.ESTAB_TEXT:
            e = s_clean_text(c)
        elif c in R.ESTAB_DATE:
            e = s_date8(c)
        elif c == "cnpj":
            e = s_pad(c, 8)
        elif c == "cnae_primario":
            e = s_pad(c, 7)
        elif c == "id_matriz":
            e = s_decode(c, S.HQ_LABELS)
        elif c == "uf":
            e = s_upper_trim(c)
        elif c == "correio_eletronico":
            e = s_repair_email(c)
        elif c == "numero":
            e = s_blank_sentinel(c, S.NO_NUMBER_SENTINELS)
        else:
            e = c
        exprs.append(f"{e} AS {c}")
    return ", ".join(exprs)


SQL_REGISTRY_ESTABLISHMENTS = f"""
WITH raw AS ({ESTAB.sql()}),
mun AS ({_code_sql('nation', 'mun')}),
pais AS ({_code_sql('region', 'pais')}),
e AS (SELECT {_estab_select()} FROM raw)
SELECT {', '.join('e.' + c for c in S.ESTAB_COLS)}, mun.nome_mun, pais.nome_pais
FROM e JOIN mun ON e.cod_mun = mun.cod_mun
       LEFT JOIN pais ON e.cod_pais = pais.cod_pais
"""

QUERIES = {
    "dim_codes": (q_dim_codes, SQL_DIM_CODES),
    "registry_simples": (q_registry_simples, SQL_REGISTRY_SIMPLES),
    "registry_companies": (q_registry_companies, SQL_REGISTRY_COMPANIES),
    "registry_partners": (q_registry_partners, SQL_REGISTRY_PARTNERS),
    "registry_establishments": (q_registry_establishments, SQL_REGISTRY_ESTABLISHMENTS),
}

"""Raw layouts, published column orders and code labels of the two datasets.

FIXED VALUES. The column lists describe the public file layouts (files are
headerless, so position is the only name) and the labels are the published
meanings of the codes.  They must stay exactly as written for results to
match; they are stated here once, in the files' own order.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# --- Registry (company register): raw file layouts, in file order ----------
# FIXED VALUES
SIMPLES_COLS = [
    "cnpj", "opcao_simples", "data_inclusao_simples", "data_exclusao_simples",
    "opcao_mei", "data_inclusao_mei", "data_exclusao_mei",
]
PARTNER_COLS = [
    "cnpj_empresa", "id_socio", "nome_socio", "cpf_cnpj_socio", "cod_quals",
    "data_entrada_sociedade", "cod_pais", "num_rep_legal", "nome_rep_legal",
    "cod_quals_rep_legal", "faixa_etaria",
]
COMPANY_COLS = [
    "cnpj", "razao_social", "cod_natju", "cod_quals", "capital_social", "porte",
    "ente_fed_resp",
]
ESTAB_COLS = [
    "cnpj", "cnpj_ordem", "cnpj_dv", "id_matriz", "nome_fantasia",
    "situacao_cadastral", "data_situacao_cadastral", "motivo_situacao_cadastral",
    "nome_cidade_ext", "cod_pais", "data_inicio_atividades", "cnae_primario",
    "cnae_secundario", "tipo_logradouro", "logradouro", "numero", "complemento",
    "bairro", "cep", "uf", "cod_mun", "ddd_1", "telefone_1", "ddd_2", "telefone_2",
    "ddd_fax", "fax", "correio_eletronico", "situacao_especial",
    "data_situacao_especial",
]

# Code tables: file-name marker -> short name used in column names.
# FIXED VALUES (MUNIC files publish the "mun" table)
CODE_TABLES = {"CNAE": "cnae", "MUNIC": "mun", "NATJU": "natju", "PAIS": "pais", "QUALS": "quals", "MOTI": "moti"}

# File-name markers of the big registry tables (one file per part directory).
# FIXED VALUES
BIG_TABLE_MARKERS = {"companies": "EMPRECSV", "partners": "SOCIOCSV", "establishments": "ESTABELECSV"}
SIMPLES_MARKER = "SIMPLES"

# Raw read options of every registry file. FIXED VALUES
REGISTRY_READ_OPTIONS = {"sep": ";", "encoding": "ISO-8859-1", "quote": '"', "escape": '"'}

# --- Registry: published output column orders -------------------------------
COMPANY_OUT = [
    "cnpj", "razao_social", "capital_social", "porte", "nome_porte", "ente_fed_resp",
    "cod_natju", "nome_natju", "cod_quals", "nome_quals",
]
PARTNER_OUT = [
    "cnpj_empresa", "nome_socio", "cpf_cnpj_socio", "id_socio", "faixa_etaria",
    "cod_quals", "nome_quals", "data_entrada_sociedade", "cod_pais", "nome_pais",
    "num_rep_legal", "nome_rep_legal", "cod_quals_rep_legal", "nome_quals_rep_legal",
]
ESTAB_OUT = ESTAB_COLS + ["nome_mun", "nome_pais"]

# --- Registry: code -> label. FIXED VALUES ----------------------------------
COMPANY_SIZE_LABELS = {
    1: "Nao Informado",
    2: "Micro Empresa",
    3: "Empresa de Pequeno Porte",
    5: "Demais",
}
AGE_BAND_LABELS = {
    0: "Nao se aplica",
    1: "0 a 12 anos",
    2: "13 a 20 anos",
    3: "21 a 30 anos",
    4: "31 a 40 anos",
    5: "41 a 50 anos",
    6: "51 a 60 anos",
    7: "61 a 70 anos",
    8: "71 a 80 anos",
    9: "Mais de 80 anos",
}
PARTNER_KIND_LABELS = {1: "PJ", 2: "PF", 3: "Estrangeiro"}
HQ_LABELS = {1: "Matriz", 2: "Filial"}
# House-number values that mean "no number". FIXED VALUES
NO_NUMBER_SENTINELS = ["S/N", "S/N B"]

# Key widths. FIXED VALUES
CNPJ_ROOT_WIDTH = 8
CNAE_WIDTH = 7

# --- Trade (foreign trade by municipality) ----------------------------------
# FIXED VALUES: header names of the fact files and lookup files.
TRADE_FACT_COLS = ["CO_ANO", "CO_MES", "SH4", "CO_PAIS", "SG_UF_MUN", "CO_MUN", "KG_LIQUIDO", "VL_FOB"]
TRADE_TEXT_COLS = ["SG_UF_MUN"]          # every other fact column is numeric
TRADE_MEASURES = ["KG_LIQUIDO", "VL_FOB"]  # widened to bigint
TRADE_MUN_COLS = ["CO_MUN_GEO", "NO_MUN_MIN"]
TRADE_COUNTRY_COLS = ["CO_PAIS", "NO_PAIS"]
TRADE_PRODUCT_COLS = ["CO_SH4", "NO_SH4_POR", "CO_SH2", "NO_SH2_POR", "CO_NCM_SECROM", "NO_SEC_POR"]
TRADE_OUT = [
    "ano", "mes", "cod_municipio", "nome_municipio", "uf", "cod_pais", "nome_pais",
    "SH4", "nome_sh4", "SH2", "nome_sh2", "secao", "nome_secao", "KG_LIQUIDO", "VL_FOB",
]
TRADE_FLOWS = {"exp": "EXP", "imp": "IMP"}
TRADE_DEFAULT_YEARS = (2016, 2021)


def string_schema(cols: list[str]) -> StructType:
    """All-string positional schema for a headerless raw file."""
    return StructType([StructField(c, StringType(), True) for c in cols])

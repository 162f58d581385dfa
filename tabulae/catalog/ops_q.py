"""Single operators (cleaners, projections, lookups, sets) on whole test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulae import schemas as S
from tabulae.catalog.sqlgen import (
    s_blank_sentinel, s_clean_text, s_date8, s_decimal_comma, s_decode, s_int,
    s_pad, s_repair_email, s_trim, s_trim_translit, s_upper_trim,
)
from tabulae.catalog.standin import Standin, d8, table
from tabulae.functions import clean as C
from tabulae.functions.transliteration import translit, translit_sql
from tabulae.operators import columns as P
from tabulae.operators.lookups import coerce_key, duplicate_keys, lookup, unmatched_keys
from tabulae.operators.sets import distinct_rows, union_by_name

STR = "STRING"
Q: dict = {}


def reg(name, sql=None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


# --- X1 int -----------------------------------------------------------------
INTS = Standin("orders", [
    ("o_orderkey", "o_orderkey"),
    ("code", "substring(o_orderpriority, 1, 1)"),
    ("junk", "o_orderpriority"),
    ("padded", f"concat(' ', CAST(o_custkey AS {STR}), ' ')"),
    ("big", f"CAST(o_orderkey * 1000000 AS {STR})"),
])


@reg("clean_int", f"""SELECT o_orderkey, {s_int('code')} AS code_int, {s_int('junk')} AS junk_int,
  {s_int('padded')} AS padded_int, {s_int('big')} AS big_int, {s_int('big', 'BIGINT')} AS big_bigint
  FROM ({INTS.sql()}) r""")
def q_clean_int(spark, sf):
    r = INTS.df(spark, sf)
    return r.select("o_orderkey", C.to_int("code").alias("code_int"), C.to_int("junk").alias("junk_int"),
                    C.to_int("padded").alias("padded_int"), C.to_int("big").alias("big_int"),
                    C.to_int("big", "bigint").alias("big_bigint"))


# --- X2 date ----------------------------------------------------------------
_OD = d8("o_orderdate")
DATES = Standin("orders", [
    ("o_orderkey", "o_orderkey"),
    ("d", tuple(f"CASE WHEN o_orderkey % 7 = 0 THEN '00000000' WHEN o_orderkey % 11 = 0 THEN '20211301' "
                f"WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 17 = 0 THEN '0' ELSE {e} END" for e in _OD)),
])


@reg("clean_date", f"SELECT o_orderkey, {s_date8('d')} AS d FROM ({DATES.sql()}) r")
def q_clean_date(spark, sf):
    return DATES.df(spark, sf).select("o_orderkey", C.to_date8("d").alias("d"))


# --- X3 / X4 text -------------------------------------------------------------
@reg("clean_text", f"SELECT doc_id, {s_clean_text('text')} AS text_clean FROM documents")
def q_clean_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", C.clean_text("text").alias("text_clean"))


@reg("translit_text", f"SELECT doc_id, {translit_sql('text')} AS text_ascii FROM documents")
def q_translit_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", translit(F.col("text")).alias("text_ascii"))


# X5 / X6: trade lookup names: trim then transliterate; trim only
NAMES = Standin("documents", [("doc_id", "doc_id"), ("name", "concat('  ', text, ' ')")])


@reg("trade_dim_names", f"SELECT doc_id, {s_trim_translit('name')} AS name_translit, {s_trim('name')} AS name_trim "
                        f"FROM ({NAMES.sql()}) r")
def q_trade_dim_names(spark, sf):
    r = NAMES.df(spark, sf)
    return r.select("doc_id", C.trim_translit("name").alias("name_translit"), F.trim("name").alias("name_trim"))


# --- X7 decimal comma ----------------------------------------------------------
MONEY = Standin("customer", [
    ("c_custkey", "c_custkey"),
    ("capital", f"replace(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS {STR}), '.', ',')"),
    ("dotted", f"concat('1.', replace(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS {STR}), '.', ','))"),
])


@reg("decimal_comma", f"SELECT c_custkey, {s_decimal_comma('capital')} AS capital, {s_decimal_comma('dotted')} AS dotted "
                      f"FROM ({MONEY.sql()}) r")
def q_decimal_comma(spark, sf):
    r = MONEY.df(spark, sf)
    return r.select("c_custkey", C.decimal_comma("capital").alias("capital"), C.decimal_comma("dotted").alias("dotted"))


@reg("decimal_comma_float", f"SELECT c_custkey, {s_decimal_comma('capital', 'FLOAT')} AS capital FROM ({MONEY.sql()}) r")
def q_decimal_comma_float(spark, sf):
    return MONEY.df(spark, sf).select("c_custkey", C.decimal_comma("capital", "float").alias("capital"))


# --- X8 pad ---------------------------------------------------------------------
KEYS = Standin("customer", [
    ("c_custkey", "c_custkey"),
    ("k", f"CAST(c_custkey AS {STR})"),
    ("long_k", f"CAST(c_custkey * 1000003 AS {STR})"),
])


@reg("pad_key", f"SELECT c_custkey, {s_pad('k', 8)} AS k8, {s_pad('long_k', 8)} AS k8_cut, {s_pad('k', 7)} AS k7 "
                f"FROM ({KEYS.sql()}) r")
def q_pad_key(spark, sf):
    r = KEYS.df(spark, sf)
    return r.select("c_custkey", C.pad_key("k", 8).alias("k8"), C.pad_key("long_k", 8).alias("k8_cut"),
                    C.pad_key("k", 7).alias("k7"))


# --- X9 / X10 / X11 code -> label ------------------------------------------------
SIZE = Standin("orders", [("o_orderkey", "o_orderkey"), ("porte", "substring(o_orderpriority, 1, 1)")])


@reg("code_label_case", f"SELECT o_orderkey, {s_int('porte')} AS porte, {s_decode('porte', S.COMPANY_SIZE_LABELS)} AS nome_porte "
                        f"FROM ({SIZE.sql()}) r")
def q_code_label_case(spark, sf):
    r = SIZE.df(spark, sf)
    return r.select("o_orderkey", C.to_int("porte").alias("porte"),
                    C.decode("porte", S.COMPANY_SIZE_LABELS, cast="int").alias("nome_porte"))


AGE = Standin("orders", [("o_orderkey", "o_orderkey"), ("faixa", f"CAST(o_orderkey % 11 AS {STR})")])


@reg("code_label_ageband", f"SELECT o_orderkey, {s_decode('faixa', S.AGE_BAND_LABELS)} AS faixa_etaria FROM ({AGE.sql()}) r")
def q_code_label_ageband(spark, sf):
    r = AGE.df(spark, sf)
    return r.select("o_orderkey", C.decode("faixa", S.AGE_BAND_LABELS, cast="int").alias("faixa_etaria"))


KIND = Standin("lineitem", [
    ("l_orderkey", "l_orderkey"), ("l_linenumber", "l_linenumber"),
    ("matriz", f"CASE WHEN l_linenumber = 6 THEN 'x' ELSE lpad(CAST(l_linenumber AS {STR}), 2, '0') END"),
    ("socio", f"CAST(l_orderkey % 4 AS {STR})"),
])


@reg("code_label_when", f"SELECT l_orderkey, l_linenumber, {s_decode('matriz', S.HQ_LABELS)} AS id_matriz, "
                        f"{s_decode('socio', S.PARTNER_KIND_LABELS)} AS id_socio FROM ({KIND.sql()}) r")
def q_code_label_when(spark, sf):
    r = KIND.df(spark, sf)
    return r.select("l_orderkey", "l_linenumber",
                    C.decode("matriz", S.HQ_LABELS, cast="int").alias("id_matriz"),
                    C.decode("socio", S.PARTNER_KIND_LABELS, cast="int").alias("id_socio"))


# --- X12 / X13 / X15 --------------------------------------------------------------
CONTACT = Standin("customer", [
    ("c_custkey", "c_custkey"),
    ("uf", "concat(' ', lower(c_mktsegment), ' ')"),
    ("email", "concat(' ', c_name, '''', c_mktsegment, '.COM ')"),
])


@reg("upper_trim", f"SELECT c_custkey, {s_upper_trim('uf')} AS uf FROM ({CONTACT.sql()}) r")
def q_upper_trim(spark, sf):
    return CONTACT.df(spark, sf).select("c_custkey", C.upper_trim("uf").alias("uf"))


@reg("repair_email", f"SELECT c_custkey, {s_repair_email('email')} AS email FROM ({CONTACT.sql()}) r")
def q_repair_email(spark, sf):
    return CONTACT.df(spark, sf).select("c_custkey", C.repair_email("email").alias("email"))


NUMBERS = Standin("lineitem", [
    ("l_orderkey", "l_orderkey"), ("l_linenumber", "l_linenumber"),
    ("numero", f"CASE WHEN l_linenumber = 7 THEN NULL WHEN l_returnflag = 'R' THEN 'S/N' "
               f"WHEN l_returnflag = 'A' THEN 'S/N B' ELSE CAST(l_linenumber AS {STR}) END"),
])


@reg("blank_sentinel", f"SELECT l_orderkey, l_linenumber, {s_blank_sentinel('numero', S.NO_NUMBER_SENTINELS)} AS numero "
                       f"FROM ({NUMBERS.sql()}) r")
def q_blank_sentinel(spark, sf):
    return NUMBERS.df(spark, sf).select("l_orderkey", "l_linenumber", C.blank_sentinel("numero").alias("numero"))


# --- F1 drop all-null rows ------------------------------------------------------------
EVENTS = Standin("events", [
    ("a", f"CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(event_id AS {STR}) END"),
    ("b", "CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END"),
    ("c", f"CASE WHEN event_id % 6 IN (0, 1) THEN NULL ELSE CAST(user_id AS {STR}) END"),
    ("d", "CASE WHEN event_id % 2 = 0 THEN NULL ELSE props END"),
])


@reg("drop_all_null", f"SELECT * FROM ({EVENTS.sql()}) r WHERE coalesce(a, b, c, d) IS NOT NULL")
def q_drop_all_null(spark, sf):
    return P.drop_all_null(EVENTS.df(spark, sf))


# --- P1 / P2 projection ---------------------------------------------------------------
@reg("project_ordered", "SELECT c_custkey AS cnpj, c_name AS razao_social, c_mktsegment AS segmento, "
                        "c_acctbal AS capital_social FROM customer")
def q_project_ordered(spark, sf):
    return P.project(table(spark, sf, "customer"), ["cnpj", "razao_social", "segmento", "capital_social"],
                     {"c_custkey": "cnpj", "c_name": "razao_social", "c_mktsegment": "segmento", "c_acctbal": "capital_social"})


# --- P6 / P7 column rules ---------------------------------------------------------------
RULES = Standin("orders", [
    ("cod_cliente", f"CAST(o_custkey AS {STR})"),
    ("cod_prioridade", "o_orderpriority"),
    ("data_pedido", _OD),
    ("nome_status", "concat(' pedido ', lower(o_orderstatus))"),
    ("valor", f"CAST(o_totalprice AS {STR})"),
])


@reg("clean_by_column_rule", f"""SELECT {s_int('cod_cliente')} AS cod_cliente, {s_int('cod_prioridade')} AS cod_prioridade,
  {s_date8('data_pedido')} AS data_pedido, {s_clean_text('nome_status')} AS nome_status, valor FROM ({RULES.sql()}) r""")
def q_clean_by_column_rule(spark, sf):
    r = RULES.df(spark, sf)
    return (r.transform(P.clean_columns("int", P.columns_by_rule(r.columns, prefix="cod")))
             .transform(P.clean_columns("date", P.columns_by_rule(r.columns, contains="data")))
             .transform(P.clean_columns("str", P.columns_by_rule(r.columns, prefix="nome"))))


# --- J lookups --------------------------------------------------------------------------
@reg("lookup_left", """SELECT c.c_custkey, c.c_nationkey, n.n_name FROM customer c
  LEFT JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 2) n ON c.c_nationkey = n.n_nationkey""")
def q_lookup_left(spark, sf):
    nation = table(spark, sf, "nation").where("n_regionkey <> 2").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return lookup(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), nation, "c_nationkey", "left").select(
        "c_custkey", "c_nationkey", "n_name")


@reg("lookup_inner", """SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey % 30 AS cod_mun, n.n_name AS nome_mun
  FROM lineitem l JOIN nation n ON l.l_suppkey % 30 = n.n_nationkey""")
def q_lookup_inner(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 30).alias("cod_mun"))
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("cod_mun"), F.col("n_name").alias("nome_mun"))
    return lookup(li, nation, "cod_mun", "inner").select("l_orderkey", "l_linenumber", "cod_mun", "nome_mun")


@reg("lookup_coerced_key", """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name FROM lineitem l
  JOIN (SELECT lpad(CAST(p_partkey AS STRING), 6, '0') AS k, p_name FROM part) p ON l.l_partkey = TRY_CAST(p.k AS BIGINT)""")
def q_lookup_coerced_key(spark, sf):
    part = table(spark, sf, "part").select(F.lpad(F.col("p_partkey").cast("string"), 6, "0").alias("l_partkey"), "p_name")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lookup(li, coerce_key(part, "l_partkey", "bigint"), "l_partkey", "inner").select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_name")


# lines per part and supplier: a code table whose key (the part) comes more than once
@reg("lookup_duplicate_keys", """SELECT l_partkey, count(*) AS n_rows FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) d
  GROUP BY l_partkey HAVING count(*) > 1""")
def q_lookup_duplicate_keys(spark, sf):
    return duplicate_keys(distinct_rows(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"]), "l_partkey")


@reg("lookup_unmatched_keys", """SELECT l_suppkey % 30 AS cod_mun, count(*) AS n_rows FROM lineitem
  WHERE l_suppkey % 30 NOT IN (SELECT n_nationkey FROM nation) GROUP BY l_suppkey % 30""")
def q_lookup_unmatched_keys(spark, sf):
    li = table(spark, sf, "lineitem").select((F.col("l_suppkey") % 30).alias("cod_mun"))
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("cod_mun"))
    return unmatched_keys(li, nation, "cod_mun")


@reg("lookup_role_playing", """SELECT o.o_orderkey, o.o_custkey % 30 AS cod_quals, q1.n_name AS nome_quals,
  o.o_orderkey % 30 AS cod_quals_rep_legal, q2.n_name AS nome_quals_rep_legal FROM orders o
  LEFT JOIN nation q1 ON o.o_custkey % 30 = q1.n_nationkey
  LEFT JOIN nation q2 ON o.o_orderkey % 30 = q2.n_nationkey""")
def q_lookup_role_playing(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 30).alias("cod_quals"),
                                         (F.col("o_orderkey") % 30).alias("cod_quals_rep_legal"))
    quals = table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("cod_quals"), F.col("n_name").alias("nome_quals"))
    df = lookup(o, P.suffix_columns(quals, "_rep_legal"), "cod_quals_rep_legal", "left")
    df = lookup(df, quals, "cod_quals", "left")
    return df.select("o_orderkey", "cod_quals", "nome_quals", "cod_quals_rep_legal", "nome_quals_rep_legal")


# --- U1 / U2 ------------------------------------------------------------------------------
@reg("union_flow_files", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus NOT IN ('F', 'O')""")
def q_union_flow_files(spark, sf):
    # the whole table as three "files" by status, each with its own column order
    o = table(spark, sf, "orders")
    f1 = o.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    f2 = o.where("o_orderstatus = 'O'").select("o_totalprice", "o_orderstatus", "o_custkey", "o_orderkey")
    f3 = o.where("o_orderstatus NOT IN ('F', 'O')").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    return union_by_name([f1, f2, f3])


@reg("distinct_dim", "SELECT DISTINCT p_brand, p_type FROM part")
def q_distinct_dim(spark, sf):
    return distinct_rows(table(spark, sf, "part"), ["p_brand", "p_type"])

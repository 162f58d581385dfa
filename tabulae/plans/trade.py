"""Foreign-trade job: three lookup tables and one fact table per flow.

All fact files of a flow are read by one scan, each line by its file's own
header: an all-null row is judged on every column the file has.  Only the
published columns go on to the lookups, so each code table is broadcast once
per flow, not once per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulae import schemas as S
from tabulae.functions.clean import to_int, trim_translit
from tabulae.operators.columns import drop_all_null
from tabulae.operators.lookups import coerce_key, fits_broadcast_all, lookup, require_unique
from tabulae.operators.sets import distinct_rows, union_by_name
from tabulae.session import scratch_path
from tabulae.sinks import write_table
from tabulae.sources.delimited import scan_by_header
from tabulae.sources.files import list_files


def municipalities(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("CO_MUN_GEO").alias("CO_MUN"), trim_translit("NO_MUN_MIN").alias("nome_municipio"))


def countries(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("CO_PAIS"), trim_translit("NO_PAIS").alias("nome_pais"))


def products(raw: DataFrame) -> DataFrame:
    """Product headings at SH4 grain: the file is finer (one row per NCM)."""
    df = raw.select(
        F.col("CO_SH4").alias("SH4"),
        F.trim("NO_SH4_POR").alias("nome_sh4"),
        F.col("CO_SH2").alias("SH2"),
        F.trim("NO_SH2_POR").alias("nome_sh2"),
        F.col("CO_NCM_SECROM").alias("secao"),
        F.trim("NO_SEC_POR").alias("nome_secao"),
    )
    return distinct_rows(df)


def fact_file(raw: DataFrame, measure_type: str = "bigint") -> DataFrame:
    """One raw fact file -> typed published fact columns (before lookups).

    Measures are ``bigint`` (values above 2^31 exist); ``measure_type="int"``
    gives the earlier type, where such values become null.
    """
    return fact_columns(drop_all_null(raw), measure_type)


def fact_columns(df: DataFrame, measure_type: str = "bigint") -> DataFrame:
    """Raw fact columns, typed."""
    typed = {}
    for c in S.TRADE_FACT_COLS:
        if c in S.TRADE_TEXT_COLS:
            typed[c] = F.col(c)
        elif c in S.TRADE_MEASURES:
            typed[c] = to_int(c, measure_type)
        else:
            typed[c] = to_int(c)
    return df.select([e.alias(c) for c, e in typed.items()])


def keyed_lookups(mun: DataFrame, pais: DataFrame, prod: DataFrame) -> dict[str, DataFrame]:
    """Lookup tables keyed like the facts (int), by fact column.

    The lookup files are spreadsheet exports: a code column with gaps is
    written as ``101.0``, which still names code 101.
    """
    return {
        "CO_MUN": coerce_key(mun, "CO_MUN", "int", integral_decimals=True),
        "CO_PAIS": coerce_key(pais, "CO_PAIS", "int", integral_decimals=True),
        "SH4": distinct_rows(coerce_key(prod, "SH4", "int", integral_decimals=True)),
    }


def prepare_lookups(tables: dict[str, DataFrame]) -> dict:
    """Each table with the outcome of its size check (one job for all)."""
    small = fits_broadcast_all(tables)
    return {key: (df, small[key]) for key, df in tables.items()}


def decorate(facts: DataFrame, mun: DataFrame, pais: DataFrame, prod: DataFrame, prepared: dict | None = None) -> DataFrame:
    """Inner lookups on int fact keys against text lookup keys, then publish."""
    prepared = prepared or prepare_lookups(keyed_lookups(mun, pais, prod))
    df = facts
    for key in ("CO_MUN", "CO_PAIS", "SH4"):
        dim, small = prepared[key]
        df = lookup(df, dim, key, "inner", small=small)
    df = df.withColumnsRenamed({
        "CO_MUN": "cod_municipio", "CO_PAIS": "cod_pais", "SG_UF_MUN": "uf",
        "CO_ANO": "ano", "CO_MES": "mes",
    })
    return df.select(*S.TRADE_OUT)


def flow(raw_files: list[DataFrame], mun: DataFrame, pais: DataFrame, prod: DataFrame, prepared: dict | None = None,
         measure_type: str = "bigint") -> DataFrame:
    """All files of one flow, stacked by column name, decorated once."""
    if not raw_files:
        raise ValueError("no fact files for this flow")
    return decorate(union_by_name([fact_file(r, measure_type) for r in raw_files]), mun, pais, prod, prepared)


# --- file-level job ---------------------------------------------------------

def run(spark: SparkSession, raw_root: str, out_root: str, fmt: str = "parquet",
        partition_by: list[str] | None = None, fact_sep: str = ",", aux_sep: str = ",",
        encoding: str = "UTF-8", compat: bool = False, repeated: tuple[str, ...] = ()) -> dict[str, str]:
    """``raw_root/mun/*EXP*|*IMP*`` facts + ``raw_root/aux_tables`` lookups.

    ``partition_by=["ano"]`` lays the flows out by year, so readers that
    filter on the year prune whole directories.  The fact files are read with
    real CSV quoting, so the portal's own ``;``-separated quoted files work
    as they are (``fact_sep=";"``), with no rewriting step.  ``compat=True``
    publishes the measures as ``int`` (the earlier type).

    A lookup key that comes more than once is an error, but for the tables
    named in ``repeated`` (``CO_MUN``, ``CO_PAIS``, ``SH4``): there a fact is
    published once for each of its key's rows, as in any join.
    """
    unknown = set(repeated) - {"CO_MUN", "CO_PAIS", "SH4"}
    if unknown:
        raise ValueError(f"unknown lookup keys: {sorted(unknown)}")

    def lookup_file(name: str, cols: list[str]) -> DataFrame:
        return scan_by_header(spark, f"{raw_root}/aux_tables/{name}", cols, aux_sep, encoding)

    mun = municipalities(lookup_file("UF_MUN.csv", S.TRADE_MUN_COLS))
    pais = countries(lookup_file("PAIS.csv", S.TRADE_COUNTRY_COLS))
    prod = products(lookup_file("NCM_SH.csv", S.TRADE_PRODUCT_COLS))
    # one count for each flow: archives are not fact files
    files = list_files(spark, f"{raw_root}/mun").where(~F.lower("name").endswith(".zip"))
    counts = files.agg(*[F.count_if(F.col("name").contains(marker)).alias(name) for name, marker in S.TRADE_FLOWS.items()]).first()
    empty = [name for name in S.TRADE_FLOWS if not counts[name]]
    if empty:  # fail before anything is written
        raise ValueError(f"no fact files for flow(s) {empty} under {raw_root}/mun")
    # written once, checked once, used by both flows
    tables = keyed_lookups(mun, pais, prod)
    for key, df in tables.items():
        path = scratch_path(spark, f"lookup-{key}")
        write_table(df, path)
        tables[key] = spark.read.schema(df.schema).parquet(path)
    single = {key: df for key, df in tables.items() if key not in repeated}
    if single:
        require_unique(single)
    prepared = prepare_lookups(tables)
    out = {}
    for flow_name, marker in S.TRADE_FLOWS.items():
        # one scan for all files and layouts; each file is still judged on its own columns
        raw = scan_by_header(spark, f"{raw_root}/mun", S.TRADE_FACT_COLS, fact_sep, encoding, contains=marker, drop_empty=True)
        df = decorate(fact_columns(raw, "int" if compat else "bigint"), mun, pais, prod, prepared)
        out[flow_name] = f"{out_root}/comex_{flow_name}"
        write_table(df, out[flow_name], fmt, partition_by=partition_by)
    return out

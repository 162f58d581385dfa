"""Company-register job: code tables, simples, companies, partners, establishments.

Each ``*_table`` function is a pure transform from the raw all-string table
(plus the code tables it decodes against) to the published table.  They
contain no shuffle: cleaners are one projection, lookups are size-checked
broadcast joins.  ``run`` wires them to the raw files and parquet sinks.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulae import schemas as S
from tabulae.functions.clean import (
    blank_sentinel, clean_text, decimal_comma, decode, pad_key, repair_email,
    to_date8, to_int, upper_trim,
)
from tabulae.operators.columns import columns_by_rule, project
from tabulae.operators.lookups import fits_broadcast, fits_broadcast_all, lookup, lookup_role, require_unique
from tabulae.sinks import write_table
from tabulae.sinks.publish import Release
from tabulae.sources.delimited import malformed_records, scan_delimited
from tabulae.sources.files import list_files


def _carried(df: DataFrame) -> list[str]:
    """The column of source files, where a raw table has one (``streaming.ledger``)."""
    return [c for c in df.columns if c == "_file"]


def code_table(raw: DataFrame, name: str) -> DataFrame:
    """``cod_<name>`` int, ``nome_<name>`` cleaned text."""
    cod, nome = f"cod_{name}", f"nome_{name}"
    return raw.select(to_int(cod).alias(cod), clean_text(nome).alias(nome))


def simples_table(raw: DataFrame, pad: bool = True) -> DataFrame:
    """Small-company regime flags; the four ``data_*`` columns become dates.

    The key is padded like in the three sibling tables so all four join
    (``pad=False`` keeps it as delivered).
    """
    dates = columns_by_rule(raw.columns, contains="data")
    fixes = {c: to_date8(c) for c in dates}
    if pad:
        fixes["cnpj"] = pad_key("cnpj", S.CNPJ_ROOT_WIDTH)
    return raw.withColumns(fixes).select(*S.SIMPLES_COLS, *_carried(raw))


def companies_table(raw: DataFrame, natju: DataFrame, quals: DataFrame, capital_type: str = "decimal(18,2)",
                    small: dict[str, bool] | None = None) -> DataFrame:
    small = small or {}
    df = raw.withColumns({
        "cnpj": pad_key("cnpj", S.CNPJ_ROOT_WIDTH),
        "razao_social": clean_text("razao_social"),
        "ente_fed_resp": clean_text("ente_fed_resp"),
        "cod_natju": to_int("cod_natju"),
        "cod_quals": to_int("cod_quals"),
        "porte": to_int("porte"),
        "nome_porte": decode("porte", S.COMPANY_SIZE_LABELS, cast="int"),
        "capital_social": decimal_comma("capital_social", capital_type),
    })
    df = lookup(df, natju.select("cod_natju", "nome_natju"), "cod_natju", "left", small=small.get("natju"))
    df = lookup(df, quals.select("cod_quals", "nome_quals"), "cod_quals", "left", small=small.get("quals"))
    return df.select(*S.COMPANY_OUT, *_carried(raw))


def partners_table(raw: DataFrame, quals: DataFrame, pais: DataFrame, small: dict[str, bool] | None = None) -> DataFrame:
    small = small or {}
    df = raw.withColumns({
        "cnpj_empresa": pad_key("cnpj_empresa", S.CNPJ_ROOT_WIDTH),
        "cod_quals": to_int("cod_quals"),
        "cod_pais": to_int("cod_pais"),
        "cod_quals_rep_legal": to_int("cod_quals_rep_legal"),
        "id_socio": decode("id_socio", S.PARTNER_KIND_LABELS, cast="int"),
        "faixa_etaria": decode("faixa_etaria", S.AGE_BAND_LABELS, cast="int"),
        "nome_socio": clean_text("nome_socio"),
        "nome_rep_legal": clean_text("nome_rep_legal"),
        "data_entrada_sociedade": to_date8("data_entrada_sociedade"),
    })
    quals = quals.select("cod_quals", "nome_quals")
    q_small = small.get("quals")
    if q_small is None:
        q_small = fits_broadcast(quals)  # one check for both roles
    # one code table in two roles, broadcast once
    df = lookup_role(df, quals, "cod_quals", "cod_quals_rep_legal", {"nome_quals": "nome_quals_rep_legal"}, small=q_small)
    df = lookup(df, quals, "cod_quals", "left", small=q_small)
    df = lookup(df, pais.select("cod_pais", "nome_pais"), "cod_pais", "left", small=small.get("pais"))
    return df.select(*S.PARTNER_OUT, *_carried(raw))


ESTAB_INT = ["cod_pais", "cod_mun", "situacao_cadastral", "motivo_situacao_cadastral"]
ESTAB_TEXT = ["nome_fantasia", "nome_cidade_ext", "tipo_logradouro", "logradouro", "complemento", "bairro"]
ESTAB_DATE = ["data_situacao_cadastral", "data_inicio_atividades", "data_situacao_especial"]


def establishments_table(raw: DataFrame, mun: DataFrame, pais: DataFrame, small: dict[str, bool] | None = None) -> DataFrame:
    small = small or {}
    fixes = {c: to_int(c) for c in ESTAB_INT}
    fixes.update({c: clean_text(c) for c in ESTAB_TEXT})
    fixes.update({c: to_date8(c) for c in ESTAB_DATE})
    fixes.update({
        "cnpj": pad_key("cnpj", S.CNPJ_ROOT_WIDTH),
        "cnae_primario": pad_key("cnae_primario", S.CNAE_WIDTH),
        "id_matriz": decode("id_matriz", S.HQ_LABELS, cast="int"),
        "uf": upper_trim("uf"),
        "correio_eletronico": repair_email("correio_eletronico"),
        "numero": blank_sentinel("numero"),
    })
    df = raw.withColumns(fixes)
    # establishments without a known municipality are not published
    df = lookup(df, mun.select("cod_mun", "nome_mun"), "cod_mun", "inner", small=small.get("mun"))
    df = lookup(df, pais.select("cod_pais", "nome_pais"), "cod_pais", "left", small=small.get("pais"))
    return project(df, [*S.ESTAB_OUT, *_carried(raw)])


# --- file-level job ---------------------------------------------------------

def _not_archives(marker: str) -> str:
    """Name glob: holds ``marker`` and does not end in ``.zip`` (downloads lie beside the files)."""
    tails = ("", "*[^pP]", "*[^iI][pP]", "*[^zZ][iI][pP]", "*[^.][zZ][iI][pP]")
    return "{" + ",".join(f"*{marker}{t}" for t in tails) + "}"


GLOBS = {name: f"*{marker}CSV" for marker, name in S.CODE_TABLES.items()} | {
    "simples": _not_archives(S.SIMPLES_MARKER)} | {kind: f"*{marker}" for kind, marker in S.BIG_TABLE_MARKERS.items()}


def raw_files(spark: SparkSession, raw_root: str) -> DataFrame:
    """Every raw file of the register with the table it belongs to: kind, path, name, length, modificationTime."""
    name = F.col("name")
    kinds = [F.when(name.endswith(marker + "CSV"), F.lit(kind)) for marker, kind in S.CODE_TABLES.items()]
    kinds += [F.when(name.endswith(marker), F.lit(kind)) for kind, marker in S.BIG_TABLE_MARKERS.items()]
    kinds.append(F.when(name.contains(S.SIMPLES_MARKER) & ~F.lower(name).endswith(".zip"), F.lit("simples")))
    return list_files(spark, raw_root).withColumn("kind", F.explode(F.array_compact(F.array(*kinds)))).select(
        "kind", "path", "name", "length", "modificationTime")


def inventory(spark: SparkSession, raw_root: str, required: list[str] | None = None) -> dict[str, str]:
    """A fingerprint of each table's raw files (names, sizes and time stamps).

    One aggregate of the listing: one row for all tables comes back, however
    many files there are.  A table with no file is an error: an empty code
    table would silently null every label.
    """
    mark = F.xxhash64("path", "length", "modificationTime")
    each = raw_files(spark, raw_root).groupBy("kind").agg(
        F.concat_ws("-", F.count(F.lit(1)), F.sum("length"), F.hex(F.bit_xor(mark))).alias("fingerprint"))
    found = each.agg(F.map_from_entries(F.collect_list(F.struct("kind", "fingerprint")))).first()[0]     # a row for each table
    must = set(S.CODE_TABLES.values()) | set(required if required is not None else
                                              ["simples", *S.BIG_TABLE_MARKERS])
    missing = sorted(must - set(found))
    if missing:
        raise FileNotFoundError(f"no raw files under {raw_root} for: {', '.join(missing)}")
    return found


def scan_table(spark: SparkSession, raw_root: str, kind: str, cols: list[str], options: dict[str, str] | None = None,
               checked: bool = False) -> DataFrame:
    """The raw files of a table by one glob scan, with the standard options, overridden by ``options``.

    ``checked`` adds the column of malformed records (``sources.delimited``).
    """
    opts = dict(S.REGISTRY_READ_OPTIONS)
    opts.update(options or {})
    return scan_delimited(spark, raw_root, cols, options=opts, file_glob=GLOBS[kind], recursive=True, checked=checked)


NEEDED = {"simples": "simples", "empresas": "companies", "socios": "partners", "estab": "establishments"}
_COLS = {"simples": S.SIMPLES_COLS, "companies": S.COMPANY_COLS, "partners": S.PARTNER_COLS, "establishments": S.ESTAB_COLS} | {
    name: [f"cod_{name}", f"nome_{name}"] for name in S.CODE_TABLES.values()}


def run(spark: SparkSession, raw_root: str, out_root: str, fmt: str = "parquet",
        partition_by: dict[str, list[str]] | None = None, compat: bool = False,
        read_options: dict[str, str] | None = None, tables: list[str] | None = None,
        release: bool = False, mode: str = "overwrite", quarantine: bool = False) -> dict[str, str]:
    """Whole register: code tables first (the others decode against them).

    ``partition_by`` optionally lays a published table out by columns, e.g.
    ``{"estab": ["uf"]}``.  ``compat=True`` publishes the earlier types where
    the defaults deliberately differ: ``capital_social`` as float and the
    simples key unpadded.  ``read_options`` overrides the raw read options
    (e.g. ``{"encoding": "UTF-8"}`` if a release changes its encoding).
    ``tables`` rebuilds only some of ``simples``, ``empresas``, ``socios``,
    ``estab`` (the code tables are always rebuilt: they are tiny and the
    others decode against them).

    ``release=True`` publishes all tables together (``sinks.publish``): they
    are written beside the published ones, a pointer is swapped last, a
    stopped run is gone on with, and tables whose inputs did not change are
    not written again.  ``mode`` is the write mode of the tables or of the
    release.  ``quarantine=True`` also writes the malformed raw records of all
    tables to ``df_malformed`` (table, file, record, problem); they stay in
    their tables too, as far as they could be read.
    """
    wanted = set(tables or NEEDED)
    unknown = wanted - set(NEEDED)
    if unknown:
        raise ValueError(f"unknown register tables: {sorted(unknown)}")
    if fmt != "parquet":
        raise ValueError("the register job decodes against parquet code tables; use fmt='parquet'")
    layout = partition_by or {}
    marks = inventory(spark, raw_root, [NEEDED[t] for t in wanted])
    # what a table is made from: its raw files, how they are read, and the code tables
    settings = json.dumps([read_options, compat, layout, quarantine], sort_keys=True)
    codes_mark = "|".join(marks[name] for name in sorted(S.CODE_TABLES.values()))
    prints = {name: f"{marks[name]}|{settings}" for name in S.CODE_TABLES.values()} | {
        name: f"{marks[kind]}|{codes_mark}|{settings}" for name, kind in NEEDED.items() if kind in marks}
    target = Release(spark, out_root, json.dumps([sorted(wanted), prints], sort_keys=True), mode) if release else None
    if target is not None and target.skip:
        return {name.removeprefix("df_"): path for name, path in target.commit().items()}
    out: dict[str, str] = {}

    def put(name: str, build: Callable[[], DataFrame], **options) -> None:
        if target is not None:
            out[name] = target.write(f"df_{name}", prints[name], build, **options)
        else:
            out[name] = f"{out_root}/df_{name}"
            write_table(build(), out[name], fmt, mode=mode, **options)

    def raw(kind: str) -> DataFrame:
        return scan_table(spark, raw_root, kind, _COLS[kind], read_options)

    for name in S.CODE_TABLES.values():
        put(name, lambda n=name: code_table(raw(n), n))
    # the written code tables cut the lineage
    codes = {name: spark.read.parquet(out[name]) for name in ("natju", "quals", "pais", "mun")}
    small = fits_broadcast_all(codes)  # each checked once, all in one job
    require_unique({f"cod_{name}": df for name, df in codes.items()})

    builders = {
        "simples": lambda raw: simples_table(raw, pad=not compat),
        "empresas": lambda raw: companies_table(
            raw, codes["natju"], codes["quals"], capital_type="float" if compat else "decimal(18,2)", small=small),
        "socios": lambda raw: partners_table(raw, codes["quals"], codes["pais"], small=small),
        "estab": lambda raw: establishments_table(raw, codes["mun"], codes["pais"], small=small),
    }
    for name, build in builders.items():  # one map-only job per table, in order
        if name in wanted:
            put(name, lambda n=name, b=build: b(raw(NEEDED[n])), partition_by=layout.get(name))
    if quarantine:
        kinds = [*S.CODE_TABLES.values(), *(NEEDED[t] for t in builders if t in wanted)]
        prints["malformed"] = "|".join(marks[k] for k in kinds) + settings
        put("malformed", lambda: reduce(DataFrame.unionByName, [
            malformed_records(scan_table(spark, raw_root, k, _COLS[k], read_options, checked=True), _COLS[k],
                              {**S.REGISTRY_READ_OPTIONS, **(read_options or {})}["sep"]).withColumn("table", F.lit(k)) for k in kinds]).select(
            "table", "file", "record", "problem"))
    if target is not None:
        target.commit()
    return out


def run_archives(spark: SparkSession, archive_root: str, work_root: str, out_root: str, **kwargs) -> dict[str, str]:
    """Downloaded ``.zip`` archives -> published tables: every member is
    unpacked in parallel (one task per member) into ``work_root/<archive>/``,
    then the whole register is built from there."""
    from tabulae.sources.archives import unpack_archives

    unpack_archives(spark, archive_root, work_root)
    return run(spark, work_root, out_root, **kwargs)

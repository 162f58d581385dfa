"""The register job, incrementally: each run cleans only newly landed files.

One ``availableNow`` stream per table reads the files of that table (by name
marker) that arrived since its last run, cleans them with the same table
function as the batch job, decodes against the static code tables (checked
and broadcast as in batch: a stream-static join) and appends to the
published table.  Each stream's checkpoint is its ledger, so a file is
published exactly once even across crashes and re-runs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tabulae import schemas as S
from tabulae.operators.lookups import fits_broadcast_all
from tabulae.plans import registry as R
from tabulae.streaming.ingest import ingest_available
from tabulae.streaming.ledger import ingest_files

_TABLES = {
    # published name: (file-name glob, raw columns, builder(raw, codes, small))
    "simples": (f"*{S.SIMPLES_MARKER}*", S.SIMPLES_COLS, lambda raw, c, s: R.simples_table(raw)),
    "empresas": (f"*{S.BIG_TABLE_MARKERS['companies']}", S.COMPANY_COLS,
                 lambda raw, c, s: R.companies_table(raw, c["natju"], c["quals"], small=s)),
    "socios": (f"*{S.BIG_TABLE_MARKERS['partners']}", S.PARTNER_COLS,
               lambda raw, c, s: R.partners_table(raw, c["quals"], c["pais"], small=s)),
    "estab": (f"*{S.BIG_TABLE_MARKERS['establishments']}", S.ESTAB_COLS,
              lambda raw, c, s: R.establishments_table(raw, c["mun"], c["pais"], small=s)),
}


def run_incremental(spark: SparkSession, landing_root: str, codes_root: str, out_root: str,
                    checkpoint_root: str, tables: list[str] | None = None,
                    read_options: dict[str, str] | None = None) -> dict[str, str]:
    """Append newly landed raw files of each table to ``out_root/df_<table>``.

    ``codes_root`` holds the published code tables (``df_natju`` ...), e.g.
    the output of a batch ``registry.run``.
    """
    opts = dict(S.REGISTRY_READ_OPTIONS)
    opts.update(read_options or {})
    codes = {name: spark.read.parquet(f"{codes_root}/df_{name}") for name in ("natju", "quals", "pais", "mun")}
    small = fits_broadcast_all(codes)
    out = {}
    for name in tables or list(_TABLES):
        glob, cols, build = _TABLES[name]
        out[name] = f"{out_root}/df_{name}"
        ingest_available(
            spark, landing_root, S.string_schema(cols), out[name], f"{checkpoint_root}/{name}",
            options=opts, transform=lambda raw, b=build: b(raw, codes, small), file_glob=glob,
        )
    return out


def run_ledgered(spark: SparkSession, landing_root: str, codes_root: str, out_root: str, tables: list[str] | None = None,
                 read_options: dict[str, str] | None = None, overwrite: bool = False) -> dict[str, str]:
    """As ``run_incremental``, with the ledger of ``streaming.ledger``.

    Read the tables with ``ledger.published``.  With ``overwrite`` a file that
    is delivered again under its name replaces its earlier rows; without, the
    first delivery stays.
    """
    opts = dict(S.REGISTRY_READ_OPTIONS)
    opts.update(read_options or {})
    codes = {name: spark.read.parquet(f"{codes_root}/df_{name}") for name in ("natju", "quals", "pais", "mun")}
    small = fits_broadcast_all(codes)
    out = {}
    for name in tables or list(_TABLES):
        glob, cols, build = _TABLES[name]
        out[name] = f"{out_root}/df_{name}"
        ingest_files(spark, landing_root, out[name], list(cols), lambda raw, b=build: b(raw, codes, small),
                     file_glob=glob, overwrite=overwrite, options=opts)
    return out

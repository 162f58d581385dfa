"""Command line for the jobs, meant for ``spark-submit``:

    spark-submit --py-files tabulae.zip tabulae/__main__.py registry <raw_root> <out_root>
    python -m tabulae trade <raw_root> <out_root> [--partition-by ano] [--fact-sep ';']
    python -m tabulae manifest <pages> <out> --kind trade [--years 2016 2021] [--known <ledger>]
    python -m tabulae incremental <landing> <out_root> --codes <published> --checkpoints <folder>

``registry --archives <work_root>`` unpacks downloaded archives first.  The
session comes from the submit configuration (``getOrCreate``); nothing here
overrides cluster settings.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tabulae")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, source: str, target: str, about: str) -> argparse.ArgumentParser:
        p = jobs.add_parser(name, help=about)
        p.add_argument("source", metavar=source)
        p.add_argument("target", metavar=target)
        return p

    registry = job("registry", "raw_root", "out_root", "build the whole register")
    trade = job("trade", "raw_root", "out_root", "build both trade flows")
    incremental = job("incremental", "landing", "out_root", "publish newly landed register files")
    manifest = job("manifest", "pages", "out", "list the files to fetch from crawled index pages (parquet: html)")
    for p in (registry, trade):
        p.add_argument("--partition-by", nargs="*", default=None,
                       help="columns to lay the output out by: trade flows (e.g. ano) or establishments (e.g. uf)")
        p.add_argument("--format", choices=["parquet", "csv"], default="parquet",
                       help="output format (the register job decodes against parquet code tables)")
        p.add_argument("--compat", action="store_true",
                       help="publish the earlier types (float capital, int measures, unpadded simples key)")
    trade.add_argument("--fact-sep", default=",", help="separator of the fact files (';' for the portal's own)")
    registry.add_argument("--archives", metavar="work_root", default=None,
                          help="raw_root holds downloaded archives: unpack them to this folder first")
    registry.add_argument("--release", action="store_true",
                          help="publish all tables together under out_root (a pointer is swapped last; a stopped run is gone on with)")
    registry.add_argument("--quarantine", action="store_true", help="also write the malformed raw records (df_malformed)")
    incremental.add_argument("--ledger", action="store_true", help="keep a ledger of files beside each table instead of a stream checkpoint")
    incremental.add_argument("--overwrite", action="store_true", help="with --ledger: a file delivered again replaces its earlier rows")
    for p in (registry, incremental):
        p.add_argument("--tables", nargs="*", default=None, help="only these of simples empresas socios estab")
    for p in (registry, trade, incremental):
        p.add_argument("--encoding", default=None, help="raw file encoding, if not the usual one")
    incremental.add_argument("--codes", required=True, help="folder of the published code tables")
    incremental.add_argument("--checkpoints", default=None, help="shared folder of the stream checkpoints (not with --ledger)")
    manifest.add_argument("--kind", choices=["registry", "trade"], required=True)
    manifest.add_argument("--years", nargs=2, type=int, default=None, metavar=("FROM", "TO"))
    manifest.add_argument("--all-years", action="store_true", help="trade links of every year, or without one")
    manifest.add_argument("--known", default=None, help="an earlier manifest (parquet): list only names not in it")
    return parser


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"tabulae-{args.job}").getOrCreate()
    if args.job == "registry":
        from tabulae.plans import registry

        options = dict(fmt=args.format, compat=args.compat, tables=args.tables,
                       partition_by={"estab": args.partition_by} if args.partition_by else None,
                       read_options={"encoding": args.encoding} if args.encoding else None,
                       release=args.release, quarantine=args.quarantine)
        if args.archives:
            out = registry.run_archives(spark, args.source, args.archives, args.target, **options)
        else:
            out = registry.run(spark, args.source, args.target, **options)
    elif args.job == "trade":
        from tabulae.plans import trade

        out = trade.run(spark, args.source, args.target, fmt=args.format, partition_by=args.partition_by,
                        fact_sep=args.fact_sep, compat=args.compat, encoding=args.encoding or "UTF-8")
    elif args.job == "incremental":
        from tabulae.streaming.registry import run_incremental, run_ledgered

        if args.ledger:
            out = run_ledgered(spark, args.source, args.codes, args.target, tables=args.tables, overwrite=args.overwrite,
                               read_options={"encoding": args.encoding} if args.encoding else None)
        elif not args.checkpoints:
            raise SystemExit("incremental needs --checkpoints, or --ledger")
        else:
            out = run_incremental(spark, args.source, args.codes, args.target, args.checkpoints, tables=args.tables,
                                  read_options={"encoding": args.encoding} if args.encoding else None)
    else:
        from tabulae.operators import links
        from tabulae.operators.ingest import new_only
        from tabulae.sinks import write_table

        pages = spark.read.parquet(args.source)
        if args.kind == "trade":
            files = links.trade_manifest(pages, links.ALL_YEARS if args.all_years else tuple(args.years) if args.years else None)
        else:
            files = links.registry_manifest(pages)
        if args.known:
            files = new_only(files, spark.read.parquet(args.known), "name")
        write_table(files, args.target)
        out = {"manifest": args.target}
    for name, path in out.items():
        print(f"{name}\t{path}")
    return 0


if __name__ == "__main__":
    sys.exit(main())

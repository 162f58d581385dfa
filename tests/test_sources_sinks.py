"""Raw-text quirks of the readers and writers."""

import os

import pytest

from tabulae.sinks import write_delimited, write_table
from tabulae.sources.delimited import csv_to_parquet, scan_delimited, scan_header_csv
from tabulae.sources.files import list_files

from conftest import rows


def write(path, text, encoding="ISO-8859-1"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as fh:
        fh.write(text)


def test_quote_escape_rules(spark, tmp):
    write(f"{tmp}/a/X.EMPRECSV", '"02";;"b\\";"d"\n"x ""y"" z";"";"Ã";\n"short"\n')
    got = scan_delimited(spark, f"{tmp}/a", ["c1", "c2", "c3", "c4"], file_glob="*EMPRECSV", recursive=True).collect()
    got = [tuple(r) for r in got]
    assert got[0] == ("02", None, "b\\", "d")          # backslash is data; ; splits
    assert got[1] == ('x "y" z', None, "Ã", None)      # doubled quote; "" is null; latin-1 decoded
    assert got[2] == ("short", None, None, None)        # short rows padded with null


def test_glob_matches_bare_and_prefixed_names(spark, tmp):
    write(f"{tmp}/r/p1/EMPRECSV", '"1"\n')
    write(f"{tmp}/r/p2/F.K03200$Z.D10710.EMPRECSV", '"2"\n')
    write(f"{tmp}/r/p2/F.K03200$Z.D10710.ESTABELECSV", '"3"\n')
    got = scan_delimited(spark, f"{tmp}/r", ["c"], file_glob="*EMPRECSV", recursive=True)
    assert rows(got) == [("1",), ("2",)]


def test_delimited_round_trip_keeps_blanks(spark, tmp):
    df = spark.createDataFrame([("1", "  lead", "trail  ", 'q"uote;semi'), ("2", None, "x\ny", "é")], "a string, b string, c string, d string")
    write_delimited(df, f"{tmp}/rt")
    back = scan_delimited(spark, f"{tmp}/rt", ["a", "b", "c", "d"], multiline=True)
    assert rows(back) == rows(df)


def test_header_csv_and_parquet(spark, tmp):
    write(f"{tmp}/h/t.csv", "A;B;C\n1;x;\n2;y;z\n", encoding="utf-8")
    assert rows(scan_header_csv(spark, f"{tmp}/h", ["A", "C"], sep=";")) == [("1", None), ("2", "z")]
    pq = csv_to_parquet(spark, f"{tmp}/h", f"{tmp}/p", sep=";")
    assert pq.columns == ["A", "B", "C"] and pq.count() == 2


def test_sinks(spark, tmp):
    df = spark.createDataFrame([(1, " a ")], "k int, v string")
    write_table(df, f"{tmp}/o")
    write_table(df, f"{tmp}/o")  # overwrite: a re-run does not fail
    write_table(df, f"{tmp}/c", fmt="csv")
    assert rows(scan_header_csv(spark, f"{tmp}/c")) == [("1", " a ")]
    with pytest.raises(ValueError):
        write_table(df, f"{tmp}/x", fmt="xlsx")


def test_list_files_filters(spark, tmp):
    for name in ("EXP_2020_MUN.csv", "IMP_2020_MUN.csv", "EXP_2020.txt"):
        write(f"{tmp}/l/{name}", "x\n")
    names = lambda **kw: sorted(r.name for r in list_files(spark, f"{tmp}/l", **kw).collect())
    assert names(suffix=".csv") == ["EXP_2020_MUN.csv", "IMP_2020_MUN.csv"]
    assert names(contains="EXP") == ["EXP_2020.txt", "EXP_2020_MUN.csv"]
    assert names(regex=r"^IMP_\d{4}") == ["IMP_2020_MUN.csv"]


def test_header_groups(spark, tmp):
    from tabulae.operators.sets import union_by_name
    from tabulae.sources.delimited import read_headers, scan_header_groups

    write(f"{tmp}/g/a.csv", "A,B\n1,x\n", encoding="utf-8")
    write(f"{tmp}/g/b.csv", "A,B\n2,y\n3,z\n", encoding="utf-8")
    write(f"{tmp}/g/c.csv", '"B","A"\r\nw,4\r\n', encoding="utf-8")
    paths = [f"{tmp}/g/{n}.csv" for n in "abc"]
    assert set(read_headers(spark, paths).values()) == {"A,B", '"B","A"'}
    groups = scan_header_groups(spark, paths)
    assert len(groups) == 2  # one scan per distinct header
    assert rows(union_by_name(groups).select("A", "B")) == [("1", "x"), ("2", "y"), ("3", "z"), ("4", "w")]


def test_header_with_byte_order_mark(spark, tmp):
    from tabulae.sources.delimited import scan_header_groups

    write(f"{tmp}/bom/a.csv", "﻿CO_ANO,NO\n2020,x\n", encoding="utf-8")
    (df,) = scan_header_groups(spark, [f"{tmp}/bom/a.csv"])
    assert df.columns == ["CO_ANO", "NO"] and rows(df) == [("2020", "x")]


def test_empty_header_file_is_skipped(spark, tmp):
    from tabulae.sources.delimited import scan_header_groups

    write(f"{tmp}/e/a.csv", "A,B\n1,x\n", encoding="utf-8")
    write(f"{tmp}/e/empty.csv", "", encoding="utf-8")
    groups = scan_header_groups(spark, [f"{tmp}/e/a.csv", f"{tmp}/e/empty.csv"])
    assert len(groups) == 1 and rows(groups[0]) == [("1", "x")]

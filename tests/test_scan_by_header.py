"""Header files of several layouts through one splittable scan."""

import os

import pytest

from tabulae.sources.delimited import scan_by_header, scan_header_groups
from tabulae.sources.files import list_files


def put(folder, name, text, encoding="utf-8"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding=encoding, newline="") as f:
        f.write(text)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_layouts_blank_lines_and_marks(spark, tmp):
    put(f"{tmp}/in/a", "EXP_1.csv", "x,y,z\n1,\"a, b\",c\n\n2,,\n,,only z\n,,\n")
    put(f"{tmp}/in/b", "EXP_2.csv", "﻿z,x,more,y\r\nc,3,m,\"say \"\"é\"\"\"\r\n,,m,\r\n,,,\r\n")
    put(f"{tmp}/in", "EXP_3.csv", "x,y,z\n4,d,e\nx,y,z\n5,f,g")
    put(f"{tmp}/in", "EXP_4.csv", "")
    put(f"{tmp}/in", "IMP_1.csv", "x,y,z\n9,no,no\n")
    put(f"{tmp}/in", "EXP.zip", "no")
    got = scan_by_header(spark, f"{tmp}/in", ["x", "y"], contains="EXP")
    want = [("1", "a, b"), ("2", None), (None, None), (None, None), ("3", 'say "é"'), (None, None), (None, None), ("4", "d"), ("5", "f")]
    assert rows(got) == sorted(want, key=str)
    kept = scan_by_header(spark, f"{tmp}/in", ["x", "y"], contains="EXP", drop_empty=True)
    # judged on every column a file has: a row with only z, or only the column that is not asked for, stays
    assert rows(kept) == sorted([w for w in want if w != (None, None)] + [(None, None)] * 2, key=str)


def test_same_rows_as_a_scan_for_each_header(spark, tmp):
    for i in range(6):
        order = ["k", "v", "w"] if i % 2 else ["w", "k", "v"]
        body = "".join(",".join({"k": str(j), "v": f'"q{j}"', "w": f"ç{i}"}[c] for c in order) + "\n" for j in range(200))
        put(f"{tmp}/in", f"f{i}.csv", ",".join(order) + "\n" + body)
    paths = [r["path"] for r in list_files(spark, f"{tmp}/in").collect()]
    old = [t for df in scan_header_groups(spark, paths) for t in rows(df.select("k", "v", "w"))]
    assert rows(scan_by_header(spark, f"{tmp}/in", ["k", "v", "w"])) == sorted(old, key=str)


def test_latin_text_and_separator(spark, tmp):
    put(f"{tmp}/in", "f.csv", "a;b\nção;1\n", "latin-1")
    assert rows(scan_by_header(spark, f"{tmp}/in", ["b", "a"], sep=";", encoding="ISO-8859-1")) == [("1", "ção")]
    with pytest.raises(ValueError, match="UTF-16"):
        scan_by_header(spark, f"{tmp}/in", ["a"], encoding="UTF-16")


def test_missing_column_and_empty_folder(spark, tmp):
    put(f"{tmp}/in", "f.csv", "a,b\n1,2\n")
    with pytest.raises(ValueError, match=r"lacks the columns \['c'\]"):
        scan_by_header(spark, f"{tmp}/in", ["a", "c"])
    put(f"{tmp}/none", "f.csv", "")
    assert scan_by_header(spark, f"{tmp}/none", ["a", "c"]).count() == 0


def test_a_file_is_read_by_many_tasks(spark, tmp):
    put(f"{tmp}/in", "f.csv", "a,b\n" + "".join(f"{i},text of a line\n" for i in range(50_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        df = scan_by_header(spark, f"{tmp}/in", ["a"])
        assert df.rdd.getNumPartitions() > 5
        assert sorted(int(r[0]) for r in df.collect()) == list(range(50_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)

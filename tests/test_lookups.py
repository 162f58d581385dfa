"""Lookup joins: semantics, both physical paths, invariants, plan shape."""

import pytest
from pyspark.sql import functions as F

from tabulae.operators.lookups import coerce_key, duplicate_keys, fits_broadcast, lookup, require_unique, unmatched_keys
from tabulae.operators.sets import distinct_rows, union_by_name

from conftest import SF01, rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_left_keeps_rows_and_nulls(spark):
    fact = spark.createDataFrame([(1, 10), (2, None), (3, 99), (4, 10)], "id int, k int")
    dim = spark.createDataFrame([(10, "ten")], "k int, name string")
    small = lookup(fact, dim, "k", "left")
    big = lookup(fact, dim, "k", "left", max_broadcast_rows=0)  # shuffle path, salted nulls
    expect = [(1, 10, "ten"), (2, None, None), (3, 99, None), (4, 10, "ten")]
    assert rows(small.select("id", "k", "name")) == expect
    assert rows(big.select("id", "k", "name")) == expect
    assert "BroadcastHashJoin" in _plan(small)
    assert "__tabulae_null_salt" not in big.columns


def test_inner_drops_unknown_and_null(spark):
    fact = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id int, k int")
    dim = spark.createDataFrame([(10, "ten")], "k int, name string")
    assert rows(lookup(fact, dim, "k", "inner")) == [(10, 1, "ten")]
    assert rows(lookup(fact, dim, "k", "inner", max_broadcast_rows=0)) == [(10, 1, "ten")]


def test_coerced_text_key(spark):
    fact = spark.createDataFrame([(101,), (5,), (None,)], "SH4 int")
    dim = spark.createDataFrame([("0101", "a"), ("101.0", "b"), ("x", "c")], "SH4 string, name string")
    got = rows(lookup(fact, coerce_key(dim, "SH4", "int"), "SH4", "inner"))
    assert got == [(101, "a")]  # '0101' matches 101; '101.0' and junk never match
    dim2 = spark.createDataFrame([("101.0", "b"), ("5.5", "c"), ("x", "d")], "SH4 string, name string")
    got = rows(lookup(fact, coerce_key(dim2, "SH4", "int", integral_decimals=True), "SH4", "inner"))
    assert got == [(101, "b")]  # a whole decimal names the code; 5.5 does not


def test_size_check_is_bounded(spark):
    df = spark.range(1000)
    assert fits_broadcast(df, 1000) and not fits_broadcast(df, 999)
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("label"))
    assert fits_broadcast(wide, max_bytes=10_000) and not fits_broadcast(wide, max_bytes=9_999)
    assert fits_broadcast(spark.range(0))


def test_invariants_on_tables(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").select("l_orderkey", (F.col("l_suppkey") % 30).alias("k"))
    nation = spark.read.parquet(f"{SF01}/nation.parquet").select(F.col("n_nationkey").cast("bigint").alias("k"), "n_name")
    n = li.count()
    assert lookup(li, nation, "k", "left").count() == n
    inner = lookup(li, nation, "k", "inner").count()
    lost = li.join(nation, "k", "left_anti").count()
    assert inner + lost == n
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    parts = [o.where(F.col("o_orderstatus") == s) for s in ("F", "O", "P")]
    assert union_by_name(parts).count() == sum(p.count() for p in parts) == o.count()
    assert distinct_rows(spark.read.parquet(f"{SF01}/part.parquet"), ["p_brand", "p_type"]).count() == 150


def test_union_by_name_reordered(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k int")
    assert rows(union_by_name([a, b])) == [(1, "x"), (2, "y")]


def test_lookup_role_matches_renamed_lookup(spark):
    from tabulae.operators.columns import suffix_columns
    from tabulae.operators.lookups import lookup_role

    fact = spark.createDataFrame([(1, 10, 20), (2, None, 10), (3, 99, None)], "id int, q int, q_rep int")
    dim = spark.createDataFrame([(10, "ten"), (20, "twenty")], "q int, name string")
    a = lookup_role(fact, dim, "q", "q_rep", {"name": "name_rep"})
    b = lookup(fact, suffix_columns(dim, "_rep").withColumnRenamed("q_rep", "q_rep"), "q_rep", "left")
    want = [(1, 10, 20, "twenty"), (2, None, 10, "ten"), (3, 99, None, None)]
    assert rows(a.select("id", "q", "q_rep", "name_rep")) == want
    assert rows(b.select("id", "q", "q_rep", "name_rep")) == want
    c = lookup_role(fact, dim, "q", "q_rep", {"name": "name_rep"}, max_broadcast_rows=0)
    assert rows(c.select("id", "q", "q_rep", "name_rep")) == want


def test_new_only_both_paths(spark):
    from tabulae.operators.ingest import new_only

    manifest = spark.createDataFrame([("a.zip", 1), ("b.zip", 2), ("c.zip", 3), (None, 4)], "name string, n int")
    ledger = spark.createDataFrame([("a.zip",), ("a.zip",), ("c.zip",)], "name string")
    want = [(None, 4), ("b.zip", 2)]  # duplicates in the ledger are harmless; a null name is never "done"
    assert rows(new_only(manifest, ledger, "name")) == want
    assert rows(new_only(manifest, ledger, "name", max_broadcast_rows=0)) == want
    assert new_only(manifest, ledger, "name", overwrite=True).count() == 4


def test_fits_broadcast_all_matches_single_checks(spark):
    from tabulae.operators.lookups import fits_broadcast_all

    dims = {"a": spark.range(10), "b": spark.range(1000), "c": spark.range(0),
            "d": spark.range(5).select(F.repeat(F.lit("x"), 100).alias("s"))}
    got = fits_broadcast_all(dims, max_rows=100, max_bytes=400)
    assert got == {k: fits_broadcast(v, 100, 400) for k, v in dims.items()}
    assert got == {"a": True, "b": False, "c": True, "d": False}


def test_duplicate_and_unmatched_keys(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    fact = spark.createDataFrame([(1,), (3,), (3,), (None,)], "k int")
    assert rows(duplicate_keys(dim, "k")) == [(1, 2)]
    assert sorted(map(tuple, unmatched_keys(fact, dim, "k").collect()), key=str) == [(3, 2), (None, 1)]
    require_unique({"k": dim.where("v <> 'b'")})
    with pytest.raises(ValueError, match=r"k=1 \(2 rows\)"):
        require_unique({"k": dim})

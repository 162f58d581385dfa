"""Jobs on rows that only larger tables hold."""

import datetime
import glob
import shutil

import pytest
from pyspark.sql import functions as F

from oracle_compare import compare, duck
from tabulae.catalog import jobs_q
from tabulae.catalog.all import CATALOG
from tabulae.functions.clean import clean_text
from tabulae.operators.geocode import similar_sets
from tabulae.plans import trade as T
from test_golden_trade import make_raw


def tables(spark, root, **of):
    for name, (schema, data) in of.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{root}/{name}.dir")
        shutil.copy(glob.glob(f"{root}/{name}.dir/*.parquet")[0], f"{root}/{name}.parquet")


def test_trade_job_of_a_million_products(spark, tmp):
    """Headings are six digits: products 100000 and 1000001 share one, and a fact of it is published for both."""
    day = datetime.datetime(1997, 3, 4)
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    tables(spark, tmp,
           part=("p_partkey long, p_name string, p_brand string, p_type string, p_size int",
                 [(100000, "a", "b1", "t", 1), (1000001, "c", "b2", "t", 2), (7, "d", "b3", "t", 3)]),
           supplier=("s_suppkey long, s_name string", [(1, "s1"), (2, "s2")]),
           nation=("n_nationkey int, n_name string", [(k, f"N{k}") for k in range(25)]),
           lineitem=(line, [(k, p, s, 2.0, 3.0, f, st, day) for k, (p, s, f, st) in enumerate(
               (p, s, f, st) for p in (100000, 1000001, 7) for s in (1, 2) for f, st in ("AF", "AO", "RF", "RO", "NF"))]))
    query, sql = CATALOG["trade_job"]
    ok, msg = compare(query(spark, str(tmp)), duck(str(tmp)), sql)
    assert ok, msg


def test_repeated_lookup_keys_are_an_error_unless_named(spark, tmp):
    raw = f"{tmp}/raw"
    make_raw(raw)
    with open(f"{raw}/aux_tables/NCM_SH.csv", "a", encoding="utf-8") as fh:
        fh.write("02012000,0201,Carnes frescas,02,Carnes,I,Animais \n")
    with pytest.raises(ValueError, match="more than once.*SH4=201"):
        T.run(spark, raw, f"{tmp}/strict")
    with pytest.raises(ValueError, match="unknown lookup keys"):
        T.run(spark, raw, f"{tmp}/strict", repeated=("SH5",))
    paths = T.run(spark, raw, f"{tmp}/out", repeated=("SH4",))
    got = sorted((r.SH4, r.nome_sh4, r.VL_FOB) for r in spark.read.parquet(paths["exp"]).collect())
    assert got == [(101, "Cavalos", 5000000000), (201, "Carnes", 7), (201, "Carnes", 20),
                   (201, "Carnes frescas", 7), (201, "Carnes frescas", 20)]


def test_archives_are_bounded_and_read_in_parts(spark, tmp, monkeypatch):
    """A larger table makes more archives, not larger ones, and a large member is read by many tasks."""
    texts = [(k, None if k % 50 == 3 else f'line {k} "q";\nmore ' + "x" * 4000, "en", "web", 9) for k in range(300)]
    tables(spark, tmp, documents=("doc_id long, text string, lang string, source string, n_chars long", texts))
    packed, plain = [], jobs_q.pack_files
    monkeypatch.setattr(jobs_q, "pack_files", lambda *x, **k: packed.append(plain(*x, **k)) or packed[-1])
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 << 10))
    try:
        query, sql = jobs_q.Q["unpack_archives"]
        df = query(spark, str(tmp))
        assert packed[0].count() == 4
        parts = df.withColumn("part", F.spark_partition_id()).groupBy("part").count().collect()
        assert len(parts) > 8, parts
        ok, msg = compare(df, duck(str(tmp)), sql)
        assert ok, msg
        monkeypatch.setattr(jobs_q, "ARCHIVED_BYTES", 100_000)
        query(spark, str(tmp))
        assert packed[1].count() == 12
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)


def test_addresses_of_few_bytes_are_scored_by_many_tasks(spark):
    """Pairs are much work and few bytes: they are not all given to one task."""
    rows = [("mg|x", f"RUA {chr(65 + k // 26)}{chr(65 + k % 26)}X W{k % 50}") for k in range(300)]
    side = spark.createDataFrame(rows, "__place string, __street string")
    pairs = similar_sets(side, side, "__street", 5, 10)
    parts = pairs.withColumn("part", F.spark_partition_id()).groupBy("part").count().collect()
    assert len(parts) > 4, parts
    sets = [set(t.split(" ")) for _, t in rows]
    assert pairs.count() == sum(20 * len(a & b) >= 5 * (len(a) + len(b)) for a in sets for b in sets)


def test_wide_tables_of_text_are_compiled(spark):
    """A cleaned text column adds little code: methods above 8000 bytes run interpreted."""
    df = spark.createDataFrame([("Œuvre № 5 “São” …", None)], "a string, b string")
    names = [f"t{k}" for k in range(6)]
    wide = df.select(*(F.concat("a", F.lit(n)).alias(n) for n in names)).select(*(clean_text(n).alias(n) for n in names))
    assert wide.first()["t0"] == 'Oeuvre No 5 "sao" ...t0'
    stages = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$").codegenStringSeq(wide._jdf.queryExecution().executedPlan())
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert all(x < 8000 for x in sizes), sizes

"""Address words, computed scores and split joins against plain Python."""

import random

from pyspark.sql import functions as F

from tabulae.functions.address import address_words
from tabulae.operators.geocode import geocode, similar_sets
from tabulae.operators.heavy import heavy_keys, split_join
from tabulae.operators.match import PRECISE

GAZ = "id int, rua string, cep string, bairro string, municipio string, uf string, quality string, lat double, lng double"
ASK = "k int, rua string, cep string, bairro string, municipio string, uf string"


def words(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(address_words(F.col("t"))).collect()]


def test_address_words(spark):
    got = words(spark, "R. Dr. João de Souza", "RUA DOUTOR JOAO SOUSA", "Av. N. Sra. da Conceição, 12-B", "  ", None, "São São", "Thereza Mello Pinheiro")
    assert got[0] == got[1] == ["DOUTOR", "JOAO", "RUA", "SOUSA"]
    assert got[2] == ["12", "AVENIDA", "B", "CONCEICAO", "N", "SRA"]
    assert got[3:6] == [[], [], ["SAO"]] and got[6] == ["MELO", "PINHEIRO", "TERESA"]


def run(spark, asked, known):
    got = geocode(spark.createDataFrame(asked, ASK), spark.createDataFrame(known, GAZ))
    assert got.columns == ["k", "rua", "cep", "bairro", "municipio", "uf", "lat", "lng", "tier", "score"]
    return {r["k"]: (r["tier"], r["score"], r["lat"]) for r in got.collect()}


def test_rules(spark):
    known = [
        (1, "Rua das Flores", "01000000", "Centro", "São Paulo", "SP", "PointAddress", 1.0, 0.0),
        (2, "Rua das Flores", "01000001", "Jardim Norte", "São Paulo", "SP", "Locality", 2.0, 0.0),
        (3, "Avenida Paulista Nova", "01000002", "Bela Vista", "São Paulo", "SP", "Locality", 3.0, 0.0),
        (4, "Rua das Flores", "01000000", "Centro", "Campinas", "SP", "PointAddress", 4.0, 0.0),
        (5, "Rua Sem Bairro", None, None, "Campinas", "SP", "StreetAddress", 5.0, 0.0),
        (6, None, "13000000", None, "Campinas", "SP", None, 6.0, 0.0),
        (7, "Rua X", "13000009", "Y", None, "SP", "PointAddress", 7.0, 0.0),
    ]
    asked = [
        (1, "R. FLORES", "0", "CENTRO", "SAO PAULO", "sp"),               # all words agree
        (2, "Rua das Flores", None, "Jd. Norte", "São Paulo", "SP"),      # 100 needs no precise address
        (3, "Avenida Paulista", None, "Bela Vista", "São Paulo", "SP"),   # 86 on a locality: rule 2
        (4, "R. Flores", None, "Centro", "Campinas", "SP"),
        (5, "Rua Sem Bairro", None, "", "Campinas", "SP"),                # both without a quarter
        (6, "Outra", "13000-000", "Nenhum", "Campinas", "SP"),            # rule 3
        (7, "Rua X", "13000009", "Y", None, "SP"),                        # no city
        (8, "Rua das Flores Velhas", None, "Centro", "São Paulo", "SP"),  # 70 * 4/5 + 30 = 86, precise
        (9, None, None, "Centro", "São Paulo", "SP"),                     # no street: rule 2
        (10, "Rua das Flores", None, "Outro", "São Paulo", "SP"),         # 70: not enough
        (1, "R. FLORES", "0", "CENTRO", "SAO PAULO", "sp"),
    ]
    got = run(spark, asked, known)
    assert got == {1: (1, 100, 1.0), 2: (1, 100, 2.0), 3: (2, 100, 3.0), 4: (1, 100, 4.0), 5: (1, 100, 5.0), 6: (3, None, 6.0), 7: (None, None, None),
                   8: (1, 86, 1.0), 9: (2, 100, 1.0), 10: (None, None, None)}
    assert run(spark, asked, [])[1] == (None, None, None) and run(spark, [], known) == {}


def test_generated_addresses_equal_all_pairs(spark):
    r = random.Random(3)
    names = ["FLORES", "PAULISTA", "NOVA", "VELHA", "BRASIL", "MAIO", "SETE", "LUA", "SOL"]

    def text(n):
        return None if r.random() < 0.08 else " ".join(["RUA", *r.sample(names, r.randrange(n))])

    known = [(i, text(5), r.choice([None, f"{r.randrange(30):08d}"]), text(3), r.choice(["A", "B"]), "SP", r.choice([*PRECISE, "Locality", None]), float(i), 0.0) for i in range(300)]
    asked = [(i, text(5), r.choice([None, f"{r.randrange(60):05d}-000", f"{r.randrange(30)}"]), text(3), r.choice(["A", "B", "C", None]), "SP") for i in range(400)]

    def brute(a):
        _, rua, cep, bairro, city, _ = a
        s, q = set((rua or "").split()), set((bairro or "").split())
        code = "".join(c for c in cep or "" if c.isdigit())
        best = []
        for i, r2, c2, b2, m2, _, quality, lat, _ in known:
            if city != m2:
                continue
            s2, q2 = set((r2 or "").split()), set((b2 or "").split())
            qi, qs = (1, 2) if not q and not q2 else (len(q & q2), len(q) + len(q2))
            if s and s2:
                score = 2 * (70 * len(s & s2) * qs + 30 * qi * (len(s) + len(s2))) // ((len(s) + len(s2)) * qs)
                if score == 100 or score >= 80 and quality in PRECISE:
                    best.append((1, -score, i, lat))
            if q and q2 and 200 * len(q & q2) // (len(q) + len(q2)) >= 80:
                best.append((2, -(200 * len(q & q2) // (len(q) + len(q2))), i, lat))
            if code and c2 and code.rjust(8, "0") == c2:
                best.append((3, 0, i, lat))
        if not best:
            return (None, None, None)
        tier, score, _, lat = min(best)
        return (tier, None if tier == 3 else -score, lat)

    got = run(spark, asked, known)
    assert got == {a[0]: brute(a) for a in asked}
    assert {t for t, _, _ in got.values()} == {None, 1, 2, 3}


def test_blocking_loses_no_pair(spark):
    r = random.Random(8)
    sets = sorted({" ".join(sorted(r.sample("ABCDEFGHIJKL", r.randrange(1, 8)))) for _ in range(150)})
    df = spark.createDataFrame([("p", s) for s in sets], "__place string, key string")
    for num, den in ((5, 7), (4, 5), (1, 1), (1, 3)):
        want = {(a, b) for a in sets for b in sets if 2 * den * len(set(a.split()) & set(b.split())) >= num * (len(a.split()) + len(b.split()))}
        got = [(x["key"], x["__other"]) for x in similar_sets(df, df, "key", num, den).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def facts(spark, n=30_000):
    i = F.col("id")
    key = F.when(i % 3 == 0, F.lit(None).cast("long")).when(i % 3 == 1, F.lit(7).cast("long")).otherwise(i % 500)
    return spark.range(n).select("id", key.alias("k"), F.lit("s").alias("t"))


def test_heavy_keys_are_found(spark):
    got = {r[0] for r in heavy_keys(facts(spark), ["k"], 8).collect()}
    assert len(got) == 2
    assert heavy_keys(facts(spark).where("id % 3 = 2"), ["k"], 8).count() == 0
    assert heavy_keys(facts(spark, 0), ["k"], 8).count() == 0


def test_split_join_spreads_null_and_hot_keys(spark):
    dim = spark.range(500).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name")).unionByName(
        spark.createDataFrame([(None, "none")], "k long, name string"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # as if both were large
    try:
        for null_safe, how, want in ((True, "left", 30_000), (False, "left", 30_000), (False, "inner", 20_000), (True, "inner", 30_000)):
            joined = split_join(facts(spark), dim, "k", how, null_safe=null_safe, salt_by=["id"], parts=8)
            assert joined.columns == ["id", "k", "t", "name"]
            spread = joined.withColumn("p", F.spark_partition_id()).groupBy("k").agg(F.countDistinct("p").alias("p"), F.count("*").alias("n"), F.min("name"), F.max("name")).collect()
            by = {r["k"]: r for r in spread}
            assert sum(r["n"] for r in spread) == want
            assert by[7]["n"] == 10_020 and by[7]["p"] > 1 and by[7][3] == by[7][4] == "n7"
            if None in by:
                assert by[None]["n"] == 10_000 and by[None]["p"] > 1 and by[None][3] == ("none" if null_safe else None)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_split_join_on_a_stream_takes_its_heavy_keys_from_earlier_rows(spark, tmp):
    facts(spark, 3_000).write.parquet(f"{tmp}/in")
    heavy = heavy_keys(facts(spark, 3_000), ["k"], 4)
    dim = spark.range(500).select(F.col("id").alias("k"), F.lit("n").alias("name"))
    stream = spark.readStream.schema("id long, k long, t string").parquet(f"{tmp}/in")
    joined = split_join(stream, dim, "k", "inner", salt_by=["id"], heavy=heavy, parts=4)
    q = joined.writeStream.format("parquet").option("checkpointLocation", f"{tmp}/ckpt").trigger(availableNow=True).start(f"{tmp}/out")
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp}/out").count() == 2_000

"""Re-aimed jobs: links, tiered match (vs brute force), archives, streaming."""

import os
import zipfile

from pyspark.sql import functions as F

from tabulae.operators.links import base_name, link_manifest, year_filter
from tabulae.operators.match import Tier, match_addresses, tiered_match
from tabulae.schemas import string_schema
from tabulae.sinks import write_delimited
from tabulae.sources.archives import list_members, unpack_archives
from tabulae.streaming.ingest import ingest_available

from conftest import rows


def test_link_manifest(spark):
    html = ('<a href="/registro/Empresas0.zip">x</a><A class="c" HREF=\'/registro/Socios1.zip\'>y</A>'
            '<a data-href="/no.zip">n</a><a name="top">t</a><a href="/mun/EXP_2020_MUN.csv">e</a>'
            '<a href="/ncm/EXP_2020.csv">n</a>')
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert rows(link_manifest(pages, keep=["page_id"], suffix=".zip")) == [(1, "/registro/Empresas0.zip"), (1, "/registro/Socios1.zip")]
    assert rows(link_manifest(pages, suffix=".csv", contains="mun")) == [("/mun/EXP_2020_MUN.csv",)]


def test_year_and_base_name(spark):
    df = spark.createDataFrame([("https://x/mun/EXP_2015_MUN.csv",), ("https://x/mun/EXP_2016_MUN.csv",),
                                ("https://x/mun/IMP_2021_MUN.csv",), ("https://x/mun/IMP_2022_MUN.csv",),
                                ("https://x/mun/README",)], "u string")
    kept = year_filter(df, "u", 2016, 2021).select("year")
    assert sorted(r.year for r in kept.collect()) == [2016, 2021]
    names = [r[0] for r in df.select(base_name("u", "mun/")).collect()]
    assert names[0] == "EXP_2015_MUN.csv" and names[-1] == "README"


def test_tiered_match_vs_brute_force(spark):
    ref = [  # id, street, city, state, score, quality, lat, lng
        (1, "rua a", "sp", "SP", 100, "Locality", 1.0, 1.0),
        (2, "rua a", "sp", "SP", 90, "PointAddress", 2.0, 2.0),
        (3, None, "sp", "SP", 85, "Locality", 3.0, 3.0),
        (4, "rua b", "rj", "RJ", 70, "PointAddress", 4.0, 4.0),   # tier 1 rejects (score)
        (5, None, "rj", "RJ", 79, "Locality", 5.0, 5.0),          # tier 2 rejects (score)
        (6, None, "rj", "RJ", 10, "Locality", 6.0, 6.0),          # tier 3 accepts anything
        (7, "rua c", "bh", "MG", 95, "StreetAddress", 7.0, 7.0),
        (8, "rua c", "bh", "MG", 95, "StreetAddress", 8.0, 8.0),  # tie: lower id wins
    ]
    recs = [(10, "rua a", "sp", "SP"), (11, "rua x", "sp", "SP"), (12, "rua b", "rj", "RJ"),
            (13, "rua c", "bh", "MG"), (14, "rua z", "pa", "PA"), (15, None, None, None)]
    rdf = spark.createDataFrame(ref, "id int, street string, city string, state string, score int, quality string, lat double, lng double")
    cdf = spark.createDataFrame(recs, "rid int, rua string, municipio string, uf string")
    tiers = [
        Tier({"rua": "street", "municipio": "city", "uf": "state"},
             (F.col("score") == 100) | ((F.col("score") >= 80) & F.col("quality").isin("PointAddress", "StreetAddress"))),
        Tier({"municipio": "city", "uf": "state"}, F.col("score") >= 80),
        Tier({"uf": "state"}),
    ]
    got = {r.rid: (r.lat, r.tier) for r in tiered_match(cdf, rdf, tiers, ["lat", "lng"], [-F.col("score"), F.col("id")]).collect()}

    def brute(rec):
        rid, rua, mun, uf = rec
        rules = [
            (lambda g: (g[1], g[2], g[3]) == (rua, mun, uf) and (g[4] == 100 or (g[4] >= 80 and g[5] in ("PointAddress", "StreetAddress")))),
            (lambda g: (g[2], g[3]) == (mun, uf) and g[4] >= 80),
            (lambda g: g[3] == uf),
        ]
        for t, ok in enumerate(rules, start=1):
            cands = [g for g in ref if None not in (rua, mun, uf)[3 - len(rules) + t - 1:] and ok(g)]
            cands = [g for g in cands if all(v is not None for v in (g[1], g[2], g[3])[t - 1:])]
            if cands:
                best = sorted(cands, key=lambda g: (-g[4], g[0]))[0]
                return (best[6], t)
        return (None, None)

    assert got == {rid: brute(r) for r in recs for rid in [r[0]]}
    assert len(got) == len(recs)  # no fan-out
    # a reference table over the broadcast bound: checkpointed reduction + shuffle joins
    big = tiered_match(cdf, rdf, tiers, ["lat", "lng"], [-F.col("score"), F.col("id")], max_broadcast_rows=0)
    assert {r.rid: (r.lat, r.tier) for r in big.collect()} == got


def test_unpack_archives(spark, tmp):
    os.makedirs(f"{tmp}/zips")
    big = ("x" * 1000 + "\n") * 20000  # 20 MB member: streamed in chunks
    with zipfile.ZipFile(f"{tmp}/zips/K3241.K03200Y0.D10710.zip", "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("K3241.K03200Y0.D10710.EMPRECSV", '"1";"a"\n"2";"b"\n')
        zf.writestr("K3241.K03200Y0.D10710.SOCIOCSV", big)
    with zipfile.ZipFile(f"{tmp}/zips/K3241.K03200Y1.D10710.zip", "w") as zf:
        zf.writestr("EMPRECSV", '"3";"c"\n')
    assert list_members(spark, f"{tmp}/zips").count() == 3
    manifest = unpack_archives(spark, f"{tmp}/zips", f"{tmp}/out")
    assert manifest.rdd.getNumPartitions() == 3  # one task per member
    sizes = {r.member: r.bytes for r in manifest.collect()}
    assert sizes["K3241.K03200Y0.D10710.SOCIOCSV"] == len(big)
    assert os.path.isfile(f"{tmp}/out/K3241.K03200Y0.D10710/K3241.K03200Y0.D10710.EMPRECSV")
    from tabulae.sources.delimited import scan_delimited
    emp = scan_delimited(spark, f"{tmp}/out", ["cnpj", "x"], file_glob="*EMPRECSV", recursive=True)
    assert rows(emp) == [("1", "a"), ("2", "b"), ("3", "c")]


def test_stream_ingests_only_new_files(spark, tmp):
    schema = string_schema(["k", "v"])
    landing, sink, ckpt = f"{tmp}/landing", f"{tmp}/sink", f"{tmp}/ckpt"
    write_delimited(spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string"), f"{landing}/d1")
    ingest_available(spark, landing, schema, sink, ckpt)
    assert spark.read.parquet(sink).count() == 2
    ingest_available(spark, landing, schema, sink, ckpt)  # nothing new
    assert spark.read.parquet(sink).count() == 2
    write_delimited(spark.createDataFrame([("3", "c")], "k string, v string"), f"{landing}/d2")
    ingest_available(spark, landing, schema, sink, ckpt)
    assert rows(spark.read.parquet(sink).select("k", "v")) == [("1", "a"), ("2", "b"), ("3", "c")]


def test_download_manifest(spark):
    from tabulae.operators.links import download_manifest

    html = ('<a href="https://x/mun/EXP_2015_MUN.csv">a</a><a href="https://x/mun/EXP_2016_MUN.csv">b</a>'
            '<a href="https://x/ncm/EXP_2016.csv">c</a><a href="https://x/mun/IMP_2021_MUN.csv">d</a>'
            '<a href="/registro/Empresas0.zip">e</a>')
    pages = spark.createDataFrame([(html,)], "html string")
    trade = download_manifest(pages, ".csv", contains="mun", marker_regex="mun/", years=(2016, 2021))
    assert sorted((r.name, r.year) for r in trade.collect()) == [("EXP_2016_MUN.csv", 2016), ("IMP_2021_MUN.csv", 2021)]
    zips = download_manifest(pages, ".zip")
    assert [r.name for r in zips.collect()] == ["Empresas0.zip"]


def test_cli_runs_trade_job(spark, tmp):
    from tabulae.__main__ import main
    from test_golden_trade import make_raw

    make_raw(f"{tmp}/raw")
    assert main(["trade", f"{tmp}/raw", f"{tmp}/out"]) == 0
    assert spark.read.parquet(f"{tmp}/out/comex_imp").count() == 1


def test_stream_backlog_in_bounded_batches(spark, tmp):
    schema = string_schema(["k", "v"])
    landing, sink, ckpt = f"{tmp}/landing", f"{tmp}/sink", f"{tmp}/ckpt"
    for i in range(3):
        write_delimited(spark.createDataFrame([(str(i), "x")], "k string, v string"), f"{landing}/d{i}")
    batches = ingest_available(spark, landing, schema, sink, ckpt, max_files_per_trigger=1)
    assert batches >= 3
    assert spark.read.parquet(sink).count() == 3


def test_archive_members_cannot_escape():
    import pytest

    from tabulae.sources.archives import safe_member

    assert safe_member("K3241.EMPRECSV") == "K3241.EMPRECSV"
    assert safe_member("dir/./a.csv") == "dir/a.csv"
    for bad in ("../x", "a/../../x", "/etc/x", "..", "C:/x"):
        with pytest.raises(ValueError):
            safe_member(bad)


def test_tiered_match_with_address_rules(spark):
    # (id, street, bairro, cep, city, state, matched address, score, quality, lat, lng)
    ref = [
        (1, "rua a", "centro", "01000", "sao paulo", "SP", "Rua A, Centro, sao paulo", 100, "Locality", 1.0, 1.0),
        (2, "rua b", "centro", "01000", "sao paulo", "SP", "Rua B, somewhere else", 100, "PointAddress", 2.0, 2.0),
        (3, None, "centro", None, "sao paulo", "SP", "Centro, sao paulo", 85, "Locality", 3.0, 3.0),
        (4, None, None, "01000", "sao paulo", "SP", "01000", 10, "Postal", 4.0, 4.0),
        (5, "rua c", "vila", "02000", "sao paulo", "SP", "Rua C, Vila, sao paulo", 85, "Locality", 5.0, 5.0),
    ]
    recs = [  # rid, rua, bairro, cep, municipio, uf
        (10, "rua a", "centro", "01000", "sao paulo", "SP"),   # tier 1 (score 100, contains city)
        (11, "rua b", "centro", "01000", "sao paulo", "SP"),   # tier 1 rejects (city missing) -> tier 2
        (12, "rua c", "vila", "02000", "sao paulo", "SP"),     # tier 1 rejects (85, Locality); tier 2 none for vila? -> tier 2 via ref 5
        (13, "rua z", "nowhere", "01000", "sao paulo", "SP"),  # tier 3 by cep
        (14, "rua z", "nowhere", "99999", "sao paulo", "SP"),  # no match
    ]
    rdf = spark.createDataFrame(ref, "id int, street string, bairro string, cep string, city string, state string, "
                                     "address string, score int, quality string, lat double, lng double")
    cdf = spark.createDataFrame(recs, "rid int, rua string, b string, c string, municipio string, uf string")
    has_city = F.col("address").contains(F.col("city"))
    tiers = [
        Tier({"rua": "street", "b": "bairro", "municipio": "city", "uf": "state"},
             has_city & ((F.col("score") == 100) | ((F.col("score") >= 80) & F.col("quality").isin("PointAddress", "StreetAddress")))),
        Tier({"b": "bairro", "municipio": "city", "uf": "state"}, has_city & (F.col("score") >= 80)),
        Tier({"c": "cep", "municipio": "city", "uf": "state"}),
    ]
    got = {r.rid: (r.lat, r.tier) for r in tiered_match(cdf, rdf, tiers, ["lat", "lng"], [-F.col("score"), F.col("id")]).collect()}

    def brute(rid, rua, b, c, mun, uf):
        def ok1(g):
            return (g[1], g[2], g[4], g[5]) == (rua, b, mun, uf) and mun in g[6] and (
                g[7] == 100 or (g[7] >= 80 and g[8] in ("PointAddress", "StreetAddress")))

        def ok2(g):
            return (g[2], g[4], g[5]) == (b, mun, uf) and mun in g[6] and g[7] >= 80

        def ok3(g):
            return (g[3], g[4], g[5]) == (c, mun, uf)

        for t, ok in enumerate((ok1, ok2, ok3), start=1):
            cands = sorted((g for g in ref if ok(g)), key=lambda g: (-g[7], g[0]))
            if cands:
                return (cands[0][9], t)
        return (None, None)

    assert got == {r[0]: brute(*r) for r in recs}
    assert got[10] == (1.0, 1) and got[11][1] == 2 and got[13] == (1.0, 3) and got[14] == (None, None)


def test_missing_score_ranks_last(spark):
    ref = spark.createDataFrame([(1, "SP", None, 9.0), (2, "SP", 10, 1.0), (3, "SP", None, 8.0)],
                                "id int, state string, score int, lat double")
    recs = spark.createDataFrame([(1, "SP")], "rid int, uf string")
    got = tiered_match(recs, ref, [Tier({"uf": "state"})], ["lat"], [-F.col("score"), F.col("id")]).collect()
    assert [(r.lat, r.tier) for r in got] == [(1.0, 1)]


def test_leftover_partial_is_never_read(spark, tmp):
    import os

    from tabulae.sources.archives import _hidden_partial

    target = f"{tmp}/x/F.K03200$W.SIMPLES.CSV.D10911"
    partial = _hidden_partial(target)
    assert os.path.basename(partial).startswith(".")
    os.makedirs(f"{tmp}/x")
    with open(partial, "w") as fh:  # as if a task died mid-copy
        fh.write('"99";"S"\n')
    names = [r.name for r in list_files_rows(spark, f"{tmp}/x")]
    assert names == []


def list_files_rows(spark, root):
    from tabulae.sources.files import list_files

    return list_files(spark, root).collect()


def test_registry_and_trade_manifests(spark):
    from tabulae.operators.links import registry_manifest, trade_manifest

    html = ('<a href="https://x/mun/EXP_2015_MUN.csv">a</a><a href="https://x/mun/EXP_2016_MUN.csv">b</a>'
            '<a href="https://x/mun/IMP_2022_MUN.csv">c</a><a href="/registro/Empresas0.zip">d</a>')
    pages = spark.createDataFrame([(html,)], "html string")
    assert [r.name for r in trade_manifest(pages).collect()] == ["EXP_2016_MUN.csv"]
    assert sorted(r.name for r in trade_manifest(pages, years=(2015, 2022)).collect()) == [
        "EXP_2015_MUN.csv", "EXP_2016_MUN.csv", "IMP_2022_MUN.csv"]
    assert [r.name for r in registry_manifest(pages).collect()] == ["Empresas0.zip"]


def test_address_rules(spark):
    """Each rule's border, with the expected row written by hand."""
    ref = spark.createDataFrame([
        # rua, cep, bairro, municipio, uf, address, score, quality, lat, lng
        ("a", "1", "centro", "Rio", "RJ", "a, Rio", 80, "StreetAddress", 1.0, 1.0),
        ("b", "1", "centro", "Rio", "RJ", "b, Rio", 79, "PointAddress", 2.0, 2.0),     # below 80
        ("c", "1", "norte", "Rio", "RJ", "c, Niteroi", 100, "PointAddress", 3.0, 3.0),  # another city's address
        ("d", "2", "sul", "Rio", "RJ", "d, Rio", 80, "Locality", 4.0, 4.0),            # not precise: rule 2
        ("e", "3", "leste", "Rio", "RJ", "e, Rio", 100, "Locality", 5.0, 5.0),
    ], "ref_rua string, ref_cep string, ref_bairro string, ref_municipio string, ref_uf string, address string, "
       "score int, quality string, lat double, lng double")
    recs = spark.createDataFrame([
        (1, "a", "1", "centro", "Rio", "RJ"), (2, "b", "1", "centro", "Rio", "RJ"), (3, "c", "1", "norte", "Rio", "RJ"),
        (4, "d", "2", "sul", "Rio", "RJ"), (5, "e", "3", "leste", "Rio", "RJ"), (6, "a", "9", "centro", "Rio", "SP"),
        (7, None, None, None, None, None),
    ], "i int, rua string, cep string, bairro string, municipio string, uf string")
    got = {r.i: (r.lat, r.tier) for r in match_addresses(recs, ref).collect()}
    assert got == {1: (1.0, 1), 2: (1.0, 2), 3: (3.0, 3), 4: (4.0, 2), 5: (5.0, 1), 6: (None, None), 7: (None, None)}


def test_cli_manifest_and_incremental(spark, tmp):
    from tabulae.__main__ import main
    from test_golden_registry import make_raw

    pages = [(1, '<a href="/x/Empresas0.zip">e</a><a href="/mun/EXP_2016_MUN.csv">c</a><a href="/mun/EXP_2025_MUN.csv">c</a>')]
    spark.createDataFrame(pages, "page_id int, html string").write.parquet(f"{tmp}/pages")
    assert main(["manifest", f"{tmp}/pages", f"{tmp}/m1", "--kind", "registry"]) == 0
    assert [r.name for r in spark.read.parquet(f"{tmp}/m1").collect()] == ["Empresas0.zip"]
    assert main(["manifest", f"{tmp}/pages", f"{tmp}/m2", "--kind", "trade"]) == 0
    assert [r.name for r in spark.read.parquet(f"{tmp}/m2").collect()] == ["EXP_2016_MUN.csv"]
    assert main(["manifest", f"{tmp}/pages", f"{tmp}/m3", "--kind", "trade", "--years", "2016", "2030", "--known", f"{tmp}/m2"]) == 0
    assert [r.name for r in spark.read.parquet(f"{tmp}/m3").collect()] == ["EXP_2025_MUN.csv"]
    make_raw(f"{tmp}/raw")
    assert main(["registry", f"{tmp}/raw", f"{tmp}/out", "--partition-by", "uf", "--tables", "estab"]) == 0
    assert any(d.startswith("uf=") for d in os.listdir(f"{tmp}/out/df_estab"))
    assert main(["incremental", f"{tmp}/raw", f"{tmp}/inc", "--codes", f"{tmp}/out", "--checkpoints", f"{tmp}/ck", "--tables", "estab"]) == 0
    assert spark.read.parquet(f"{tmp}/inc/df_estab").count() == spark.read.parquet(f"{tmp}/out/df_estab").count()

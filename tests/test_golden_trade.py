"""Whole trade job on tiny header CSV files."""

import os

from tabulae.plans import trade as T


def write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write("\n".join(lines) + "\n")


def make_raw(root):
    write(f"{root}/mun/EXP_2020_MUN.csv", [
        "CO_ANO,CO_MES,SH4,CO_PAIS,SG_UF_MUN,CO_MUN,KG_LIQUIDO,VL_FOB",
        "2020,01,0101,105,SP,3550308,100,5000000000",
        ",,,,,,,",
        "2020,02,0201,249,RJ,3304557,10,20",
        "2020,03,0101,999,RJ,3304557,1,2",
    ])
    # a later file: other column order and one more column
    write(f"{root}/mun/EXP_2021_MUN.csv", [
        "VL_FOB,KG_LIQUIDO,CO_MUN,SG_UF_MUN,CO_PAIS,SH4,CO_MES,CO_ANO,CO_UNID",
        "7,3,3550308,SP,105,0201,12,2021,10",
        ",,,,,,,,",
    ])
    write(f"{root}/mun/IMP_2021_MUN.csv", [
        "CO_ANO,CO_MES,SH4,CO_PAIS,SG_UF_MUN,CO_MUN,KG_LIQUIDO,VL_FOB",
        "2021,05,0101,249,SP,3550308,50,60",
    ])
    write(f"{root}/aux_tables/UF_MUN.csv", ["CO_MUN_GEO,NO_MUN_MIN", "3550308, São Paulo ", "3304557,Rio de Janeiro"])
    # a spreadsheet export with a gap in the code column writes floats
    write(f"{root}/aux_tables/PAIS.csv", ["CO_PAIS,NO_PAIS", "105.0,Brasil", "249.0,Estados Unidos ", ",Sem codigo"])
    write(f"{root}/aux_tables/NCM_SH.csv", [
        "CO_NCM,CO_SH4,NO_SH4_POR,CO_SH2,NO_SH2_POR,CO_NCM_SECROM,NO_SEC_POR",
        "01011000,0101,Cavalos ,01,Animais vivos,I,Animais ",
        "01012000,0101,Cavalos ,01,Animais vivos,I,Animais ",
        "02011000,0201,Carnes,02,Carnes,I,Animais ",
    ])


def test_trade_job(spark, tmp):
    raw, out = f"{tmp}/raw", f"{tmp}/out"
    make_raw(raw)
    paths = T.run(spark, raw, out)
    exp = spark.read.parquet(paths["exp"])
    imp = spark.read.parquet(paths["imp"])
    assert exp.columns == T.S.TRADE_OUT
    got = sorted((r.ano, r.mes, r.SH4, r.cod_pais, r.uf, r.KG_LIQUIDO, r.VL_FOB, r.nome_municipio, r.nome_pais, r.nome_sh4, r.nome_secao)
                 for r in exp.collect())
    assert got == [
        (2020, 1, 101, 105, "SP", 100, 5000000000, "Sao Paulo", "Brasil", "Cavalos", "Animais"),
        (2020, 2, 201, 249, "RJ", 10, 20, "Rio de Janeiro", "Estados Unidos", "Carnes", "Animais"),
        (2021, 12, 201, 105, "SP", 3, 7, "Sao Paulo", "Brasil", "Carnes", "Animais"),
    ]
    # D4: the import flow holds imports only
    assert [(r.ano, r.mes, r.KG_LIQUIDO) for r in imp.collect()] == [(2021, 5, 50)]
    schema = dict((f.name, f.dataType.simpleString()) for f in exp.schema.fields)
    assert schema["VL_FOB"] == "bigint" and schema["SH4"] == "int" and schema["SH2"] == "string"


def test_trade_job_partitioned_by_year(spark, tmp):
    raw, out = f"{tmp}/raw", f"{tmp}/out"
    make_raw(raw)
    paths = T.run(spark, raw, out, partition_by=["ano"])
    assert sorted(d for d in os.listdir(paths["exp"]) if d.startswith("ano=")) == ["ano=2020", "ano=2021"]
    exp = spark.read.parquet(paths["exp"]).where("ano = 2021")
    assert "PartitionFilters: [isnotnull(ano" in exp._jdf.queryExecution().executedPlan().toString()
    assert exp.count() == 1


def test_trade_job_reads_portal_files_as_they_are(spark, tmp):
    raw, out = f"{tmp}/raw", f"{tmp}/out"
    make_raw(raw)
    # replace the facts by ';'-separated, fully quoted files
    for name in os.listdir(f"{raw}/mun"):
        os.remove(f"{raw}/mun/{name}")
    write(f"{raw}/mun/EXP_2020_MUN.csv", ['"CO_ANO";"CO_MES";"SH4";"CO_PAIS";"SG_UF_MUN";"CO_MUN";"KG_LIQUIDO";"VL_FOB"',
                                         '"2020";"01";"0101";"105";"SP";"3550308";"100";"7"'])
    write(f"{raw}/mun/IMP_2020_MUN.csv", ['"CO_ANO";"CO_MES";"SH4";"CO_PAIS";"SG_UF_MUN";"CO_MUN";"KG_LIQUIDO";"VL_FOB"',
                                         '"2020";"02";"0201";"249";"RJ";"3304557";"5";"6"'])
    paths = T.run(spark, raw, out, fact_sep=";")
    got = [(r.ano, r.SH4, r.nome_municipio, r.VL_FOB) for r in spark.read.parquet(paths["exp"]).collect()]
    assert got == [(2020, 101, "Sao Paulo", 7)]
    assert spark.read.parquet(paths["imp"]).count() == 1


def test_trade_compat_types(spark, tmp):
    raw, out = f"{tmp}/raw", f"{tmp}/out"
    make_raw(raw)
    paths = T.run(spark, raw, out, compat=True)
    exp = spark.read.parquet(paths["exp"])
    types = dict((f.name, f.dataType.simpleString()) for f in exp.schema.fields)
    assert types["VL_FOB"] == "int" and types["KG_LIQUIDO"] == "int"
    # 5,000,000,000 does not fit an int: null under the earlier type
    assert sorted((r.VL_FOB is None) for r in exp.collect()) == [False, False, True]


def test_trade_job_csv_output(spark, tmp):
    from tabulae.__main__ import main
    from tabulae.sources.delimited import scan_header_csv

    make_raw(f"{tmp}/raw")
    assert main(["trade", f"{tmp}/raw", f"{tmp}/out", "--format", "csv"]) == 0
    back = scan_header_csv(spark, f"{tmp}/out/comex_exp")
    assert back.columns == T.S.TRADE_OUT and back.count() == 3


def test_flow_without_files_is_a_clear_error(spark, tmp):
    import pytest

    raw, out = f"{tmp}/raw", f"{tmp}/out"
    make_raw(raw)
    os.remove(f"{raw}/mun/IMP_2021_MUN.csv")  # no import file at all
    with pytest.raises(ValueError, match="no fact files"):
        T.run(spark, raw, out)
    assert not os.path.exists(out) or not os.listdir(out)  # nothing written before the error


def test_archives_in_the_fact_folder_are_not_read(spark, tmp):
    import zipfile

    raw, out = f"{tmp}/raw", f"{tmp}/out"
    make_raw(raw)
    with zipfile.ZipFile(f"{raw}/mun/EXP_COMPLETA.zip", "w") as zf:
        zf.writestr("x", "not a table")
    paths = T.run(spark, raw, out)
    assert spark.read.parquet(paths["exp"]).count() == 3

"""Whole register job on tiny raw files in the true raw format."""

import datetime as dt
import os
from decimal import Decimal

from tabulae import schemas as S
from tabulae.plans import registry as R


def write(path, lines, encoding="ISO-8859-1"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as fh:
        fh.write("\n".join(lines) + "\n")


def make_raw(root):
    p = "F.K03200$Z.D10710."
    write(f"{root}/{p}CNAECSV", ['"0111301";"CULTIVO DE ARROZ"'])
    write(f"{root}/{p}MUNICCSV", ['"7107";"SÃO PAULO"', '"6001";"RIO DE JANEIRO"'])
    write(f"{root}/{p}NATJUCSV", ['"2062";"SOCIEDADE EMPRESÁRIA LIMITADA"'])
    write(f"{root}/{p}PAISCSV", ['"105";"BRASIL"', '"249";"ESTADOS UNIDOS"'])
    write(f"{root}/{p}QUALSCSV", ['"49";"SÓCIO-ADMINISTRADOR"', '"05";"ADMINISTRADOR"'])
    write(f"{root}/{p}MOTICSV", ['"00";"SEM MOTIVO"'])
    write(f"{root}/F.K03200$W.SIMPLES.CSV.D10911", ['"12";"S";"20070701";"00000000";"N";"00000000";"00000000"'])
    # big tables: one directory per unpacked archive, prefixed and bare names
    write(f"{root}/K3241.K03200Y0.D10710.EMPRECSV/K3241.K03200Y0.D10710.EMPRECSV", [
        '"12";"  acme açúcar ltda ";"2062";"49";"000000001000,50";"01";""',
        '"34567890";"BETA";"9999";"";"1.234,56";"4";"União"',
    ])
    write(f"{root}/K3241.K03200Y1.D10710.EMPRECSV/EMPRECSV", ['"1";"Gama";"2062";"49";"5,00";"5";""'])
    write(f"{root}/K3241.K03200Y0.D10710.SOCIOCSV/K3241.K03200Y0.D10710.SOCIOCSV", [
        '"12";"2";"JOÃO DA SILVA";"***123456**";"49";"20200115";"";"***000000**";"";"00";"5"',
        '"34567890";"1";"EMPRESA X";"12345678000199";"05";"00000000";"249";"";"MARIA";"49";"0"',
    ])
    estab = [
        # doubled quotes inside a field; a backslash right before the closing quote
        '"12";"0001";"91";"1";"BAR ""DO ZÉ""";"02";"20200101";"00";"";"";"20070701";"111301";"";"RUA";'
        '"DO CAFÉ\\";"S/N";"";"CENTRO";"01001000";" sp";"7107";"11";"12345678";"";"";"";"";" CONTATO\'BAR.COM.BR ";"";""',
        '"34567890";"0002";"10";"2";"LOJA";"08";"20211301";"01";"";"249";"20100101";"4711302";"";"AV";'
        '"PAULISTA";"10";"SALA 1";"BELA VISTA";"01310100";"rj ";"6001";"";"";"";"";"";"";"";"";""',
        '"1";"0001";"55";"1";"SEM MUNICIPIO";"02";"";"";"";"";"";"1";"";"";"";"";"";"";"";"";"9999";"";"";"";"";"";"";"";"";""',
        '"2";"0001";"55";"1";"MUNICIPIO VAZIO";"02";"";"";"";"";"";"1";"";"";"";"";"";"";"";"";"";"";"";"";"";"";"";"";"";""',
    ]
    write(f"{root}/K3241.K03200Y0.D10710.ESTABELECSV/K3241.K03200Y0.D10710.ESTABELECSV", estab)


def test_register_job(spark, tmp):
    raw, out = f"{tmp}/raw", f"{tmp}/trusted"
    make_raw(raw)
    paths = R.run(spark, raw, out)
    read = lambda name: spark.read.parquet(paths[name])

    quals = {r.cod_quals: r.nome_quals for r in read("quals").collect()}
    assert quals == {49: "Socio-administrador", 5: "Administrador"}
    assert read("cnae").collect()[0].cod_cnae == 111301
    assert {r.nome_mun for r in read("mun").collect()} == {"Sao Paulo", "Rio De Janeiro"}

    s = read("simples").collect()[0]
    assert s.cnpj == "00000012" and s.data_inclusao_simples == dt.date(2007, 7, 1) and s.data_exclusao_simples is None

    emp = {r.cnpj: r for r in read("empresas").collect()}
    assert list(read("empresas").columns) == [
        "cnpj", "razao_social", "capital_social", "porte", "nome_porte", "ente_fed_resp",
        "cod_natju", "nome_natju", "cod_quals", "nome_quals"]
    a = emp["00000012"]
    assert (a.razao_social, a.capital_social, a.porte, a.nome_porte, a.ente_fed_resp) == (
        "Acme Acucar Ltda", Decimal("1000.50"), 1, "Nao Informado", None)
    assert (a.nome_natju, a.nome_quals) == ("Sociedade Empresaria Limitada", "Socio-administrador")
    b = emp["34567890"]
    assert (b.capital_social, b.nome_porte, b.nome_natju, b.cod_quals, b.ente_fed_resp) == (None, None, None, None, "Uniao")
    assert emp["00000001"].nome_porte == "Demais"  # bare file name found too

    soc = {r.cnpj_empresa: r for r in read("socios").collect()}
    j = soc["00000012"]
    assert (j.id_socio, j.nome_socio, j.faixa_etaria, j.nome_quals, j.data_entrada_sociedade) == (
        "PF", "Joao Da Silva", "41 a 50 anos", "Socio-administrador", dt.date(2020, 1, 15))
    assert (j.cod_pais, j.nome_pais, j.cod_quals_rep_legal, j.nome_quals_rep_legal) == (None, None, 0, None)
    x = soc["34567890"]
    assert (x.id_socio, x.faixa_etaria, x.nome_quals, x.nome_pais, x.nome_quals_rep_legal, x.data_entrada_sociedade) == (
        "PJ", "Nao se aplica", "Administrador", "Estados Unidos", "Socio-administrador", None)

    est = {r.cnpj: r for r in read("estab").collect()}
    assert set(est) == {"00000012", "34567890"}  # unknown / empty municipality dropped (inner)
    e = est["00000012"]
    assert e.nome_fantasia == 'Bar "do Ze"'
    assert e.logradouro == "Do Cafe\\"
    assert (e.id_matriz, e.numero, e.uf, e.cnae_primario, e.nome_mun, e.nome_pais) == (
        "Matriz", "", "SP", "0111301", "Sao Paulo", None)
    assert e.correio_eletronico == "contato@bar.com.br"
    assert e.data_situacao_cadastral == dt.date(2020, 1, 1) and e.cod_mun == 7107
    f = est["34567890"]
    assert (f.id_matriz, f.numero, f.uf, f.nome_pais, f.data_situacao_cadastral) == ("Filial", "10", "RJ", "Estados Unidos", None)
    assert len(read("estab").columns) == 32

    # D13: a second run over the same output folder succeeds (overwrite)
    R.run(spark, raw, out)
    assert read("estab").count() == 2


def test_missing_table_is_an_error(spark, tmp):
    import pytest

    raw = f"{tmp}/raw"
    make_raw(raw)
    os.remove(f"{raw}/F.K03200$Z.D10710.PAISCSV")
    with pytest.raises(FileNotFoundError, match="pais"):
        R.run(spark, raw, f"{tmp}/out")


def test_cli_runs_register_job(spark, tmp, capsys):
    from tabulae.__main__ import main

    make_raw(f"{tmp}/raw")
    assert main(["registry", f"{tmp}/raw", f"{tmp}/out"]) == 0
    assert main(["registry", f"{tmp}/raw", f"{tmp}/out2", "--tables", "empresas", "--encoding", "ISO-8859-1"]) == 0
    assert sorted(d for d in os.listdir(f"{tmp}/out2") if d.startswith("df_")) == sorted(
        ["df_cnae", "df_mun", "df_natju", "df_pais", "df_quals", "df_moti", "df_empresas"])
    printed = capsys.readouterr().out
    assert "estab\t" in printed and "df_cnae" in printed
    assert spark.read.parquet(f"{tmp}/out/df_estab").count() == 2


def test_incremental_register(spark, tmp):
    from tabulae.streaming.registry import run_incremental

    make_raw(f"{tmp}/raw")
    batch = R.run(spark, f"{tmp}/raw", f"{tmp}/batch")
    codes_root = f"{tmp}/batch"
    landing, out, ckpt = f"{tmp}/landing", f"{tmp}/inc", f"{tmp}/ckpt"
    # first delivery: one companies file and the establishments
    write(f"{landing}/d1/A.EMPRECSV", ['"12";"  acme açúcar ltda ";"2062";"49";"000000001000,50";"01";""'])
    os.makedirs(f"{landing}/d1/x", exist_ok=True)
    import shutil
    shutil.copy(f"{tmp}/raw/K3241.K03200Y0.D10710.ESTABELECSV/K3241.K03200Y0.D10710.ESTABELECSV", f"{landing}/d1/x/B.ESTABELECSV")
    run_incremental(spark, landing, codes_root, out, ckpt, tables=["empresas", "estab"])
    assert spark.read.parquet(f"{out}/df_empresas").count() == 1
    assert spark.read.parquet(f"{out}/df_estab").count() == 2
    run_incremental(spark, landing, codes_root, out, ckpt, tables=["empresas", "estab"])  # nothing new
    assert spark.read.parquet(f"{out}/df_empresas").count() == 1
    # second delivery: two more companies
    write(f"{landing}/d2/C.EMPRECSV", ['"34567890";"BETA";"9999";"";"1.234,56";"4";"União"', '"1";"Gama";"2062";"49";"5,00";"5";""'])
    run_incremental(spark, landing, codes_root, out, ckpt, tables=["empresas", "estab"])
    inc = spark.read.parquet(f"{out}/df_empresas")
    ref = spark.read.parquet(batch["empresas"])
    assert sorted(map(tuple, inc.select(*ref.columns).collect()), key=str) == sorted(map(tuple, ref.collect()), key=str)
    assert spark.read.parquet(f"{out}/df_estab").count() == 2


def test_register_compat_types(spark, tmp):
    make_raw(f"{tmp}/raw")
    paths = R.run(spark, f"{tmp}/raw", f"{tmp}/out", compat=True)
    emp = spark.read.parquet(paths["empresas"])
    assert dict((f.name, f.dataType.simpleString()) for f in emp.schema.fields)["capital_social"] == "float"
    assert spark.read.parquet(paths["simples"]).collect()[0].cnpj == "12"


def test_register_from_archives(spark, tmp):
    import zipfile

    make_raw(f"{tmp}/raw")
    os.makedirs(f"{tmp}/zips")
    # one archive per top-level entry, as the portal ships them
    for entry in sorted(os.listdir(f"{tmp}/raw")):
        src = f"{tmp}/raw/{entry}"
        stem = entry.split("$", 1)[-1].replace(".", "_")
        with zipfile.ZipFile(f"{tmp}/zips/{stem}.zip", "w", zipfile.ZIP_DEFLATED) as zf:
            if os.path.isdir(src):
                for name in os.listdir(src):
                    zf.write(f"{src}/{name}", name)
            else:
                zf.write(src, entry)
    paths = R.run_archives(spark, f"{tmp}/zips", f"{tmp}/work", f"{tmp}/out")
    direct = R.run(spark, f"{tmp}/raw", f"{tmp}/direct")
    for t in ("empresas", "socios", "estab", "simples", "quals"):
        a = sorted(map(tuple, spark.read.parquet(paths[t]).collect()), key=str)
        b = sorted(map(tuple, spark.read.parquet(direct[t]).collect()), key=str)
        assert a == b, t


def test_register_with_utf8_release(spark, tmp):
    raw = f"{tmp}/raw"
    make_raw(raw)
    # re-encode every raw file as UTF-8, as a release might
    for dirpath, _, names in os.walk(raw):
        for name in names:
            path = os.path.join(dirpath, name)
            text = open(path, encoding="ISO-8859-1").read()
            open(path, "w", encoding="utf-8").write(text)
    paths = R.run(spark, raw, f"{tmp}/out", read_options={"encoding": "UTF-8"})
    emp = {r.cnpj: r for r in spark.read.parquet(paths["empresas"]).collect()}
    assert emp["00000012"].razao_social == "Acme Acucar Ltda"
    assert {r.nome_mun for r in spark.read.parquet(paths["mun"]).collect()} == {"Sao Paulo", "Rio De Janeiro"}


def test_register_partial_run(spark, tmp):
    import pytest

    raw = f"{tmp}/raw"
    make_raw(raw)
    # the partners' files are not needed for a run that rebuilds only estab
    import shutil
    shutil.rmtree(f"{raw}/K3241.K03200Y0.D10710.SOCIOCSV")
    paths = R.run(spark, raw, f"{tmp}/out", tables=["estab"])
    assert "estab" in paths and "socios" not in paths and "quals" in paths
    assert spark.read.parquet(paths["estab"]).count() == 2
    with pytest.raises(FileNotFoundError, match="partners"):
        R.run(spark, raw, f"{tmp}/out2")
    with pytest.raises(ValueError):
        R.run(spark, raw, f"{tmp}/out3", tables=["nope"])


def test_incremental_register_all_tables_match_batch(spark, tmp):
    import shutil

    from tabulae.streaming.registry import run_incremental

    raw = f"{tmp}/raw"
    make_raw(raw)
    batch = R.run(spark, raw, f"{tmp}/batch")
    landing = f"{tmp}/landing"
    shutil.copytree(raw, landing)  # every raw file lands at once
    out = run_incremental(spark, landing, f"{tmp}/batch", f"{tmp}/inc", f"{tmp}/ckpt")
    for t in ("simples", "empresas", "socios", "estab"):
        ref = spark.read.parquet(batch[t])
        inc = spark.read.parquet(out[t]).select(*ref.columns)
        assert sorted(map(tuple, inc.collect()), key=str) == sorted(map(tuple, ref.collect()), key=str), t


def test_register_partitioned_output(spark, tmp):
    make_raw(f"{tmp}/raw")
    paths = R.run(spark, f"{tmp}/raw", f"{tmp}/out", tables=["estab"], partition_by={"estab": ["uf"]})
    assert sorted(d for d in os.listdir(paths["estab"]) if d.startswith("uf=")) == ["uf=RJ", "uf=SP"]
    sp = spark.read.parquet(paths["estab"]).where("uf = 'SP'")
    assert "PartitionFilters: [isnotnull(uf" in sp._jdf.queryExecution().executedPlan().toString()
    assert [r.cnpj for r in sp.collect()] == ["00000012"]


def test_archives_in_the_raw_tree_are_not_read(spark, tmp):
    import zipfile

    raw = f"{tmp}/raw"
    make_raw(raw)
    with zipfile.ZipFile(f"{raw}/SIMPLES.zip", "w") as zf:  # a download left next to the files
        zf.writestr("x", "not a table")
    files = [tuple(r) for r in R.raw_files(spark, raw).select("kind", "name").collect()]
    assert not any(name.endswith(".zip") for _kind, name in files)
    assert sum(kind == "simples" for kind, _name in files) == 1
    scanned = R.scan_table(spark, raw, "simples", S.SIMPLES_COLS).inputFiles()
    assert len(scanned) == 1 and not scanned[0].endswith(".zip")

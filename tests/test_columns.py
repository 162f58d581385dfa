"""Column helpers: projection, rules, transforms, empty rows, preview."""

import pytest

from tabulae.operators import columns as P

from conftest import rows


def test_columns_by_rule():
    cols = ["cnpj", "cod_pais", "cod_mun", "data_inicio", "nome_x", "situacao_data"]
    assert P.columns_by_rule(cols, prefix="cod") == ["cod_pais", "cod_mun"]
    assert P.columns_by_rule(cols, contains="data") == ["data_inicio", "situacao_data"]
    assert P.columns_by_rule(cols, exclude=["cnpj"]) == cols[1:]
    assert P.columns_by_rule(cols, prefix="cod", exclude=["cod_mun"]) == ["cod_pais"]


def test_project_renames_then_orders(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "CO_ANO int, SG string, VL double")
    out = P.project(df, ["uf", "ano"], {"CO_ANO": "ano", "SG": "uf"})
    assert out.columns == ["uf", "ano"] and rows(out) == [("a", 1)]
    with pytest.raises(Exception):
        P.project(df, ["missing"])


def test_clean_columns_one_projection(spark):
    df = spark.createDataFrame([("07", "20210305", " são ")], "cod string, data string, nome string")
    out = (df.transform(P.clean_columns("int", "cod"))
             .transform(P.clean_columns("date", ["data"]))
             .transform(P.clean_columns("str", []))
             .transform(P.clean_columns("str", "nome")))
    r = out.collect()[0]
    assert (r.cod, str(r.data), r.nome) == (7, "2021-03-05", "Sao")


def test_drop_all_null_and_preview(spark):
    df = spark.createDataFrame([(None, None), ("a", None), (None, "b"), (None, None)], "x string, y string")
    assert rows(P.drop_all_null(df)) == [(None, "b"), ("a", None)]
    assert rows(P.drop_all_null(df, subset=["x"])) == [("a", None)]
    assert P.preview(df, 2).count() == 2


def test_suffix_columns(spark):
    df = spark.createDataFrame([(1, "q")], "cod_quals int, nome_quals string")
    assert P.suffix_columns(df, "_rep_legal").columns == ["cod_quals_rep_legal", "nome_quals_rep_legal"]

"""Scalar cleaners on the hand-made edge rows (FIXTURES.md §E)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tabulae import schemas as S
from tabulae.functions import clean as C
from tabulae.functions.transliteration import LATIN1_ASCII, TABLE, translit, untransliterated


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn("x").alias("y")).collect()]


def test_int(spark):
    assert one_col(spark, ["08", " 7 ", "", "abc", "3000000000", None, "8.5"], C.to_int) == [8, 7, None, None, None, None, None]
    assert one_col(spark, ["3000000000"], lambda c: C.to_int(c, "bigint")) == [3000000000]


def test_date(spark):
    got = one_col(spark, ["20210305", "00000000", "0", "", "20211301", "2021-03-05", None], C.to_date8)
    assert got == [dt.date(2021, 3, 5), None, None, None, None, None, None]


def test_decimal_comma(spark):
    got = one_col(spark, ["000000001000,00", "123456789,01", "1.234,56", "", None], C.decimal_comma)
    assert got == [Decimal("1000.00"), Decimal("123456789.01"), None, None, None]


def test_decimal_comma_float_loses_precision(spark):
    # the float variant is kept for compatibility; decimal is exact
    got = one_col(spark, ["123456789,01"], lambda c: C.decimal_comma(c, "float"))
    assert got[0] != 123456789.01


def test_pad(spark):
    assert one_col(spark, ["12", "1234567890", None], lambda c: C.pad_key(c, 8)) == ["00000012", "12345678", None]


def test_text(spark):
    got = one_col(spark, ["  SÃO JOÃO ", None, "ÆGIR straße", "d'ávila  çà"], C.clean_text)
    assert got == ["Sao Joao", None, "Aegir Strasse", "D'avila  Ca"]


def test_trim_then_translit_keeps_nbsp_as_blank(spark):
    # trim runs first, so a no-break space at the edge survives as a blank
    assert one_col(spark, [" Á "], C.trim_translit) == [" A"]


def test_company_size(spark):
    got = one_col(spark, ["1", "2", "3", "5", "4", "0", None], lambda c: C.decode(c, S.COMPANY_SIZE_LABELS, cast="int"))
    assert got == ["Nao Informado", "Micro Empresa", "Empresa de Pequeno Porte", "Demais", None, None, None]


def test_age_band(spark):
    got = one_col(spark, [str(i) for i in range(11)] + [None], lambda c: C.decode(c, S.AGE_BAND_LABELS, cast="int"))
    assert got[:10] == [S.AGE_BAND_LABELS[i] for i in range(10)]
    assert got[10:] == [None, None]


def test_hq_flag(spark):
    got = one_col(spark, ["1", "2", "01", "x", None], lambda c: C.decode(c, S.HQ_LABELS, cast="int"))
    assert got == ["Matriz", "Filial", "Matriz", None, None]


def test_house_number(spark):
    assert one_col(spark, ["S/N", "S/N B", "12", None], C.blank_sentinel) == ["", "", "12", None]


def test_email(spark):
    assert one_col(spark, [" A'B.COM ", None], C.repair_email) == ["a@b.com", None]


def test_upper_trim(spark):
    assert one_col(spark, [" sp ", None], C.upper_trim) == ["SP", None]


def test_translit_table_is_ascii_and_complete():
    assert len(LATIN1_ASCII) == 96
    for cp in range(0x80, 0x100):
        assert chr(cp) in TABLE
        assert TABLE[chr(cp)].isascii()
    assert TABLE["ç"] == "c" and TABLE["ß"] == "ss" and TABLE["Æ"] == "AE" and TABLE["ő"] == "o" and TABLE["ł"] == "l"


def test_translit_every_latin1_char(spark):
    text = "".join(chr(cp) for cp in range(0xA0, 0x100))
    got = one_col(spark, [text], lambda c: translit(F.col(c)))[0]
    assert got == "".join(LATIN1_ASCII)


def test_translit_idempotent_and_null(spark):
    vals = ["Ação Ñandú ½ 3°", None, "plain ascii"]
    once = one_col(spark, vals, lambda c: translit(F.col(c)))
    twice = one_col(spark, once, lambda c: translit(F.col(c)))
    assert once == twice
    assert once[1] is None and once[2] == "plain ascii"


def test_letter_rows_agree_with_duckdb_strip_accents():
    import duckdb

    letters = [chr(cp) for cp in list(range(0xC0, 0x100)) + list(range(0x100, 0x180))
               if len(TABLE.get(chr(cp), "")) == 1 and TABLE[chr(cp)].isalpha()]
    con = duckdb.connect()
    got = con.execute("SELECT list_transform(?, lambda x: strip_accents(x))", [letters]).fetchone()[0]
    # letters that strip_accents leaves alone (no decomposition) are in the fixed list
    disagree = {c: (TABLE[c], d) for c, d in zip(letters, got) if d != TABLE[c] and d.isascii()}
    assert not disagree
    assert sum(d.isascii() for d in got) > 150


def test_translit_of_utf8_names(spark):
    """Expected spellings written by hand."""
    pairs = {
        "São Tomé – “x” ’ … € Ș ộ": "Sao Tome - \"x\" ' ... EUR S o",
        "București, Timișoara, Iași": "Bucuresti, Timisoara, Iasi",
        "Thành phố Hồ Chí Minh": "Thanh pho Ho Chi Minh",
        "Łódź — Gdańsk": "Lodz -- Gdansk",
        "Côte d’Ivoire": "Cote d'Ivoire",
        "Sa\u0303o Joa\u0303o": "Sao Joao",
        "a\u2003b\u200bc": "a bc",
        "N° 5 № 6": "Ndeg 5 No 6",
    }
    assert one_col(spark, list(pairs), lambda c: translit(F.col(c))) == list(pairs.values())


def test_untransliterated_counts_what_stays(spark):
    vals = ["Rio", "Ação", "北京 x", "Москва", "", None]
    assert one_col(spark, vals, lambda c: untransliterated(F.col(c))) == [0, 0, 2, 6, 0, 0]

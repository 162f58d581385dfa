"""Cleaners against plain-Python statements of their rules, on random text.

One Spark job per hypothesis example: each example is a whole batch of
strings, compared element by element.
"""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabulae.functions import clean as C
from tabulae.functions.transliteration import TABLE, translit

LATIN1 = "".join(chr(c) for c in range(0xA0, 0x100))
ALPHABET = "abcXYZ 09'-." + LATIN1 + "łőŒ"
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

texts = st.lists(st.text(alphabet=ALPHABET, max_size=30) | st.none(), min_size=1, max_size=60)


def run(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    got = {r.i: r.y for r in df.select("i", fn(F.col("x")).alias("y")).collect()}
    return [got[i] for i in range(len(values))]


def py_translit(s):
    return None if s is None else "".join(TABLE.get(ch, ch) for ch in s)


def py_initcap(s):
    # Spark: lower-case everything, then upper-case the first letter of the
    # string and every letter after a blank
    out, prev = [], " "
    for ch in s.lower():
        out.append(ch.upper() if prev == " " else ch)
        prev = ch
    return "".join(out)


@SETTINGS
@given(values=texts)
def test_translit_matches_table(spark, values):
    assert run(spark, values, translit) == [py_translit(v) for v in values]


@SETTINGS
@given(values=texts)
def test_clean_text_rule(spark, values):
    expect = [None if v is None else py_initcap(py_translit(v).strip(" ")) for v in values]
    assert run(spark, values, C.clean_text) == expect


@SETTINGS
@given(values=st.lists(st.text(alphabet="0123456789ab", max_size=12) | st.none(), min_size=1, max_size=60),
       width=st.integers(min_value=1, max_value=10))
def test_pad_rule(spark, values, width):
    expect = [None if v is None else (v[:width] if len(v) >= width else "0" * (width - len(v)) + v) for v in values]
    assert run(spark, values, lambda c: C.pad_key(c, width)) == expect


INT_RE = re.compile(r"^[+-]?\d+$")


def py_int(s):
    if s is None:
        return None
    t = s.strip(" ")
    if not INT_RE.match(t):
        return None
    v = int(t)
    return v if -(2 ** 31) <= v < 2 ** 31 else None


@SETTINGS
@given(values=st.lists(st.text(alphabet="0123456789 +-a", max_size=12) | st.none(), min_size=1, max_size=60))
def test_int_rule(spark, values):
    assert run(spark, values, C.to_int) == [py_int(v) for v in values]


def py_date8(s):
    if s is None or not re.fullmatch(r"\d{8}", s):
        return None
    try:
        return dt.datetime.strptime(s, "%Y%m%d").date()
    except ValueError:
        return None


@SETTINGS
@given(values=st.lists(st.from_regex(r"\A(19|20)[0-9]{2}[01][0-9][0-3][0-9]\Z") | st.text(alphabet="0123456789-", max_size=10),
                       min_size=1, max_size=60))
def test_date_rule(spark, values):
    assert run(spark, values, C.to_date8) == [py_date8(v) for v in values]


from tabulae import schemas as S  # noqa: E402

codes = st.lists(st.sampled_from(["0", "1", "2", "3", "4", "5", "9", "01", " 2 ", "x", ""]) | st.none(), min_size=1, max_size=60)


@SETTINGS
@given(values=codes)
def test_decode_rule(spark, values):
    expect = [None if py_int(v) is None else S.COMPANY_SIZE_LABELS.get(py_int(v)) for v in values]
    assert run(spark, values, lambda c: C.decode(c, S.COMPANY_SIZE_LABELS, cast="int")) == expect


@SETTINGS
@given(values=st.lists(st.sampled_from(["S/N", "S/N B", "s/n", "12", "", " S/N"]) | st.none(), min_size=1, max_size=40))
def test_sentinel_rule(spark, values):
    expect = [None if v is None else ("" if v in S.NO_NUMBER_SENTINELS else v) for v in values]
    assert run(spark, values, C.blank_sentinel) == expect


@SETTINGS
@given(values=st.lists(st.text(alphabet="aB' .@x", max_size=15) | st.none(), min_size=1, max_size=60))
def test_email_and_upper_rules(spark, values):
    assert run(spark, values, C.repair_email) == [None if v is None else v.lower().strip(" ").replace("'", "@") for v in values]
    assert run(spark, values, C.upper_trim) == [None if v is None else v.upper().strip(" ") for v in values]


@SETTINGS
@given(values=st.lists(st.from_regex(r"\A[0-9]{1,12},[0-9]{2}\Z") | st.text(alphabet="0123456789,.", max_size=8), min_size=1, max_size=60))
def test_decimal_comma_rule(spark, values):
    from decimal import Decimal, InvalidOperation

    def py(v):
        t = v.replace(",", ".")
        if not re.fullmatch(r"[0-9]*\.?[0-9]*", t) or t in ("", "."):
            return None
        try:
            d = Decimal(t).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")
        except InvalidOperation:
            return None
        return d if d.adjusted() < 16 else None

    assert run(spark, values, C.decimal_comma) == [py(v) for v in values]

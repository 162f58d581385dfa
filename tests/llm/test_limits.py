"""Texts at the limits of what the operators' patterns and formats can take."""

import numpy as np

from pyspark.sql import functions as F

from tabulae.llm import packing, pii
from tabulae.llm.pii import replace_personal_data


def replaced(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [r["text"] for r in replace_personal_data(df).orderBy("doc_id").collect()]


def test_long_runs_take_no_stack(spark):
    n = 100_000
    runs = ["x@a" + ".a" * n, "x@" + "a" * n + ".com", "x" * n + "@a.com", "x@a" + "." * n, "1" * n, "1-" * n, "1 " * n, "+" * n, "(" * n, "1." * n,
            "Mr. " * n, "Mr. A" + "b" * n, "Mr. Ab " + "Ab " * n, "@" * n, "-" * n, "'" * n, "Mr. A" + "-b" * n]
    got = replaced(spark, *runs)
    assert got[0] != runs[0] and len(got[0]) == len(runs[0]) and got[0].count(".") == n
    assert got[1] != runs[1] and got[2] != runs[2] and got[3] == runs[3] and got[7:9] == runs[7:9] and got[13:16] == runs[13:16]


def test_formats_with_few_surrogates_get_longer_ones(spark):
    mails = [f"{a}@{b}.com" for a in "0123456789" for b in "012345"]
    got = replaced(spark, " ".join(mails), "again " + mails[7], *(f"one {m}" for m in mails))
    new = got[0].split()
    assert len(set(new)) == len(mails) and not set(new) & set(mails)
    assert all(m.endswith(".com") and m.count("@") == 1 for m in new)
    assert got[1] == f"again {new[7]}" and got[2:] == [f"one {m}" for m in new]      # every mention alike
    assert replaced(spark, "_@-.com") != ["_@-.com"]


def test_longer_surrogates_of_numbers_keep_the_format(spark):
    def dressed(kind, piece, made):
        return spark.range(1).select(pii.dressed(F.lit(kind), F.lit(piece), F.lit(made))).first()[0]

    assert dressed("phone", "+1 749-555-7057", "1234567890") == "+1 123-456-7890"
    assert dressed("phone", "+1 749-555-7057", "991234567890") == "99+1 123-456-7890"
    assert dressed("ssn", "123-45-6789", "5987654321") == "5987-65-4321"
    assert dressed("email", "Ab@x.com", "qrcd@y.com") == "Qrcd@y.com"
    made = spark.range(1).select(*(pii.surrogate("k", F.lit(kind), F.lit(canon), F.lit(9)).alias(kind) for kind, canon in (
        ("phone", "7495557057"), ("ssn", "123456789"), ("card", "4111111111111111"), ("email", "d@d.com"), ("ip", "1.2.3.4")))).first()
    assert [len(made[k]) for k in ("phone", "ssn", "card", "email")] == [13, 12, 19, 15] and ":1" in made["ip"]


def test_double_barrelled_names_are_replaced_whole(spark):
    got, other = replaced(spark, "Mr. Smith met Ms. Smith-Jones. SMITH-JONES left, Smith stayed.", "Ms. Smith-Jones and Mr. Smith.")
    words = got.replace(".", "").replace(",", "").split()
    assert "Smith" not in got and "Jones" not in got and "SMITH" not in got and "JONES" not in got
    assert words[1] == words[7] and words[4].upper() == words[5] and words[1] != words[4]
    assert other == f"Ms. {words[4]} and Mr. {words[1]}."


def test_a_million_blanks_are_packed(spark):
    from tokenizers import Tokenizer

    texts = [" " * 1_000_000, "\n" * 1_000_000, "a" + "\t" * 1_000_000 + "b", "word " * 250_000, "x" * 1_000_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tok = Tokenizer.from_file(packing.tokenizer_path())
    tok.encode_special_tokens = True
    got = packing.pack_documents(df).groupBy("doc_id").agg(F.sum("length"), F.max("doc_tokens")).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == {i: (n, n) for i, n in enumerate(len(tok.encode(t, add_special_tokens=False).ids) + 1 for t in texts)}
    encoder = packing.Encoder(packing.tokenizer_path())
    assert (np.frombuffer(encoder.ids(texts[2]), "<u4") == tok.encode(texts[2], add_special_tokens=False).ids).all()

"""Native transliteration vs a row-at-a-time Python UDF (benchmark only).

    python scripts/compare_translit.py [sf_dir]

The UDF applies the same character table in Python, row by row, the way a
per-row library call would; it exists only here, to measure the design
choice.  Both sides are materialised through the noop sink; best of 3.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import StringType  # noqa: E402

from tabulae.catalog import registry_q as RQ  # noqa: E402
from tabulae.catalog.standin import table  # noqa: E402
from tabulae.functions import clean as C  # noqa: E402
from tabulae.functions.transliteration import TABLE  # noqa: E402
from tabulae.plans import registry as R  # noqa: E402
from tabulae.session import local_session  # noqa: E402

_MAP = str.maketrans(TABLE)


@F.udf(StringType())
def translit_udf(s):
    return None if s is None else s.translate(_MAP)


def best(df, runs=3):
    t = float("inf")
    for _ in range(runs):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        t = min(t, time.perf_counter() - t0)
    return t


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    docs = table(spark, sf, "documents")
    estab = RQ.ESTAB.df(spark, sf)
    best(docs.select(C.clean_text("text")), 1)  # warm-up
    cases = {
        "documents.text (10k long texts)": (
            docs.select(F.initcap(F.trim(translit_udf("text")))),
            docs.select(C.clean_text("text")),
        ),
        "establishments, 6 name columns (600k rows)": (
            estab.select(*[F.initcap(F.trim(translit_udf(c))).alias(c) for c in R.ESTAB_TEXT]),
            estab.select(*[C.clean_text(c).alias(c) for c in R.ESTAB_TEXT]),
        ),
    }
    for name, (udf_df, native_df) in cases.items():
        key = lambda r: tuple("" if v is None else v for v in r)
        assert sorted(map(tuple, udf_df.collect()), key=key) == sorted(map(tuple, native_df.collect()), key=key), name
        u, n = best(udf_df), best(native_df)
        print(f"{name}: python row UDF {u:.2f}s, native {n:.2f}s, speed-up {u / n:.1f}x")
    spark.stop()


if __name__ == "__main__":
    main()

"""Compare a Spark result with a DuckDB oracle as multisets of rows.

Values are normalised to text.  Integers and decimals are exact (7, 7.0 and
7.00 are one number), floats have 9 significant digits, dates are ISO.  The
columns must have the same names in the same order.
"""

from __future__ import annotations

import math
import os
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, Decimal):
        return f"{v.normalize():f}"
    if isinstance(v, (date, datetime)):
        return v.isoformat()
    return str(v)


def multiset(rows) -> Counter:
    return Counter(tuple(map(norm, r)) for r in rows)


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')").fetchall()
    return con


def compare(df, con, sql: str) -> tuple[bool, str]:
    """(equal, message) for a Spark DataFrame against oracle SQL."""
    scols = df.columns
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    dcols, drows = rel.columns, rel.fetchall()
    if scols != dcols:
        return False, f"columns differ: spark {scols} duck {dcols}"
    a, b = multiset(srows), multiset(drows)
    if a == b:
        return True, f"{len(srows)} rows"
    only_s, only_d = list((a - b).elements())[:3], list((b - a).elements())[:3]
    return False, (f"spark {len(srows)} rows, duck {len(drows)} rows; "
                   f"only in spark {only_s}; only in duck {only_d}")

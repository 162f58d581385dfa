"""Column cleaners: pure ``Column -> Column`` expressions.

Every cleaner is ANSI-safe (bad input becomes null instead of failing the
job) and built from Spark built-ins, so a whole table of cleaners compiles to
one whole-stage-codegen projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabulae.functions.transliteration import translit
from tabulae.schemas import NO_NUMBER_SENTINELS


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c: str | Column, dtype: str = "int") -> Column:
    """String -> integer; blanks around digits are ignored, junk -> null."""
    return col_(c).try_cast(dtype)


def to_date8(c: str | Column, fmt: str = "yyyyMMdd") -> Column:
    """Compact date text (``yyyyMMdd``) -> date; impossible dates -> null."""
    return F.try_to_date(col_(c), fmt)


def clean_text(c: str | Column) -> Column:
    """Name text: ASCII transliteration, blank trim, then word capitals."""
    return F.initcap(F.trim(translit(col_(c))))


def trim_translit(c: str | Column) -> Column:
    """Trim blanks first, then transliterate (no case change)."""
    return translit(F.trim(col_(c)))


def decimal_comma(c: str | Column, dtype: str = "decimal(18,2)") -> Column:
    """Decimal-comma text (``1000,50``) -> number; thousands dots -> null."""
    return F.replace(col_(c), F.lit(","), F.lit(".")).try_cast(dtype)


def pad_key(c: str | Column, width: int) -> Column:
    """Left-pad a code with zeros to ``width`` (longer input is cut to it)."""
    return F.lpad(col_(c), width, "0")


def decode(c: str | Column, labels: dict, cast: str | None = None) -> Column:
    """Code -> label; unknown codes and null -> null.

    ``cast`` converts a text code first (``'01'`` matches 1, ``'x'`` -> null).
    """
    key = col_(c)
    if cast:
        key = key.try_cast(cast)
    expr = None
    for code, label in labels.items():
        expr = F.when(key == F.lit(code), F.lit(label)) if expr is None else expr.when(key == F.lit(code), F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))


def upper_trim(c: str | Column) -> Column:
    return F.trim(F.upper(col_(c)))


def repair_email(c: str | Column) -> Column:
    """Lower-case, trim, and restore ``@`` typed as an apostrophe."""
    return F.replace(F.trim(F.lower(col_(c))), F.lit("'"), F.lit("@"))


def blank_sentinel(c: str | Column, sentinels: list[str] = NO_NUMBER_SENTINELS) -> Column:
    """Sentinel values -> empty string; everything else (and null) unchanged."""
    x = col_(c)
    return F.when(x.isin(*sentinels), F.lit("")).otherwise(x)


# name -> cleaner, for table-level transforms (see operators.columns)
CLEANERS = {
    "int": to_int,
    "bigint": lambda c: to_int(c, "bigint"),
    "date": to_date8,
    "str": clean_text,
}

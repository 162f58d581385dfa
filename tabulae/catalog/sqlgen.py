"""DuckDB spellings of the cleaners, for the oracle queries."""

from __future__ import annotations

from tabulae.functions.address import ABBREVIATIONS, SOUNDS, STOP_WORDS
from tabulae.functions.transliteration import translit_sql


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def s_int(e: str, t: str = "INTEGER") -> str:
    return f"TRY_CAST({e} AS {t})"


def s_date8(e: str) -> str:
    return f"CAST(TRY_STRPTIME({e}, '%Y%m%d') AS DATE)"


def s_initcap(e: str) -> str:
    # words are split on the blank only, as Spark's initcap does
    return (f"list_aggregate(list_transform(string_split({e}, ' '), "
            f"lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ')")


def s_trim(e: str) -> str:
    return f"trim({e}, ' ')"


def s_clean_text(e: str) -> str:
    return s_initcap(s_trim(translit_sql(e)))


def s_trim_translit(e: str) -> str:
    return translit_sql(s_trim(e))


def s_decimal_comma(e: str, t: str = "DECIMAL(18,2)") -> str:
    return f"TRY_CAST(replace({e}, ',', '.') AS {t})"


def s_pad(e: str, n: int) -> str:
    return f"lpad({e}, {n}, '0')"


def s_decode(e: str, labels: dict, cast: bool = True) -> str:
    key = s_int(e) if cast else e
    whens = " ".join(f"WHEN {code} THEN {q(label)}" for code, label in labels.items())
    return f"(CASE {key} {whens} ELSE NULL END)"


def s_upper_trim(e: str) -> str:
    return s_trim(f"upper({e})")


def s_repair_email(e: str) -> str:
    return f"replace({s_trim(f'lower({e})')}, '''', '@')"


def s_blank_sentinel(e: str, sentinels: list[str]) -> str:
    inlist = ", ".join(q(s) for s in sentinels)
    return f"(CASE WHEN {e} IN ({inlist}) THEN '' ELSE {e} END)"


def s_digest(name: str, sql: str, cols: list[str]) -> str:
    """One row: table name, rows, and an order-free checksum of all columns."""
    text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in cols)
    return (f"SELECT {q(name)} AS published, count(*) AS n_rows, "
            f"CAST(coalesce(sum(CAST(concat('0x', substr(md5(concat_ws('|', {text})), 1, 8)) AS BIGINT)), 0) AS BIGINT) AS checksum "
            f"FROM ({sql}) t")


def s_address_words(e: str) -> str:
    """Sorted distinct comparable words of an address part (accents by DuckDB's own rule)."""
    plain = f"regexp_replace(upper(strip_accents(coalesce({e}, ''))), '[^0-9A-Z]+', ' ', 'g')"
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in ABBREVIATIONS.items())
    words = f"flatten(list_transform(string_split({plain}, ' '), lambda w: string_split(CASE w {whens} ELSE w END, ' ')))"
    sounded = "w"
    for old, new in SOUNDS:
        sounded = f"replace({sounded}, {q(old)}, {q(new)})"
    kept = f"list_filter({words}, lambda w: w <> '' AND w NOT IN {STOP_WORDS})"
    return f"list_sort(list_distinct(list_transform({kept}, lambda w: {sounded})))"

"""Brazilian address text as sets of comparable words (native expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabulae.functions.transliteration import translit

# FIXED VALUES: usual abbreviations of street types, titles and quarters.
ABBREVIATIONS = {
    "R": "RUA", "AV": "AVENIDA", "AVE": "AVENIDA", "TV": "TRAVESSA", "TRAV": "TRAVESSA", "AL": "ALAMEDA", "ROD": "RODOVIA",
    "EST": "ESTRADA", "ESTR": "ESTRADA", "PC": "PRACA", "PCA": "PRACA", "LGO": "LARGO", "LRG": "LARGO", "BC": "BECO", "VD": "VIADUTO",
    "DR": "DOUTOR", "DRA": "DOUTORA", "PROF": "PROFESSOR", "PROFA": "PROFESSORA", "ENG": "ENGENHEIRO", "CEL": "CORONEL",
    "CAP": "CAPITAO", "GEN": "GENERAL", "MAL": "MARECHAL", "TEN": "TENENTE", "SGT": "SARGENTO", "BRIG": "BRIGADEIRO", "ALM": "ALMIRANTE",
    "PRES": "PRESIDENTE", "GOV": "GOVERNADOR", "PREF": "PREFEITO", "VER": "VEREADOR", "DEP": "DEPUTADO", "SEN": "SENADOR", "MIN": "MINISTRO",
    "PE": "PADRE", "S": "SAO", "STO": "SANTO", "STA": "SANTA", "NSA": "NOSSA SENHORA", "JD": "JARDIM", "JDM": "JARDIM", "VL": "VILA", "PQ": "PARQUE", "PRQ": "PARQUE",
    "RES": "RESIDENCIAL", "CJ": "CONJUNTO", "CONJ": "CONJUNTO", "DIST": "DISTRITO", "CID": "CIDADE", "BRO": "BAIRRO",
}
# FIXED VALUES: words that join names and tell nothing apart.
STOP_WORDS = ("DE", "DA", "DO", "DAS", "DOS", "E")
# FIXED VALUES: spellings that sound alike, replaced in this order.
SOUNDS = (("PH", "F"), ("TH", "T"), ("Y", "I"), ("W", "V"), ("K", "C"), ("Z", "S"), ("LL", "L"), ("NN", "N"), ("TT", "T"),
          ("SS", "S"), ("RR", "R"), ("PP", "P"), ("MM", "M"), ("FF", "F"), ("CC", "C"))


def address_words(text: Column) -> Column:
    """The distinct words of an address part, sorted: no accents, upper case,
    abbreviations written out, joining words dropped, spelling by sound.
    Null and wordless text give an empty array."""
    plain = F.regexp_replace(F.upper(translit(F.coalesce(text, F.lit("")))), "[^0-9A-Z]+", " ")
    full = F.create_map(*(F.lit(x) for pair in ABBREVIATIONS.items() for x in pair))

    words = F.transform(F.split(plain, " "), lambda w: F.coalesce(F.try_element_at(full, w), w))
    words = F.flatten(F.transform(words, lambda w: F.split(w, " ")))
    kept = F.filter(words, lambda w: (w != "") & ~w.isin(*STOP_WORDS))
    # no spelling holds a blank: replaced in all words at once
    sounded = F.array_join(kept, " ")
    for old, new in SOUNDS:
        sounded = F.replace(sounded, F.lit(old), F.lit(new))
    return F.array_sort(F.array_distinct(F.filter(F.split(sounded, " "), lambda w: w != "")))

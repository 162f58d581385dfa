from tabulae.functions.clean import (  # noqa: F401
    CLEANERS, blank_sentinel, clean_text, col_, decimal_comma, decode, pad_key,
    repair_email, to_date8, to_int, trim_translit, upper_trim,
)
from tabulae.functions.transliteration import translit, translit_sql  # noqa: F401

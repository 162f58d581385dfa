"""Links of HTML text as native expressions.

One pattern is the tokenizer: it walks a page once, from markup to markup, and
knows comments, declarations, elements whose content is text (scripts, styles,
titles ...) and tags with quoted, unquoted and empty attributes.  Only anchors
and the page's base are captured; everything else is consumed, so a link in a
comment, a script or another attribute's value is no link.  All loops are
possessive: a tag of any length takes no stack and is not tried twice.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANK = r"[ \t\n\f\r]"
_VALUE = rf"""(?:"[^"]*+"|'[^']*+'|[^ \t\n\f\r>]*+)"""
_NAME = r"=?+[^ \t\n\f\r/>=]++"
_ATTRIBUTE = rf"{_NAME}(?:{_BLANK}*+={_BLANK}*+{_VALUE})?+"
_ATTRIBUTES = rf"(?:(?:{_BLANK}|/)++|{_ATTRIBUTE}|=)*+"
# FIXED VALUES: elements whose content is text up to their end tag.
TEXT_ELEMENTS = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
TOKENS = "(?is)" + "|".join((
    rf"(<(?:a|base)(?={_BLANK}|/){_ATTRIBUTES}>)",                                       # group 1: the tags that are asked for
    rf"<({'|'.join(TEXT_ELEMENTS)})(?={_BLANK}|[/>]){_ATTRIBUTES}>.*?(?:</\2(?={_BLANK}|[/>])|\z)",
    r"<!--(?:-?+>|.*?(?:--!?+>|\z))",
    rf"</?+[a-z][^ \t\n\f\r/>]*+{_ATTRIBUTES}>",
    r"<[!?/][^>]*+>",
))
_PARSED = rf"(?s)({_NAME})(?:{_BLANK}*+={_BLANK}*+({_VALUE}))?+"
# Names that are read without their semicolon too: those of Latin-1 and the four of markup itself.
NAMED = {f"{n};": chr(c) for n, c in name2codepoint.items()} | {"apos;": "'"}
NAMED |= {n: chr(c) for n, c in name2codepoint.items() if c < 256}
_REFERENCE = r"&#[0-9]++;?+|&#[xX][0-9a-fA-F]++;?+|&[A-Za-z][A-Za-z0-9]*+(?:;|(?!=))|[^&]++|&"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once a row."""
    return F.transform(F.array(value), body)[0]


def _sign(code: Column) -> Column:
    """The character of a code point (null: too large); what is none becomes U+FFFD."""
    # Fixed rule: 0x80 to 0x9F are read as the old Windows code page, as browsers do.
    windows = F.array(*(F.lit(bytes([b]).decode("cp1252", "ignore") or chr(b)) for b in range(0x80, 0xA0)))
    whole = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    bad = code.isNull() | (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    return F.when(bad, F.lit("�")).when(code.between(0x80, 0x9F), F.get(windows, (code - 0x80).cast("int"))).otherwise(whole)


def unescape(text: Column) -> Column:
    """Character references of an attribute value resolved.

    Numeric ones (decimal, hexadecimal) and the names of HTML 4; a name without its
    semicolon counts only where no letter, digit or ``=`` follows, so the
    parameters of a query string stay.
    """
    names = F.create_map(*(F.lit(x) for pair in NAMED.items() for x in pair))

    def one(t: Column) -> Column:
        digits = F.regexp_extract(t, "^&#[xX]?([0-9a-fA-F]+)", 1)
        short = F.when(F.length(F.ltrim(digits, F.lit("0"))) <= 8, digits)      # longer ones are no code points
        number = F.when(t.rlike("^&#[xX]"), F.conv(short, 16, 10)).otherwise(F.conv(short, 10, 10))
        return (F.when(~t.startswith("&"), t).when(t == "&amp;", F.lit("&"))
                .when(t.startswith("&#"), _sign(number.cast("long")))
                .otherwise(F.coalesce(F.try_element_at(names, F.substr(t, F.lit(2))), t)))

    tokens = F.regexp_extract_all(text, F.lit(_REFERENCE), 0)
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(tokens, one), "")).otherwise(text)


def attribute(tag: Column, name: str) -> Column:
    """The value of a start tag's attribute, references resolved ('' without a
    value, null without the attribute); of several the last one counts."""
    inner = F.regexp_replace(tag, r"^<[^ \t\n\f\r/>]++", "")

    def last(text: Column) -> Column:
        pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(_PARSED), 1).alias("name"), F.regexp_extract_all(text, F.lit(_PARSED), 2).alias("value"))
        return F.try_element_at(F.filter(pairs, lambda p: F.lower(p["name"]) == name), F.lit(-1))["value"]

    def bare(value: Column) -> Column:
        return F.when(value.rlike("""(?s)^(?:".*"|'.*')$"""), F.substring(value, 2, F.length(value) - 2)).otherwise(value)

    return _let(_let(inner, last), lambda v: unescape(bare(v)))


def link_tags(html: Column) -> Column:
    """The start tags of anchors and bases of a page, in order."""
    return F.filter(F.regexp_extract_all(html, F.lit(TOKENS), 1), lambda t: t != "")


def _parts(url: Column) -> Column:
    """scheme, authority (with its slashes), path, query and fragment of a URL, '' where absent."""
    pattern = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*+:)?(//[^/?#]*+)?([^?#]*+)(\?[^#]*+)?(#.*+)?$"
    return F.struct(*(F.regexp_extract(url, pattern, i).alias(n) for i, n in enumerate(("scheme", "host", "path", "query", "fragment"), 1)))


def _without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` segments resolved."""
    def step(kept: Column, s: Column) -> Column:
        return (F.when(s == ".", kept).when(s == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1))))
                .otherwise(F.concat(kept, F.array(s))))

    def walked(segments: Column) -> Column:
        kept = F.aggregate(F.slice(segments, F.lit(2), F.size(segments)), F.slice(segments, 1, 1), step)
        return F.array_join(F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")

    return F.when(path.rlike(r"(?:^|/)\.\.?(?:/|$)"), _let(F.split(path, "/", -1), walked)).otherwise(path)


def resolve(base: Column, link: Column) -> Column:
    """The absolute URL of a link on a page (RFC 3986): blanks around it and
    tabs and line breaks in it are dropped; null if either is null."""
    clean = F.btrim(F.translate(link, "\t\n\r", ""), F.lit(" \f"))

    def joined(b: Column, r: Column) -> Column:
        merged = F.when(r["path"].startswith("/"), r["path"]).when(
            (b["path"] == "") & (b["host"] != ""), F.concat(F.lit("/"), r["path"])).otherwise(
            F.concat(F.regexp_extract(b["path"], "(?s)^(.*/)?", 1), r["path"]))
        # RFC 3986, 5.2.2
        return (F.when(r["scheme"] != "", F.concat(r["scheme"], r["host"], _without_dots(r["path"]), r["query"]))
                .when(r["host"] != "", F.concat(b["scheme"], r["host"], _without_dots(r["path"]), r["query"]))
                .when(r["path"] == "", F.concat(b["scheme"], b["host"], b["path"], F.when(r["query"] != "", r["query"]).otherwise(b["query"])))
                .otherwise(F.concat(b["scheme"], b["host"], _without_dots(merged), r["query"])))

    return _let(F.struct(_parts(base).alias("b"), _parts(clean).alias("r")), lambda p: F.concat(joined(p["b"], p["r"]), p["r"]["fragment"]))

"""Link manifests from index pages, and what a file name says (year, base name).

Pages are rows; links come out by ``explode`` of the tokens of the HTML, so the
work spreads over all pages with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulae.functions.html import attribute, link_tags, resolve


def extract_links(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None,
                  base_col: str | None = None) -> DataFrame:
    """One row per anchor with an ``href``: ``keep`` columns + ``link``.

    ``link`` is the value as a parser reads it (any quotes, references
    resolved); anchors in comments, scripts and other text elements are none.
    With ``base_col``, the column of the pages' addresses, ``resolved`` is the
    absolute link; a page's own ``<base href>`` counts as a parser would.
    """
    keep = keep or []
    tags = pages.select(*keep, *([F.col(base_col).alias("__page")] if base_col else []), link_tags(F.col(html_col)).alias("__tags"))
    if base_col:
        own = F.try_element_at(F.filter(F.transform(F.filter("__tags", lambda t: t.rlike("(?i)^<b")), lambda t: attribute(t, "href")),
                                        lambda h: h.isNotNull()), F.lit(1))
        tags = tags.withColumn("__base", F.when(own.isNull(), F.col("__page")).otherwise(resolve(F.col("__page"), own)))
    anchors = F.filter("__tags", lambda t: t.rlike("(?i)^<a"))
    links = tags.select(*keep, *(["__base"] if base_col else []), F.explode(anchors).alias("__tag")).withColumn(
        "link", attribute(F.col("__tag"), "href")).where(F.col("link").isNotNull())
    if base_col:
        links = links.withColumn("resolved", resolve(F.col("__base"), F.col("link")))
    return links.drop("__base", "__tag")


def link_manifest(
    pages: DataFrame,
    html_col: str = "html",
    keep: list[str] | None = None,
    suffix: str | None = None,
    contains: str | None = None,
    base_col: str | None = None,
) -> DataFrame:
    """Links of the index pages, optionally only those ending in ``suffix``
    (e.g. ``.zip``) and containing ``contains`` (e.g. ``mun``).  With
    ``base_col`` they also come ``resolved`` against the page's address."""
    df = extract_links(pages, html_col, keep, base_col)
    if suffix is not None:
        df = df.filter(F.col("link").endswith(suffix))
    if contains is not None:
        df = df.filter(F.col("link").contains(contains))
    return df


def first_number(c: str | Column, digits: int = 4) -> Column:
    """The first run of ``digits`` digits in the text, as int (none -> null)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract(x, f"[0-9]{{{digits}}}", 0).try_cast("int")


def year_filter(df: DataFrame, c: str, lo: int, hi: int, digits: int = 4, out: str = "year") -> DataFrame:
    """Keep rows whose name carries a year in ``[lo, hi]`` (inclusive)."""
    return df.withColumn(out, first_number(c, digits)).filter(F.col(out).between(lo, hi))


def base_name(c: str | Column, marker_regex: str) -> Column:
    """Everything after the first match of ``marker_regex`` ('' if absent)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract(x, f"{marker_regex}(.+)", 1)


def download_manifest(
    pages: DataFrame,
    suffix: str,
    contains: str | None = None,
    marker_regex: str | None = None,
    years: tuple[int, int] | None = None,
    html_col: str = "html",
    keep: list[str] | None = None,
    base_col: str | None = None,
) -> DataFrame:
    """Files to fetch from index pages: links ending in ``suffix`` (and
    containing ``contains``), their base name after ``marker_regex`` (the
    last path segment when not given), and, with ``years``, only names whose
    first 4-digit run lies in the inclusive range."""
    df = link_manifest(pages, html_col, keep, suffix=suffix, contains=contains, base_col=base_col)
    name = base_name("link", marker_regex) if marker_regex else F.regexp_extract("link", r"([^/]+)$", 1)
    df = df.withColumn("name", name)
    if years is not None:
        df = year_filter(df, "name", years[0], years[1])
    return df


def registry_manifest(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None,
                      base_col: str | None = None) -> DataFrame:
    """The register's downloads: every ``.zip`` link of the index pages."""
    return download_manifest(pages, ".zip", html_col=html_col, keep=keep, base_col=base_col)


ALL_YEARS = "all"


def trade_manifest(pages: DataFrame, years: tuple[int, int] | str | None = None, html_col: str = "html",
                   keep: list[str] | None = None, base_col: str | None = None) -> DataFrame:
    """The trade downloads: ``.csv`` links under ``mun/`` whose name carries a
    year in ``years`` (default: the published default range; ALL_YEARS: every
    link, whatever its name says)."""
    from tabulae.schemas import TRADE_DEFAULT_YEARS

    return download_manifest(pages, ".csv", contains="mun", marker_regex="mun/", html_col=html_col, keep=keep, base_col=base_col,
                             years=None if years == ALL_YEARS else years or TRADE_DEFAULT_YEARS)

"""Links of hard pages and computed address scores on whole test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulae.catalog.sqlgen import s_address_words
from tabulae.catalog.standin import Standin, table
from tabulae.operators.geocode import geocode
from tabulae.operators.links import extract_links
from tabulae.operators.match import PRECISE

Q: dict = {}


# --- R2: every page's links written in other ways, with decoys; the expectation comes from the plain page
_PLAIN = r'<a href="(/[^"]*)">'
_HARD = {
    0: "<A class=x HREF=$1 >",
    1: "<a title=\"a > b\" href='&#47;.$1'><!-- <a href=\"/no\"> -->",
    2: "<!-- <a href='$1'> --><script>var t='<a href=\"$1\">';</script><a data-href='/no' href=\"$1\"><p title='<a href=$1>'>",
    3: "<title><a href=$1></title><a\n\t href\n= \"./../../../..$1\"/>",
}


def q_link_tokens(spark, sf):
    pages = table(spark, sf, "pages")
    html = F.when(F.lit(False), F.col("html"))
    for k, new in _HARD.items():
        html = html.when(F.col("page_id") % 4 == k, F.regexp_replace("html", _PLAIN, new))
    return extract_links(pages.withColumn("hard", html), "hard", ["page_id"], base_col="url").select("page_id", "resolved")


Q["link_tokens"] = (q_link_tokens, """SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]+') || unnest(regexp_extract_all(html, '<a href="(/[^"]*)">', 1)) AS resolved
  FROM pages""")


# --- R1: addresses of one table, spelt in other ways, scored against those of the same table
def _pick(by: str, *texts: str) -> str:
    return f"CASE {by} " + " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(texts)) + " END"


KNOWN = Standin("part", [
    ("id", "p_partkey"),
    ("rua", f"concat({_pick('p_partkey % 4', repr('Rua '), repr('R. '), repr('Avenida Dr. '), repr('Praça da '))}, p_name, ' ', p_type)"),
    ("bairro", "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE concat('Jardim ', replace(p_brand, '#', ' ')) END"),
    ("municipio", "concat('São Tomé ', CAST(p_size % 10 AS STRING))"),
    ("uf", "CASE WHEN p_partkey % 50 = 7 THEN NULL ELSE 'mg' END"),
    ("cep", "lpad(CAST(p_partkey % 97 AS STRING), 8, '0')"),
    ("quality", "CASE p_partkey % 3 WHEN 0 THEN 'PointAddress' WHEN 1 THEN 'StreetAddress' ELSE 'Locality' END"),
    ("lat", "p_retailprice / 100"), ("lng", "CAST(p_partkey AS DOUBLE) / 7"),
])
ASKED = Standin("part", [
    ("p_partkey", "p_partkey"),
    ("rua", f"concat({_pick('p_partkey % 5', repr('RUA '), repr('av doutor '), repr('pca '), repr(''), repr('Travessa do '))}, upper(p_type), ', ', "
            f"{_pick('p_partkey % 3', 'p_name', 'upper(p_name)', 'p_type')})"),
    ("bairro", "CASE WHEN p_partkey % 7 = 0 THEN '' ELSE concat('JD. ', replace(p_brand, '#', '-'), CASE WHEN p_partkey % 9 = 0 THEN ' II' ELSE '' END) END"),
    ("municipio", "concat('SAO THOMÉ ', CAST((p_size + p_partkey % 2) % 10 AS STRING))"),
    ("uf", "'MG'"),
    ("cep", "CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE concat('00000-', lpad(CAST(p_partkey % 120 AS STRING), 3, '0')) END"),
])


def q_address_scores(spark, sf):
    return geocode(ASKED.df(spark, sf), KNOWN.df(spark, sf)).select("p_partkey", "tier", "score", "lat", "lng")


_PARTS = f"""{s_address_words('rua')} AS s, {s_address_words('bairro')} AS q, {s_address_words('municipio')} AS m, {s_address_words('uf')} AS u,
  lpad(nullif(regexp_replace(coalesce(cep, ''), '[^0-9]', '', 'g'), ''), 8, '0') AS c"""
# every pair of one city, no blocking
Q["address_scores"] = (q_address_scores, f"""WITH r AS MATERIALIZED (SELECT p_partkey, {_PARTS} FROM ({ASKED.sql()}) a),
k AS MATERIALIZED (SELECT id, lat, lng, quality IN {PRECISE} AS good, {_PARTS} FROM ({KNOWN.sql()}) b),
p AS (SELECT p_partkey, id, lat, lng, good, r.c IS NOT NULL AND r.c = k.c AS same_code,
    len(list_intersect(r.s, k.s)) AS si, len(r.s) + len(k.s) AS ss, len(r.s) AS rs,
    CASE WHEN len(r.q) + len(k.q) = 0 THEN 1 ELSE len(list_intersect(r.q, k.q)) END AS qi, greatest(len(r.q) + len(k.q), 2 * CAST(len(r.q) + len(k.q) = 0 AS INTEGER)) AS qs, len(r.q) AS rq
  FROM r JOIN k ON r.m = k.m AND r.u = k.u AND len(r.u) > 0),
s AS (SELECT *, CASE WHEN rs > 0 AND ss > 0 THEN (2 * (70 * si * qs + 30 * qi * ss)) // (ss * qs) END AS s1, CASE WHEN rq > 0 THEN 200 * qi // qs END AS s2 FROM p),
t AS (SELECT p_partkey, id, lat, lng, 1 AS tier, s1 AS score FROM s WHERE s1 = 100 OR (s1 >= 80 AND good)
  UNION ALL SELECT p_partkey, id, lat, lng, 2, s2 FROM s WHERE s2 >= 80
  UNION ALL SELECT p_partkey, id, lat, lng, 3, NULL FROM s WHERE same_code),
best AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY tier, score DESC, id) AS n FROM t)
SELECT r.p_partkey, tier, CAST(score AS INTEGER) AS score, lat, lng FROM r LEFT JOIN best ON best.p_partkey = r.p_partkey AND n = 1""")

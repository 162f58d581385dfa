"""The HTML tokenizer against hand-written expectations and a parser."""

import random
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark.sql import functions as F

from tabulae.functions.html import resolve, unescape
from tabulae.operators.links import ALL_YEARS, extract_links, registry_manifest, trade_manifest

# page, links in order
PAGES = [
    ('<a href="x.zip">x</a>', ["x.zip"]),
    ("<A HREF='x.zip'>x</A>", ["x.zip"]),
    ("<a href=x.zip>x</a><a\n\thref = y.zip\n>y</a><a href=z.zip/>", ["x.zip", "y.zip", "z.zip/"]),
    ('<!-- <a href="no.zip"> --><a href="yes.zip"><!--><a href="two.zip">--', ["yes.zip", "two.zip"]),
    ('<!-- <a href="no.zip"> never ended', []),
    ("""<script>document.write('<a href="no.zip">x</a>')</script><a href=yes.zip>""", ["yes.zip"]),
    ('<SCRIPT type="a>b">"<a href=no>"</script ><a href=yes>', ["yes"]),
    ("<script><a href=no></scripty><a href=no2></script><a href=yes>", ["yes"]),
    ("<style>a{}<a href=no></style><textarea><a href=no></textarea><title><a href=no></title><a href=yes>", ["yes"]),
    ("<script>never ended <a href=no>", []),
    ('<a data-href="no" title="x > y" href="yes">', ["yes"]),
    ("""<img alt='<a href="no">'><p title="<a href='no'>"><a href=yes>""", ["yes"]),
    ("<a href>one</a><a href=''>two</a><a name=x>no</a><a>no</a><abbr href=no><area href=no>", ["", ""]),
    ('<a href="a?x=1&amp;y=2&copy=3&#38;z=&#x2F;&lt;&eacute;&apos;&unknown;&AMP">', ["a?x=1&y=2&copy=3&z=/<é'&unknown;&AMP"]),
    ('<a href="one" href="two">', ["two"]),
    ("<a class=b/href=c>no</a><a/href=d>", ["d"]),
    ('<a href="a\nb">', ["a\nb"]),
    ("2 < 3 <a href=yes> < a href=no> <1a href=no>", ["yes"]),
    ("<!DOCTYPE html><?xml <a href=no ?><a href=yes></a href=no>", ["yes"]),
    ("<a href=\"it's\">, <a href='say \"so\"'>, <a href=it's>", ["it's", 'say "so"', "it's"]),
    ("", []), (None, []),
]


def found(spark, pages, **kw):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "id int, html string")
    out = {}
    for r in extract_links(df, keep=["id"], **kw).collect():
        out.setdefault(r["id"], []).append(r["link"])
    return [out.get(i, []) for i in range(len(pages))]


def test_hand_written_pages(spark):
    for (page, want), got in zip(PAGES, found(spark, [p for p, _ in PAGES])):
        assert got == want, page


class _Anchors(HTMLParser):
    def __init__(self):
        super().__init__()
        self.links = []

    def handle_starttag(self, tag, attrs):
        if tag == "a" and "href" in dict(attrs):
            self.links.append(dict(attrs)["href"] or "")


def test_generated_pages_equal_a_parser(spark):
    r = random.Random(5)
    words = ["x.zip", "/mun/EXP_2019.csv", "../a/b?c=1&amp;d=2", "http://h.org/é", "#top", "a&#47;b", "q&eacute;", "p&gt;q"]

    def attr(name):
        v = r.choice(words)
        style = r.choice(['{n}="{v}"', "{n}='{v}'", "{n}={v}", '{n} = "{v}"', "{n}\n=\n'{v}'", "{n}"])
        return style.format(n=r.choice([name, name.upper()]), v=v)

    def piece():
        kind = r.randrange(7)
        attrs = [attr(n) for n in r.sample(["href", "title", "data-href", "class", "id"], r.randrange(5))]
        r.shuffle(attrs)
        if kind == 0:
            return f"<!-- <a {' '.join(attrs)}> -->"
        if kind == 1:
            return f"<script {' '.join(attrs)}>if (a<b) '<a {' '.join(attrs)}>'</script>"
        if kind == 2:
            return f"<{r.choice(['p', 'div', 'abbr', 'area'])} {' '.join(attrs)}>"
        if kind == 3:
            return r.choice(["text & more", "</p>", "a < b", "<br/>", "<!DOCTYPE x>", "é"])
        return f"<{r.choice('aA')} {' '.join(attrs)}>link</a>"

    pages = ["".join(piece() for _ in range(r.randrange(1, 30))) for _ in range(300)]
    want = []
    for p in pages:
        parser = _Anchors()
        parser.feed(p)
        want.append(parser.links)
    got = found(spark, pages)
    assert got == want
    assert sum(map(len, want)) > 500


def test_long_markup_takes_no_stack_and_linear_time(spark):
    n = 200_000
    pages = ["<a " + "x=1 " * n + "href=yes>", "<a " + "/" * n + "href=yes>", "<" * n + "<a href=yes>", "<!--" * n + "--><a href=yes>",
             "<p title=\"" + "y" * n + "\"><a href=yes>", "<a href='" + "&amp;" * n + "'>"]
    got = found(spark, pages)
    assert got[:5] == [["yes"]] * 5 and got[5] == ["&" * n]


def test_references(spark):
    cases = {"&#233;": "é", "&#x1F600;": "😀", "&#0;": "�", "&#xD800;": "�", "&#99999999999;": "�", "&#x80;": "€",
             "&#00000000000038;": "&", "&nbsp": "\xa0", "&lt;b&gt;": "<b>", "&euro;": "€", "&euro": "&euro", "&": "&", "&;": "&;", "&#;": "&#;", "a&b": "a&b", "": "", None: None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r[0]: r[1] for r in df.select("t", unescape(F.col("t"))).collect()}
    assert got == cases


def test_resolution_equals_urljoin(spark):
    bases = ["http://h.org/a/b/c.html?q=1#f", "http://h.org", "https://h.org/dir/", "http://h.org/x"]
    links = ["d.zip", "./d.zip", "../d.zip", "../../../d.zip", "/r/./s/../d.zip", "//o.org/x.zip", "ftp://f.org/y", "?p=2", "#z", "", "d/../e/.", "d/..", "mailto:a@b", " x.zip\n", "g;x=1/../y", "http://k.org"]
    df = spark.createDataFrame([(b, x) for b in bases for x in links], "b string, x string")
    for r in df.withColumn("u", resolve(F.col("b"), F.col("x"))).collect():
        want = urljoin(r["b"], r["x"].strip()) if r["x"].strip() not in ("", "#z") else r["b"].split("#")[0] + r["x"].strip()
        assert r["u"] == want, (r["b"], r["x"])


def test_page_base_counts(spark):
    df = spark.createDataFrame([(1, "http://h.org/a/", '<base target=x><base href="../files/"><base href="no/"><a href="x.zip">'), (2, "http://h.org/a/", "<a href=x.zip>")], "id int, url string, html string")
    got = {r["id"]: (r["link"], r["resolved"]) for r in extract_links(df, keep=["id"], base_col="url").collect()}
    assert got == {1: ("x.zip", "http://h.org/files/x.zip"), 2: ("x.zip", "http://h.org/a/x.zip")}


def test_manifests_can_take_all_years_and_resolve(spark):
    html = "".join(f"<a href=mun/EXP_{y}_MUN.csv>" for y in (1997, 2016, 2021, 2030)) + "<a href=mun/EXP_ALL.csv><a href='F.zip?'><a href=F&#46;zip>"
    df = spark.createDataFrame([("http://h.org/i/", html)], "url string, html string")
    assert [r["name"] for r in trade_manifest(df).collect()] == ["EXP_2016_MUN.csv", "EXP_2021_MUN.csv"]
    assert trade_manifest(df, years=ALL_YEARS).count() == 5
    assert [(r["name"], r["resolved"]) for r in registry_manifest(df, base_col="url").collect()] == [("F.zip", "http://h.org/i/F.zip")]

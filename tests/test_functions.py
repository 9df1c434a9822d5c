import pytest
import html as pyhtml
from urllib.parse import urljoin

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkloom.functions.html import decode_references, hrefs, html_text
from linkloom.functions.scalars import coupon_number, pad_code, parse_time, format_time, tokens
from linkloom.functions.urls import index_name, url_join

BASES = [
    "https://h.org", "https://h.org/", "https://h.org/a/b/c.html", "https://h.org/a/b/?x=1",
    "http://h.org/a/b#f",
]
REFS = [
    "", "x", "/x", "../x", "../../../x", "./x", "x/", "?q=1", "//o.com/p", ".", "..", "a//b",
    "/a/../b", "x?y=1", "a/./b", "library/os.html", "../", "/",
]


def _joined(spark, pairs):
    rows = spark.createDataFrame(list(enumerate(pairs)), "i int, p struct<b:string,r:string>")
    out = rows.select("i", url_join(F.col("p.b"), F.col("p.r")).alias("u")).collect()
    return [u for _, u in sorted(out)]


def test_url_join_table(spark):
    pairs = [(b, r) for b in BASES for r in REFS]
    assert _joined(spark, pairs) == [urljoin(b, r) for b, r in pairs]


_part = st.sampled_from(["a", "b.html", "..", ".", "", "x-1", "é"])
_ref = st.one_of(
    st.lists(_part, max_size=5).map("/".join),
    st.tuples(st.lists(_part, max_size=4).map("/".join), st.sampled_from(["q=1", "a=/b", ""])).map("?".join),
    st.tuples(st.lists(_part, max_size=4).map("/".join), st.sampled_from(["top", ""])).map("#".join),
    st.sampled_from(["mailto:x@y", "https://z.org/q/../r", "HTTP://Z.org/a", "//n.org", "javascript:void(0)"]),
)
_base = st.tuples(
    st.sampled_from(["http://h.org", "https://h.org:8080"]), st.lists(_part, max_size=5).map("/".join)
).map(lambda t: t[0] + ("/" + t[1] if t[1] else ""))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs=st.lists(st.tuples(_base, _ref), min_size=60, max_size=120))
def test_url_join_random(spark, pairs):
    for pair, got in zip(pairs, _joined(spark, pairs)):
        assert got == urljoin(*pair), pair


def _one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values))
    return row.select(column.alias("v")).first()[0]


def test_references(spark):
    for text in ["a &amp;lt; b", "&lt;4&gt; &amp;amp;", "&eacute;&#233;&#xe9;&#x1F600;", "x & y &nope; z",
                 "no reference", "&copy;&hellip;", "&amp", "&&amp;&", "it&apos;s &check; &lt &ltx &notit; &copycat &fjlig; &amp=", "&nosuch &#x;"]:
        expected = pyhtml.unescape(text)
        assert _one(spark, decode_references(F.col("t")), t=text) == expected, text


def test_html_corner_cases(spark):
    cases = {
        "<p>a < b</p>": "a < b",
        "<header>x</header>y": "x y",
        "<head><title>t</title><body>x": "x",
        "<!-- <script> -->kept<script>dropped</script>": "kept",
        "<SCRIPT type='a'>no</SCRIPT >yes<STYLE>no</STYLE>": "yes",
        "<p>\xa0 a\xa0b 　</p>": "a\xa0b",
        "a<!-- open <p>b": "a",
        "a<script>var b = '<p>'": "a",
        "a<p>b<img src='": "a b",
        "": "",
    }
    for html, text in cases.items():
        assert _one(spark, html_text(F.col("h")), h=html) == text, html


def test_first_script_only(spark):
    html = "<head>h</head>a<script>one</script>b<script>two</script>c"
    assert _one(spark, html_text(F.col("h"), first_only=True), h=html) == "a b two c"
    assert _one(spark, html_text(F.col("h")), h=html) == "a b c"


def test_hrefs(spark):
    html = (
        "<a class=x href=one>1</a><A HREF='two'>2</A><a data-href='no'>n</a><a href=\"a&amp;b\">3</a>"
        "<abbr href=no></abbr><a name=n\nhref = \"four\">4</a><a href='one'>again</a><a href=''>e</a>"
    )
    assert _one(spark, hrefs(F.col("h")), h=html) == ["one", "two", "a&b", "four", ""]


def test_codes(spark):
    assert _one(spark, pad_code(F.col("c")), c=123) == "123000"
    assert _one(spark, pad_code(F.col("c")), c=1048575) == "1048575"
    top = spark.range(2000).select(coupon_number(F.col("id")).alias("c")).agg(F.min("c"), F.max("c")).first()
    assert 0 <= top[0] and top[1] <= 0xFFFFF


def test_times_and_names(spark):
    text = "2024-01-02 03:04:05"
    assert _one(spark, format_time(parse_time(F.col("t"))), t=text) == text
    assert _one(spark, parse_time(F.col("t")), t="yesterday") is None
    assert _one(spark, index_name(F.col("u")), u="https://site.test/a?b") == "httpssite.testab"
    assert _one(spark, tokens(F.col("t")), t="Don't stop, Éa 3.14 spark") == ["don't", "stop", "éa", "3.14", "spark"]


def test_references_by_hand(spark):
    text = "it&apos;s &check; 1 &lt 2, &copy2024 &NotEqualTilde; &unknown;"
    assert _one(spark, decode_references(F.col("t")), t=text) == "it's \u2713 1 < 2, \xa92024 \u2242\u0338 &unknown;"


def test_bad_pages_take_linear_time(spark):
    import time

    for opener, column in (("<a ", hrefs), ("<head>", html_text), ("<a href='", hrefs), ("<script>", html_text), ("<", html_text)):
        took = []
        for size in (500_000, 1_000_000):
            page = spark.createDataFrame([(opener * (size // len(opener)),)], "h string").select(F.length(F.to_json(F.struct(column(F.col("h"))))))
            started = time.time()
            page.collect()
            took.append(time.time() - started)
        assert took[1] < 3 * took[0] + 2, (opener, took)


@pytest.mark.parametrize("text, words", [
    ("rock'n'roll 'quoted' o'", ["rock'n'roll", "quoted", "o"]),
    ("don’t l'été naïve", ["don’t", "l'été", "naïve"]),
    ("e.g. a.b@c.org x:y U.S.A.", ["e.g", "a.b", "c.org", "x:y", "u.s.a"]),
    ("1,000.5;6 10:30 1. .5 1.a a.1 3'4", ["1,000.5;6", "10", "30", "1", "5", "1", "a", "a", "1", "3'4"]),
    ("snake_case __ _a_ _", ["snake_case", "_a_"]),
    ("東京タワーは x漢y カタカナabc 한국어", ["東", "京", "タワー", "は", "x", "漢", "y", "カタカナ", "abc", "한국어"]),
    ("...---!!", []), ("", []),
])
def test_words_of_the_default_analyzer(spark, text, words):
    assert _one(spark, tokens(F.col("t")), t=text) == words


def test_long_odd_texts_are_cut_in_linear_time(spark):
    for piece, count in (("a'", 1), ("1.", 1), ("' ", 0), ("漢", 100_000), (" .", 0), ("a ", 100_000)):
        assert spark.range(1).select(F.size(tokens(F.repeat(F.lit(piece), 100_000)))).first()[0] == count
    assert spark.range(1).select(tokens(F.lit(None).cast("string")).isNull()).first()[0]

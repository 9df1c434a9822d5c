from pyspark.sql import functions as F

from linkloom.functions.html import html_text
from linkloom.operators import documents as D
from linkloom.operators import links as L
from linkloom.operators.reach import crawl, crawl_requests, reach
from linkloom.sources.tables import usable_pages

S = "https://site.test"
SITE = [
    (S, '<html><head><title>T</title></head><body><a href="a.html">A</a><a href="/b/">B</a><a href="a.html">again</a>'
        '<a href="#top">x</a><a href="mailto:x@y">m</a></body></html>'),
    (f"{S}/a.html", "<body><a href='https://site.test/b/'>abs</a> <a href=https://site.test/d.zip>zip</a>"
        '<a href="https://other.test/z">o</a><a href="/fr/x">fr</a><a href="lib/zipfile.html">zf</a></body>'),
    (f"{S}/b/", '<body><!-- <a href="/hidden">h</a> --><script>var t="<a href=\'/js\'>";</script>'
        '<a href="../c?x=1&amp;y=2">C</a><a href="?p=2">p</a><a href="//o.test/q">pr</a>'
        '<a href="https://other.test/?u=https://site.test/">sub</a></body>'),
    (f"{S}/c?x=1&y=2", "<p> one <b>two</b>\n three &lt;4&gt; &amp;amp; </p><style>p{}</style><script>x()</script>"
        "<script>y()</script>"),
    (f"{S}/fr/x", '<body><a href="q.html">q</a><a href="https://site.test/c?x=1&amp;y=2">c</a></body>'),
    (f"{S}/empty", ""),
]
TARGETS = {
    S: [f"{S}/a.html", f"{S}/b/"],
    f"{S}/a.html": [f"{S}/b/", f"{S}/d.zip"],
    f"{S}/b/": ["https://o.test/q", f"https://other.test/?u={S}/", f"{S}/b/?p=2", f"{S}/c?x=1&y=2"],
    f"{S}/fr/x": [f"{S}/c?x=1&y=2"],
}
TEXTS = ["A B again x m", "abs zip o fr zf", "C p pr sub", "one two three <4> &amp;", "q c", ""]
DEPTHS = {
    S: 0, f"{S}/a.html": 1, f"{S}/b/": 1, "https://o.test/q": 2, f"https://other.test/?u={S}/": 2,
    f"{S}/b/?p=2": 2, f"{S}/c?x=1&y=2": 2, f"{S}/d.zip": 2,
}


def site(spark):
    return spark.createDataFrame(SITE, "url string, html string")


def _targets(df):
    found = {}
    for r in df.collect():
        found.setdefault(r["src"], []).append(r["dst"])
    return {k: sorted(v) for k, v in found.items()}


def test_site_edges_and_text(spark):
    edges = L.edges(site(spark), F.lit(S))
    assert _targets(edges) == {k: sorted(v) for k, v in TARGETS.items()}
    texts = {r["url"]: r["t"] for r in site(spark).select("url", html_text(F.col("html")).alias("t")).collect()}
    assert [texts[u] for u, _ in SITE] == TEXTS


def test_edge_options(spark):
    strict = _targets(L.edges(site(spark), F.lit(S), strict_extensions=True))
    assert f"{S}/d.zip" not in strict[f"{S}/a.html"]
    by_host = _targets(L.edges(site(spark), F.lit(S), root_match="host"))
    assert f"https://other.test/?u={S}/" not in by_host[f"{S}/b/"]
    same = _targets(L.edges(site(spark), F.lit(S), same_host=True))
    assert "https://o.test/q" not in same[f"{S}/b/"]
    assert L.edges(site(spark), F.lit("")).count() == 0


def test_crawl(spark):
    roots = spark.createDataFrame([(S,)], "root string")
    got = {r["url"]: r["depth"] for r in crawl(site(spark), roots).collect()}
    assert got == DEPTHS
    reached = reach(L.edges(site(spark), F.lit(S)).select("src", "dst"), roots)
    assert {r["url"]: r["depth"] for r in reached.collect()} == DEPTHS
    assert crawl(site(spark), roots, max_depth=1).agg(F.max("depth")).first()[0] == 1


def test_crawl_requests(spark):
    asked = spark.createDataFrame([(S, 1), (S, 2), (f"{S}/fr/x", 2)], "root string, author_id long")
    got = crawl_requests(site(spark), asked)
    assert got.filter("author_id = 1").count() == len(DEPTHS)
    assert got.count() == 2 * len(DEPTHS) + 1  # the link on /fr/x does not hold that root


def test_frontier_and_seen(spark):
    reached = spark.createDataFrame([(u,) for u in DEPTHS], "dst string")
    missing = {r[0] for r in L.frontier(reached, site(spark)).collect()}
    assert missing == {u for u, d in DEPTHS.items() if d == 2} - {f"{S}/c?x=1&y=2"}
    union = L.seen_union(site(spark), reached.select(F.col("dst").alias("url")))
    assert union.count() == len(set(DEPTHS) | {u for u, _ in SITE})


def test_reach_with_cycles_and_hub(spark):
    """A hub holds most edges; every node once, at its smallest depth, whatever the partitions."""
    pairs = [("hub", f"n{i}") for i in range(500)] + [(f"n{i}", f"n{i // 2}") for i in range(500)]
    pairs += [("root", "n7"), ("n7", "hub"), ("hub", "root"), ("hub", "hub")]
    near = {}
    level, depth = {"root"}, 0
    while level:
        near.update({u: depth for u in level})
        depth += 1
        level = {d for s, d in pairs if s in level} - set(near)
    roots = spark.createDataFrame([("root",)], "root string")
    for parts in (1, 7):
        edges = spark.createDataFrame(pairs, "src string, dst string").repartition(parts)
        assert {r["url"]: r["depth"] for r in reach(edges, roots).collect()} == near


def test_status(spark):
    rows = spark.createDataFrame([("a", 404), ("b", 500), ("c", None), ("d", 200)], "url string, status int")
    assert {r["url"] for r in usable_pages(rows).collect()} == {"b", "c", "d"}
    assert {r["url"] for r in usable_pages(rows, (404, 500)).collect()} == {"c", "d"}


def test_latest_document_wins(spark, tmp_path):
    rows = spark.createDataFrame(
        [(S, f"<p>v{i}", i) for i in range(300)] + [(f"{S}/x", "<p>x", 1)], "url string, html string, seq int"
    )
    docs = D.page_documents(rows, F.lit(S), "seq")
    D.write_documents(docs, str(tmp_path / "docs"), [F.col("seq")])
    stored = D.read_documents(spark, str(tmp_path / "docs"))
    assert {(r["index_name"], r["url"], r["content"]) for r in stored.collect()} == {
        ("httpssite.test", S, "v299"), ("httpssite.test", f"{S}/x", "x"),
    }
    plan = D.latest(rows, ["url"], [F.col("seq")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("WindowGroupLimit") >= 2

"""Seen filters, tables in parts, repeated keys, equal seqs, cursors, quoted markup."""

import os
import time

import pytest
from pyspark.sql import functions as F

from linkloom.functions.html import hrefs, html_text
from linkloom.operators import links as L
from linkloom.operators import membership as M
from linkloom.operators import search as S
from linkloom.operators.schema import Model, int_field, string_field
from linkloom.sources.parts import PartTable
from linkloom.sources.snapshots import SnapshotTable
from linkloom.streaming.stores import PageIndexLog


@pytest.mark.parametrize("bits", [64, 1 << 10, 1 << 16])
def test_unseen_is_exact_at_every_size(spark, bits):
    seen = spark.createDataFrame([(f"u{k}",) for k in range(0, 900, 3)] + [(None,)], "url string")
    links = spark.createDataFrame([(f"u{k}",) for k in range(600)] + [("u1",), (None,)], "url string")
    expected = {f"u{k}" for k in range(600) if k % 3} | {None}
    found = [r.url for r in L.new_links_filtered(links, seen, bits).collect()]
    assert set(found) == expected and len(found) == len(expected)
    words = M.seen_filter(seen, "url", bits)
    assert words.count() <= bits // 64
    maybe = M.with_maybe(links.filter("url is not null"), words, "url", bits).filter("maybe").count()
    if bits == 1 << 16:
        assert maybe < 240  # 200 were seen; few others look like it
    assert L.new_links_filtered(links, seen.limit(0), bits).count() == 601 and L.new_links_filtered(links.limit(0), seen, bits).count() == 0


def test_the_filter_is_put_together_before_the_shuffle(spark):
    plan = M.seen_filter(spark.range(1000).select(F.col("id").cast("string").alias("url")), "url")._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan
    with pytest.raises(ValueError):
        M.seen_filter(spark.range(1), "id", 100)


def model():
    return Model("Account", [int_field("id"), string_field("name", required=False)])


def test_a_save_writes_the_parts_of_its_keys_only(spark, tmp_path):
    path = str(tmp_path / "t")
    store = PartTable(spark, path, model(), ["id"], parts=50)
    assert store.read().count() == 0
    store.save(spark.createDataFrame([(k, f"n{k}") for k in range(2000)], "id long, name string"))

    def files():
        return {os.path.join(at, n): os.path.getmtime(os.path.join(at, n)) for at, _, names in os.walk(path) for n in names if n.endswith(".parquet")}

    before = files()
    updates = spark.createDataFrame([(3, "a", 1), (3, "b", 2), (5000, "new", 1), (7, None, 1)], "id long, name string, at int")
    store.save(updates, [F.col("at").desc()])
    after = files()
    touched = {os.path.dirname(k) for k in set(before) ^ set(after)}
    assert 0 < len(touched) <= 3 and all(after[k] == before[k] for k in before if os.path.dirname(k) not in touched)
    expected = {k: f"n{k}" for k in range(2000)} | {3: "b", 5000: "new", 7: None}
    rows = store.read().collect()
    assert {r.id: r.name for r in rows} == expected and len(rows) == len(expected)
    again = PartTable(spark, path, model(), ["id"])
    assert again.parts == 50
    with pytest.raises(ValueError):
        PartTable(spark, path, model(), ["id"], parts=9)
    lone = again._placed(spark.createDataFrame([(5000, "")], "id long, name string")).first()["part"]
    keys = again._stored().filter(F.col("part") == lone).select("id")
    gone = {r.id for r in keys.collect()}
    again.delete_keys(keys.unionByName(spark.createDataFrame([(3,), (99999,)], "id long")))
    assert {r.id for r in again.read().collect()} == set(expected) - gone - {3}


def test_a_save_takes_the_last_of_a_repeated_key(spark, tmp_path):
    store = SnapshotTable(spark, str(tmp_path / "t"), model())
    rows = spark.createDataFrame([(1, "first"), (2, "x"), (1, "second")], "id long, name string").coalesce(1)
    store.save(rows)
    assert sorted((r.id, r.name) for r in store.read().collect()) == [(1, "second"), (2, "x")]
    parts = PartTable(spark, str(tmp_path / "p"), model(), ["id"], parts=4)
    parts.save(rows)
    assert sorted((r.id, r.name) for r in parts.read().collect()) == [(1, "second"), (2, "x")]


def test_of_equal_seqs_the_later_batch_counts(spark, tmp_path):
    log = PageIndexLog(spark, str(tmp_path / "log"))
    handle = log.handler(lambda: F.lit("i"))
    for number in (2, 9, 10):
        handle(spark.createDataFrame([("u", f"<p>page{number}", 5)], "url string, html string, seq long"), number)
    assert [r.content for r in log.documents().collect()] == ["page10"]
    fresh = log.rewrite(str(tmp_path / "fresh"))
    assert [r.content for r in fresh.documents().collect()] == ["page10"]
    fresh.handler(lambda: F.lit("i"))(spark.createDataFrame([("u", "<p>after", 5)], "url string, html string, seq long"), 0)
    assert [r.content for r in fresh.documents().collect()] == ["after"]


def test_pages_after_a_cursor(spark):
    docs = spark.createDataFrame([(f"u{k:02d}", "a " * (k % 3 + 1)) for k in range(30)], "url string, content string")
    held, totals = S.postings(docs), S.corpus_totals(S.document_lengths(docs))
    terms = S.term_statistics(held)
    schema = "query_id int, q string, limit int, after_score double, after_url string"
    whole = [(r.url, r.score) for r in sorted(S.search_after(spark.createDataFrame([(1, "a", 99, None, None)], schema), held, terms, totals).collect(), key=lambda r: r["rank"])]
    assert len(whole) == 30
    paged, cursor = [], (None, None)
    while True:
        page = sorted(S.search_after(spark.createDataFrame([(1, "a", 7, *cursor), (2, "none", 7, None, None)], schema), held, terms, totals).collect(), key=lambda r: r["rank"])
        paged += [(r.url, r.score) for r in page]
        if len(page) < 7:
            break
        cursor = (page[-1].score, page[-1].url)
    assert paged == whole


def test_a_reply_has_a_hundred_urls_at_most(spark):
    asked = spark.createDataFrame([(1, "a", 101, 0)], "query_id int, q string, limit int, offset int")
    with pytest.raises(ValueError):
        S.replies(asked, spark.createDataFrame([], "query_id int, rank long, url string"))


PAGES = [
    ('<p title="a > b">one</p><a title=\'x > y\' href="/h?a>b">two</a>', "one two", ["/h?a>b"]),
    ('<a title="href=/wrong" href=/right>t</a>', "t", ["/right"]),
    ("<a data-href='/no' class=x HREF = '/yes'>t</a><a name=q>u</a>", "t u", ["/yes"]),
    ('<a alt="it\'s > that" href="it\'s">t</a>', "t", ["it's"]),
    ('<p class="a"" id=b>stray</p><a "x" href="/s">t</a>', "stray t", ["/s"]),
    ('<script data-x="</script>">no</script><style media="a>b">no</style>yes', 'yes', []),
    ('<p title="never closed>lost <a href="/x">t</a>', "t", []),
    ("<a href=/bare>x</a><a/href=/slash>y</a><a href=>z</a>", "x y z", ["/bare", "/slash"]),
    ("a < b and c > d <3", "a < b and c > d <3", []),
]


@pytest.mark.parametrize("page, text, targets", PAGES)
def test_quoted_values_are_units(spark, page, text, targets):
    row = spark.createDataFrame([(page,)], "html string").select(html_text(F.col("html")).alias("t"), hrefs(F.col("html")).alias("h")).first()
    assert (row.t, row.h) == (text, targets)


@pytest.mark.parametrize("piece", ["<a href=", "<p title=\"x\" ", "<a b='", "=", "<a =", '<a href="x" ', "<!--", "<script ", "<head ", "<head><body ", "a=b "])
def test_odd_markup_takes_linear_time(spark, piece):
    def took(count):
        df = spark.range(1).select(F.concat(F.lit("<a "), F.repeat(F.lit(piece), count)).alias("html"))
        started = time.time()
        df.select(F.length(html_text(F.col("html"))), F.size(hrefs(F.col("html")))).collect()
        return time.time() - started

    took(1000)
    assert took(40_000) < 2 + 4 * took(10_000)


def test_hits_after_a_cursor_add_up_in_their_bucket(spark):
    docs = spark.createDataFrame([(f"u{k}", "a " * (k % 5) + "b") for k in range(40)] + [("none", None)], "url string, content string")
    schema = "query_id int, q string, limit int, after_score double, after_url string"
    asked = spark.createDataFrame([(1, "a b", 7, None, None), (2, "a", 3, None, None), (3, None, 3, None, None)], schema)
    held, totals = S.matching_postings(docs, asked.select("query_id", "q"))
    assert totals.first()[:] == (41, 120)
    found = S.search_after(asked, held, S.term_statistics(held), totals)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "url#" not in "".join(line for line in plan.split("\n") if "hashpartitioning" in line)
    plain = S.postings(docs)
    expected = S.search_after(asked, plain, S.term_statistics(plain), S.corpus_totals(S.document_lengths(docs)))
    assert sorted(found.collect()) == sorted(expected.collect()) and found.count() == 10

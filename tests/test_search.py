import pytest
import math
import random
from collections import Counter

from pyspark.sql import functions as F

from linkloom.operators import search as S
from linkloom.session import work_path
from linkloom.sources.index_store import IndexStore

DOCS = [("u1", "spark stream"), ("u2", "spark spark join"), ("u3", "join table")]


def docs(spark, rows=DOCS):
    return spark.createDataFrame(rows, "url string, content string")


def queries(spark, rows):
    return spark.createDataFrame(rows, "query_id long, q string, limit int, offset int")


def brute(rows, q):
    """BM25 by loops."""
    words = {u: [w for w in _split(t)] for u, t in rows}
    n, total = len(words), sum(map(len, words.values()))
    score = Counter()
    for term in _split(q):
        df = sum(term in w for w in words.values())
        for u, w in words.items():
            tf = w.count(term)
            if tf:
                idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
                score[u] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / (total / n)))
    return sorted(score.items(), key=lambda p: (-round(p[1], 7), p[0]))


def _split(text):
    out, word = [], ""
    for c in text.lower() + " ":
        if c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def _hits(df):
    return [(r["url"], round(r["score"], 6)) for r in df.collect()]


def test_small_queries(spark):
    d = docs(spark)
    assert _hits(S.search(d, "spark")) == [("u2", 0.598186), ("u1", 0.499176)]
    expected = [("u2", 1.019004), ("u1", 0.499176), ("u3", 0.499176)]
    assert _hits(S.search(d, "spark join")) == expected
    assert _hits(S.search(d, '"spark"')) == expected[:0] + [("u2", 0.598186), ("u1", 0.499176)]
    assert _hits(S.search(d, "none")) == [] and _hits(S.search(d, "?!")) == []
    assert [u for u, _ in _hits(S.search(d, "spark join", limit=1, offset=1))] == ["u1"]


def _corpus(seed, count):
    rng = random.Random(seed)
    common = ["the"] * 30 + ["of"] * 10 + [f"w{i}" for i in range(60)]
    rows = [(f"d{i:03d}", " ".join(rng.choices(common, k=rng.randint(1, 60)))) for i in range(count)]
    # copies make a third of the corpus, and some documents are empty
    rows += [(f"copy{i:03d}", rows[0][1]) for i in range(count // 2)] + [("empty1", ""), ("empty2", " ,; ")]
    return rows


def test_many_queries_match_brute_force(spark):
    rows = _corpus(1, 80)
    asked = [(1, "the w1 w2", 10, 0), (2, "w3 the w3", 5, 2), (3, "nothing", 10, 0), (4, "", 10, 0),
             (5, "W1, the; w2", 200, 0), (6, "of w9", 3, 118), (7, "the w1 w2", 4, 1)]
    got = S.search_documents(docs(spark, rows), queries(spark, asked)).collect()
    for qid, q, limit, offset in asked:
        expected = brute(rows, q)[offset:offset + limit]
        mine = sorted((r["rank"], r["url"], r["score"]) for r in got if r["query_id"] == qid)
        assert [u for _, u, _ in mine] == [u for u, _ in expected], q
        assert [p for p, _, _ in mine] == list(range(1, len(expected) + 1))
        assert all(abs(a - b) < 1e-7 for (_, _, a), (_, b) in zip(mine, expected))


def test_deep_pages_are_numbered_without_one_task(spark):
    rows = _corpus(2, 60)
    asked = [(1, "the of", 1500, 0)]
    got = S.search_documents(docs(spark, rows), queries(spark, asked)).orderBy("rank").collect()
    assert [r["url"] for r in got] == [u for u, _ in brute(rows, "the of")]


def test_long_query_and_deep_page(spark, monkeypatch):
    rows = _corpus(6, 50)
    q = " ".join(f"w{i}" for i in range(40)) + " the the"
    assert [u for u, _ in _hits(S.search(docs(spark, rows), q, limit=9, offset=3))] == [
        u for u, _ in brute(rows, q)][3:12]
    monkeypatch.setattr(S, "TOP_ROWS", 5)
    assert [u for u, _ in _hits(S.search(docs(spark, rows), "the w1", limit=9, offset=3))] == [
        u for u, _ in brute(rows, "the w1")][3:12]


def test_many_words_take_the_other_way(spark, monkeypatch):
    rows = _corpus(3, 40)
    asked = [(1, "the w1", 10, 0), (2, "w5 of", 10, 0)]
    usual = sorted(map(tuple, S.search_documents(docs(spark, rows), queries(spark, asked)).collect()))
    monkeypatch.setattr(S, "FEW_WORDS", 1)
    monkeypatch.setattr(S, "FEW_TERMS", 1)
    other = sorted(map(tuple, S.search_documents(docs(spark, rows), queries(spark, asked)).collect()))
    assert usual == other and len(usual) == 20


def test_replies(spark):
    asked = queries(spark, [(1, "spark join", 2, 1), (2, "none", 10, 0)])
    out = S.replies(asked, S.search_documents(docs(spark), asked)).orderBy("query_id").collect()
    assert [r["urls"] for r in out] == [["u1", "u3"], []]
    assert out[0].asDict() | {"urls": None} == {
        "query_id": 1, "request": "spark join", "limit": 2, "offset": 1, "urls": None}


def test_stored_index(spark):
    rows = [("a", u, t) for u, t in _corpus(4, 50)] + [("b", u, t) for u, t in _corpus(5, 20)] + [("c", "e", "")]
    d = spark.createDataFrame(rows, "index_name string, url string, content string")
    path = work_path(spark, "store")
    store = IndexStore(spark, "test_store", path, buckets=4)
    store.build(d)
    asked = spark.createDataFrame(
        [(1, "a", "the w1", 7, 0), (2, "b", "the w1", 7, 0), (3, "c", "the", 5, 0)],
        "query_id long, index_name string, q string, limit int, offset int",
    )
    stored = sorted(map(tuple, store.search_many(asked).collect()))
    direct = sorted(map(tuple, S.search_documents(d, asked).collect()))
    assert stored == direct and len(stored) == 14
    for qid, name in ((1, "a"), (2, "b")):
        best = [u for u, _ in brute([(u, t) for i, u, t in rows if i == name], "the w1")][:7]
        assert [r[2] for r in stored if r[0] == qid] == best
    totals = {r["index_name"]: r["n"] for r in store.totals().collect()}
    assert totals["c"] == 1 and totals["a"] == 77
    # a scan of postings is cut down by index and word, and scores need no shuffle by document
    with pytest.raises(ValueError):
        IndexStore(spark, "test_store_wrong", path, buckets=8)
    with pytest.raises(ValueError):
        IndexStore(spark, "test_store", work_path(spark, "other"), buckets=4)  # the name stands for another index
    again = IndexStore(spark, "test_store_again", path)
    assert again.buckets == 4 and sorted(map(tuple, again.search_many(asked).collect())) == stored
    assert again.postings().count() == store.postings().count()
    scored = S.score(again.postings(), again.term_stats(), again.totals(),
                     S.query_terms(asked, ["query_id", "index_name"]), ["query_id", "index_name"], True)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    head = plan[: plan.index("Join")]
    assert "Exchange" not in head, head
    store.close()
    again.close()


def test_postings(spark):
    got = {(r["url"], r["term"]): (r["tf"], r["dl"]) for r in S.postings(docs(spark)).collect()}
    assert got == {("u1", "spark"): (1, 2), ("u1", "stream"): (1, 2), ("u2", "spark"): (2, 3),
                   ("u2", "join"): (1, 3), ("u3", "join"): (1, 2), ("u3", "table"): (1, 2)}
    assert S.term_statistics(S.postings(docs(spark))).filter("term = 'spark'").first()["df"] == 2
    assert S.corpus_totals(S.document_lengths(docs(spark))).first().asDict() == {"n": 3, "total": 7}
    assert S.document_lengths(docs(spark)).agg(F.sum("dl")).first()[0] == 7


def test_long_queries_follow_the_same_rule(spark):
    """Indexes and repeated urls make no difference between few words and many."""
    rows = [("a", "u", "w1 w2"), ("b", "u", "w1"), ("b", "v", "w1 w3 w3"), ("a", "x", "none")]
    d = spark.createDataFrame(rows, "index_name string, url string, content string")
    short = S.search(d, "w1").collect()
    long = S.search(d, " ".join(["w1", *(f"z{i}" for i in range(60))])).collect()
    assert [tuple(r) for r in short] == [tuple(r) for r in long] and len(short) == 3
    assert S.search(d, "w1", offset=-2).count() == 0


def test_postings_need_no_shuffle(spark):
    d = spark.createDataFrame([("u", "b a b"), ("v", ""), ("w", None)], "url string, content string")
    found = S.postings(d)
    assert sorted(map(tuple, found.collect())) == [("u", "a", 1, 3), ("u", "b", 2, 3)]
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert S.term_statistics(found)._jdf.queryExecution().executedPlan().toString().count("Exchange hash") == 1


def test_a_long_query_gives_the_rows_of_a_short_way(spark, monkeypatch):
    texts = [" ".join(f"w{(i * k) % 97}" for k in range(i % 40)) for i in range(60)] + ["", None]
    docs = spark.createDataFrame([(f"u{i % 55}", t) for i, t in enumerate(texts)], "url string, content string")
    q = " ".join(f"w{k % 97}" for k in range(120))
    joined = [tuple(r) for r in S.search(docs, q, 40, 3).collect()]
    monkeypatch.setattr(S, "FEW_NAMED", 10_000)
    assert [tuple(r) for r in S.search(docs, q, 40, 3).collect()] == joined and len(joined) == 40


def test_a_bucket_sends_its_best_hits_only(spark):
    docs = spark.createDataFrame([(f"u{i}", f"a b{i % 3} c") for i in range(200)], "url string, content string")
    asked = spark.createDataFrame([(1, "a b1", 5, 0), (2, "c", 3, 1)], "query_id int, q string, limit int, offset int")
    plan = S.search_documents(docs, asked)._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("partial_sum")]
    scored = above[above.rindex("WindowGroupLimit"):]
    assert "Partial" in scored and "Exchange" not in scored  # scores are summed and cut before the only shuffle of hits

"""The index of blocks and segments beside scores made one by one."""

import math
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from linkloom.operators import blocks as K
from linkloom.operators import search as S
from linkloom.sources.segments import SegmentIndex

DOCS = "index_name string, url string, content string"
ASKED = "query_id long, q string, limit int, offset int, index_name string"


def made(seed, count, index="a", words=40):
    draw = random.Random(seed)
    names = [f"w{k}" for k in range(words)]
    rows = []
    for k in range(count):
        text = " ".join(draw.choices(names, [1 / (i + 1) for i in range(words)], k=draw.choice([1, 3, 10, 60])))
        rows.append((index, f"u{k:04d}", text))
    return rows


def plain(live, queries):
    """Hits of every query over {(index, url): text}, score by score."""
    out = set()
    for key, q, limit, offset, index in queries:
        docs = {u: (t or "").split() for (i, u), t in live.items() if i == index}
        if not docs:
            continue
        avgdl = sum(map(len, docs.values())) / len(docs)
        scores = {}
        for term in set(q.split()):
            df = sum(term in words for words in docs.values())
            weight = q.split().count(term) * math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
            for url, words in docs.items():
                if tf := words.count(term):
                    part = weight * (tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / avgdl)))
                    scores[url] = scores.get(url, 0) + math.floor(part * 1e9 + 0.5)
        ranked = sorted((-s, u) for u, s in scores.items())
        out |= {(key, n + 1, u, round(-s / 1e9, 6)) for n, (s, u) in enumerate(ranked[offset:offset + limit])}
    return out


def hits(df):
    return {(r.query_id, r["rank"], r.url, round(r.score, 6)) for r in df.collect()}


QUERIES = [(1, "w0 w3 w39", 10, 0, "a"), (2, "w5", 5, 3, "a"), (3, "w0 w0 w1", 1000, 0, "b"), (4, "none", 5, 0, "a"),
           (5, "w3 w39 w0", 3, 1, "a"), (6, "w2", 0, 0, "a"), (7, "w2", 3, -1, "a"), (8, "w2", 4, 0, "c"), (9, "", 4, 0, "a")]


@pytest.fixture
def index(spark, tmp_path):
    index = SegmentIndex(spark, "t_" + os.path.basename(tmp_path).replace("-", "_"), str(tmp_path / "index"), buckets=2)
    yield index
    index.close()


def test_upserts_and_merge(spark, index):
    first = made(1, 300) + made(2, 80, "b") + [("a", "empty", ""), ("a", "null", None), ("a", None, "w0"), (None, "x", "w0")]
    second = [(i, u, t + " w39 w39") for i, u, t in made(3, 300)[::2]] + [("a", "n1", "w0 w1"), ("b", "u0003", "w9")]
    third = [("a", "u0000", "w3"), ("a", "empty", "w3 w3"), ("c", "only", "w2")]
    live = {}
    asked = spark.createDataFrame(QUERIES, ASKED)
    for rows in (first, second, third):
        index.upsert(spark.createDataFrame(rows, DOCS))
        live.update({(i, u): t for i, u, t in rows if i and u})
        assert hits(index.search_many(asked)) == plain(live, QUERIES)
        found = {(r.index_name, r.term): (r.df, r.occurrences) for r in index.term_stats().collect()}
        counts = {}
        for (i, _), t in live.items():
            for w in set((t or "").split()):
                df, n = counts.get((i, w), (0, 0))
                counts[i, w] = (df + 1, n + t.split().count(w))
        assert found == counts
    assert index.segments() == [0, 1, 2]
    assert {(r.index_name, r.url) for r in index.documents().collect()} == set(live)
    index.merge()
    assert index.segments() == [3]
    assert hits(index.search_many(asked)) == plain(live, QUERIES)
    index.upsert(spark.createDataFrame([("a", "u0000", "w7 w7 w7")], DOCS))
    live["a", "u0000"] = "w7 w7 w7"
    assert hits(index.search_many(asked)) == plain(live, QUERIES)
    again = SegmentIndex(spark, index.name + "_again", index.path)
    assert again.buckets == 2 and hits(again.search_many(asked)) == plain(live, QUERIES)
    again.close()
    with pytest.raises(ValueError):
        SegmentIndex(spark, index.name + "_other", index.path, buckets=3)


def test_only_the_new_segment_is_written(spark, index):
    index.upsert(spark.createDataFrame(made(4, 200), DOCS))

    def files():
        return {os.path.join(at, n): os.path.getmtime(os.path.join(at, n)) for at, _, names in os.walk(index.path) for n in names if "_SUCCESS" not in n}

    before = files()
    index.upsert(spark.createDataFrame([("a", "u0001", "w1 w2"), ("a", "new", "w1")], DOCS))
    after = files()
    assert {k: after[k] for k in before} == before
    added = [k for k in after if k not in before and "/blocks/" in k and k.endswith(".parquet")]
    assert added and all("/segment=1/" in k for k in added)
    assert sum(os.path.getsize(k) for k in added) < sum(os.path.getsize(k) for k in before if "/blocks/" in k and k.endswith(".parquet"))


def test_repeated_urls_and_failed_writes(spark, index, monkeypatch):
    rows = spark.createDataFrame([("a", "u", "w1", 1), ("a", "u", "w2", 2), ("a", "v", "w1", 1)], DOCS + ", seq int")
    index.upsert(rows, ["seq"])
    asked = spark.createDataFrame([(1, "w1 w2", 9, 0, "a")], ASKED)
    live = {("a", "u"): "w2", ("a", "v"): "w1"}
    assert hits(index.search_many(asked)) == plain(live, [(1, "w1 w2", 9, 0, "a")])
    monkeypatch.setattr(K, "dead_blocks", lambda *a: 1 / 0)  # the blocks are written, the marks are not
    with pytest.raises(ZeroDivisionError):
        index.upsert(spark.createDataFrame([("a", "u", "w1 w1")], DOCS))
    assert index.segments() == [0] and hits(index.search_many(asked)) == plain(live, [(1, "w1 w2", 9, 0, "a")])
    monkeypatch.undo()
    assert index.upsert(spark.createDataFrame([("a", "u", "w1 w1")], DOCS)) == 2
    live["a", "u"] = "w1 w1"
    assert hits(index.search_many(asked)) == plain(live, [(1, "w1 w2", 9, 0, "a")])


def test_an_empty_index(spark, index):
    asked = spark.createDataFrame([(1, "w1", 9, 0, "a")], ASKED)
    index.upsert(spark.createDataFrame([], DOCS))
    assert index.search_many(asked).count() == 0 and index.totals().count() == 0
    assert index.search_many(asked.limit(0)).count() == 0


def test_many_words_take_the_join(spark, index, monkeypatch):
    rows = made(5, 120)
    index.upsert(spark.createDataFrame(rows, DOCS))
    asked = spark.createDataFrame(QUERIES, ASKED)
    live = {(i, u): t for i, u, t in rows}
    few = hits(index.search_many(asked))
    monkeypatch.setattr(S, "FEW_TERMS", 0)
    assert hits(index.search_many(asked)) == few == plain(live, QUERIES)


def test_blocks_are_skipped_and_few_rows_leave_a_shard(spark, index):
    rows = [("a", f"u{k:04d}", "rare " * (8 if k < 3 else 1) + "common " * (k % 7 + 1) + "x " * (k % 50)) for k in range(1500)]
    index.upsert(spark.createDataFrame(rows, DOCS))
    query = [(1, "rare common", 3, 0, "a")]
    watch = Observation()
    found = hits(index.search_many(spark.createDataFrame(query, ASKED), watch))
    assert found == plain({(i, u): " ".join(t.split()) for i, u, t in rows}, query)
    assert watch.get["opened"] < watch.get["blocks"] / 2
    plan = index._hits(index_rows(index, spark, query), "bigint")._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange hashpartitioning" not in plan  # the stored blocks do not move


def index_rows(index, spark, query):
    asked = S.asked_queries(spark.createDataFrame(query, ASKED), ["index_name"])
    keys = ["index_name", "scored_as"]
    weighted = S.weighted_terms(index.term_stats(), index.totals(), asked.terms, keys)
    return weighted.join(asked.unique.select(*keys, "deepest"), keys).collect()


def test_a_shard_sends_what_is_asked_for_only():
    schema = pa.schema([("term", pa.string()), ("segment", pa.int32()), ("range", pa.int32()), ("of_segment", pa.int32()), ("max_tf", pa.int64()),
                        ("min_dl", pa.int64()), ("docs", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64())), ("dls", pa.list_(pa.int64())),
                        ("urls", pa.list_(pa.string()))])
    rows = []
    for r in range(6):
        docs = list(range(K.RANGE))
        rows.append({"term": K.DOCUMENTS, "segment": 0, "range": r, "docs": docs, "urls": [f"{r}-{d:02d}" for d in docs], "dls": [5] * K.RANGE, "tfs": [0] * K.RANGE})
        rows.append({"term": "t", "segment": 0, "range": r, "max_tf": 6 - r, "min_dl": 5, "docs": docs, "tfs": [6 - r] * K.RANGE, "dls": [5] * K.RANGE})
    rows.append({"term": K.DEAD, "segment": 1, "of_segment": 0, "range": 0, "docs": list(range(1, K.RANGE))})
    shard = K.Shard(pa.Table.from_pylist(rows, schema))
    found, blocks, opened = shard.best(K.Query("a", 1, [("t", 1.0), ("absent", 9.0)], 5.0, 4))
    assert [u for u, _ in found] == ["0-00", "1-00", "1-01", "1-02"]  # equal scores by url, replaced ones left out
    assert blocks == 6 and opened < 6
    assert shard.best(K.Query("a", 1, [("absent", 1.0)], 5.0, 4)) == ([], 0, 0)
    assert np.all(np.diff([-s for _, s in found]) >= 0)


def test_a_query_opens_an_index_with_buckets_for_its_rows(spark):
    from linkloom.plans.search import _opened
    for rows, buckets in ((10, 8), (160_001, 9), (1_000_000, 50)):
        index = _opened(spark, spark.range(rows))
        assert index.buckets == buckets
        index.close()

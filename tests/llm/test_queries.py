"""The registered queries, beside their SQL where they have some, and the pipeline against brute force."""

import glob
import os
import re
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools"), os.path.dirname(os.path.abspath(__file__))]

import corpus_pipeline  # noqa: E402
from check import rows_of  # noqa: E402
from test_decontaminate import plain as plain_hits  # noqa: E402
from test_packing import check as check_packing  # noqa: E402
from test_pii import plain_spans  # noqa: E402
from test_simhash import plain_components, plain_fingerprint  # noqa: E402

from linkloom.llm import pii  # noqa: E402
from linkloom.llm.queries import ORACLES, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, sf, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    df = QUERIES[name](spark, sf)
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, result.fetchall())


def test_all_are_registered():
    assert {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES} == set(range(1, 14))


@pytest.fixture(scope="module")
def stages(spark, sf):
    """The result of every stage over the smallest documents and a few odd rows."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("lang_pred", F.lit("x")).withColumn("row", F.lit(1))
    odd = spark.createDataFrame(
        [(1000, None, "en"), (1001, "", "en"), (1002, "12 34 !!", None), (1003, "call +1 (743) 555-3824 or write a.b@c.org about the thing that was on the table", "en")],
        "doc_id long, text string, lang string")
    docs = docs.unionByName(odd, allowMissingColumns=True)
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(stage(spark, found[-1], sf).cache())
    return found


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_their_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[1:5])
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"} == set(stages[5].columns)


def test_language_keeps_all_but_wordless_documents(stages):
    assert ids(stages[1]) == [i for i in ids(stages[0]) if i not in (1000, 1001, 1002)]


def test_one_of_each_group_stays(stages):
    prints = {r.doc_id: plain_fingerprint(r.text) for r in stages[1].collect()}
    assert ids(stages[2]) == sorted(set(plain_components(prints).values()))


def test_contaminated_documents_go(spark, sf, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = [r.doc_id for r in stages[2].collect() if not plain_hits(r.text, items)[4]]
    assert ids(stages[3]) == sorted(clean) and len(clean) < stages[2].count()


def test_personal_data_is_replaced(stages):
    before, after = ({r.doc_id: r for r in df.collect()} for df in stages[3:5])
    assert before.keys() == after.keys()
    for k, r in after.items():
        assert plain_spans(r.text) == []
        if not plain_spans(before[k].text):
            assert r.text == before[k].text
        assert r.n_chars == len(r.text)
    assert after[1003].text == "call <PHONE> or write <EMAIL> about the thing that was on the table"
    assert pii.masked("x 1.2.3.4", [("ip", 2, 9)]) == "x <IP>"


def test_packed_ids_are_the_documents(stages):
    check_packing({r.doc_id: r.text for r in stages[4].collect()}, stages[5].collect())


def test_run_is_the_stages(spark, sf):
    found = corpus_pipeline.run(spark, sf)
    assert found.count() > 0 and found.agg(F.sum("length")).first()[0] == sum(
        r.doc_tokens for r in found.select("doc_id", "doc_tokens").distinct().collect())


def test_empty_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0


def test_rules_of_the_folder():
    for path in glob.glob(f"{ROOT}/linkloom/llm/*.py"):
        source = open(path).read()
        assert "localCheckpoint" not in source and "crossJoin" not in source and ".sample(" not in source, path

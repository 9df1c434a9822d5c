import functools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from linkloom.llm import packing

CAPACITY = packing.CAPACITY


@functools.cache
def tokenizer():
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return made


@functools.cache
def both():
    return packing.Tokens(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def padding(sequences):
    return sum(0 if n & (n - 1) == 0 else CAPACITY - n for n in sequences.values())


def check(texts, rows):
    """Exact round trip: pieces give back each document's ids, sequences are gapless and within capacity."""
    plain = tokenizer()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == texts.keys()
    for doc, own in by_doc.items():
        expected = [*plain.encode(texts[doc] or "", add_special_tokens=False).ids, 1]
        own.sort(key=lambda r: r.start)
        at = 0
        for r in own:
            assert r.start == at and r.doc_tokens == len(expected)
            ids = expected[at:at + r.length]
            assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
            assert r.ids == ids
            at += r.length
        assert at == len(expected)
    lengths = {}
    for number, own in by_sequence.items():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= CAPACITY
        lengths[number] = at
    return lengths


def test_documents_round_trip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = packing.pack(docs, carry={"doc_id": F.col("doc_id")}, with_ids=True).collect()
    lengths = check(texts, rows)
    assert padding(lengths) < 0.01 * sum(lengths.values())


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "<|endoftext|> x"), (4, "a b " * 40000), (5, "同じ ͸ text"), (None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("x")).withColumn("length", F.lit("y")).repartition(3)
    check({k: t for k, t in rows}, packing.pack(docs, carry={"doc_id": F.col("doc_id")}, with_ids=True).collect())
    assert packing.pack(docs.limit(0)).count() == 0
    twice = docs.union(docs)
    assert packing.pack(twice).agg(F.sum("length")).first()[0] == 2 * packing.pack(docs).agg(F.sum("length")).first()[0]


def test_a_class_fills_its_bins():
    for length in range(1, 3 * CAPACITY):
        made = packing.pieces(length)
        assert sum(n for n, _ in made) == length
        assert all(0 < n * k <= CAPACITY for n, k in made)
    bins = packing.Bins()
    for _ in range(7):
        for n, k in packing.pieces(1500):
            bins.add(("d", 0, np.zeros(n, "<u4")), k)
    for b in bins.take():
        assert len({len(ids) for _, _, ids in b}) == 1 and CAPACITY - sum(len(ids) for _, _, ids in b) < len(b)
    bins.finish()
    sizes = [sum(len(ids) for _, _, ids in b) for b in bins.take()]
    assert all(n == CAPACITY or n & (n - 1) == 0 for n in sizes)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60))
def test_both_libraries_give_the_same_ids(text):
    assert both().ids(text) == tokenizer().encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8", max_codepoint=0x24F), max_size=60))
def test_latin_texts_give_the_same_ids(text):
    assert both().ids(text) == tokenizer().encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("folder", ["sf0.01"])
def test_given_texts_give_the_same_ids(spark, folder):
    texts = [r.text for r in spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").select("text").collect()]
    tokens = both()
    assert [tokens.ids(t) for t in texts] == [e.ids for e in tokenizer().encode_batch(texts, add_special_tokens=False)]

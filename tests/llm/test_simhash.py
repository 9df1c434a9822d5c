import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from linkloom.llm import simhash


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if sum(h >> k & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints, radius=4):
    keys = list(prints)
    parent = {k: k for k in keys}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if bin(prints[a] ^ prints[b]).count("1") <= radius:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {k: root(k) for k in keys}


def test_documents_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {r.id: r for r in simhash.near_duplicates(docs).collect()}
    prints = {k: plain_fingerprint(t) for k, t in texts.items()}
    assert {k: r.fingerprint % 2 ** 64 for k, r in found.items()} == prints
    assert {k: r.component for k, r in found.items()} == plain_components(prints)


@pytest.mark.parametrize("bucket_rows", [8, 4096])
def test_links_of_made_fingerprints(spark, bucket_rows):
    draw = random.Random(3)
    prints = {0: 0}
    for group in range(12):
        centre = draw.getrandbits(64)
        for _ in range(draw.choice([1, 2, 40])):
            value = centre
            for bit in draw.sample(range(64), draw.randint(0, 4)):
                value ^= 1 << bit
            prints[len(prints)] = value
        chain = draw.getrandbits(64)  # a chain whose ends are far apart
        for k in range(0, 24, 4):
            chain ^= 0b1111 << k
            prints[len(prints)] = chain
    rows = spark.createDataFrame([(v - 2 ** 64 if v >> 63 else v,) for v in set(prints.values())], "fingerprint long")
    roots = simhash.components(simhash.near_links(rows, bucket_rows=bucket_rows))
    roots = {r.vertex % 2 ** 64: r.root % 2 ** 64 for r in roots.collect()}
    expected = plain_components(prints)
    ours = {}
    for k, v in prints.items():
        ours.setdefault(roots.get(v, v), []).append(k)
    plain = {}
    for k, r in expected.items():
        plain.setdefault(r, []).append(k)
    assert sorted(ours.values()) == sorted(plain.values())


def test_bit_sliced_distances():
    draw = np.random.default_rng(5)
    base = draw.integers(0, 2 ** 63, 1, np.uint64)
    members = np.array([base[0] ^ np.uint64(sum(1 << int(b) for b in draw.choice(64, draw.integers(0, 9), False))) for _ in range(150)], np.uint64)
    planes = simhash.bit_planes(members)
    valid = np.array([2 ** 64 - 1, 2 ** 64 - 1, 2 ** 22 - 1], np.uint64)
    queries = np.repeat(members, 3)
    for radius in (0, 1, 4, 5, 7):
        word = np.tile(np.arange(3), 150)
        live, near = simhash.within(planes, valid[word], queries, word, radius)
        got = {(int(i) // 3, 64 * (int(i) % 3) + k) for i, m in zip(live, near) for k in range(64) if int(m) >> k & 1}
        plain = {(i, j) for i, a in enumerate(members) for j, b in enumerate(members) if int(a ^ b).bit_count() <= radius}
        assert got == plain


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a b c d e"), (5, "A B C D E"), (5, "a b c d e"), (7, "x " * 50000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component", F.lit("x")).withColumn("row", F.lit(0))
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == 7
    by = {}
    for r in found:
        by.setdefault(r.component, []).append(r.id)
    assert by[1] == [1, 2, 3] or sorted(by[1]) == [1, 2, 3]
    assert sorted(by[5], key=str) == [5, 5, None]
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == 3
    empty = docs.limit(0)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).count() == 0

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import lm
from linkloom.llm.queries import QUERIES


def plain_tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    return [w for w in lowered.split(" ") if w] + [""]


def plain_base(rows):
    counts = {}
    for i, text in rows:
        if zlib.crc32(str(i).encode()) % 10:
            for w in plain_tokens(text):
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    out = {}
    for i, text in rows:
        ts = plain_tokens(text)
        out[i] = (zlib.crc32(str(i).encode()) % 10 == 0, len(ts), sum(w in counts for w in ts), n,
                  sum(math.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in ts))
    return out


@pytest.mark.parametrize("head", [lm.HEAD, 50])
def test_documents_against_brute_force(spark, sf, head, monkeypatch):
    monkeypatch.setattr(lm.fit, "__defaults__", ("text", head))
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = plain_base(rows)
    found = QUERIES["op6_lm"](spark, sf).collect()
    assert len(found) == len(expected)
    for r in found:
        held_out, n, known, total, base = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0


def test_the_model_beats_counts_on_held_out_texts(spark):
    found = QUERIES["op6_lm"](spark, "/root/testdata/sf0.1").where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert found.s > found.b


def test_scores_are_normalised():
    p = lm.Parameters.new(np.full(lm.CLASSES, 1 / lm.CLASSES))
    p.bias += np.random.default_rng(0).normal(0, 1, lm.CLASSES).astype(np.float32)
    sums = lm.normalisers(p)
    for a, b in ((0, 0), (3, 500), (511, 7)):
        scores = (p.context[0][a] + p.context[1][b]) @ p.target.T + p.bias
        assert np.exp(scores - sums[a, b]).sum() == pytest.approx(1, abs=1e-4)


def test_noise_contrastive_estimation_learns_a_chain():
    draw = np.random.default_rng(4)
    share = np.full(lm.CLASSES, 1e-6)
    share[:8] = 1 / 8
    p = lm.Parameters.new(share / share.sum())
    trainer = lm.Trainer(p, share / share.sum())
    last = draw.integers(0, 8, 4096)
    target = (last * 3 + 1) % 8
    before = draw.integers(0, 8, 4096)
    losses = [trainer.step(before[k:k + 512], last[k:k + 512], target[k:k + 512]) for _ in range(30) for k in range(0, 4096, 512)]
    assert losses[-1] < 0.7 * losses[0]
    logs = (p.context[0][before] + p.context[1][last]) @ p.target.T + p.bias
    assert (logs[:, :8].argmax(1) == target).mean() > 0.95


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (4, "A  b\n" * 30000), (5, "never seen")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("x")).withColumn("n", F.lit(1))
    model, counts = lm.fit(docs.where("doc_id <> 5"), head=2)
    found = sorted((r.id or 0, r.n_tokens, r.n_known) for r in lm.score(docs, model, counts, carry={"id": F.col("doc_id")}).collect())
    assert found == [(0, 3, 3), (1, 1, 1), (2, 1, 1), (2, 1, 1), (4, 60001, 60001), (5, 3, 1)]
    none, counts = lm.fit(docs.limit(0))
    assert {r.n_known for r in lm.score(docs, none, counts).collect()} == {0}
    assert lm.score(docs.limit(0), none, counts).count() == 0

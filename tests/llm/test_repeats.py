import hashlib
import random

import pytest
from pyspark.sql import functions as F

from linkloom.llm import repeats
from linkloom.llm.repeats import WINDOW


def plain(rows):
    first, out = {}, []
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        for k in range(len(words) - WINDOW + 1):
            if i is not None:
                key = tuple(words[k:k + WINDOW])
                first[key] = min(first.get(key, i), i)
    for i, words in split:
        gone = set()
        for k in range(len(words) - WINDOW + 1):
            if i is not None and first[tuple(words[k:k + WINDOW])] < i:
                gone.update(range(k, k + WINDOW))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out.append((i, len(words), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def made(seed):
    draw = random.Random(seed)
    passages = [[draw.choice("abcdefgh") + str(draw.randint(0, 30)) for _ in range(n)] for n in (12, 13, 14, 30, 60, 200)]
    rows = []
    for k in range(60):
        words = []
        for _ in range(draw.randint(0, 6)):
            words += draw.choice(passages) if draw.random() < 0.5 else [str(draw.random()) for _ in range(draw.randint(1, 20))]
        rows.append((draw.randint(0, 40), draw.choice([" ", "\n", " \t "]).join(words)))
    rows += [(None, " ".join(passages[4])), (3, " ".join(passages[5])), (3, " ".join(passages[5])), (50, None), (51, ""),
             (52, "x " * 400), (53, "x " * 30), (54, "A " + "x " * 13 + "É"), (55, " ".join(passages[0]))]
    return rows + [(k, " ".join(passages[3])) for k in range(60, 90)]


@pytest.mark.parametrize("seed,common,shard_rows", [(1, 1024, 2000), (2, 4, 2000), (3, 3, 2)])
def test_made_documents_against_brute_force(spark, seed, common, shard_rows):
    rows = made(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("hash", F.lit("x")).withColumn("anchors", F.lit(1)).repartition(5)
    found = repeats.keep_first(docs, common=common, shard_rows=shard_rows).collect()
    assert sorted(((r.id, r.n_words, r.n_removed, r.kept_sha256) for r in found), key=str) == plain(rows)


def test_no_shard_takes_a_common_anchor(spark, monkeypatch):
    passage = " ".join(f"w{k}" for k in range(20))
    rows = [(k, f"{' '.join(f'a{k}x{j}' for j in range(9))} {passage} {' '.join(f'b{k}x{j}' for j in range(9))}") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    most, locate = [], repeats._locate

    def watched(stretches, shard_rows):
        most.append(stretches.groupBy("anchor").count().agg(F.max("count")).first()[0] or 0)
        return locate(stretches, shard_rows)

    monkeypatch.setattr(repeats, "_locate", watched)
    found = repeats.keep_first(docs, common=8).collect()
    assert sorted(((r.id, r.n_words, r.n_removed, r.kept_sha256) for r in found), key=str) == plain(rows)
    assert max(most) <= 8


def test_pieces_of_long_texts(monkeypatch):
    text = " ".join(str(k % 97) + "w" * (k % 5) for k in range(1000)).encode()

    def anchors(texts):
        return sorted((t, a, own) for page in repeats.pages(texts) for t, a, own in zip(page.text.tolist(), page.at.tolist(), page.own.tolist()))

    whole = anchors([b"", text, b"few words", text[500:]])
    assert len(whole) > 988 and [x[2] for x in whole if x[0] == 1] == [x[2] for x in anchors([text])]
    monkeypatch.setattr(repeats, "PIECE", 7)
    assert anchors([b"", text, b"few words", text[500:]]) == whole


def test_kept_text_and_empty_tables(spark):
    passage = " ".join(f"w{k}" for k in range(15))
    docs = spark.createDataFrame([(1, f"a {passage}"), (2, f"b {passage} c")], "doc_id long, text string")
    kept = {r.id: r.kept for r in repeats.keep_first(docs, with_text=True).collect()}
    assert kept == {1: f"a {passage}", 2: "b c"}
    assert repeats.keep_first(docs.limit(0)).count() == 0

import hashlib
import random
import re

from pyspark.sql import functions as F

from linkloom.llm import decontaminate

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items):
    words, hit, found = plain_words(text), set(), set()
    for item, item_text in items:
        test = plain_words(item_text)
        n = min(10, len(test))
        for i in range(len(test) - n + 1 if n else 0):
            for j in range(len(words) - n + 1):
                if words[j:j + n] == test[i:i + n]:
                    hit.update(range(j, j + n))
                    found.add(item)
    listed = sorted(str(x) for x in found if x is not None)
    return len(words), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)


def compare(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_hit", F.lit("x")).withColumn("flags", F.lit(1))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("items", F.lit(1))
    rows = decontaminate.search(d, b, carry={"doc_id": F.col("doc_id")}, **options).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows), key=str)
    assert got == sorted(((k, *plain(t, items)) for k, t in docs), key=str)
    return got


def test_made_texts_against_brute_force(spark):
    draw = random.Random(1)
    few = ["a", "b", "Ä", "7"]
    items = [(k, " ".join(draw.choice(few) for _ in range(draw.choice([0, 1, 3, 9, 10, 11, 25])))) for k in range(20)]
    items = [i for i in items if len(i[1].split()) != 1] + [(100, "rare"), (100, "b.B,b"), (None, "7 7 7"), (101, None), (9, "")]
    docs = [(k, draw.choice([" ", ".\n", "-"]).join(draw.choice(few + ["zz"]) for _ in range(draw.choice([0, 5, 40, 200])))) for k in range(60)]
    docs += [(60, None), (61, ""), (62, "RARE!"), (62, "RARE!"), (None, "rare " * 3000)]
    found = compare(spark, docs, items)
    assert any(r[5] for r in found) and not all(r[5] for r in found)


def test_several_shards_give_the_same(spark, monkeypatch):
    items = [(k, f"one two {k} four five six seven eight nine ten eleven") for k in range(9)]
    docs = [(k, f"x one two {k % 12} four five six seven eight nine ten eleven y one two {k % 7} four five six seven eight nine ten") for k in range(30)]
    one = compare(spark, docs, items)
    monkeypatch.setattr(decontaminate, "shards", lambda *a: [[(str(k), t.encode())] for k, t in items])
    assert compare(spark, docs, items) == one


def test_empty_tables(spark):
    assert compare(spark, [(1, "a b c")], [(1, None)])[0][2] == 0
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.search(d, b).count() == 0
    assert decontaminate.search(spark.createDataFrame([(1, "x")], d.schema), b).first().n_hit == 0

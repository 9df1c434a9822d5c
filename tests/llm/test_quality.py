"""Quality rules beside plain counts, and odd rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from linkloom.llm import quality

SPACES = " \t\n\x0b\x0c\r"


def plain(text):
    text = text or ""
    words = [w for w in re.split(f"[{SPACES}]+", text) if w]
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    repeated = {p for k, w in enumerate(windows) if windows.count(w) > 1 for p in range(k, k + 3)}
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), failed)


def made(seed):
    draw = random.Random(seed)
    texts = [None, "", " \n\t\x0b ", "one", "a b", "a b c", "a a a a", "a b c a b c", "é" * 40, "\x85 \xa0  x"]
    for _ in range(40):
        words = draw.choices(["the", "of", "naïve", "#tag", "x|y", "ÉTÉ", "longerword", "a", "漢字"], k=draw.randint(0, 120))
        texts.append("".join(w + draw.choice([" ", "\n", "\t", "\n\n", " \r\n"]) for w in words))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_against_brute_force(spark, seed):
    texts = made(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for name in ("n_words", "_words", "words", "kept", "_given", "at", "hash"):  # names the operator uses itself
        docs = docs.withColumn(name, F.lit("x"))
    found = quality.judge(docs, carry={"doc_id": F.col("doc_id")}).collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found} == {
        k: plain(t) for k, t in enumerate(texts)}
    assert not any(r.kept and r.base_failed for r in found)


def test_every_rule_decides(spark):
    good = " ".join(f"the word{k} of number{k * 7}" for k in range(30))
    odd = {
        "mean_word_chars": good.replace("the ", "the" + "x" * 90 + " the "),
        "symbols_per_word": good.replace("word", "## word"), "marks_per_word": good.replace("word", "!!!!!! word"),
        "capital_word_ratio": good.upper() + " the of the of", "stop_word_ratio": good.replace("the ", "qth ").replace("of ", "qof "),
        "dup_line_ratio": "\n".join(["x"] * 200) + "\n" + good,
    }
    docs = spark.createDataFrame([("good", good), *odd.items()], "name string, text string")
    found = {r.name: r for r in quality.judge(docs, carry={"name": F.col("name")}).collect()}
    assert found["good"].kept
    for name, r in found.items():
        broken = {rule.measure for rule in quality.RULES if (rule.least is not None and r[rule.measure] < rule.least) or (rule.most is not None and r[rule.measure] > rule.most)}
        assert r.kept == (not broken and not r.base_failed)
        assert name == "good" or name in broken, (name, broken)
    own = quality.judge(docs, rules=[quality.Rule("n_words", most=10)]).collect()
    assert not any(r.kept for r in own)


def test_odd_tables(spark):
    rows = [(1, None), (1, None), (None, "a " * 60000), (2, "word " * 49 + "x"), (2, "word " * 49 + "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = quality.judge(docs, carry={"doc_id": F.col("doc_id")}).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_repeat_words) for r in found) == [(0, 60000, 60000), (1, 0, 0), (1, 0, 0), (2, 50, 49), (2, 50, 49)]
    empty = quality.judge(docs.limit(0), carry={"doc_id": F.col("doc_id")})
    assert empty.count() == 0 and "kept" in empty.columns


def test_nothing_leaves_the_jvm_and_nothing_moves(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = quality.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan

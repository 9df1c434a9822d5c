from pyspark.sql import functions as F

from linkloom.llm import language
from linkloom.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "text")
    found = QUERIES["op5_language"](spark, folder).join(docs, "doc_id").where("held_out").collect()
    right = sum(r.lang == r.lang_pred for r in found)
    assert len(found) > 200 and right / len(found) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_a_mixture_has_both_languages(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs)
    en, de = (docs.where((F.col("lang") == l) & (F.length("text") > 1500)).first().text[:1200] for l in ("en", "de"))
    mixed = spark.createDataFrame([(en + "\n" + de,), (en,), (de,)], "text string")
    both, first, second = language.predict(mixed, model).collect()
    assert set(both.languages) == {"en", "de"} and 0.3 < both.score < 0.7
    assert first.languages == ["en"] and second.languages == ["de"]


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 %", "de"), (4, "the cat sat on the mat", "en"), (5, "die katze und das haus", "de"),
            (5, "the the the " * 20000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("lang_pred", F.lit(1)).withColumn("score", F.lit(1))
    model = language.fit(docs)
    assert model.languages == ["de", "en"]
    found = language.predict(docs, model, carry={"doc_id": F.col("doc_id")}).collect()
    assert [(r.doc_id, r.lang_pred) for r in found] == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de"), (5, "en")]
    none = language.fit(docs.where("lang is null"))
    assert none.languages == [] and {r.lang_pred for r in language.predict(docs, none).collect()} == {"und"}
    assert language.predict(docs.limit(0), model).count() == 0


def plain_windows(text):
    kept = "".join(c if "a" <= c <= "z" or ord(c) >= 128 else " " for c in text.lower())
    data = b" " + " ".join(kept.split()).encode() + b" "
    data = data + b" " * (4 - len(data)) if data.strip() else b""
    return [data[i:i + 4] for i in range(len(data) - 3)]


def plain_likelihood(model, text, chosen, rounds=3000):
    """The best likelihood of a set of languages, and the shares that have it, by plain expectation maximisation."""
    import math

    buckets = [(int.from_bytes(w, "big") * 2654435761 % 2 ** 32) >> 17 for w in plain_windows(text)]
    share = [1 / len(chosen)] * len(chosen)
    table = [[float(model.probabilities[l, b]) for b in buckets] for l in chosen]
    for _ in range(rounds):
        total = [sum(s * row[k] for s, row in zip(share, table)) for k in range(len(buckets))]
        new = [s * sum(row[k] / total[k] for k in range(len(buckets))) / len(buckets) for s, row in zip(share, table)]
        done = max(abs(a - b) for a, b in zip(new, share)) < 1e-5
        share = new
        if done:
            break
    return sum(math.log(sum(s * row[k] for s, row in zip(share, table))) for k in range(len(buckets))), share


def test_mixtures_against_plain_expectation_maximisation(spark):
    import itertools
    import math

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs)
    parts = {r.lang: r.text[:90] for r in docs.where("length(text) > 400").dropDuplicates(["lang"]).collect()}
    tried = [*parts.values(), *(a + " " + b for a, b in itertools.combinations(parts.values(), 2))]
    for text in tried:
        windows = plain_windows(text)
        assert sorted((int.from_bytes(w, "big") * 2654435761 % 2 ** 32) >> 17 for w in windows) == sorted(language.ngram_buckets(text.encode()).tolist())
        found = language.mixture(model, text.encode())
        price = 4.0 * 0.5 * math.log(len(windows) + 1)
        sets = [c for n in range(1, len(model.languages) + 1) for c in itertools.combinations(range(len(model.languages)), n)]
        value = {c: plain_likelihood(model, text, c) for c in sets}
        best = max(value[c][0] - price * len(c) for c in sets)
        mine = tuple(sorted(found))
        assert value[mine][0] - price * len(mine) > best - 0.5  # dropped one by one, as good a set as the best of all
        assert all(abs(found[l] - s) < 0.05 for l, s in zip(mine, value[mine][1]))


def test_every_text_with_a_letter_has_a_learned_language(spark):
    docs = spark.createDataFrame([("the cat sat on the mat", "en"), ("die katze und das haus", "de")], "text string, lang string")
    model = language.fit(docs)
    rows = spark.createDataFrame([(t,) for t in ("a", "I", "A1", "7 x", "é", "ß", "漢", "a.b", " z ")], "text string")
    found = language.predict(rows, model).collect()
    assert {r.lang_pred for r in found} <= {"en", "de"} and all(0 < r.score <= 1 for r in found)
    none = spark.createDataFrame([("7",), ("%!",), ("²",)], "text string")
    assert {(r.lang_pred, r.score) for r in language.predict(none, model).collect()} == {("und", 0.0)}

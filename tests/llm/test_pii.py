import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import pii
from linkloom.llm.tagger import Tagger

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False,
                  "card": 13 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                found.append((kind, m.start(), m.end()))
    return found


def test_base_spans_of_made_texts():
    draw = random.Random(2)
    parts = ["a", "b.c", "@", "@x.y", ".", "-", " ", "+", "1", "22", "255", "256", "1.2.3.4", "4111 1111 1111 1111", "(555)", "é", "+1 ", "d@e.f", "_%"]
    for _ in range(20000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        assert sorted(pii.base_spans(text)) == sorted(plain_spans(text)), text


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_long_runs_take_linear_time():
    for text in ("7" * 400_000, "a" * 400_000, "+" + "1 " * 200_000, "1." * 200_000, "a@" * 200_000):
        pii.base_spans(text)


def test_documents_against_the_plain_patterns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = pii.digest(docs, pii.fit(docs), carry={"doc_id": F.col("doc_id")}).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_spans(texts[r.doc_id])
        joined = pii.join_spans(base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r.spans.split(","))
        if not r.n_added:
            assert r.spans == joined
    assert sum(r.n_added for r in rows) <= 5


@pytest.fixture(scope="module")
def tagger(spark):
    return pii.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def found(tagger, text):
    return [(k, text[a:b]) for k, a, b in pii.added_spans(tagger, [text], [pii.base_spans(text)])[0]]


def test_what_patterns_miss(tagger):
    draw, hits, total = random.Random(9), 0, 0
    for _ in range(200):
        kind = draw.choice(pii.KINDS)
        span = pii._rewritten(draw, kind, pii._made_span(draw, kind))
        text = f"the ander thation of the {span} ened in the reatth"
        if any(k == kind and text[a:b] == span for k, a, b in pii.base_spans(text)) or not pii.plausible(kind, span):
            continue
        if pii.base_spans(text):
            continue
        total += 1
        hits += (kind, span) in found(tagger, text)
    assert total > 50 and hits / total > 0.8


def test_every_spelled_form_is_decoded_alone():
    ats = [a + mark + b for mark in ("at", "AT") for a, b in [(" ", " "), *((o + i, i + c) for x, y in ("[]", "()", "{}", "<>") for i in ("", " ") for o, c in ((x, y), (" " + x, y + " ")))]]
    dots = [".", *(f"{a}{mark}{b}" for mark in ("dot", "DOT") for a, b in (" " * 2, "[]", "()", "{}", "<>", (" [ ", " ] ")))]
    for at in ats + [" at\n", "\tat  "]:
        for dot in dots:
            span = f"jane.doe{at}example{dot}com"
            text = f"the ander thation of the {span} ened in the reatth"
            if pii.plausible("email", span):
                assert any(a <= 25 and 25 + len(span) <= b for a, b in pii.regions(text)), span
    assert pii.plausible("email", "jane.doe at example.com") and pii.plausible("email", "jane[dot]doe < at >example.com")
    assert pii.regions("at at jane at x.com") and pii.regions("jane[dot] at x.com")
    assert pii.regions("meet at noon. And the dots at (at) the end") == []


def test_spelled_addresses_without_digits_are_found(tagger):
    draw, word = random.Random(1), lambda: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(3, 8)))
    for at in (" at ", " AT ", "[at]", " [at] ", "(at)", " (at) ", "[ at ]", "( at )", "<at>"):
        hits = 0
        for k in range(40):
            span = f"{word()}.{word()}{at}{word()}.{draw.choice(['com', 'org', 'net', 'de'])}"
            hits += ("email", span) in found(tagger, f"the ander thation of the {span} ened in the reatth")
        assert hits >= 20, (at, hits)


def test_harmless_digits_are_left_alone(tagger):
    draw, texts = random.Random(11), []
    for _ in range(300):
        texts.append(" ".join(draw.choice(["the", "and", "of", pii._harmless(draw)]) for _ in range(30)))
    added = pii.added_spans(tagger, texts, [pii.base_spans(t) for t in texts])
    assert sum(map(len, added)) <= 6


def test_gradients():
    allowed = np.ones((3, 3), bool)
    allowed[0, 2] = False
    tagger = Tagger(5, allowed, np.array([True, True, False]), width=3, hidden=4)
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    draw = np.random.default_rng(0)
    symbols = draw.integers(0, 5, (2, 6))
    tags = np.array([[0, 1, 2, 2, 0, 1], [1, 2, 0, 0, 1, 2]])
    _, grads = tagger.loss(symbols, tags)
    for name, value in tagger.p.items():
        at = tuple(draw.integers(0, n) for n in value.shape)
        if name == "trans" and not allowed[at]:
            continue
        kept, step = value[at], 1e-2
        value[at] = kept + step
        up = tagger.loss(symbols, tags)[0]
        value[at] = kept - step
        down = tagger.loss(symbols, tags)[0]
        value[at] = kept
        assert abs((up - down) / (2 * step) - grads[name][at]) < 2e-3, name


def test_windows_are_reconciled():
    seen = pii.windows(0, 300)
    assert seen[0] == (0, 128) and seen[-1] == (172, 300)
    one = ("email", 70, 90)
    assert pii.reconcile({one: 2}, seen) == [one]
    assert pii.reconcile({("email", 10, 30): 1, ("phone", 12, 20): 1}, seen)[0] in (("email", 10, 30), ("phone", 12, 20))
    assert pii.reconcile({("ip", 100, 110): 1}, seen) == []  # one of two windows is not most


def test_odd_rows(spark, tagger):
    rows = [(1, None, 4), (2, "", 0), (3, "mail a.b@c.de now", 17), (3, "mail a.b@c.de now", 17), (None, "x 1.2.3.4 " * 5000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumn("spans", F.lit("x")).withColumn("base", F.lit(1))
    out = pii.redact(docs, tagger, length_column="n_chars")
    assert out.columns == docs.columns
    got = {(r.doc_id, r.text[:40] if r.text is not None else None, r.n_chars) for r in out.collect()}
    assert {(1, None, 4), (2, "", 0), (3, "mail <EMAIL> now", 16)} <= got and out.count() == 5
    assert any(t and t.startswith("x <IP> x <IP>") and n == 5000 * 7 for _, t, n in got)
    assert pii.fit(docs.where("doc_id = 2")) is None
    assert pii.digest(docs, None).select("n_ip").agg(F.sum("n_ip")).first()[0] == 5000
    assert pii.find(docs.limit(0), tagger).count() == 0 and pii.redact(docs.limit(0), tagger).count() == 0

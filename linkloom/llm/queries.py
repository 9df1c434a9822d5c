"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import (
    decontaminate, embedding_dedup, hard_negatives, html_content, language, lm, packing, pii, quality, repeats, secrets, simhash,
    whitening,
)
from linkloom.llm.common import named, remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document: fixed patterns, and what the tagger adds."""
    documents = table(spark, folder, "documents")
    return pii.digest(documents, pii.fit(documents), carry={"doc_id": named("doc_id")})


@query
def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """SimHash fingerprints and the components of near duplicates, for every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


@query
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's tokens in sequences of 2048."""
    return packing.pack(table(spark, folder, "documents"), carry={"doc_id": named("doc_id")})


@query
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """What each document shares with the benchmark."""
    return decontaminate.search(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), carry={"doc_id": named("doc_id")})


ORACLES["op4_decontamination"] = r"""
WITH dw AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
bw AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
strings AS (
    SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS s
    FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM bw WHERE len(w) > 0)),
found AS (
    SELECT d.r, d.i, strings.n, strings.item
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, (SELECT DISTINCT n FROM strings) WHERE len(w) >= n) d
    JOIN strings ON strings.n = d.n AND strings.s = array_to_string(d.w[d.i:d.i + d.n - 1], ' ')),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""


@query
def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from labelled documents that are not held out."""
    documents = table(spark, folder, "documents")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = language.fit(documents.where(~held_out))
    return language.predict(documents, model, carry={"doc_id": named("doc_id"), "held_out": held_out})


@query
def op6_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Base and model score of every document, learned from those that are not held out."""
    documents = table(spark, folder, "documents")
    held_out = F.coalesce(remainder("doc_id", 10) == 0, F.lit(False))
    model, counts = lm.fit(documents.where(~held_out))
    return lm.score(documents, model, counts, carry={"doc_id": named("doc_id"), "held_out": held_out})


@query
def op7_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without passages of smaller doc_ids."""
    return repeats.keep_first(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


ORACLES["op7_repeats"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
    SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) > 12)),
firsts AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s),
gone AS (
    SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM windows JOIN firsts USING (s) WHERE doc_id > first),
words AS (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


@query
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict of the quality rules on every document."""
    found = quality.judge(table(spark, folder, "documents"), carry={"doc_id": named("doc_id")})
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLES["op8_quality"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (
    SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
    FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
windows AS (
    SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)),
repeats AS (
    SELECT r, count(DISTINCT p) AS n_repeat_words FROM (
        SELECT r, unnest(range(i, i + 3)) AS p FROM windows SEMI JOIN (SELECT r, s FROM windows GROUP BY r, s HAVING count(*) > 1) USING (r, s))
    GROUP BY r),
counts AS (
    SELECT r, count(*) AS n_words, sum(length(x)) AS word_chars,
        count(*) FILTER (lower(x) IN ({stop_words})) AS n_stop,
        count(*) FILTER (regexp_matches(x, '\p{{Lu}}{{2}}') AND x = upper(x)) AS n_capital
    FROM (SELECT r, unnest(w) AS x FROM d) GROUP BY r),
m AS (
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(regexp_extract_all(t, '[!?]')) AS n_marks,
        coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(n_stop, 0) AS n_stop, coalesce(n_capital, 0) AS n_capital
    FROM d LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r) LEFT JOIN counts USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, greatest(n_words, 1)::DOUBLE AS n FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
    NOT base_failed AND word_chars / n BETWEEN 2 AND 12 AND n_symbols / n <= 0.2 AND n_marks / n <= 1.0 AND n_capital / n <= 0.5
        AND n_stop / n >= 0.02 AND n_repeat_words / n <= 0.5 AND n_dup_lines / greatest(n_lines, 1)::DOUBLE <= 0.5 AS kept
FROM f
""".format(stop_words=", ".join(f"'{w}'" for w in quality.STOP_WORDS))


@query
def op9_html(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return html_content.extract(table(spark, folder, "pages"), carry={"page_id": named("page_id"), "url": named("url")})


@query
def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Every candidate for a secret in the documents, with the forest's verdict; the secret itself as a digest."""
    forest = secrets.Forest.fit(secrets.features(secrets.labelled_findings(spark)))
    found = secrets.scan(table(spark, folder, "documents"), forest, carry={"doc_id": named("doc_id")})
    return found.select("doc_id", "start", "stop", "kind", F.sha2("candidate", 256).alias("candidate_sha256"), "score", "is_secret")


@query
def op11_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of the embeddings of each label."""
    found = embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


ORACLES["op11_embedding_dedup"] = r"""
WITH RECURSIVE v AS (
    SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
        label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
    FROM embeddings),
links AS (
    SELECT a.r AS src, b.r AS dst FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
    WHERE a.usable AND b.usable AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
    SELECT r AS src, r AS dst FROM v
    UNION SELECT reach.src, links.dst FROM reach JOIN links ON reach.dst = links.src),
least AS (SELECT src, min(vec_id) AS component_id FROM reach JOIN v ON v.r = dst GROUP BY src),
degree AS (SELECT src, count(*) AS n FROM links GROUP BY src)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN least ON least.src = r LEFT JOIN degree ON degree.src = r
"""


@query
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The whitened components of every embedding, the fit on each different vector once.

    A deviation that no long can hold is null here; the operator has it as a decimal.
    """
    found = whitening.whiten(table(spark, folder, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"), "n", F.col("deviation").try_cast("long").alias("deviation"), "identity_error", "explained",
        F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
        F.get("explained", "at").alias("explained"), "identity_error")


@query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every fiftieth embedding, some labels moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


ORACLES["op13_hard_negatives"] = r"""
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT a.r AS ar, a.vec_id AS anchor_id, a.label AS own, b.r, b.vec_id, b.label,
        CAST(list_sum(list_transform(range(1, len(a.c) + 1), lambda i: a.c[i] * b.c[i])) AS BIGINT) AS score
    FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.r <> b.r),
positives AS (
    SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) AS nth FROM scores WHERE label = own),
ranked AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.ar, p.nth ORDER BY s.score DESC, s.vec_id) AS rank
    FROM positives p JOIN scores s ON s.ar = p.ar AND s.label <> s.own AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
    WHERE p.nth <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""

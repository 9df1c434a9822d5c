"""Postings, BM25 and paged results for one query or very many."""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.scalars import encode_body, tokens
from linkloom.operators.ranks import TOP_ROWS, numbered_between
from linkloom.operators.requests import LARGEST_LIMIT
from linkloom.session import settle, settle_bucketed

# Fixed values of the ranking formula.
K1 = 1.2
B = 0.75

# Parts of a score are added up as whole billionths: the sum is then the same in whatever order
# tasks deliver the parts, and equal documents tie exactly.
UNIT = 1e9


def _by(df: DataFrame) -> list[str]:
    """Search is within an index when the documents have one."""
    return ["index_name"] if "index_name" in df.columns else []


def word_counts(documents: DataFrame) -> DataFrame:
    """([index_name,] url, dl, words): every document's words with how often it has them, beside its number of tokens.

    A document is one row, so its sorted words are counted in runs inside the row and nothing is shuffled.
    """
    by = _by(documents)
    split = documents.select(*by, "url", F.sort_array(tokens(F.coalesce("content", F.lit("")))).alias("_t"))
    starts = F.filter(F.sequence(F.lit(0), F.size("_t") - 1), lambda i: (i == 0) | (F.get("_t", i) != F.get("_t", i - 1)))
    placed = split.withColumn("_at", F.when(F.size("_t") > 0, starts).otherwise(F.array().cast("array<int>")))
    words = F.transform("_at", lambda i, k: F.struct(
        F.get("_t", i).alias("term"), (F.coalesce(F.get("_at", k + 1), F.size("_t")) - i).cast("bigint").alias("tf")))
    return placed.select(*by, "url", F.size("_t").cast("bigint").alias("dl"), words.alias("words"))


def postings(documents: DataFrame, mark: str | None = None) -> DataFrame:
    """([index_name,] url, term, tf, dl): how often a term stands in a document of dl tokens.

    ``mark`` is a term that every document has once. Rows with the same url are different documents.
    """
    words = F.col("words")
    if mark is not None:
        words = F.concat(F.array(F.struct(F.lit(mark).alias("term"), F.lit(1).cast("bigint").alias("tf"))), words)
    counted = word_counts(documents)
    # outer: for a plain explode Spark infers a test of the array's size and would analyze every text once more, word by word
    each = counted.select(*_by(documents), "url", "dl", F.explode_outer(words).alias("_r"))
    return each.select(*_by(documents), "url", "_r.term", "_r.tf", "dl").filter(F.col("term").isNotNull())


def document_lengths(documents: DataFrame) -> DataFrame:
    return documents.select(
        *_by(documents), "url", F.size(tokens(F.col("content"))).cast("bigint").alias("dl")
    )


def corpus_totals(lengths: DataFrame) -> DataFrame:
    """([index_name,] n, total): documents and tokens; empty documents count too."""
    return lengths.groupBy(*_by(lengths)).agg(
        F.count(F.lit(1)).alias("n"), F.sum("dl").cast("bigint").alias("total")
    )


def term_statistics(postings: DataFrame) -> DataFrame:
    """([index_name,] term, df, occurrences)"""
    return postings.groupBy(*_by(postings), "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").cast("bigint").alias("occurrences")
    )


def idf(n: Column, df: Column) -> Column:
    return F.log(F.lit(1.0) + (n - df + F.lit(0.5)) / (df + F.lit(0.5)))


def term_score(tf: Column, dl: Column, avgdl: Column) -> Column:
    return tf * F.lit(K1 + 1) / (tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * dl / avgdl))


def in_units(part: Column) -> Column:
    # floor, as round goes through decimals and costs more than all the rest of a score
    return F.floor(part * F.lit(UNIT) + F.lit(0.5))


def query_terms(queries: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, term, qtf): a term written twice counts twice."""
    return (
        queries.select(*keys, F.explode(tokens(F.col("q"))).alias("term"))
        .groupBy(*keys, "term")
        .agg(F.count(F.lit(1)).alias("qtf"))
    )


def weighted_terms(term_stats: DataFrame, totals: DataFrame, terms: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, [index_name,] term, weight, avgdl): what a query's word adds to a score, but for the document's part."""
    by = _by(term_stats)
    weighted = terms.join(term_stats.select(*by, "term", "df"), [*by, "term"])
    weighted = (
        weighted.join(totals, by) if by else weighted.withColumns(
            {c: totals.select(c).scalar() for c in ("n", "total")}
        )
    )
    return weighted.select(
        *dict.fromkeys([*keys, *by, "term"]),
        (F.col("qtf") * idf(F.col("n"), F.col("df"))).alias("weight"),
        (F.col("total") / F.col("n")).alias("avgdl"),
    )


def score(
    postings: DataFrame,
    term_stats: DataFrame,
    totals: DataFrame,
    terms: DataFrame,
    keys: list[str],
    few_terms: bool = False,
) -> DataFrame:
    """(keys, url, score): documents holding any term of a query, by BM25.

    Only query terms and their statistics meet the postings. ``few_terms`` says that the caller
    counted them and they may be broadcast; otherwise Spark sizes the join, and splits the rows of a
    very common term. The sum is partial before its shuffle.
    """
    weighted = weighted_terms(term_stats, totals, terms, keys)
    if few_terms:
        weighted = F.broadcast(weighted)
    part = F.col("weight") * term_score(F.col("tf"), F.col("dl"), F.col("avgdl"))
    return (
        postings.join(weighted, [*_by(postings), "term"]).groupBy(*keys, "url").agg(
            (F.sum(in_units(part)) / F.lit(UNIT)).alias("score")
        )
    )


def hit_order() -> list[Column]:
    return [F.col("score").desc(), F.col("url").asc()]


def search(documents: DataFrame, q: str, limit: int = 10, offset: int = 0) -> DataFrame:
    """(url, score) of one query over unindexed documents, best first, paged.

    One pass over the texts writes the query's words found in each row; every row is a document of one corpus,
    whatever its url. Document frequencies are as many numbers as the query has words. With few words a score is
    made inside its row; with many, the words found meet their prices in a broadcast join. One row a document, and then
    the best hits, are all that is shuffled.
    """
    spark = documents.sparkSession
    # the terms come out of the engine's own analysis; the query is one short text
    found = spark.range(1).select(tokens(F.lit(q)).alias("t")).first()[0]
    weight = Counter(found)
    if not weight or limit < 1 or offset < 0:
        return documents.select("url", F.lit(0.0).alias("score")).limit(0)
    held = F.filter("words", lambda w: w["term"].isin(list(weight)))
    rows = word_counts(documents.select("url", "content")).select("url", "dl", held.alias("held"))
    counts = settle(rows.withColumn("row", F.monotonically_increasing_id()), "counts")
    n, total = counts.agg(F.count(F.lit(1)), F.sum("dl")).first()
    matches = counts.select("row", "url", "dl", F.explode("held").alias("w")).select("row", "url", "dl", "w.term", "w.tf")
    each = matches.groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()
    if not each:
        return counts.select("url", F.lit(0.0).alias("score")).limit(0)
    avgdl = F.lit(float(total) / n)
    if len(weight) <= FEW_NAMED:
        priced = F.create_map(*[c for r in each for c in (F.lit(r["term"]), F.lit(weight[r["term"]]) * idf(F.lit(n), F.lit(r["df"])))])
        units = F.aggregate("held", F.lit(0).cast("bigint"), lambda sofar, w: sofar + in_units(
            F.element_at(priced, w["term"]) * term_score(w["tf"], F.col("dl"), avgdl)))
        hits = counts.filter(F.size("held") > 0).select("url", (units / F.lit(UNIT)).alias("score"))
    else:
        named = spark.createDataFrame([(r["term"], weight[r["term"]], r["df"]) for r in each], "term string, qtf bigint, df bigint")
        priced = named.select("term", (F.col("qtf") * idf(F.lit(n), F.col("df"))).alias("weight"))
        part = F.col("weight") * term_score(F.col("tf"), F.col("dl"), avgdl)
        scored = matches.join(F.broadcast(priced), "term").groupBy("row", "url").agg(F.sum(in_units(part)).alias("units"))
        hits = scored.select("url", (F.col("units") / F.lit(UNIT)).alias("score"))
    if offset + limit > TOP_ROWS:
        placed = numbered_between(hits, [], hit_order(), offset + 1, offset + limit, "_place")
        return placed.orderBy("_place").select("url", "score")
    return hits.orderBy(*hit_order()).offset(offset).limit(limit)


# up to this many words of one query are priced inside a document's row; more are joined: the same rows
FEW_NAMED = 64


def search_many(
    queries: DataFrame,
    postings: DataFrame,
    term_stats: DataFrame,
    totals: DataFrame,
    deepest: int | None = None,
) -> DataFrame:
    """(query_id, rank, url, score) for a table of queries (query_id, q, limit, offset[, index_name]).

    Queries with the same words are scored once, under the smallest of their ids, so a query
    repeated a million times costs one. ``deepest`` is the largest offset + limit, counted when
    not given. ``rank`` starts at 1 on the first row of the page asked for. A page with a negative offset or
    without rows is none.
    """
    by = _by(postings)
    asked = asked_queries(queries, by)
    keys = [*by, "scored_as"]
    hits = score(postings, term_stats, totals, asked.terms, keys, asked.term_count <= FEW_TERMS)
    deepest = asked.deepest if deepest is None else deepest
    return asked.pages(numbered_between(hits, keys, hit_order(), 1, deepest, "place"))


class Asked(NamedTuple):
    """A table of queries with each set of words once: under the smallest query_id that has it."""

    rows: DataFrame  # query_id, [index_name,] words, limit, offset
    unique: DataFrame  # [index_name,] words, scored_as, deepest
    terms: DataFrame  # [index_name,] scored_as, term, qtf
    deepest: int
    term_count: int

    def pages(self, top: DataFrame) -> DataFrame:
        """(query_id, rank, url, score): each query's page of the ranked hits ([index_name,] scored_as, place, url, score)."""
        by = _by(self.rows)
        within = (F.col("place") > F.col("offset")) & (F.col("place") <= F.col("offset") + F.col("limit"))
        return (
            self.rows.join(self.unique, [*by, "words"])
            .join(top, [*by, "scored_as"])
            .filter(within)
            .select("query_id", (F.col("place") - F.col("offset")).cast("bigint").alias("rank"), "url", "score")
        )


def asked_queries(queries: DataFrame, by: list[str]) -> Asked:
    words = F.array_join(F.array_sort(tokens(F.col("q"))), " ")
    rows = queries.select("query_id", *by, words.alias("words"), "limit", "offset")
    rows = rows.filter((F.col("words") != "") & (F.col("limit") > 0) & (F.col("offset") >= 0))
    last = F.col("limit").cast("bigint") + F.col("offset")
    unique = rows.groupBy(*by, "words").agg(F.min("query_id").alias("scored_as"), F.max(last).alias("deepest"))
    terms = query_terms(unique.withColumnRenamed("words", "q"), [*by, "scored_as"])
    deepest, term_count = rows.agg(
        F.coalesce(F.max(last), F.lit(0)), F.coalesce(F.sum(F.size(F.split("words", " "))), F.lit(0))
    ).first()
    return Asked(rows, unique, terms, deepest, term_count)


# the number of query terms, over all queries, that may be broadcast to the postings
FEW_TERMS = 500_000
# the term of the posting that every document has when marked; no token is empty
MARK = ""


# up to this many different query words are named in a scan, which then skips row groups
WORD_LIST = 500


def for_words(queries: DataFrame, postings: DataFrame) -> DataFrame:
    """The postings a query table can need: with few words those of the words, else all."""
    words = queries.select(F.explode(tokens(F.col("q"))).alias("t")).distinct()
    few = [r[0] for r in words.limit(WORD_LIST + 1).collect()]
    return postings.filter(F.col("term").isin(few)) if len(few) <= WORD_LIST else postings


# up to this many different query words are broadcast to the scan of the texts
FEW_WORDS = 10_000


def search_documents(documents: DataFrame, queries: DataFrame, deepest: int | None = None) -> DataFrame:
    """``search_many`` without a stored index.

    One pass over the texts writes the postings of the query words and the length of every
    document, since scores and statistics both need them. They are bucketed by url, so that scores
    add up in their bucket, and a bucket sends a query's best hits only. Urls must be unique within an index: scores are by url.
    """
    matches, totals = matching_postings(documents, queries)
    return search_many(queries, matches, term_statistics(matches), totals, deepest)


def matching_postings(documents: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The postings of the query words, bucketed by url, and the totals of all documents: one pass over the texts."""
    by = _by(documents)
    wanted = query_terms(queries, by).select(*by, "term")
    few = wanted.limit(FEW_WORDS + 1).count() <= FEW_WORDS
    flags = wanted.withColumn("_wanted", F.lit(True))
    flags = F.broadcast(flags) if few else flags

    def keep(rows: DataFrame) -> DataFrame:
        marked = rows.join(flags, [*by, "term"], "left")
        return marked.filter(F.col("_wanted") | (F.col("term") == MARK)).drop("_wanted")

    kept = keep(postings(documents, MARK))
    small = settle_bucketed(kept, "postings", "url")
    return small.filter(F.col("term") != MARK), corpus_totals(small.filter(F.col("term") == MARK))


def search_after(queries: DataFrame, postings: DataFrame, term_stats: DataFrame, totals: DataFrame) -> DataFrame:
    """(query_id, rank, url, score): the ``limit`` hits of every query that follow its cursor, numbered from 1.

    ``queries`` is (query_id, q, limit, after_score, after_url[, index_name]); the cursor is the last hit of the page
    before, or nulls for the first page. Hits up to the cursor are cut off where they are scored, so a deep page costs
    no more than the first, and hits that came or went on earlier pages shift nothing. Queries of at most ``FEW_TERMS``
    words go to the postings: of those bucketed by url, a bucket sends a query's best hits only.
    """
    by = _by(postings)
    asked = queries.filter(F.col("limit") > 0)
    keys = [*by, "query_id"]
    # a query without words counts too, as its cursor is sent
    largest, size = asked.agg(
        F.coalesce(F.max("limit"), F.lit(0)), F.coalesce(F.sum(F.lit(1) + F.size(tokens(F.coalesce("q", F.lit(""))))), F.lit(0))
    ).first()
    few = size <= FEW_TERMS
    hits = score(postings, term_stats, totals, query_terms(asked, keys), keys, few)
    cursors = asked.select(*keys, F.col("limit").alias("_limit"), "after_score", "after_url")
    behind = (F.col("score") < F.col("after_score")) | ((F.col("score") == F.col("after_score")) & (F.col("url") > F.col("after_url")))
    left = hits.join(F.broadcast(cursors) if few else cursors, keys).filter(F.col("after_score").isNull() | behind)
    placed = numbered_between(left, keys, hit_order(), 1, largest, "rank")
    return placed.filter(F.col("rank") <= F.col("_limit")).select("query_id", "rank", "url", "score")


def replies(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """(query_id, request, limit, offset, urls): ranked urls of every query, none for no hit.

    A reply is one row, so a query may ask for ``LARGEST_LIMIT`` hits at most; one for more is refused.
    """
    largest = queries.agg(F.max("limit")).first()[0]
    if largest is not None and largest > LARGEST_LIMIT:
        raise ValueError(f"a reply has at most {LARGEST_LIMIT} urls; page through more")
    pages = hits.filter(F.col("rank") <= LARGEST_LIMIT).groupBy("query_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "url"))), lambda h: h["url"]
        ).alias("urls")
    )
    return queries.join(pages, "query_id", "left").select(
        "query_id",
        F.col("q").alias("request"),
        "limit",
        "offset",
        F.coalesce("urls", F.array().cast("array<string>")).alias("urls"),
    )


def reply_bodies(replies: DataFrame) -> DataFrame:
    """(query_id, body): replies as JSON texts."""
    fields = {n: F.col(n) for n in ("request", "limit", "offset", "urls")}
    return replies.select("query_id", encode_body(**fields).alias("body"))

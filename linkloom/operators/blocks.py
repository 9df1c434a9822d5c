"""Postings in blocks, and top hits that skip the blocks which cannot reach them.

The documents of an index lie in shards by url. Inside a shard they are numbered by length and cut into ranges of
``RANGE`` documents; a block is what one term has in one range: the documents, how often they hold the term, and the
largest such count and the smallest document length. From these two follows the most that the term can add to
the score of a document of the range, whatever the mean length is by then. The ranges of all terms are the same, so the
bounds of a query's words add up by range.

A shard answers a query from its best range downwards. Once it has as many documents as asked for, a range whose
bound is below the worst of them is never opened. What leaves a shard is at most that many rows a query.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.operators.search import B, K1, UNIT, word_counts

RANGE = 32
# Terms of rows that are no postings; no word is empty or has a space.
DOCUMENTS = ""  # the documents of a range: their urls and lengths
DEAD = " "  # documents of an earlier segment that this segment replaces
BLOCK = (
    "index_name string, term string, shard int, range int, of_segment int, max_tf bigint, min_dl bigint, "
    "docs array<int>, tfs array<bigint>, dls array<bigint>, urls array<string>"
)


def counted(documents: DataFrame, shards: int) -> DataFrame:
    """(index_name, url, dl, words, shard): every document's words with their counts, in its own row; no shuffle."""
    usable = documents.select("index_name", "url", "content").filter(F.col("url").isNotNull() & F.col("index_name").isNotNull())
    return word_counts(usable).withColumn("shard", F.pmod(F.xxhash64("url"), F.lit(shards)).cast("int"))


def blocks(rows: DataFrame) -> DataFrame:
    """``BLOCK`` rows of documents (index_name, url, dl, words, shard), which already lie by shard.

    Everything is grouped inside a shard, so nothing but the words' counts was ever moved, and a list holds a
    range's documents at most.
    """
    order = Window.partitionBy("shard", "index_name").orderBy("dl", "url")
    numbered = rows.withColumn("_n", F.row_number().over(order) - 1).withColumns(
        {"range": F.expr(f"int(_n div {RANGE})"), "doc": F.expr(f"int(_n % {RANGE})")})
    marked = F.concat(F.array(F.struct(F.lit(DOCUMENTS).alias("term"), F.lit(0).cast("bigint").alias("tf"))), "words")
    held = numbered.select("index_name", "shard", "range", "doc", "dl", "url", F.explode(marked).alias("w")).select(
        "index_name", F.col("w.term").alias("term"), "shard", "range", "doc", F.col("w.tf").alias("tf"), "dl",
        F.when(F.col("w.term") == DOCUMENTS, F.col("url")).alias("url"))
    grouped = held.groupBy("index_name", "term", "shard", "range").agg(
        F.max("tf").alias("max_tf"), F.min("dl").alias("min_dl"),
        F.sort_array(F.collect_list(F.struct("doc", "tf", "dl", "url"))).alias("_d"))
    lists = [F.col(f"_d.{name}").alias(f"{name}s") for name in ("doc", "tf", "dl")]
    urls = F.when(F.col("term") == DOCUMENTS, F.col("_d.url")).alias("urls")
    return grouped.select("index_name", "term", "shard", "range", F.lit(None).cast("int").alias("of_segment"), "max_tf", "min_dl", *lists, urls)


def opened(block_rows: DataFrame) -> DataFrame:
    """(segment, shard, index_name, range, doc, term, tf, dl) of blocks (without ``DEAD`` ones)."""
    each = F.arrays_zip("docs", "tfs", "dls")
    return block_rows.filter(F.col("term") != DEAD).select(
        "segment", "shard", "index_name", "range", "term", F.explode(each).alias("d")).select(
        "segment", "shard", "index_name", "range", F.col("d.docs").alias("doc"), "term", F.col("d.tfs").alias("tf"), F.col("d.dls").alias("dl"))


def block_documents(block_rows: DataFrame) -> DataFrame:
    """(segment, shard, index_name, range, doc, url, dl) of every stored document."""
    each = F.arrays_zip("docs", "urls", "dls")
    return block_rows.filter(F.col("term") == DOCUMENTS).select(
        "segment", "shard", "index_name", "range", F.explode(each).alias("d")).select(
        "segment", "shard", "index_name", "range", F.col("d.docs").alias("doc"), F.col("d.urls").alias("url"), F.col("d.dls").alias("dl"))


def dead_documents(block_rows: DataFrame) -> DataFrame:
    """(segment, shard, index_name, range, doc): stored documents that a later segment replaced."""
    return block_rows.filter(F.col("term") == DEAD).select(
        F.col("of_segment").alias("segment"), "shard", "index_name", "range", F.explode("docs").alias("doc"))


PLACE = ["segment", "shard", "index_name", "range", "doc"]


def dead_blocks(places: DataFrame) -> DataFrame:
    """``BLOCK`` rows that mark the documents at ``PLACE`` as replaced."""
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("max_tf", "bigint"), ("min_dl", "bigint"))]
    grouped = places.groupBy("index_name", "shard", "range", F.col("segment").alias("of_segment")).agg(F.sort_array(F.collect_set("doc")).alias("docs"))
    lists = [F.lit(None).cast(kind).alias(name) for name, kind in (("tfs", "array<bigint>"), ("dls", "array<bigint>"), ("urls", "array<string>"))]
    return grouped.select("index_name", F.lit(DEAD).alias("term"), "shard", "range", "of_segment", *nothing, "docs", *lists)


@dataclass
class Query:
    """One set of words asked in one index: what each word adds, and how many hits are wanted."""

    index: str
    scored_as: object
    weights: list[tuple[str, float]]
    avgdl: float
    wanted: int


def _units(weight: np.ndarray, tf: np.ndarray, dl: np.ndarray, avgdl: float) -> np.ndarray:
    """The same arithmetic as ``search.term_score`` and ``search.in_units``; whole numbers, exact in doubles."""
    part = weight * (tf * (K1 + 1) / (tf + K1 * ((1 - B) + B * dl / avgdl)))
    return np.floor(part * UNIT + 0.5)


class Shard:
    """The blocks of one shard and index that some query may need."""

    def __init__(self, rows: pa.Table):
        terms = rows.column("term").combine_chunks().dictionary_encode()
        codes = terms.indices.to_numpy()
        names = terms.dictionary.to_pylist()
        place = rows.column("segment").to_numpy().astype(np.int64) << 32 | rows.column("range").to_numpy().astype(np.int64)
        own = names.index(DOCUMENTS) if DOCUMENTS in names else -1
        dead = names.index(DEAD) if DEAD in names else -1
        marks = np.flatnonzero(codes == own)
        marks = marks[np.argsort(place[marks])]
        self.slots = len(marks)
        self.urls = [rows.column("urls")[int(m)] for m in marks]
        self.live = np.ones(self.slots * RANGE, bool)
        for at in np.flatnonzero(codes == dead).tolist():
            target = rows.column("of_segment")[at].as_py() << 32 | rows.column("range")[at].as_py()
            slot = int(np.searchsorted(place[marks], target))
            if slot < self.slots and place[marks[slot]] == target:
                self.live[slot * RANGE + np.array(rows.column("docs")[at].as_py())] = False
        kept = np.flatnonzero((codes != own) & (codes != dead))
        kept = kept[np.argsort(codes[kept], kind="stable")]
        posts = rows.take(pa.array(kept))
        self.slot = np.searchsorted(place[marks], place[kept])
        self.max_tf, self.min_dl = (posts.column(c).to_numpy().astype(float) for c in ("max_tf", "min_dl"))
        docs = posts.column("docs").combine_chunks()
        self.ends = docs.offsets.to_numpy().astype(np.int64)
        self.docs = docs.flatten().to_numpy()
        self.tfs, self.dls = (posts.column(c).combine_chunks().flatten().to_numpy().astype(float) for c in ("tfs", "dls"))
        self.ends = self.ends - self.ends[0] if len(self.ends) else self.ends
        sorted_codes = codes[kept]
        self.rows_of = {names[c]: (int(np.searchsorted(sorted_codes, c)), int(np.searchsorted(sorted_codes, c, "right"))) for c in np.unique(sorted_codes).tolist()}
        self.bounds = len(kept)

    def best(self, query: Query, first: int = 1) -> tuple[list[tuple[str, float]], int, int]:
        """(url, score) of the best ``query.wanted`` documents, how many blocks its words have, how many were opened."""
        held = [(self.rows_of[t], w) for t, w in query.weights if t in self.rows_of]
        if not held:
            return [], 0, 0
        rows = np.concatenate([np.arange(a, b) for (a, b), _ in held])
        weight = np.repeat([w for _, w in held], [b - a for (a, b), _ in held])
        slot = self.slot[rows]
        bound = np.bincount(slot, _units(weight, self.max_tf[rows], self.min_dl[rows], query.avgdl), self.slots)
        has = np.bincount(slot, minlength=self.slots) > 0
        order = np.argsort(-bound, kind="stable")
        order = order[has[order]]
        scores, docs = np.zeros(0), np.zeros(0, np.int64)
        least, at, step, looked = -1.0, 0, first, 0
        place = np.full(self.slots, -1)
        while at < len(order):
            batch = order[at:at + step]
            batch = batch[bound[batch] >= least]  # an equal score may still win by its url
            if not len(batch):
                break
            place[batch] = np.arange(len(batch))
            chosen = np.flatnonzero(place[slot] >= 0)
            found, where = self._scores(rows[chosen], weight[chosen], place, len(batch), query.avgdl)
            place[batch] = -1
            looked += len(chosen)
            docs = np.concatenate([docs, batch[where // RANGE] * RANGE + where % RANGE])
            scores = np.concatenate([scores, found])
            alive = self.live[docs]
            docs, scores = docs[alive], scores[alive]
            if len(scores) >= query.wanted:
                least = np.partition(scores, len(scores) - query.wanted)[len(scores) - query.wanted]
                kept = scores >= least
                docs, scores = docs[kept], scores[kept]
            at += step
            step *= 2
        hits = sorted(((-s, self.url(d)) for s, d in zip(scores.tolist(), docs.tolist())))[:query.wanted]
        return [(url, -s / UNIT) for s, url in hits], len(rows), looked

    def _scores(self, rows: np.ndarray, weight: np.ndarray, place: np.ndarray, count: int, avgdl: float) -> tuple[np.ndarray, np.ndarray]:
        """Scores in units of all documents of the blocks ``rows``, and their numbers within the opened ranges."""
        sizes = self.ends[rows + 1] - self.ends[rows]
        flat = np.repeat(self.ends[rows] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
        units = _units(np.repeat(weight, sizes), self.tfs[flat], self.dls[flat], avgdl)
        number = np.repeat(place[self.slot[rows]], sizes) * RANGE + self.docs[flat]
        total = np.bincount(number, units, count * RANGE)
        where = np.flatnonzero(np.bincount(number, minlength=count * RANGE))
        return total[where], where

    def url(self, doc: int) -> str:
        return self.urls[doc // RANGE][doc % RANGE].as_py()


HITS = "index_name string, scored_as {}, url string, score double, blocks bigint, opened bigint"


def answer(given, hit_schema: pa.Schema) -> Callable[[pa.Table], pa.Table]:
    """The function of one shard's blocks: its best hits of every query, and a row that says what was skipped.

    ``given`` is a broadcast list of ``Query``.
    """
    def run(rows: pa.Table) -> pa.Table:
        found: list[tuple] = []
        have = opened_blocks = 0
        by_index: dict[str, list[Query]] = {}
        for query in given.value:
            by_index.setdefault(query.index, []).append(query)
        for index in pc.unique(rows.column("index_name")).to_pylist():
            if index not in by_index:
                continue
            shard = Shard(rows.filter(pc.equal(rows.column("index_name"), index)))
            for query in by_index[index]:
                hits, blocks_held, looked = shard.best(query)
                have += blocks_held
                opened_blocks += looked
                found += [(index, query.scored_as, url, score, 0, 0) for url, score in hits]
        found.append((None, None, None, None, have, opened_blocks))
        return pa.table([pa.array(list(column), field.type) for column, field in zip(zip(*found), hit_schema)], schema=hit_schema)

    return run

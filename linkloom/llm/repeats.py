"""Repeated passages: every window of 13 words that an earlier document has, found by repeated-phrase automata.

0. Of equal texts only the first takes part: every window of a copy starts in it, so a copy of a window or more goes whole.
1. Every window has an anchor: the least hash of the runs of six words in it. Equal windows have equal
   anchors, and neighbouring windows mostly share one, so there are several times fewer anchors than
   windows. Anchors that only one document has are dropped.
2. The stretches of text around the other anchors go to shards by anchor. A shard confirms the phrases that
   several documents have, compiles them into an Aho-Corasick automaton over words, and streams its
   stretches through it. A phrase and all places that may hold it always meet in one shard.
3. The places found are gathered by document.

Where very many documents have an anchor, no shard takes it. Equal stretches are added up before the shuffle:
one of them stands for all, with its first id. The windows of those are grouped by their words, with the least
id of each found in partial sums, and joined back where an earlier document has them. The other stretches are
copies of one as a whole. Spark splits both joins where one window or stretch is very common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import map_batches, named, release, settle_dense
from linkloom.session import settle, work_path

WINDOW = 13
RUN = 6              # words in the runs that anchors are chosen from
STRETCH = 64         # most windows in one stretch
PIECE = 1 << 17      # words hashed at a time
WHOLE = -1           # end of the range of a copy: all of it

_draw = np.random.default_rng(13)
_BYTE = _draw.integers(1, 2 ** 63, 256, np.uint64)
_BASE = 6364136223846793005
_INVERSE = pow(_BASE, -1, 2 ** 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << n.bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[k] = np.multiply.accumulate(factors)
    return _powers[0][:n], _powers[1][:n]


class Pages:
    """Texts laid end to end, with the anchor of every window of every text.

    ``own[i]`` is the anchor of the window that starts at word ``at[i]`` of text ``text[i]``; the window's
    words are ``joined[starts[word[i]]:stops[word[i] + WINDOW - 1]]``.
    """

    def __init__(self, entries: list[tuple[int, int, list[bytes]]], window: int = WINDOW, run: int = RUN):
        self.joined = b" ".join([b" ".join(words) for _, _, words in entries])
        data = np.frombuffer(self.joined, np.uint8)
        self.stops = np.r_[np.flatnonzero(data == 32), len(data)]
        self.starts = np.r_[0, self.stops[:-1] + 1]
        counts = np.array([len(words) for _, _, words in entries])
        windows = counts - window + 1
        first = np.cumsum(counts) - counts
        inside = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        self.word = np.repeat(first, windows) + inside
        self.text = np.repeat(np.array([k for k, _, _ in entries]), windows)
        self.at = np.repeat(np.array([at for _, at, _ in entries]), windows) + inside
        self.own = self._least(data, window, run)[self.word]

    def _least(self, data: np.ndarray, window: int, run: int) -> np.ndarray:
        """The least hash of the runs in the window from each word on, as signed longs. Hashes are of the runs' text."""
        up, down = _powers_to(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[:-1], out=sums[1:])
        a, b = self.starts[:len(self.starts) - run + 1], self.stops[run - 1:]
        hashes = (sums[b] - sums[a]) * down[a]
        hashes ^= hashes >> np.uint64(29)
        hashes *= np.uint64(0xBF58476D1CE4E5B9)
        hashes ^= hashes >> np.uint64(32)
        least, covered, wanted = hashes, 1, window - run + 1
        while covered < wanted:
            step = min(covered, wanted - covered)
            least = np.minimum(least[:-step], least[step:])
            covered += step
        return least.view(np.int64)

    def runs(self) -> np.ndarray:
        """Where windows of one text begin to share an anchor, and the end."""
        return np.flatnonzero(np.r_[True, (self.own[1:] != self.own[:-1]) | (self.text[1:] != self.text[:-1]), True])


def pages(texts: list[bytes], size: int = 1 << 20) -> Iterator[Pages]:
    """All texts with a window, about ``size`` bytes at a time; longer texts in pieces that overlap by a window less one word."""
    entries, held = [], 0
    for k, text in enumerate(texts):
        words = text.split()
        for at in range(0, len(words) - WINDOW + 1, PIECE):
            entries.append((k, at, words[at:at + PIECE + WINDOW - 1]))
            held += len(text) if len(words) <= PIECE else size
            if held >= size:
                yield Pages(entries)
                entries, held = [], 0
    if entries:
        yield Pages(entries)


def _pairs(documents: DataFrame) -> DataFrame:
    """(anchor, id, hash): the anchors of a document, a few of them more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for page in pages(batch.column(2).to_pylist()):
                kept = page.runs()[:-1]
                rows = pa.array(page.text[kept], pa.int64())
                yield {"anchor": page.own[kept], "id": batch.column(0).take(rows), "hash": batch.column(1).take(rows)}

    return map_batches(documents, run, f"anchor long, id {documents.schema['id'].dataType.simpleString()}, hash long")


def _stretches(documents: DataFrame) -> DataFrame:
    """The words around each recurring anchor of a document: windows in a row that share it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            listed = [{r["anchor"]: r["hot"] for r in rows} for rows in batch.column(3).to_pylist()]
            for page in pages(batch.column(2).to_pylist()):
                edges = page.runs()
                begin, end = edges[:-1], edges[1:]
                out: dict = {name: [] for name in ("anchor", "hot", "row", "start", "n", "words")}
                places = zip(page.own[begin].tolist(), page.text[begin].tolist(), begin.tolist(), end.tolist(), page.at[begin].tolist(), page.word[begin].tolist())
                for anchor, k, a, b, start, word in places:
                    hot = listed[k].get(anchor)
                    if hot is None:
                        continue
                    for skip in range(0, b - a, STRETCH):
                        last = min(b - a, skip + STRETCH) + WINDOW - 2
                        out["anchor"].append(anchor)
                        out["hot"].append(hot)
                        out["row"].append(k)
                        out["start"].append(start + skip)
                        out["n"].append(last + 1 - skip)
                        out["words"].append(page.joined[page.starts[word + skip]:page.stops[word + last]])
                yield _with_ids(out, batch)

    kind = documents.schema["id"].dataType.simpleString()
    return map_batches(documents, run, f"anchor long, hot boolean, id {kind}, hash long, start long, n int, words binary")


def _with_ids(out: dict, batch: pa.RecordBatch) -> dict:
    rows = pa.array(out["row"], pa.int64())
    return out | {"id": batch.column(0).take(rows), "hash": batch.column(1).take(rows)}


class Shard:
    """Confirms phrases, compiles them, streams stretches. Rows come by anchor, then by id.

    A stretch that an earlier document has word for word is a confirmed passage as a whole. Every other one is
    streamed once through the automaton of the phrases confirmed with it, which says where they are.
    """

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.first: dict[tuple, object] = {}      # of the anchor at hand: window -> first id
        self.whole: dict[bytes, object] = {}      # of the anchor at hand: stretch -> first id
        self.recurring: dict[tuple, object] = {}  # confirmed since the last automaton
        self.waiting: list[tuple] = []
        self.found: list[tuple] = []              # (place, start, end) in words relative to the place

    def add(self, place: tuple, id_: object, text: bytes) -> None:
        known = self.whole.setdefault(text, id_)
        if known < id_:
            self.found.append((place, 0, text.count(b" ") + 1))
            return
        number = self.numbers
        words = tuple([number.setdefault(w, len(number)) for w in text.split(b" ")])
        for k in range(len(words) - WINDOW + 1):
            window = words[k:k + WINDOW]
            known = self.first.setdefault(window, id_)
            if known < id_:
                self.recurring[window] = known
        self.waiting.append((place, id_, words))

    def next_anchor(self) -> None:
        self.first, self.whole = {}, {}

    def search(self) -> list[tuple]:
        """Every occurrence in a later document since the last search."""
        if self.recurring:
            automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for window, first in self.recurring.items():
                automaton.add_word(window, first)
            automaton.make_automaton()
            for place, id_, words in self.waiting:
                start = end = None
                for last, first in automaton.iter(words):
                    if first < id_:
                        if end is not None and last - WINDOW + 1 <= end:
                            end = last + 1
                            continue
                        if end is not None:
                            self.found.append((place, start, end))
                        start, end = last - WINDOW + 1, last + 1
                if end is not None:
                    self.found.append((place, start, end))
        done, self.found, self.waiting, self.recurring = self.found, [], [], {}
        return done

    def forget_words(self) -> None:
        self.numbers = {}
        self.next_anchor()


def _locate(rows: DataFrame, shard_rows: int) -> DataFrame:
    """(anchor, id, hash, base, start, stop): words to remove, counted from ``base``. ``rows`` lie by anchor, then id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        shard, now = Shard(), None
        for batch in batches:
            out: dict = {name: [] for name in ("anchor", "id", "hash", "base", "start", "stop")}
            for a, i, h, base, text in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if a != now:
                    now = a
                    shard.next_anchor()
                    if len(shard.waiting) >= shard_rows:
                        _collect(shard, out)
                        shard.forget_words()
                shard.add((a, i, h, base), i, text)
                if len(shard.waiting) >= 4 * shard_rows:  # within one anchor: its phrases stay
                    _collect(shard, out)
            _collect(shard, out)
            yield out

    kind = rows.schema["id"].dataType.simpleString()
    return map_batches(rows, run, f"anchor long, id {kind}, hash long, base long, start long, stop long")


def _collect(shard: Shard, out: dict) -> None:
    for (a, i, h, base), start, stop in shard.search():
        for name, value in zip(out, (a, i, h, base, start, stop)):
            out[name].append(value)


def _windows(firsts: DataFrame) -> DataFrame:
    """(anchor, id, hash, start, window): every window of stretches (anchor, words, first), ``hash`` that of the stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows, start, made = [], [], []
                for row, text in enumerate(part.column(3).to_pylist()):
                    words = text.split(b" ")
                    count = len(words) - WINDOW + 1
                    rows += [row] * count
                    start += range(count)
                    made += [b" ".join(words[k:k + WINDOW]) for k in range(count)]
                taken = pa.array(rows, pa.int64())
                yield {name: part.column(k).take(taken) for k, name in enumerate(("anchor", "id", "hash"))} | {"start": start, "window": made}

    source = firsts.select("anchor", F.col("first").alias("id"), F.xxhash64("words").alias("hash"), "words")
    kind = source.schema["id"].dataType.simpleString()
    return map_batches(source, run, f"anchor long, id {kind}, hash long, start long, window binary")


def _locate_windows(firsts: DataFrame) -> DataFrame:
    """(anchor, id, hash, start, stop): windows of stretches that an earlier document has. No anchor meets in one task."""
    windows = _windows(firsts)
    recurring = settle_dense(
        windows.groupBy("anchor", "window").agg(F.min("id").alias("least"), F.max("id").alias("most"))
        .where("least < most").select("anchor", "window", "least"), "recurring-windows")
    release(firsts.sparkSession)
    return windows.join(recurring, ["anchor", "window"]).where("id > least").select(
        "anchor", "id", "hash", "start", (F.col("start") + WINDOW).alias("stop"))


def first_texts(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents (id, hash, text) that are the first of their text, and (id, hash) of the copies.

    The first ones are written once, bucketed by id and hash: what is found for them is joined without moving them.
    """
    spark = documents.sparkSession
    ids = documents.select("id", "hash")
    firsts = ids.groupBy("hash").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    # distinct first: nothing after the join needs the copies of a text together, so Spark can split a hot text
    copies = settle(ids.distinct().join(firsts, "hash").where("id > first").select("id", "hash"), "copies")
    buckets, path = int(spark.conf.get("spark.sql.shuffle.partitions")), work_path(spark, "first-texts")
    name = "first_texts_" + path[-32:]
    kept = documents.join(copies, ["id", "hash"], "left_anti").repartition(buckets, "id", "hash")
    kept.write.option("compression", "zstd").bucketBy(buckets, "id", "hash").option("path", path).saveAsTable(name)
    first = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the plan keeps its files and their buckets
    release(spark)
    return first, copies


def repeated_ranges(documents: DataFrame, common: int = 512, shard_rows: int = 2000) -> DataFrame:
    """(id, hash, ranges) of the documents (id, hash, text) with words to remove.

    ``common``: how many documents have an anchor before its stretches are added up and compared by windows,
    not in a shard; what goes is the same on either side of it. ``shard_rows``: stretches searched with one automaton.
    """
    spark = documents.sparkSession
    counted = _pairs(documents).groupBy("anchor").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n"))
    recurring = settle(counted.where("first < last").select("anchor", (F.col("n") > common).alias("hot")), "anchors")
    release(spark)
    listed = settle(
        _pairs(documents).join(recurring, "anchor").groupBy("id", "hash")
        .agg(F.collect_set(F.struct("anchor", "hot")).alias("anchors")), "document-anchors")
    release(spark)
    stretches = settle_dense(_stretches(documents.join(listed, ["id", "hash"]).select("id", "hash", "text", "anchors")), "stretches")
    release(spark)
    hot = stretches.where("hot")
    firsts = settle_dense(hot.groupBy("anchor", "words").agg(F.min("id").alias("first")), "first-stretches")
    rows = stretches.where("NOT hot").select("anchor", "id", "hash", F.col("start").alias("base"), "words")
    located = settle(_locate(rows.repartition("anchor").sortWithinPartitions("anchor", "id"), shard_rows), "located")
    release(spark)
    within = settle(_locate_windows(firsts), "located-windows")
    release(spark)
    direct = located.select("id", "hash", (F.col("base") + F.col("start")).alias("start"), (F.col("base") + F.col("stop")).alias("stop"))
    of_first = hot.withColumn("words_hash", F.xxhash64("words")).alias("h").join(
        within.alias("l"),
        F.expr("h.anchor = l.anchor AND h.words_hash = l.hash AND h.id = l.id")).select(
        "h.id", "h.hash", F.expr("h.start + l.start").alias("start"), F.expr("h.start + l.stop").alias("stop"))
    copies = hot.join(firsts, ["anchor", "words"]).where("id > first").select("id", "hash", "start", (F.col("start") + F.col("n")).alias("stop"))
    ranges = direct.union(of_first).union(copies).groupBy("id", "hash").agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))
    found = settle(ranges, "ranges")
    release(spark)
    return found


def keep_first(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", with_text: bool = False,
               common: int = 512, shard_rows: int = 2000) -> DataFrame:
    """``id``, ``n_words``, ``n_removed``, ``kept_sha256`` of every row, and ``kept`` (the text left) where asked for.

    A word goes if it lies in a window of 13 words that also starts in a document with a smaller id; what
    goes from one document does not change what is found in others. A row without id has no order among
    documents: it loses nothing and takes nothing. Rows of one id do not take from each other. Null is a text
    without words. Rows are told apart by id and 64-bit hash of the text, so equal rows share a result.
    """
    text = F.coalesce(named(text_column).cast("binary"), F.lit(b""))
    documents = df.select(named(id_column).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    first, copies = first_texts(documents.where("id IS NOT NULL"))
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.lit(WHOLE).cast("bigint").alias("stop")))
    found = repeated_ranges(first, common, shard_rows).union(copies.select("id", "hash", whole.alias("ranges")))
    joined = documents.join(found, ["id", "hash"], "left").select("id", "text", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            out: dict = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
            for content, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = content.split()
                left, at = [], 0
                for a, b in sorted((r["start"], r["stop"] if r["stop"] != WHOLE else len(words)) for r in ranges or ()):
                    if b - a < WINDOW:
                        continue  # a copy without a window
                    left += words[at:a]
                    at = max(at, b)
                left += words[at:]
                kept = b" ".join(left)
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(left))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept.decode("utf-8", "replace") if with_text else None)
            yield out | {"id": batch.column(0)}

    kind = documents.schema["id"].dataType.simpleString()
    return map_batches(joined, run, f"id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text)

"""Streams that keep a stored table up to date: sessions and the incremental index."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.scalars import session_expiry
from linkloom.operators import search as S
from linkloom.operators.documents import latest, page_documents
from linkloom.session import child_names, settle
from linkloom.sources.index_store import IndexStore
from linkloom.sources.snapshots import SnapshotTable
from linkloom.streaming.run import batch_name


def renew_sessions(sessions: SnapshotTable, when: str = "ts") -> Callable[[DataFrame, int], None]:
    """A micro-batch function over logins (token, user_id, id, ts): each renews its token for a day.

    A batch is known by its query and number, so one that is run again changes nothing. Logins of one token
    are reduced to the latest before they meet the table; a login that comes late shortens no session.
    """
    fallback = uuid.uuid4().hex  # for batches that come from no streaming query

    def handle(batch: DataFrame, number: int) -> None:
        renewed = batch.groupBy("token", "user_id", "id").agg(F.max(when).alias("_at"))
        held = sessions.read().groupBy("token").agg(F.max("expire_date").alias("_held"))
        renewed = renewed.join(held, "token", "left").withColumn(
            "expire_date", F.greatest(session_expiry(F.col("_at")).cast("timestamp_ntz"), F.col("_held"))
        )
        sessions.upsert(renewed, [F.col("expire_date").desc()], batch_name(batch, number, fallback))

    return handle


class PageIndexLog:
    """Documents and postings of arriving pages, one pair of folders per query and batch.

    A page that comes again replaces its document: the newest (seq) document of a url counts, and
    only its postings are live. Statistics follow from what is live, so they are exact after every
    batch. When the log grows long, ``rewrite`` keeps what is live in a new log, and ``compact``
    builds an ``IndexStore`` of it.
    """

    KEYS = ["index_name", "url"]
    DOCUMENTS = "index_name string, url string, content string, seq bigint, dl bigint"
    POSTINGS = "index_name string, url string, term string, tf bigint, dl bigint"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def handler(self, root: Callable[[], Column]) -> Callable[[DataFrame, int], None]:
        """A micro-batch function over pages (url, html, seq)."""
        fallback = uuid.uuid4().hex

        def handle(batch: DataFrame, number: int) -> None:
            newest = latest(batch.withColumn("_index", root()), ["_index", "url"], [F.col("seq")])
            docs = page_documents(newest, root(), "seq")
            name = "{}-{}".format(*batch_name(batch, number, fallback))
            folder = f"{self.path}/documents/batch={name}"
            length = F.size(S.tokens(F.col("content"))).cast("bigint")
            docs.withColumn("dl", length).write.mode("overwrite").parquet(folder)
            stored = self.spark.read.schema(self.DOCUMENTS).parquet(folder)
            S.postings(stored).write.mode("overwrite").parquet(f"{self.path}/postings/batch={name}")

        return handle

    def _log(self, part: str, schema: str) -> DataFrame:
        if not child_names(self.spark, f"{self.path}/{part}"):
            return self.spark.createDataFrame([], f"{schema}, batch string")
        return self.spark.read.schema(f"{schema}, batch string").parquet(f"{self.path}/{part}")

    def live(self) -> DataFrame:
        """(index_name, url, dl, batch) of the documents that count; texts are not read."""
        log = self._log("documents", self.DOCUMENTS).select(*self.KEYS, "seq", "dl", "batch")
        # of equal seq the later batch by its number counts; rows of a rewritten log came before all others
        number = F.coalesce(F.regexp_extract("batch", r"-(\d+)$", 1).try_cast("bigint"), F.lit(-1))
        return latest(log, self.KEYS, [F.col("seq"), number, F.col("batch")]).drop("seq")

    def documents(self) -> DataFrame:
        log = self._log("documents", self.DOCUMENTS)
        return log.join(self.live(), [*self.KEYS, "batch"], "left_semi").select(*self.KEYS, "content")

    def _live_postings(self, log: DataFrame) -> DataFrame:
        live = self.live().select(*self.KEYS, "batch")
        return log.join(live, [*self.KEYS, "batch"], "left_semi").select(*self.KEYS, "term", "tf", "dl")

    def postings(self) -> DataFrame:
        return self._live_postings(self._log("postings", self.POSTINGS))

    def totals(self) -> DataFrame:
        return S.corpus_totals(self.live().select(*self.KEYS, "dl"))

    def search_many(self, queries: DataFrame, deepest: int | None = None) -> DataFrame:
        """Scores and statistics both need the live postings of the query words: written once."""
        wanted = S.for_words(queries, self._log("postings", self.POSTINGS))
        small = settle(self._live_postings(wanted), "live")
        return S.search_many(queries, small, S.term_statistics(small), self.totals(), deepest)

    def rewrite(self, path: str) -> "PageIndexLog":
        """A log of the live documents only, as one batch before all others."""
        fresh = PageIndexLog(self.spark, path)
        live = self.live().select(*self.KEYS, "batch")
        for part, schema in (("documents", self.DOCUMENTS), ("postings", self.POSTINGS)):
            rows = self._log(part, schema).join(live, [*self.KEYS, "batch"], "left_semi").drop("batch")
            rows.write.mode("overwrite").parquet(f"{fresh.path}/{part}/batch=live")
        return fresh

    def compact(self, store: IndexStore) -> None:
        store.build(self.documents())

"""The service's messages over its stored tables: sign-up, login, session and index requests, several batches on."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.operators import sessions as N
from linkloom.session import joining_by_hash, path_exists
from linkloom.sources.snapshots import SnapshotTable
from linkloom.streaming.messages import decode_types, decoded_of
from linkloom.streaming.run import batch_name

OUTCOME = "message_id bigint, status string, message string"
SHOWN = f"{OUTCOME}, id bigint, email string, name string"
ACCEPTED = "message_id bigint, domain string, author_id bigint, outcome string"
KINDS = ["singup", "login", "current", "index"]


def spread_messages(batch: DataFrame) -> DataFrame:
    """The messages of a batch over all tasks: a batch may come as one file, which one task reads.

    They go by their whole content, so that ids that are missing or one busy type fill no task. A batch with a split
    for each core stays as it is.
    """
    if batch.rdd.getNumPartitions() >= batch.sparkSession.sparkContext.defaultParallelism:
        return batch
    return batch.repartition(F.xxhash64("message_id", "type", "body"))


class Service:
    """Users, tokens and crawl statistics with a folder of replies and accepted roots, (``out``).

    What a batch makes of its messages is written once, under the names of its query and number, before the
    tables change. A batch that is run again finds it, applies what is missing and answers the same. A kind that has
    no message in a batch costs nothing there: no table is read or written for it.
    """

    def __init__(self, users: SnapshotTable, tokens: SnapshotTable, stats: DataFrame, out: str):
        self.users, self.tokens, self.stats, self.out = users, tokens, stats, out.rstrip("/")

    def handler(self, as_of: Column | None = None, token: Column | None = None) -> Callable[[DataFrame, int], None]:
        """A micro-batch function over messages (message_id, type, body). A random ``token`` unless one is given."""
        fallback = uuid.uuid4().hex

        def handle(batch: DataFrame, number: int) -> None:
            with joining_by_hash(self.users.spark, batch.sparkSession):
                answer(batch, number)

        def answer(batch: DataFrame, number: int) -> None:
            name = batch_name(batch, number, fallback)
            # decoded before it is kept: each step reads its messages several times
            answered = spread_messages(batch.filter(F.col("type").isin(KINDS)))
            now, batch = N.moment(as_of), decode_types(answered, KINDS).persist()
            try:
                came = {r["type"] for r in batch.select("type").distinct().collect()}  # of KINDS
                if "singup" in came:
                    self._sign_up(decoded_of(batch, "singup"), name, now, token)
                if "login" in came:
                    self._log_in(decoded_of(batch, "login"), name, now, token)
                if "current" in came:
                    self._current(decoded_of(batch, "current"), name, now)
                if "index" in came:
                    self._index(decoded_of(batch, "index"), name, now)
            finally:
                batch.unpersist()

        return handle

    def _once(self, kind: str, name: tuple[str, int], make: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.out}/{kind}/batch={name[0]}-{name[1]}"
        if not path_exists(self.users.spark, f"{path}/_SUCCESS"):
            make().write.mode("overwrite").parquet(path)
        return self.users.spark.read.parquet(path)

    def _sign_up(self, asked: DataFrame, name: tuple[str, int], now: Column, token: Column | None) -> None:
        signed = N.sign_up(asked, self.users.read(), now, token=token, keep=lambda named: self._once("signed-up", name, lambda: named))
        self._once("signup", name, lambda: signed.outcomes.select("message_id", "status", "message"))
        self.users.append(signed.new_users, batch=name)  # their ids follow the largest one
        mark = (f"{name[0]}-signup", name[1])
        if token is None:
            self.tokens.append(signed.new_tokens, batch=mark)  # drawn, so not in the table
        else:
            self.tokens.upsert(signed.new_tokens, batch=mark)

    def _log_in(self, asked: DataFrame, name: tuple[str, int], now: Column, token: Column | None) -> None:
        mark = (f"{name[0]}-login", name[1])
        if self.tokens.applied(mark) is not None:
            return
        logged = N.log_in(asked, self.users.read(), self.tokens.read(), now, token=token)
        renewed = self._once("login-tokens", name, lambda: logged.renewed)
        self._once("login", name, lambda: logged.outcomes.select("message_id", "status", "message"))
        self.tokens.upsert(renewed, batch=mark)

    def _current(self, asked: DataFrame, name: tuple[str, int], now: Column) -> None:
        """Who a token belongs to, by the tables after the batch's sign-ups and logins."""
        self._once("current", name, lambda: N.check_sessions(asked, self._tokens_of(asked), self.users.read(), now).select(
            "message_id", "status", "message", "id", "email", "name"))

    def _index(self, asked: DataFrame, name: tuple[str, int], now: Column) -> None:
        self._once("index", name, lambda: N.index_requests(asked, self._tokens_of(asked), self.stats, now))

    def _tokens_of(self, asked: DataFrame) -> DataFrame:
        """The tokens that requests give: what is made of them follows the batch, not the table."""
        return self.tokens.read().join(asked.select("token").distinct(), "token", "left_semi")

    def replies(self, kind: str) -> DataFrame:
        """Outcomes of 'signup', 'login', 'current' or 'index' messages so far."""
        schema = {"index": ACCEPTED, "current": SHOWN}.get(kind, OUTCOME)
        if not path_exists(self.users.spark, f"{self.out}/{kind}"):
            return self.users.spark.createDataFrame([], schema)
        return self.users.spark.read.schema(f"{schema}, batch string").parquet(f"{self.out}/{kind}").drop("batch")

    def accepted_roots(self) -> DataFrame:
        """(root, author_id) of the index requests to crawl."""
        return self.replies("index").filter("outcome = 'accepted'").select(F.col("domain").alias("root"), "author_id").distinct()

"""Messages between services: bodies, dispatch by type, replies matched to requests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.scalars import decode_body, encode_body, random_id

# Message types and the fields of their bodies.
BODIES = {
    "singup": "email string, password string, name string",
    "login": "email string, password string",
    "current": "token string",
    "index": "domain string, token string",
    "search": "q string, limit int, offset int",
}


def request_messages(df: DataFrame, kind: Column, message_id: Column | None = None, **body: Column) -> DataFrame:
    """(message_id, type, body) for every row; ids are random unless given."""
    return df.select(
        (random_id() if message_id is None else message_id).alias("message_id"),
        kind.alias("type"),
        encode_body(**body).alias("body"),
    )


def reply_messages(df: DataFrame, status: Column, **data: Column) -> DataFrame:
    """(message_id, status, body) with a body of status and nested data."""
    inner = F.struct(*[c.alias(n) for n, c in data.items()])
    return df.select(
        "message_id", status.alias("status"), encode_body(status=status, data=inner).alias("body")
    )


def of_type(messages: DataFrame, kind: str) -> DataFrame:
    """The messages of one type with their decoded body fields as columns."""
    decoded = decode_body(F.col("body"), BODIES[kind]).alias("_body")
    return messages.filter(F.col("type") == kind).select("message_id", decoded).select("message_id", "_body.*")


def decode_types(messages: DataFrame, kinds: list[str]) -> DataFrame:
    """(message_id, type) and for each kind a column with the decoded bodies of its messages.

    Meant to be stored or persisted: what reads ``decoded_of`` it parses no body again, while each field and
    condition on top of ``of_type`` may become another parse of the body.
    """
    bodies = [F.when(F.col("type") == k, decode_body(F.col("body"), BODIES[k])).alias(k) for k in kinds]
    return messages.select("message_id", "type", *bodies)


def decoded_of(decoded: DataFrame, kind: str) -> DataFrame:
    """``of_type`` of messages that ``decode_types`` decoded."""
    return decoded.filter(F.col("type") == kind).select("message_id", f"{kind}.*")


def dispatcher(
    handlers: dict[str, Callable[[DataFrame], DataFrame]], out: str
) -> Callable[[DataFrame, int], None]:
    """A micro-batch function: each known type goes to its handler, other types are ignored.

    Handlers turn decoded messages into replies (message_id, status, body). Replies of a batch and
    type overwrite their own folder, so a batch that is run again leaves one copy.
    """

    def handle(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            for kind, answer in handlers.items():
                replies = answer(of_type(batch, kind)).select("message_id", "status", "body")
                replies.write.mode("overwrite").parquet(f"{out}/batch={number}/type={kind}")
        finally:
            batch.unpersist()

    return handle


def match_replies(
    requests: DataFrame, replies: DataFrame, requested: str, replied: str, patience: str = "10 minutes"
) -> DataFrame:
    """Requests with the reply of the same message id.

    The reply must come within ``patience`` after the request, which bounds the state.
    """
    return _paired(requests, replies, requested, replied, patience, "inner")


def answered_or_not(
    requests: DataFrame, replies: DataFrame, requested: str, replied: str, patience: str = "10 minutes"
) -> DataFrame:
    """Every request once with its ``outcome``: 'answered' with the reply, or 'timeout' without one.

    A timeout is released when the watermarks of both streams have passed the request by ``patience``: from then
    on no reply can count. A reply that comes after its watermark is dropped, and its request has timed out.
    """
    paired = _paired(requests, replies, requested, replied, patience, "left_outer")
    return paired.withColumn("outcome", F.when(F.col(replied).isNull(), F.lit("timeout")).otherwise(F.lit("answered")))


def _paired(requests: DataFrame, replies: DataFrame, requested: str, replied: str, patience: str, how: str) -> DataFrame:
    asked = requests.withWatermark(requested, patience)
    answers = replies.withColumnRenamed("message_id", "_reply_id").withWatermark(replied, patience)
    match = (
        (F.col("message_id") == F.col("_reply_id"))
        & (F.col(replied) >= F.col(requested))
        & (F.col(replied) <= F.col(requested) + F.expr(f"interval {patience}"))
    )
    return asked.join(answers, match, how).drop("_reply_id")

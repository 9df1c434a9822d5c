"""Chat events: which to answer, and how."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.scalars import coupon_number, coupon_url

# Fixed values of the chat.
NEW_MESSAGE = "message_new"
COUPON_PHRASE = "Сгенерировать купон"
PROMPT = "Для генерации, нажмите кнопку"


def to_answer(kind: Column, to_me: Column, text: Column) -> Column:
    """A new message to the bot with some text."""
    return (kind == NEW_MESSAGE) & to_me & (F.length(text) > 0)


def action(text: Column, phrase: str = COUPON_PHRASE) -> Column:
    return F.when(text == phrase, F.lit("coupon")).otherwise(F.lit("prompt"))


def route(events: DataFrame, phrase: str = COUPON_PHRASE, passing: tuple[str, ...] = ()) -> DataFrame:
    """(user_id, action, message) for events (type, to_me, from_user, text, user_id); stateless.

    The coupon phrase is answered by a coupon address, any other text of a user by the prompt.
    """
    asked = events.filter(to_answer(F.col("type"), F.col("to_me"), F.col("text")) & F.col("from_user"))
    keys = [F.col("user_id"), *[F.col(p) for p in passing]]
    chosen = action(F.col("text"), phrase)
    return asked.select(
        "user_id",
        *passing,
        chosen.alias("action"),
        F.when(chosen == "coupon", coupon_url(coupon_number(*keys))).otherwise(F.lit(PROMPT)).alias("message"),
    )

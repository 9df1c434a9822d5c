"""Sign-up, login, session checks and index requests as set-wise joins.

Tables follow the models USER, TOKEN and CRAWLER_STATS; the password column holds a digest.
``as_of`` is a timestamp Column, by default the time of the call. A new session's token is a Column over
``user_id``, by default a random one: what can be computed from the id could be forged. The tables are joined with each other first, to one row per key, and
then once with the requests, the large side: it is shuffled once, Spark splits a hot key in it, and
requests without a key are spread (``join_keeping``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.scalars import is_fresh, random_id, session_expiry, still_valid
from linkloom.operators.requests import token_outcome
from linkloom.operators.ranks import join_keeping, running_number
from linkloom.operators.rows import upsert
from linkloom.session import settle

# The texts of the outcomes.
BAD_LOGIN = "password or email not correct"
BAD_TOKEN = "token is not valid"
EXPIRED = "token is expire"
FORBIDDEN = "forbidden"
TAKEN = "email is taken"
MISSING = "missing parameter"
NO_STATS = "no statistics"


def moment(as_of: Column | None) -> Column:
    """The time given, or the time of this call, the same for all that is made of it."""
    return F.lit(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz") if as_of is None else as_of


def credential(password: Column) -> Column:
    """What is stored and compared instead of the password."""
    return F.sha2(password, 256)


def _one_per(df: DataFrame, key: str, order: str, *columns: str) -> DataFrame:
    """One row per key, the one with the smallest order; partial before the shuffle.

    Each column by itself: Spark adds up numbers and times by hash, but would sort all rows for a struct of them. All
    of them compare the same orders in the same turn, so they are of one row.
    """
    return df.groupBy(key).agg(*[F.min_by(c, F.col(order)).alias(c) for c in columns])


class SignUp(NamedTuple):
    outcomes: DataFrame
    new_users: DataFrame
    new_tokens: DataFrame


def sign_up(
    requests: DataFrame,
    users: DataFrame,
    as_of: Column | None = None,
    first_id: Column | None = None,
    token: Column | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> SignUp:
    """Requests (message_id, email, password, name) against the users.

    The smallest message id wins an email within the batch; an email already taken or lost to
    another request is refused. A winner gets the next user id and a one-day token. A random token is drawn once
    and written, so that outcomes and tokens agree; ``keep`` says where, it writes what the requests got and reads it.
    """
    as_of = moment(as_of)
    requests = requests.select("message_id", "email", "password", "name")
    whole = F.col("email").isNotNull() & F.col("password").isNotNull() & F.col("name").isNotNull()
    open_emails = (
        requests.filter(whole)
        .groupBy("email")
        .agg(F.min("message_id").alias("message_id"))
        .join(users.select("email"), "email", "left_anti")
    )
    # written before they are numbered: bounds are sampled first, which would make the join twice
    winners = running_number(settle(open_emails.select("message_id"), "open-emails"), [], [F.col("message_id")], "_place")
    top = users.agg(F.coalesce(F.max("id"), F.lit(-1))).scalar() if first_id is None else first_id - 1
    winners = winners.select("message_id", (top + F.col("_place")).cast("bigint").alias("user_id"))
    won = F.col("user_id").isNotNull()
    named = requests.join(winners, "message_id", "left").withColumns({
        "token": F.when(won, random_id() if token is None else token),
        "expire_date": F.when(won, session_expiry(as_of)),
        # no password is written: of the others only whether there was one
        "password": F.when(won, credential(F.col("password"))).otherwise(F.substring("password", 1, 0)),
    })
    if keep is not None:
        named = keep(named)
    elif token is None:
        named = settle(named, "signed-up")
    outcomes = named.select(
        "message_id",
        F.when(F.col("user_id").isNotNull(), F.lit("Ok")).otherwise(F.lit("error")).alias("status"),
        F.when(~whole, F.lit(MISSING)).when(F.col("user_id").isNull(), F.lit(TAKEN)).alias("message"),
        "token",
        "expire_date",
    )
    made = named.filter(F.col("user_id").isNotNull())
    new_users = made.select(
        F.col("user_id").alias("id"),
        "email",
        "password",
        "name",
        as_of.alias("created_date"),
        as_of.alias("last_login_date"),
    )
    new_tokens = made.select("token", "user_id", "expire_date", F.col("user_id").alias("id"))
    return SignUp(outcomes, new_users, new_tokens)


class LogIn(NamedTuple):
    outcomes: DataFrame
    tokens: DataFrame
    users: DataFrame
    renewed: DataFrame


def log_in(
    requests: DataFrame,
    users: DataFrame,
    tokens: DataFrame,
    as_of: Column | None = None,
    touch_login: bool = False,
    token: Column | None = None,
) -> LogIn:
    """Requests (message_id, email, password) against users and tokens.

    A wrong pair gives an error outcome. A user keeps the token they have, or gets one, and its
    life is a day from ``as_of``. ``tokens`` of the result is the whole table after the change, ``renewed`` the rows
    that are new in it. A random token is drawn once for a user and written.
    """
    as_of = moment(as_of)
    asked = requests.select("message_id", "email", credential(F.col("password")).alias("_digest"))
    known = users.select(F.col("id").alias("user_id"), "email", F.col("password").alias("_digest"))
    # only users that log in: what is written follows the requests, not the users, and the requests need not be
    # brought down to users again
    known = known.join(asked.select("email", "_digest").distinct(), ["email", "_digest"], "left_semi")
    # written: both the search for their tokens and the join with them need it
    # the smallest id of a pair, none where one is missing; a sum by hash, where a row number would sort the users
    first = F.when(~F.max(F.col("user_id").isNull()), F.min("user_id")).alias("user_id")
    known = settle(known.groupBy("email", "_digest").agg(first), "logging-in")
    held = _one_per(tokens.join(known.select("user_id"), "user_id", "left_semi"), "user_id", "id", "token", "id")
    known = known.join(held, "user_id", "left").withColumn(
        "token", F.coalesce("token", random_id() if token is None else token)
    )
    known = settle(known, "logged-in") if token is None else known
    given = join_keeping(asked, known, ["email", "_digest"], "message_id")
    expire = session_expiry(as_of)
    good = F.col("user_id").isNotNull()
    outcomes = given.select(
        "message_id",
        F.when(good, F.lit("Ok")).otherwise(F.lit("error")).alias("status"),
        F.when(~good, F.lit(BAD_LOGIN)).alias("message"),
        "token",
        F.when(good, expire).alias("expire_date"),
    )
    came = known.filter(good)
    renewed = came.select("token", "user_id", expire.alias("expire_date"), F.coalesce("id", "user_id").alias("id"))
    after = upsert(tokens, renewed, ["token"])
    seen_users = users
    if touch_login:
        came = came.select(F.col("user_id").alias("id")).distinct()
        marked = users.join(came.withColumn("_came", F.lit(True)), "id", "left")
        seen_users = marked.withColumn(
            "last_login_date", F.when(F.col("_came"), as_of).otherwise(F.col("last_login_date"))
        ).select(*users.columns)
    return LogIn(outcomes, after, seen_users, renewed)


def check_sessions(requests: DataFrame, tokens: DataFrame, users: DataFrame, as_of: Column | None = None) -> DataFrame:
    """(message_id, status, message, id, email, name, created_date, last_login_date).

    No token is 'forbidden', an unknown one 'token is not valid', one at or past its expiry
    'token is expire'; otherwise the user is shown, without the password.
    """
    known = _one_per(tokens, "token", "id", "user_id", "expire_date")
    shown = users.select("id", "email", "name", "created_date", "last_login_date")
    known = known.join(shown, F.col("user_id") == F.col("id"), "left")
    joined = join_keeping(requests.select("message_id", "token"), known, ["token"], "message_id")
    valid = F.coalesce(still_valid(F.col("expire_date"), moment(as_of)), F.lit(False))
    message = (
        F.when(F.col("token").isNull(), F.lit(FORBIDDEN))
        .when(F.col("expire_date").isNull(), F.lit(BAD_TOKEN))
        .when(~valid, F.lit(EXPIRED))
    )
    return joined.select(
        "message_id",
        F.when(message.isNull(), F.lit("Ok")).otherwise(F.lit("error")).alias("status"),
        message.alias("message"),
        *[F.when(message.isNull(), F.col(c)).alias(c) for c in shown.columns],
    )


def fresh_domains(stats: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Domains whose last crawl lies less than 30 days back."""
    last = stats.groupBy("domain").agg(F.max("time").alias("time"))
    return last.filter(is_fresh(F.col("time"), moment(as_of))).select("domain")


def not_fresh(requests: DataFrame, stats: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Requests for domains that are due; a domain never crawled is."""
    return requests.join(fresh_domains(stats, as_of), "domain", "left_anti")


def index_requests(requests: DataFrame, tokens: DataFrame, stats: DataFrame, as_of: Column | None = None) -> DataFrame:
    """(message_id, domain, author_id, outcome) for requests (message_id, token, domain).

    'accepted' requests are crawled for the owner of the token; 'fresh' ones were crawled lately.
    """
    known = _one_per(tokens, "token", "id", "user_id")
    fresh = fresh_domains(stats, as_of).withColumn("_fresh", F.lit(True))
    asked = requests.select("message_id", "token", "domain")
    joined = join_keeping(join_keeping(asked, known, ["token"], "message_id"), fresh, ["domain"], "message_id")
    outcome = (
        F.when(F.col("token").isNull(), F.lit(FORBIDDEN))
        .when(F.col("domain").isNull(), F.lit(MISSING))
        .when(F.col("user_id").isNull(), F.lit(BAD_TOKEN))
        .when(F.col("_fresh"), F.lit("fresh"))
        .otherwise(F.lit("accepted"))
    )
    return joined.select("message_id", "domain", F.col("user_id").alias("author_id"), outcome.alias("outcome"))


def stats_outcome(requests: DataFrame, tokens: DataFrame, stats: DataFrame) -> DataFrame:
    """(message_id, status, message, domain, author_id, time, pages_count): an answer to every request.

    No token is 'forbidden', an unknown one 'token is not valid'; an author without statistics gets an answer
    without a row.
    """
    known = _one_per(tokens, "token", "id", "user_id")
    first = _one_per(stats, "author_id", "domain", "domain", "time", "pages_count")
    seen = known.join(first, F.col("user_id") == F.col("author_id"), "left")
    joined = join_keeping(requests.select("message_id", "token"), seen, ["token"], "message_id")
    message = token_outcome(F.col("token"))
    message = F.coalesce(message, F.when(F.col("user_id").isNull(), F.lit(BAD_TOKEN)), F.when(F.col("author_id").isNull(), F.lit(NO_STATS)))
    refused = F.col("user_id").isNull()
    return joined.select(
        "message_id",
        F.when(refused, F.lit("error")).otherwise(F.lit("Ok")).alias("status"),
        message.alias("message"),
        "domain", "author_id", "time", "pages_count",
    )


def crawl_stats_of(requests: DataFrame, tokens: DataFrame, stats: DataFrame) -> DataFrame:
    """(message_id, domain, author_id, time, pages_count): the first statistics row (by domain) of
    the author a token belongs to."""
    known = _one_per(tokens, "token", "id", "user_id")
    first = _one_per(stats, "author_id", "domain", "domain", "time", "pages_count")
    seen = known.join(first, F.col("user_id") == F.col("author_id"))
    return join_keeping(requests.select("message_id", "token"), seen, ["token"], "message_id").filter("author_id IS NOT NULL").select(
        "message_id", "domain", "author_id", "time", "pages_count"
    )

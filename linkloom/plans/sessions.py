"""Sessions over customers: the event user or the order's customer asks, tokens come from orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkloom.functions import scalars as C
from linkloom.operators import sessions as N
from linkloom.operators.schema import USER, text_times
from linkloom.operators.stats import crawl_statistics
from linkloom.plans.links import shipped
from linkloom.plans.registry import query
from linkloom.sources.tables import table

AS_OF = "2001-07-25 12:00:00"
AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"

USERS_SQL = """
SELECT c_custkey AS id, lower(c_name) || '@mail.test' AS email, sha256(c_name) AS password, c_name AS name,
       min(o_orderdate) AS created_date, max(o_orderdate) AS last_login_date
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name
"""
TOKENS_SQL = """
SELECT md5('token|' || o_custkey) AS token, o_custkey AS user_id,
       max(o_orderdate) + INTERVAL 1 DAY AS expire_date, o_custkey AS id
FROM orders GROUP BY o_custkey
"""
REQUESTS_SQL = """
SELECT event_id AS message_id,
       CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN 'no|' || user_id
            ELSE md5('token|' || user_id) END AS token
FROM events
"""


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def token_of(user):
    return C.repeatable_id(F.lit("token"), user)


def order_dates(spark, sf):
    """The first and the last order of each customer."""
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))


def users(spark, sf, dates=None):
    dates = order_dates(spark, sf) if dates is None else dates
    dates = dates.select(F.col("o_custkey").alias("c_custkey"), F.col("first").alias("created_date"), F.col("last").alias("last_login_date"))
    return table(spark, sf, "customer").join(dates, "c_custkey", "left").select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lower("c_name"), F.lit("@mail.test")).alias("email"),
        N.credential(F.col("c_name")).alias("password"),
        F.col("c_name").alias("name"),
        "created_date",
        "last_login_date",
    )


def tokens(spark, sf, dates=None):
    dates = order_dates(spark, sf) if dates is None else dates
    return dates.select(
        token_of(F.col("o_custkey")).alias("token"),
        F.col("o_custkey").alias("user_id"),
        C.session_expiry(F.col("last")).alias("expire_date"),
        F.col("o_custkey").alias("id"),
    )


def token_requests(spark, sf):
    kind = F.col("event_type")
    token = F.when(kind == "signup", F.concat(F.lit("no|"), F.col("user_id").cast("string"))).when(
        kind != "error", token_of(F.col("user_id"))
    )
    return table(spark, sf, "events").select(F.col("event_id").alias("message_id"), token.alias("token"))


_CHECK_SQL = f"""
SELECT message_id, CASE WHEN message IS NULL THEN 'Ok' ELSE 'error' END AS status, message,
       CASE WHEN message IS NULL THEN id END AS id, CASE WHEN message IS NULL THEN email END AS email,
       CASE WHEN message IS NULL THEN name END AS name, CASE WHEN message IS NULL THEN created_date END AS created_date,
       CASE WHEN message IS NULL THEN last_login_date END AS last_login_date
FROM (SELECT r.message_id, u.*, CASE WHEN r.token IS NULL THEN 'forbidden' WHEN t.token IS NULL THEN 'token is not valid'
             WHEN NOT t.expire_date > {AS_OF_SQL} THEN 'token is expire' END AS message
      FROM ({REQUESTS_SQL}) r LEFT JOIN ({TOKENS_SQL}) t USING (token) LEFT JOIN ({USERS_SQL}) u ON u.id = t.user_id)
"""


@query(_CHECK_SQL)
def session_check(spark, sf):
    return N.check_sessions(token_requests(spark, sf), tokens(spark, sf), users(spark, sf), as_of())


@query(f"""
SELECT coalesce(message, 'Ok') AS outcome, count(*) AS requests FROM ({_CHECK_SQL}) GROUP BY ALL
""")
def session_bulk(spark, sf):
    checked = N.check_sessions(token_requests(spark, sf), tokens(spark, sf), users(spark, sf), as_of())
    return checked.groupBy(F.coalesce("message", F.lit("Ok")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("requests")
    )


_NAME_SQL = "'Customer#' || lpad(CAST({} AS VARCHAR), 9, '0')"
_LOGINS_SQL = f"""
SELECT o_orderkey AS message_id, lower({_NAME_SQL.format("o_custkey")}) || '@mail.test' AS email,
       CASE WHEN o_orderstatus = 'F' THEN 'wrong' ELSE {_NAME_SQL.format("o_custkey")} END AS password
FROM orders
"""
# only customers in credit hold a token before they log in
_HELD_SQL = f"SELECT t.* FROM ({TOKENS_SQL}) t JOIN customer ON c_custkey = user_id WHERE c_acctbal > 5000"


def _customer_name(key):
    return F.concat(F.lit("Customer#"), F.lpad(key.cast("string"), 9, "0"))


def _logins(spark, sf):
    name = _customer_name(F.col("o_custkey"))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("message_id"),
        F.concat(F.lower(name), F.lit("@mail.test")).alias("email"),
        F.when(F.col("o_orderstatus") == "F", F.lit("wrong")).otherwise(name).alias("password"),
    )


def _held(spark, sf):
    rich = table(spark, sf, "customer").filter("c_acctbal > 5000").select(F.col("c_custkey").alias("user_id"))
    held = tokens(spark, sf).join(rich, "user_id", "left_semi")
    return held.select("token", "user_id", "expire_date", "id")


_MATCHED_SQL = f"""
SELECT r.message_id, u.id AS user_id,
       CASE WHEN u.id IS NOT NULL THEN coalesce(h.token, md5('token|' || u.id)) END AS token
FROM ({_LOGINS_SQL}) r LEFT JOIN ({USERS_SQL}) u ON u.email = r.email AND u.password = sha256(r.password)
LEFT JOIN ({_HELD_SQL}) h ON h.user_id = u.id
"""


@query(f"""
SELECT message_id, CASE WHEN user_id IS NULL THEN 'error' ELSE 'Ok' END AS status,
       CASE WHEN user_id IS NULL THEN 'password or email not correct' END AS message, token,
       CASE WHEN user_id IS NOT NULL THEN {AS_OF_SQL} + INTERVAL 1 DAY END AS expire_date
FROM ({_MATCHED_SQL})
""")
def login_outcome(spark, sf):
    return N.log_in(_logins(spark, sf), users(spark, sf), _held(spark, sf), as_of(), token=token_of(F.col("user_id"))).outcomes


@query(f"""
WITH renewed AS (SELECT DISTINCT token, user_id, {AS_OF_SQL} + INTERVAL 1 DAY AS expire_date, user_id AS id
                 FROM ({_MATCHED_SQL}) WHERE user_id IS NOT NULL)
SELECT * FROM ({_HELD_SQL}) WHERE token NOT IN (SELECT token FROM renewed)
UNION ALL SELECT * FROM renewed
""")
def login_tokens(spark, sf):
    """The tokens after all logins: renewed, new and untouched ones."""
    return N.log_in(_logins(spark, sf), users(spark, sf), _held(spark, sf), as_of(), token=token_of(F.col("user_id"))).tokens


@query(f"""
SELECT id, email, name, created_date,
       CASE WHEN id IN (SELECT user_id FROM ({_MATCHED_SQL}) WHERE user_id IS NOT NULL) THEN {AS_OF_SQL}
            ELSE last_login_date END AS last_login_date
FROM ({USERS_SQL})
""")
def login_users(spark, sf):
    """The users with their last login brought up to date, which is optional."""
    after = N.log_in(_logins(spark, sf), users(spark, sf), _held(spark, sf), as_of(), touch_login=True, token=token_of(F.col("user_id"))).users
    return after.drop("password")


_SIGNUPS_SQL = f"""
SELECT o_orderkey AS message_id, lower({_NAME_SQL.format("o_custkey + 700")}) || '@mail.test' AS email,
       nullif(o_orderstatus, 'P') AS password, o_orderpriority AS name
FROM orders
"""
_WINNERS_SQL = f"""
SELECT message_id, row_number() OVER (ORDER BY message_id) + (SELECT max(c_custkey) FROM customer) AS user_id FROM (
  SELECT email, min(message_id) AS message_id FROM ({_SIGNUPS_SQL})
  WHERE password IS NOT NULL AND email NOT IN (SELECT lower(c_name) || '@mail.test' FROM customer) GROUP BY email)
"""


def _sign_ups(spark, sf):
    name = _customer_name(F.col("o_custkey") + 700)
    requests = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("message_id"),
        F.concat(F.lower(name), F.lit("@mail.test")).alias("email"),
        F.expr("nullif(o_orderstatus, 'P')").alias("password"),
        F.col("o_orderpriority").alias("name"),
    )
    return N.sign_up(requests, users(spark, sf), as_of(), token=token_of(F.col("user_id")))


@query(f"""
SELECT message_id, CASE WHEN user_id IS NULL THEN 'error' ELSE 'Ok' END AS status,
       CASE WHEN password IS NULL THEN 'missing parameter' WHEN user_id IS NULL THEN 'email is taken' END AS message,
       CASE WHEN user_id IS NOT NULL THEN md5('token|' || user_id) END AS token,
       CASE WHEN user_id IS NOT NULL THEN {AS_OF_SQL} + INTERVAL 1 DAY END AS expire_date
FROM ({_SIGNUPS_SQL}) LEFT JOIN ({_WINNERS_SQL}) USING (message_id)
""")
def signup_outcome(spark, sf):
    return _sign_ups(spark, sf).outcomes


@query(f"""
SELECT user_id AS id, email, sha256(password) AS password, name, {AS_OF_SQL} AS created_date,
       {AS_OF_SQL} AS last_login_date
FROM ({_SIGNUPS_SQL}) JOIN ({_WINNERS_SQL}) USING (message_id)
""")
def signup_users(spark, sf):
    return _sign_ups(spark, sf).new_users


_STATS_SQL = """
SELECT s_name AS domain, CAST(s_nationkey AS BIGINT) AS author_id, max(l_shipdate) AS time, count(*) AS pages_count
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL
"""


@query(f"""
SELECT c_custkey AS message_id, domain, author_id, time, pages_count
FROM customer JOIN (
  SELECT *, row_number() OVER (PARTITION BY author_id ORDER BY domain) AS place FROM ({_STATS_SQL}))
ON author_id = c_nationkey WHERE place = 1
""")
def stats_by_author(spark, sf):
    """Customers ask with the token of their nation for its first statistics row."""
    requests = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("message_id"), token_of(F.col("c_nationkey")).alias("token")
    )
    nation = F.col("n_nationkey")
    held = table(spark, sf, "nation").select(
        token_of(nation).alias("token"), nation.cast("bigint").alias("user_id"),
        as_of().alias("expire_date"), nation.cast("bigint").alias("id"),
    )
    return N.crawl_stats_of(requests, held, crawl_statistics(shipped(spark, sf)))


_CRAWLED_SQL = "SELECT o_custkey AS domain, max(o_orderdate) AS time FROM orders GROUP BY 1"


@query(f"""
SELECT c_name AS domain, c_custkey FROM customer
WHERE c_custkey NOT IN (SELECT domain FROM ({_CRAWLED_SQL}) WHERE time + INTERVAL 30 DAY > {AS_OF_SQL})
""")
def fresh_skip(spark, sf):
    """Customers whose last order is not fresh; the order stands for the last crawl."""
    requests = table(spark, sf, "customer").select(F.col("c_name").alias("domain"), "c_custkey")
    return N.not_fresh(requests, _crawled(spark, sf), as_of())


def _crawled(spark, sf):
    return table(spark, sf, "orders").select(
        _customer_name(F.col("o_custkey")).alias("domain"), F.col("o_orderdate").alias("time")
    )


@query(f"""
SELECT message_id, {_NAME_SQL.format("r.user_id")} AS domain, h.user_id AS author_id,
       CASE WHEN r.token IS NULL THEN 'forbidden' WHEN h.user_id IS NULL THEN 'token is not valid'
            WHEN time + INTERVAL 30 DAY > {AS_OF_SQL} THEN 'fresh' ELSE 'accepted' END AS outcome
FROM (SELECT r.*, e.user_id FROM ({REQUESTS_SQL}) r JOIN events e ON event_id = message_id) r
LEFT JOIN ({TOKENS_SQL}) h ON h.token = r.token LEFT JOIN ({_CRAWLED_SQL}) c ON c.domain = r.user_id
""")
def index_requests(spark, sf):
    domains = table(spark, sf, "events").select(
        F.col("event_id").alias("message_id"), _customer_name(F.col("user_id")).alias("domain")
    )
    requests = token_requests(spark, sf).join(domains, "message_id")
    return N.index_requests(requests, tokens(spark, sf), _crawled(spark, sf), as_of())


@query(f"""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS issued, o_orderdate + INTERVAL 1 DAY AS expire_date,
       o_orderdate + INTERVAL 1 DAY > {AS_OF_SQL} AS valid, o_orderdate + INTERVAL 30 DAY > {AS_OF_SQL} AS fresh
FROM orders
""")
def expiry(spark, sf):
    """Times to text and back, expiry a day later, validity and freshness at a given time."""
    issued = C.format_time(F.col("o_orderdate"))
    parsed = table(spark, sf, "orders").select("o_orderkey", issued.alias("issued")).withColumn(
        "expire_date", C.session_expiry(C.parse_time(F.col("issued")))
    )
    return parsed.select(
        "o_orderkey",
        "issued",
        "expire_date",
        C.still_valid(F.col("expire_date"), as_of()).alias("valid"),
        C.is_fresh(C.parse_time(F.col("issued")), as_of()).alias("fresh"),
    )


@query(f"""
SELECT id, email, password, name, strftime(created_date, '%Y-%m-%d %H:%M:%S') AS created_date,
       strftime(last_login_date, '%Y-%m-%d %H:%M:%S') AS last_login_date
FROM ({USERS_SQL})
""")
def times_as_text(spark, sf):
    return text_times(users(spark, sf), USER)


@query("""
SELECT c_custkey, CAST('0x' || substr(md5(c_custkey || '|' || c_name), 1, 5) AS BIGINT) AS code,
       'http://getcolor.ru/#' || CASE WHEN length(CAST(CAST('0x' || substr(md5(c_custkey || '|' || c_name), 1, 5) AS BIGINT) AS VARCHAR)) >= 6
         THEN CAST(CAST('0x' || substr(md5(c_custkey || '|' || c_name), 1, 5) AS BIGINT) AS VARCHAR)
         ELSE rpad(CAST(CAST('0x' || substr(md5(c_custkey || '|' || c_name), 1, 5) AS BIGINT) AS VARCHAR), 6, '0') END AS coupon
FROM customer
""")
def issue_codes(spark, sf):
    coded = table(spark, sf, "customer").select(
        "c_custkey", C.coupon_number(F.col("c_custkey"), F.col("c_name")).alias("code")
    )
    return coded.withColumn("coupon", C.coupon_url(F.col("code")))


@query("""
SELECT event_id, CAST(props ->> '$.k' AS INTEGER) AS k, '{"k":' || (props ->> '$.k') || ',"status":"' || event_type || '"}' AS body,
       event_type AS status
FROM events
""")
def json_round(spark, sf):
    """A body decoded, encoded with a status, and the status read back."""
    decoded = table(spark, sf, "events").select(
        "event_id", "event_type", C.decode_body(F.col("props"), "k int").alias("b")
    )
    encoded = decoded.select(
        "event_id", "b.k", C.encode_body(k=F.col("b.k"), status=F.col("event_type")).alias("body")
    )
    return encoded.withColumn("status", C.body_field(F.col("body"), "status"))


@query(f"""
SELECT c_custkey AS message_id, CASE WHEN c_custkey % 10 IN (0, 1) THEN 'error' ELSE 'Ok' END AS status,
       CASE WHEN c_custkey % 10 = 0 THEN 'forbidden' WHEN c_custkey % 10 = 1 THEN 'token is not valid'
            WHEN domain IS NULL THEN 'no statistics' END AS message,
       domain, author_id, time, pages_count
FROM customer LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY author_id ORDER BY domain) AS place FROM ({_STATS_SQL}) WHERE author_id % 3 <> 0)
ON author_id = c_nationkey AND place = 1 AND c_custkey % 10 > 1
""")
def stats_outcome(spark, sf):
    """Customers ask for statistics; some without a token, some with an unknown one, some where there are none."""
    key, nation = F.col("c_custkey"), F.col("n_nationkey")
    token = F.when(key % 10 == 1, F.lit("unknown")).when(key % 10 > 1, token_of(F.col("c_nationkey")))
    requests = table(spark, sf, "customer").select(key.alias("message_id"), token.alias("token"))
    held = table(spark, sf, "nation").select(
        token_of(nation).alias("token"), nation.cast("bigint").alias("user_id"),
        as_of().alias("expire_date"), nation.cast("bigint").alias("id"),
    )
    known = crawl_statistics(shipped(spark, sf)).filter("author_id % 3 <> 0")
    return N.stats_outcome(requests, held, known)

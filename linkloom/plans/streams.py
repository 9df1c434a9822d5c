"""Streams over the stored tables, run until the input at hand is used up."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from linkloom.functions.scalars import body_field
from linkloom.operators import sessions as N
from linkloom.operators import stats
from linkloom.operators.schema import TOKEN, USER
from linkloom.plans.links import CONTENT_SQL
from linkloom.plans.registry import query
from linkloom.plans.search import TEXT, _ranked
from linkloom.plans.sessions import _CHECK_SQL, AS_OF_SQL, as_of, order_dates, token_of, tokens, users
from linkloom.session import settle, work_path
from linkloom.sources.snapshots import SnapshotTable
from linkloom.sources.tables import table, table_stream
from linkloom.streaming import chat, expiry, keyed, messages
from linkloom.streaming.run import run_batches, run_to_table
from linkloom.streaming.service import Service
from linkloom.streaming.stores import PageIndexLog, renew_sessions

_CODE = "CAST(CAST('0x' || substr(md5(user_id || '|' || event_id), 1, 5) AS BIGINT) AS VARCHAR)"


@query(f"""
SELECT event_id, user_id, CASE WHEN event_type = 'purchase' THEN 'coupon' ELSE 'prompt' END AS action,
       CASE WHEN event_type = 'purchase' THEN 'http://getcolor.ru/#' ||
              CASE WHEN length({_CODE}) >= 6 THEN {_CODE} ELSE rpad({_CODE}, 6, '0') END
            ELSE '{chat.PROMPT}' END AS message
FROM events WHERE event_type <> 'error' AND value > 1 AND CAST(props ->> '$.k' AS INTEGER) > 3
""")
def stream_route(spark, sf):
    """Events as chat messages; a purchase says the coupon phrase."""
    kind = F.col("event_type")
    events = table_stream(spark, sf, "events").select(
        "event_id",
        "user_id",
        F.when(kind == "error", F.lit("other")).otherwise(F.lit(chat.NEW_MESSAGE)).alias("type"),
        (F.col("value") > 1).alias("to_me"),
        (body_field(F.col("props"), "k").cast("int") > 3).alias("from_user"),
        F.when(kind == "purchase", F.lit(chat.COUPON_PHRASE)).otherwise(kind).alias("text"),
    )
    return run_to_table(chat.route(events, passing=("event_id",)), "routed")


@query(f"""
SELECT message_id, 'current' AS type, status,
       '{{"status":"' || status || '","data":{{"message":' || coalesce('"' || message || '"', 'null') || ',"id":' ||
       coalesce(CAST(id AS VARCHAR), 'null') || ',"email":' || coalesce('"' || email || '"', 'null') || '}}}}' AS body
FROM ({_CHECK_SQL.replace("FROM events", "FROM events WHERE event_type IN ('view', 'signup')")})
UNION ALL
SELECT event_id, 'index', 'Ok', '{{"status":"Ok","data":{{"domain":"site' || user_id || '"}}}}'
FROM events WHERE event_type = 'click'
""")
def stream_dispatch(spark, sf):
    """Messages made from events go to the handler of their type; other types are ignored."""
    kind = F.col("event_type")
    token = F.when(kind == "signup", F.concat(F.lit("no|"), F.col("user_id").cast("string"))).otherwise(
        token_of(F.col("user_id"))
    )
    kinds = F.when(kind.isin("view", "signup"), F.lit("current")).when(kind == "click", F.lit("index"))
    sent = messages.request_messages(
        table_stream(spark, sf, "events"),
        F.coalesce(kinds, kind),
        F.col("event_id"),
        token=token,
        domain=F.concat(F.lit("site"), F.col("user_id").cast("string")),
    )
    known_users, known_tokens = users(spark, sf), tokens(spark, sf)

    def current(asked):
        checked = N.check_sessions(asked, known_tokens, known_users, as_of())
        data = {c: F.col(c) for c in ("message", "id", "email")}
        return messages.reply_messages(checked, F.col("status"), **data)

    def index(asked):
        return messages.reply_messages(asked, F.lit("Ok"), domain=F.col("domain"))

    base = work_path(spark, "dispatched")
    handle = messages.dispatcher({"current": current, "index": index}, f"{base}/out")
    run_batches(sent, handle, f"{base}/checkpoint")
    replies = spark.read.schema("message_id bigint, status string, body string, batch int, type string")
    return replies.parquet(f"{base}/out").drop("batch")


@query("SELECT DISTINCT user_id FROM events")
def stream_seen(spark, sf):
    events = table_stream(spark, sf, "events").select("user_id", "event_id")
    return run_to_table(keyed.seen_once(events, "user_id", F.col("event_id")), "seen").select("user_id")


@query("""
SELECT q.event_id AS message_id, q.ts AS asked, r.ts AS answered, q.event_type AS type, r.props AS body
FROM events q JOIN events r ON r.event_id - 1 = q.event_id
WHERE r.ts >= q.ts AND r.ts <= q.ts + INTERVAL 10 MINUTE
""")
def stream_reply(spark, sf):
    """Each event asks, the next one answers it, if it comes within ten minutes."""
    # a watermark wants an instant; the session's time zone is UTC
    requests = table_stream(spark, sf, "events").select(
        F.col("event_id").alias("message_id"), F.col("ts").cast("timestamp").alias("asked"),
        F.col("event_type").alias("type"),
    )
    replies = table_stream(spark, sf, "events").select(
        (F.col("event_id") - 1).alias("message_id"), F.col("ts").cast("timestamp").alias("answered"),
        F.col("props").alias("body"),
    )
    matched = run_to_table(messages.match_replies(requests, replies, "asked", "answered"), "replies")
    return matched.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("asked", "answered")})


def _arriving(spark, df, base, files=5):
    """A stream of ``df`` whose micro-batches are its rows with ``batch`` 0, 1, ...; the column stays behind."""
    for number in range(files):
        df.filter(F.col("batch") == number).drop("batch").coalesce(1).write.parquet(f"{base}/{number}")
    schema = df.drop("batch").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/*")


def _by_time(spark, sf):
    """Events with the quarter of all times they lie in as ``batch``, and one far later event that closes what is open."""
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    width = (last - first) / 4
    quarter = sum((F.col("ts") > F.lit(first + k * width)).cast("int") for k in (1, 2, 3))
    closing = spark.createDataFrame([(-9, last + dt.timedelta(days=100), 4)], "event_id bigint, ts timestamp, batch int")
    return events.withColumn("batch", quarter).unionByName(closing, allowMissingColumns=True)


_QUARTERS_SQL = """
SELECT *, (ts > lo + w)::INT + (ts > lo + 2 * w)::INT + (ts > lo + 3 * w)::INT AS batch
FROM events, (SELECT min(ts) AS lo, (max(ts) - min(ts)) / 4 AS w FROM events)
"""


@query(f"""
WITH e AS ({_QUARTERS_SQL}),
r AS (SELECT event_id - 1 AS message_id, ts AS answered, CASE WHEN event_id % 7 = 0 THEN 3 ELSE batch END AS arrives FROM e),
mark AS (SELECT least((SELECT max(ts) FROM e WHERE batch < 2), (SELECT max(answered) FROM r WHERE arrives < 2)) - INTERVAL 10 MINUTE AS late)
SELECT e.event_id AS message_id, e.ts AS asked, r.answered, CASE WHEN r.answered IS NULL THEN 'timeout' ELSE 'answered' END AS outcome
FROM e LEFT JOIN (SELECT r.* FROM r, mark WHERE arrives < 3 OR answered > late) r
  ON r.message_id = e.event_id AND r.answered >= e.ts AND r.answered <= e.ts + INTERVAL 10 MINUTE
""")
def stream_unanswered(spark, sf):
    """Each event asks, the next one answers within ten minutes or not at all; every seventh answer arrives with the
    last quarter. That is too late for requests of the first two: a batch goes by the watermark two batches before it."""
    base = work_path(spark, "unanswered")
    timed = _by_time(spark, sf)
    requests = timed.select(F.col("event_id").alias("message_id"), F.col("ts").alias("asked"), "batch")
    held_back = (F.col("event_id") % 7 == 0) & (F.col("batch") < 4)
    replies = timed.select(
        (F.col("event_id") - 1).alias("message_id"), F.col("ts").alias("answered"), F.when(held_back, 3).otherwise(F.col("batch")).alias("batch"))
    found = messages.answered_or_not(
        _arriving(spark, requests, f"{base}/requests"), _arriving(spark, replies, f"{base}/replies"), "asked", "answered")
    told = run_to_table(found, "outcomes").filter("message_id >= 0")
    return told.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("asked", "answered")})


@query("""
SELECT user_id, min(ts) AS first, max(ts) + INTERVAL 1 DAY AS expired FROM (
  SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS session FROM (
    SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 1 DAY > ts THEN 0 ELSE 1 END AS opens FROM events))
GROUP BY user_id, session
""")
def stream_expired(spark, sf):
    """Each event is a login for a day; a session is told once, when it has ended."""
    logins = _arriving(spark, _by_time(spark, sf).select("user_id", "ts", "batch"), work_path(spark, "logins"))
    ended = run_to_table(expiry.expired_sessions(logins, "user_id", "ts"), "ended").filter(F.col("user_id").isNotNull())
    return ended.select("user_id", *[F.timestamp_micros(c).cast("timestamp_ntz").alias(n) for c, n in (("first", "first"), ("end", "expired"))])


@query("""
SELECT event_type, start, count(*) AS requests FROM (
  SELECT event_type, unnest(generate_series(time_bucket(INTERVAL 10 MINUTE, ts) - INTERVAL 50 MINUTE, time_bucket(INTERVAL 10 MINUTE, ts), INTERVAL 10 MINUTE)) AS start
  FROM events)
GROUP BY ALL HAVING count(*) > 3
""")
def stream_rate(spark, sf):
    """Hours, one beginning every ten minutes, with more than three events of a type."""
    base = work_path(spark, "rates")
    arriving = _arriving(spark, _by_time(spark, sf).select("event_type", "ts", "batch"), base)
    found = run_to_table(stats.rate_stream(arriving, ["event_type"], "ts", 3, "1 hour", "10 minutes", "1 hour"), "rates")
    return found.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("""
SELECT user_id, unnest(range(10, count(*) + 1, 10)) AS n FROM events GROUP BY user_id
""")
def stream_counter(spark, sf):
    return run_to_table(keyed.count_steps(table_stream(spark, sf, "events"), "user_id"), "steps")


@query("""
SELECT md5('token|' || user_id) AS token, user_id, max(ts) + INTERVAL 1 DAY AS expire_date, user_id AS id
FROM events GROUP BY user_id
""")
def stream_sessions(spark, sf):
    """Each event is a login that renews the user's token."""
    logins = table_stream(spark, sf, "events").select(
        token_of(F.col("user_id")).alias("token"), "user_id", F.col("user_id").alias("id"), "ts"
    )
    base = work_path(spark, "sessions")
    store = SnapshotTable(spark, f"{base}/table", TOKEN, ["token"])
    run_batches(logins, renew_sessions(store), f"{base}/checkpoint")
    return store.read()


_ARRIVED_SQL = f"""
SELECT index_name, url, content FROM (
  SELECT 'all' AS index_name, regexp_replace(url, '[?#].*$', '') AS url, {CONTENT_SQL} AS content,
         row_number() OVER (PARTITION BY regexp_replace(url, '[?#].*$', '') ORDER BY page_id DESC) AS place
  FROM pages) WHERE place = 1
"""


@query(f"""
SELECT place AS rank, url, score FROM (
  {_ranked(_ARRIVED_SQL, f"SELECT 'all' AS index_name, 1 AS query_id, '{TEXT}' AS q", "index_name,")}) WHERE place <= 100
""")
def stream_index(spark, sf):
    """Pages arrive, each replaces its document, and the log answers a query at any time."""
    arriving = table_stream(spark, sf, "pages").select(
        F.regexp_replace("url", "[?#].*$", "").alias("url"), "html", F.col("page_id").alias("seq")
    )
    base = work_path(spark, "arrived")
    log = PageIndexLog(spark, f"{base}/log")
    run_batches(arriving, log.handler(lambda: F.lit("all")), f"{base}/checkpoint")
    asked = spark.range(1).select(
        F.col("id").alias("query_id"), F.lit("all").alias("index_name"), F.lit(TEXT).alias("q"),
        F.lit(100).alias("limit"), F.lit(0).alias("offset"),
    )
    return log.search_many(asked, deepest=100).drop("query_id")


_TIES_SQL = f"""
SELECT index_name, url, content FROM (
  SELECT 'all' AS index_name, regexp_replace(url, '[?#].*$', '') AS url, {CONTENT_SQL} AS content,
         row_number() OVER (PARTITION BY regexp_replace(url, '[?#].*$', '') ORDER BY page_id // 11 DESC, page_id % 11 DESC) AS place
  FROM pages) WHERE place = 1
"""


@query(f"""
SELECT place AS rank, url, score FROM (
  {_ranked(_TIES_SQL, f"SELECT 'all' AS index_name, 1 AS query_id, '{TEXT}' AS q", "index_name,")}) WHERE place <= 100
""")
def stream_index_ties(spark, sf):
    """Eleven batches bring pages of the same addresses and the same seq: the last batch counts, the eleventh after the tenth."""
    stored = table(spark, sf, "pages").select(
        F.regexp_replace("url", "[?#].*$", "").alias("url"), "html", F.floor(F.col("page_id") / 11).alias("seq"),
        (F.col("page_id") % 11).cast("int").alias("batch"))
    base = work_path(spark, "ties")
    log = PageIndexLog(spark, f"{base}/log")
    run_batches(_arriving(spark, stored, f"{base}/in", 11), log.handler(lambda: F.lit("all")), f"{base}/checkpoint")
    asked = spark.range(1).select(
        F.col("id").alias("query_id"), F.lit("all").alias("index_name"), F.lit(TEXT).alias("q"),
        F.lit(100).alias("limit"), F.lit(0).alias("offset"),
    )
    return log.search_many(asked, deepest=100).drop("query_id")


# The service's messages, made from orders: a sign-up of a new or a known customer, a login, an index request.
_KIND_SQL = "CASE o_orderkey % 3 WHEN 0 THEN 'singup' WHEN 1 THEN 'login' ELSE 'index' END"


def _service(spark, sf, kinds=("singup", "login", "index")):
    """All messages through the service in four batches, each with the tables its predecessor left."""
    files = spark.sparkContext.defaultParallelism  # of a batch
    # placed by message id while the rows are narrow, before bodies are made
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").repartition(4 * files, "o_orderkey")
    kind = F.element_at(F.array(*map(F.lit, kinds)), (F.col("o_orderkey") % 3 + 1).cast("int"))
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    mail = F.concat(F.lower(name), F.lit("@mail.test"))
    new_mail = F.concat(F.lit("new"), F.col("o_orderkey").cast("string"), F.lit("@mail.test"))
    fields = {
        "email": F.when((kind == "singup") & (F.col("o_orderstatus") != "F"), new_mail).otherwise(mail),
        "password": F.when((kind == "login") & (F.col("o_orderstatus") == "F"), F.lit("wrong")).otherwise(name),
        "name": F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")),
        "domain": F.concat(F.lit("https://site"), F.col("o_custkey").cast("string")),
        "token": F.when(F.col("o_orderstatus") == "F", F.lit("unknown")).when(F.col("o_orderstatus") == "O", token_of(F.col("o_custkey"))),
    }
    sent = messages.request_messages(orders, kind, F.col("o_orderkey"), **fields)
    base = work_path(spark, "service")
    sent.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", files).parquet(f"{base}/in")
    known_users = SnapshotTable(spark, f"{base}/users", USER)
    dates = settle(order_dates(spark, sf), "order-dates")  # users, tokens and crawled domains are made of it
    known_users.write(users(spark, sf, dates))
    known_tokens = SnapshotTable(spark, f"{base}/tokens", TOKEN, ["token"])
    known_tokens.write(tokens(spark, sf, dates))
    crawled = dates.filter("o_custkey % 2 = 0").select(
        F.concat(F.lit("https://site"), F.col("o_custkey").cast("string")).alias("domain"), F.lit(1).cast("bigint").alias("author_id"),
        as_of().alias("time"), F.lit(1).cast("bigint").alias("pages_count"))
    service = Service(known_users, known_tokens, settle(crawled, "crawled"), f"{base}/out")  # each batch reads it
    run_batches(stream, service.handler(as_of()), f"{base}/checkpoint")
    return service


@query(f"""
SELECT o_orderkey AS message_id, CASE WHEN o_orderpriority <> '5-LOW' AND o_orderstatus <> 'F' THEN 'Ok' ELSE 'error' END AS status,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'missing parameter' WHEN o_orderstatus = 'F' THEN 'email is taken' END AS message, 'reply' AS source
FROM orders WHERE o_orderkey % 3 = 0
UNION ALL
SELECT NULL, 'new' || o_orderkey || '@mail.test', o_orderpriority, 'user' FROM orders
WHERE o_orderkey % 3 = 0 AND o_orderpriority <> '5-LOW' AND o_orderstatus <> 'F'
""")
def stream_signup(spark, sf):
    """Replies to sign-ups over four batches, and the users they added."""
    service = _service(spark, sf)
    added = service.users.read().filter(F.startswith("email", F.lit("new")))
    told = service.replies("signup").withColumn("source", F.lit("reply"))
    return told.union(added.select(F.lit(None).cast("bigint"), "email", "name", F.lit("user")))


@query(f"""
SELECT o_orderkey AS message_id, CASE WHEN o_orderstatus = 'F' THEN 'error' ELSE 'Ok' END AS status,
  CASE WHEN o_orderstatus = 'F' THEN 'password or email not correct' END AS message, 'reply' AS source
FROM orders WHERE o_orderkey % 3 = 1
UNION ALL
SELECT o_custkey, 'renewed', NULL, 'token' FROM orders WHERE o_orderkey % 3 = 1 AND o_orderstatus <> 'F' GROUP BY o_custkey
""")
def stream_login(spark, sf):
    """Replies to logins over four batches, and whose tokens they renewed."""
    service = _service(spark, sf)
    day = F.lit(dt.timedelta(days=1))
    renewed = service.tokens.read().join(service.users.read().filter(~F.startswith("email", F.lit("new"))).select(F.col("id").alias("user_id")), "user_id", "left_semi")
    renewed = renewed.filter(F.col("expire_date") == as_of() + day).select("user_id", F.lit("renewed"), F.lit(None).cast("string"), F.lit("token"))
    return service.replies("login").withColumn("source", F.lit("reply")).union(renewed)


@query(f"""
SELECT o_orderkey AS message_id, CASE WHEN message IS NULL THEN 'Ok' ELSE 'error' END AS status, message, CASE WHEN message IS NULL THEN o_custkey END AS id
FROM (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'forbidden' WHEN o_orderstatus = 'F' THEN 'token is not valid'
    WHEN last + INTERVAL 1 DAY <= {AS_OF_SQL} THEN 'token is expire' END AS message
  FROM orders JOIN (SELECT o_custkey, max(o_orderdate) AS last FROM orders GROUP BY o_custkey) USING (o_custkey)
  WHERE o_orderkey % 3 = 2)
""")
def stream_current(spark, sf):
    """Whose session each token is, over four batches with sign-ups in them; messages of other types are ignored."""
    service = _service(spark, sf, ("singup", "other", "current"))
    return service.replies("current").select("message_id", "status", "message", "id")


@query(f"""
SELECT o_orderkey AS message_id, 'https://site' || o_custkey AS domain, CASE WHEN o_orderstatus = 'O' THEN o_custkey END AS author_id,
  CASE o_orderstatus WHEN 'P' THEN 'forbidden' WHEN 'F' THEN 'token is not valid' ELSE
    CASE WHEN o_custkey % 2 = 0 THEN 'fresh' ELSE 'accepted' END END AS outcome
FROM orders WHERE o_orderkey % 3 = 2
""")
def stream_index_requests(spark, sf):
    """Outcomes of index requests over four batches."""
    return _service(spark, sf).replies("index")

import datetime as dt

from pyspark.sql import functions as F

from linkloom.functions.scalars import repeatable_id
from linkloom.operators import requests as Q
from linkloom.operators import sessions as N
from linkloom.operators import stats

DAY = dt.datetime(2024, 1, 2)


def as_of():
    return F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")


def users(spark):
    rows = [(1, "ann@mail.test", "secret", "Ann"), (2, "bob@mail.test", "hidden", "Bob")]
    df = spark.createDataFrame(rows, "id long, email string, p string, name string")
    day = F.lit("2023-01-01 00:00:00").cast("timestamp_ntz")
    return df.select("id", "email", N.credential(F.col("p")).alias("password"), "name",
                     day.alias("created_date"), day.alias("last_login_date"))


def tokens(spark):
    rows = [("t1", 1, dt.datetime(2024, 1, 2, 0, 0, 1), 1), ("t2", 1, DAY, 2), ("t3", 77, dt.datetime(2025, 1, 1), 3)]
    return spark.createDataFrame(rows, "token string, user_id long, expire_date timestamp_ntz, id long")


def _outcomes(df):
    return {r["message_id"]: (r["status"], r["message"]) for r in df.collect()}


def test_session_check(spark):
    asked = spark.createDataFrame([(1, "t1"), (2, "t2"), (3, "t9"), (4, None)], "message_id long, token string")
    checked = N.check_sessions(asked, tokens(spark), users(spark), as_of())
    assert _outcomes(checked) == {1: ("Ok", None), 2: ("error", "token is expire"),
                                  3: ("error", "token is not valid"), 4: ("error", "forbidden")}
    assert "password" not in checked.columns
    shown = checked.filter("message_id = 1").first()
    assert (shown["id"], shown["email"], shown["name"]) == (1, "ann@mail.test", "Ann")
    assert checked.filter("message_id > 1 AND (id IS NOT NULL OR email IS NOT NULL)").count() == 0


def test_login(spark):
    asked = spark.createDataFrame(
        [(1, "ann@mail.test", "secret"), (2, "ann@mail.test", "wrong"), (3, "bob@mail.test", "hidden"),
         (4, "bob@mail.test", "hidden"), (5, "no@mail.test", "x"), (6, None, None)],
        "message_id long, email string, password string")
    out = N.log_in(asked, users(spark), tokens(spark), as_of(), touch_login=True, token=repeatable_id(F.lit("token"), F.col("user_id")))
    got = {r["message_id"]: r for r in out.outcomes.collect()}
    bad = "password or email not correct"
    assert [got[i]["message"] for i in range(1, 7)] == [None, bad, None, None, bad, bad]
    assert got[1]["token"] == "t1" and got[1]["expire_date"] == DAY + dt.timedelta(days=1)
    assert got[3]["token"] == got[4]["token"] not in (None, "t1")
    after = {r["token"]: r for r in out.tokens.collect()}
    assert set(after) == {"t1", "t2", "t3", got[3]["token"]}
    assert after["t1"]["expire_date"] == DAY + dt.timedelta(days=1) and after["t2"]["expire_date"] == DAY
    assert {r["id"]: r["last_login_date"] for r in out.users.collect()} == {1: DAY, 2: DAY}
    plain = N.log_in(asked, users(spark), tokens(spark), as_of()).users
    assert plain.filter(F.col("last_login_date") == as_of()).count() == 0


def test_sign_up(spark):
    asked = spark.createDataFrame(
        [(5, "new@mail.test", "p", "N"), (3, "new@mail.test", "q", "First"), (1, "ann@mail.test", "p", "A"),
         (7, "other@mail.test", "p", "O"), (8, None, "p", "x"), (9, "z@mail.test", None, "z")],
        "message_id long, email string, password string, name string")
    out = N.sign_up(asked, users(spark), as_of(), token=repeatable_id(F.lit("token"), F.col("user_id")))
    assert _outcomes(out.outcomes) == {
        3: ("Ok", None), 7: ("Ok", None), 5: ("error", "email is taken"), 1: ("error", "email is taken"),
        8: ("error", "missing parameter"), 9: ("error", "missing parameter")}
    made = {r["email"]: r for r in out.new_users.collect()}
    assert {e: r["id"] for e, r in made.items()} == {"new@mail.test": 3, "other@mail.test": 4}
    assert made["new@mail.test"]["name"] == "First" and made["new@mail.test"]["password"] != "q"
    assert {r["user_id"]: r["expire_date"] for r in out.new_tokens.collect()} == {
        i: DAY + dt.timedelta(days=1) for i in (3, 4)}


def test_freshness_and_index_requests(spark):
    crawled = spark.createDataFrame(
        [("d29", 1, dt.datetime(2023, 12, 4), 10), ("d30", 1, dt.datetime(2023, 12, 3), 10),
         ("d29", 1, dt.datetime(2022, 1, 1), 10)],
        "domain string, author_id long, time timestamp_ntz, pages_count long")
    asked = spark.createDataFrame(
        [(1, "t1", "d29"), (2, "t1", "d30"), (3, "t1", "never"), (4, "t9", "never"), (5, None, "never"), (6, "t1", None)],
        "message_id long, token string, domain string")
    got = {r["message_id"]: (r["outcome"], r["author_id"]) for r in
           N.index_requests(asked, tokens(spark), crawled, as_of()).collect()}
    assert got == {1: ("fresh", 1), 2: ("accepted", 1), 3: ("accepted", 1), 4: ("token is not valid", None),
                   5: ("forbidden", None), 6: ("missing parameter", 1)}
    due = {r["domain"] for r in N.not_fresh(asked.filter("domain is not null"), crawled, as_of()).collect()}
    assert due == {"d30", "never"}
    view = N.crawl_stats_of(asked.filter("message_id < 3"), tokens(spark), crawled.filter("time > '2023-01-01'"))
    assert [(r["message_id"], r["domain"], r["pages_count"]) for r in view.orderBy("message_id").collect()] == [
        (1, "d29", 10), (2, "d29", 10)]


def test_statistics(spark):
    pages = spark.range(25).select(F.lit("a").alias("root"), F.col("id").alias("seq")).union(
        spark.range(7).select(F.lit("b"), F.col("id")))
    assert {tuple(r) for r in stats.pages_per(pages, "root").collect()} == {("a", 25), ("b", 7)}
    tenth = stats.every_nth(pages, ["root"], [F.col("seq")]).collect()
    assert sorted((r["root"], r["n"], r["seq"]) for r in tenth) == [("a", 10, 9), ("a", 20, 19)]
    hits = spark.createDataFrame(
        [("k", dt.datetime(2024, 1, 1, 0, 0, 1, i * 1000)) for i in range(5)] + [("k", DAY), ("z", DAY)],
        "k string, ts timestamp_ntz")
    over = stats.rate_report(hits, ["k"], "ts", 4).collect()
    assert [(r["k"], r["requests"], r["start"]) for r in over] == [("k", 5, dt.datetime(2024, 1, 1, 0, 0, 1))]


def test_paging(spark):
    rows = spark.createDataFrame(
        [(1, "q", None, None), (2, "q", "x", "y"), (3, "q", "7", " 2 "), (4, None, "1", "1"), (5, "q", "100", "0"),
         (6, "q", "101", "0"), (7, "q", "x", "0")],
        "id long, q string, limit string, offset string")
    lenient = Q.lenient_paging(rows)
    assert {r["id"]: (r["limit"], r["offset"]) for r in lenient.accepted.collect()} == {
        1: (10, 0), 2: (10, 0), 3: (7, 2), 5: (100, 0), 6: (101, 0), 7: (10, 0)}
    assert [r["id"] for r in lenient.rejected.collect()] == [4]
    strict = Q.strict_paging(rows)
    assert {r["id"]: (r["limit"], r["offset"]) for r in strict.accepted.collect()} == {3: (7, 2), 5: (100, 0)}
    assert {r["id"]: r["reason"] for r in strict.rejected.collect()} == {
        1: "missing parameter", 2: "bad value", 4: "missing parameter", 6: "bad value", 7: "bad value"}
    both = Q.required(rows, ["q", "limit"])
    assert both.accepted.count() == 5 and both.rejected.count() == 2
    assert rows.select(Q.token_outcome(F.col("q")).alias("o")).filter("o = 'forbidden'").count() == 1


def test_hot_and_missing_tokens_are_split(spark):
    """A third of the requests has one token, a third none: the final plan splits both."""
    asked = spark.range(60000).select(
        F.col("id").alias("message_id"),
        F.when(F.col("id") % 3 == 0, F.lit("t1")).when(F.col("id") % 3 == 1, F.concat(F.lit("u"), F.col("id").cast("string")))
        .alias("token"),
    ).repartition(8)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        checked = N.check_sessions(asked, tokens(spark), users(spark), as_of())
        counts = {r["message"]: r["n"] for r in checked.groupBy("message").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert counts == {None: 20000, "forbidden": 20000, "token is not valid": 20000}
        frame = N.check_sessions(asked, tokens(spark), users(spark), as_of())
        rows = frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert len(rows) == 60000 and "skew=true" in plan, plan[:3000]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_random_tokens_are_drawn_once(spark):
    asked = spark.createDataFrame([(3, "new@mail.test", "q", "First"), (7, "other@mail.test", "p", "O")],
                                  "message_id long, email string, password string, name string")
    out = N.sign_up(asked, users(spark))  # the token and the time are drawn here
    told = {r["token"] for r in out.outcomes.collect()}
    assert told == {r["token"] for r in out.new_tokens.collect()} == {r["token"] for r in out.outcomes.collect()} and len(told) == 2
    again = {r["token"] for r in N.sign_up(asked, users(spark)).outcomes.collect()}
    assert not told & again
    close = [abs((r["expire_date"] - dt.timedelta(days=1) - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).total_seconds()) for r in out.new_tokens.collect()]
    assert max(close) < 120


def test_every_statistics_request_gets_an_answer(spark):
    crawled = spark.createDataFrame([("b", 1, dt.datetime(2024, 1, 1), 5), ("a", 1, dt.datetime(2024, 1, 1), 7)],
                                    "domain string, author_id long, time timestamp_ntz, pages_count long")
    held = spark.createDataFrame([("t1", 1, 1), ("t2", 2, 2)], "token string, user_id long, id long")
    asked = spark.createDataFrame([(1, "t1"), (2, "t2"), (3, "t9"), (4, None)], "message_id long, token string")
    got = {r["message_id"]: (r["status"], r["message"], r["domain"]) for r in N.stats_outcome(asked, held, crawled).collect()}
    assert got == {1: ("Ok", None, "a"), 2: ("Ok", "no statistics", None), 3: ("error", "token is not valid", None), 4: ("error", "forbidden", None)}


def test_a_batch_of_one_file_is_worked_on_by_all_tasks(spark, tmp_path):
    from linkloom.streaming.service import spread_messages
    kinds = F.element_at(F.array(F.lit("singup"), F.lit("other")), (F.col("id") % 9 == 0).cast("int") + 1)
    rows = spark.range(4000).select(F.when(F.col("id") % 4 > 0, F.col("id")).alias("message_id"), kinds.alias("type"), F.col("id").cast("string").alias("body"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    stored = spark.read.parquet(f"{tmp_path}/in")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would join parts as small as these
    try:
        sizes = [r["count"] for r in spread_messages(stored).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(sizes) == 4 and sum(sizes) == 4000 and max(sizes) < 1400  # rows without an id too

import datetime as dt

from pyspark.sql import functions as F

from linkloom.operators import search as S
from linkloom.operators.schema import TOKEN
from linkloom.session import work_path
from linkloom.sources.index_store import IndexStore
from linkloom.sources.snapshots import SnapshotTable
from linkloom.sources.tables import table_stream
from linkloom.streaming import chat, keyed, messages
from linkloom.streaming.run import run_batches, run_to_table
from linkloom.streaming.stores import PageIndexLog, renew_sessions


def stream_of(spark, folder, parts, schema):
    """A stream with one micro-batch per part, in order."""
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_chat_routing(spark, tmp_path):
    rows = [
        (chat.NEW_MESSAGE, True, True, chat.COUPON_PHRASE, 1), (chat.NEW_MESSAGE, True, True, "hello", 2),
        (chat.NEW_MESSAGE, True, False, "hello", 3), (chat.NEW_MESSAGE, True, True, "", 4),
        (chat.NEW_MESSAGE, False, True, "hello", 5), ("other", True, True, "hello", 6),
        (chat.NEW_MESSAGE, True, True, None, 7),
    ]
    schema = "type string, to_me boolean, from_user boolean, text string, user_id long"
    out = run_to_table(chat.route(stream_of(spark, str(tmp_path / "in"), [rows], schema)), "chat").collect()
    assert {r["user_id"]: r["action"] for r in out} == {1: "coupon", 2: "prompt"}
    coupon = next(r["message"] for r in out if r["user_id"] == 1)
    assert coupon.startswith("http://getcolor.ru/#") and len(coupon.split("#")[1]) >= 6


def test_seen_once_over_batches(spark, tmp_path):
    parts = [[("hot", i) for i in range(200)] + [("a", 1)], [("hot", 900), ("a", 2), ("b", 3)]]
    stream = stream_of(spark, str(tmp_path / "in"), parts, "url string, n int")
    out = run_to_table(keyed.seen_once(stream, "url", F.col("n")), "seen").collect()
    assert sorted(r["url"] for r in out) == ["a", "b", "hot"]
    plain = run_to_table(keyed.seen_once(stream, "url"), "seen").collect()
    assert sorted(r["url"] for r in plain) == ["a", "b", "hot"]


def test_seen_within_a_bound(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    parts = [[("a", at)], [("a", at + dt.timedelta(minutes=1)), ("b", at + dt.timedelta(hours=9))],
             [("c", at + dt.timedelta(hours=9))], [("a", at + dt.timedelta(hours=9))]]
    stream = stream_of(spark, str(tmp_path / "in"), parts, "url string, ts timestamp")
    out = run_to_table(keyed.seen_within(stream, "url", "ts"), "seen").collect()
    assert sorted(r["url"] for r in out) == ["a", "a", "b", "c"]  # 'a' was forgotten in between


def test_counter_goes_on_over_batches(spark, tmp_path):
    parts = [[("x",)] * 7 + [("y",)] * 25, [("x",)] * 3, [("x",)] * 21 + [("z",)]]
    stream = stream_of(spark, str(tmp_path / "in"), parts, "root string")
    out = run_to_table(keyed.count_steps(stream, "root"), "steps").collect()
    assert sorted((r["root"], r["n"]) for r in out) == [("x", 10), ("x", 20), ("x", 30), ("y", 10), ("y", 20)]


def test_replies_meet_requests(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    asked = stream_of(spark, str(tmp_path / "q"), [[("m1", at), ("m2", at)], [("m3", at)]],
                      "message_id string, asked timestamp")
    minute = dt.timedelta(minutes=1)
    answers = stream_of(
        spark, str(tmp_path / "r"),
        [[("m3", at + minute)], [("m1", at + 2 * minute), ("m2", at + 11 * minute), ("m9", at)]],
        "message_id string, answered timestamp")
    out = run_to_table(messages.match_replies(asked, answers, "asked", "answered"), "replies").collect()
    assert sorted(r["message_id"] for r in out) == ["m1", "m3"]


def test_dispatch(spark, tmp_path):
    rows = spark.createDataFrame([("1", "login", "a@b", "p"), ("2", "singup", "c@d", "q"), ("3", "nonsense", "x", "y")],
                                 "message_id string, kind string, email string, password string")
    sent = messages.request_messages(rows, F.col("kind"), F.col("message_id"), email=F.col("email"), password=F.col("password"))
    sent.write.parquet(str(tmp_path / "in"))
    assert messages.request_messages(rows, F.col("kind"), email=F.col("email")).select("message_id").distinct().count() == 3
    stream = spark.readStream.schema(sent.schema).parquet(str(tmp_path / "in"))

    def login(m):
        return messages.reply_messages(m, F.lit("Ok"), token=F.concat(F.lit("t-"), F.col("email")))

    def singup(m):
        return messages.reply_messages(m, F.lit("error"), message=F.col("name"))

    out = str(tmp_path / "out")
    handle = messages.dispatcher({"login": login, "singup": singup}, out)
    run_batches(stream, handle, str(tmp_path / "cp"))
    handle(sent, 0)  # the same batch again changes nothing
    got = {r["message_id"]: (r["type"], r["status"], r["body"]) for r in spark.read.parquet(out).collect()}
    assert got == {"1": ("login", "Ok", '{"status":"Ok","data":{"token":"t-a@b"}}'),
                   "2": ("singup", "error", '{"status":"error","data":{"message":null}}')}


def test_sessions_renewed_once_per_batch(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    hour = dt.timedelta(hours=1)
    schema = "token string, user_id long, id long, ts timestamp_ntz"
    parts = [[("t1", 1, 1, at), ("t1", 1, 1, at + hour), ("t2", 2, 2, at)], [("t2", 2, 2, at + 3 * hour), ("t3", 3, 3, at)]]
    stream = stream_of(spark, str(tmp_path / "in"), parts, schema)
    store = SnapshotTable(spark, str(tmp_path / "sessions"), TOKEN, ["token"])
    handle = renew_sessions(store)
    run_batches(stream, handle, str(tmp_path / "cp"))
    day = dt.timedelta(days=1)
    expected = {"t1": at + hour + day, "t2": at + 3 * hour + day, "t3": at + day}
    assert {r["token"]: r["expire_date"] for r in store.read().collect()} == expected
    run_batches(stream, handle, str(tmp_path / "cp"))  # nothing new
    assert store.versions() == [0, 1]
    late = spark.createDataFrame([("t1", 1, 1, at - 5 * day), ("t4", 4, 4, at)], schema)
    handle(late, 0)  # another source's batch of the same number counts, and shortens no session
    handle(late, 0)  # the same once more
    assert {r["token"]: r["expire_date"] for r in store.read().collect()} == {**expected, "t4": at + day}
    assert store.versions() == [0, 1, 2]


def test_logs_and_tables_take_batches_of_new_checkpoints(spark, tmp_path):
    from linkloom.functions.urls import site_root

    log = PageIndexLog(spark, str(tmp_path / "log"))
    for k in (1, 2):  # two checkpoints, each with a batch 0
        page = [(f"https://a.t/{k}", "<p>word", k)]
        stream = stream_of(spark, str(tmp_path / f"in{k}"), [page], "url string, html string, seq long")
        run_batches(stream, log.handler(lambda: site_root(F.col("url"))), str(tmp_path / f"cp{k}"))
    assert {r["url"] for r in log.documents().collect()} == {"https://a.t/1", "https://a.t/2"}


def test_document_writes_replace_by_url(spark, tmp_path):
    from linkloom.operators.documents import read_documents, write_documents

    path, schema = str(tmp_path / "docs"), "index_name string, url string, content string, seq int"
    write_documents(spark.createDataFrame([("a", "1", "old", 1), ("a", "2", "kept", 1), ("a", "1", "older", 0)], schema), path, [F.col("seq")])
    write_documents(spark.createDataFrame([("a", "1", "new", 2), ("b", "1", "other", 2)], schema), path, [F.col("seq")])
    assert {tuple(r) for r in read_documents(spark, path).collect()} == {("a", "1", "new"), ("a", "2", "kept"), ("b", "1", "other")}


def test_incremental_index_equals_a_fresh_one(spark, tmp_path):
    parts = [
        [("https://a.t/1", "<p>spark stream", 1), ("https://a.t/2", "<p>spark", 2), ("https://b.t/1", "<p>join", 3)],
        [("https://a.t/1", "<p>spark spark join", 4), ("https://a.t/3", "<p>join table", 5), ("https://a.t/2", "", 6)],
    ]
    from linkloom.functions.urls import site_root

    stream = stream_of(spark, str(tmp_path / "in"), parts, "url string, html string, seq long")
    log = PageIndexLog(spark, str(tmp_path / "log"))
    run_batches(stream, log.handler(lambda: site_root(F.col("url"))), str(tmp_path / "cp"))
    live = {(r["url"], r["content"]) for r in log.documents().collect()}
    assert live == {("https://a.t/1", "spark spark join"), ("https://a.t/3", "join table"), ("https://a.t/2", ""), ("https://b.t/1", "join")}
    asked = spark.createDataFrame([(1, "spark join", 10, 0, "httpsa.t"), (2, "join", 10, 0, "httpsb.t")],
                                  "query_id long, q string, limit int, offset int, index_name string")
    got = sorted(map(tuple, log.search_many(asked).collect()))
    fresh = sorted(map(tuple, S.search_documents(log.documents(), asked).collect()))
    assert got == fresh and len(got) == 3
    kept = log.rewrite(str(tmp_path / "kept"))
    assert sorted(map(tuple, kept.search_many(asked).collect())) == got
    late = spark.createDataFrame([("https://a.t/1", "<p>gone", 7)], "url string, html string, seq long")
    kept.handler(lambda: site_root(F.col("url")))(late, 2)
    assert {r["content"] for r in kept.documents().collect()} == {"gone", "join table", "", "join"}
    store = IndexStore(spark, "compacted", work_path(spark, "store"), buckets=2)
    log.compact(store)
    assert sorted(map(tuple, store.search_many(asked).collect())) == got
    store.close()


def test_stream_of_folder_and_file(spark, sf, tmp_path):
    assert run_to_table(table_stream(spark, sf, "region"), "t").count() == 5
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "nums.parquet"))
    assert run_to_table(table_stream(spark, str(tmp_path), "nums", 1), "t").count() == 10


def test_service_batches_are_applied_once(spark, tmp_path):
    from linkloom.operators.schema import USER
    from linkloom.streaming.messages import request_messages
    from linkloom.streaming.service import Service

    rows = [(1, "singup", "a@t", "p", "A", None, None), (2, "singup", "a@t", "q", "B", None, None), (3, "login", "a@t", "p", None, None, None),
            (4, "login", "a@t", "no", None, None, None), (5, "index", None, None, None, "d", None), (6, "other", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "id long, kind string, email string, password string, name string, domain string, token string")
    batch = request_messages(df, F.col("kind"), F.col("id"), **{c: F.col(c) for c in ("email", "password", "name", "domain", "token")})
    users = SnapshotTable(spark, str(tmp_path / "users"), USER)
    tokens = SnapshotTable(spark, str(tmp_path / "tokens"), TOKEN, ["token"])
    stats = spark.createDataFrame([], "domain string, author_id long, time timestamp_ntz, pages_count long")
    service = Service(users, tokens, stats, str(tmp_path / "out"))
    handle = service.handler()
    for _ in range(2):
        handle(batch, 0)
        assert {r["message_id"]: (r["status"], r["message"]) for r in service.replies("signup").collect()} == {1: ("Ok", None), 2: ("error", "email is taken")}
        assert {r["message_id"]: r["status"] for r in service.replies("login").collect()} == {3: "Ok", 4: "error"}
        assert [tuple(r) for r in service.replies("index").collect()] == [(5, "d", None, "forbidden")]
        assert users.read().count() == 1 and tokens.read().count() == 1
    token = tokens.read().first()["token"]
    handle(request_messages(spark.createDataFrame([(7, "e", token)], "id long, domain string, token string"), F.lit("index"), F.col("id"),
                            domain=F.col("domain"), token=F.col("token")), 1)
    assert [tuple(r) for r in service.accepted_roots().collect()] == [("e", 0)]


def test_crawl_to_index(spark):
    from linkloom.operators.crawls import crawl_index

    pages = spark.createDataFrame(
        [("https://a.t", "<a href='/1'>x</a>", None), ("https://a.t/1", "<a href='/2'>y</a> <a href='/3'>z</a>", 200), ("https://a.t/2", "gone", 404), ("https://b.t", "other", None)],
        "url string, html string, status int")
    asked = spark.createDataFrame([("https://a.t", 1), ("https://a.t", 2), ("https://c.t", 3)], "root string, author_id long")
    made = crawl_index(pages, asked)
    assert {tuple(r) for r in made.documents.collect()} == {("httpsa.t", "https://a.t", "x"), ("httpsa.t", "https://a.t/1", "y z")}
    assert {(r["domain"], r["author_id"], r["pages_count"]) for r in made.statistics.collect()} == {
        ("https://a.t", 1, 2), ("https://a.t", 2, 2), ("https://c.t", 3, 0)}


def test_bodies_are_parsed_before_the_batch_is_kept(spark, tmp_path):
    """What a step reads of a kept batch holds no parse, and the fields are those of ``of_type``, odd bodies too."""
    from linkloom.streaming import messages as M
    from linkloom.streaming.service import KINDS
    rows = [(1, "login", '{"email":"a","password":"p"}'), (None, "login", '{"email":"a"}'), (2, "login", "no body"), (3, "login", None),
            (4, "index", '{"domain":"d","token":null}'), (5, "other", '{"email":"x"}'), (6, None, '{"email":"y"}'), (4, "index", '{"token":"t"}')]
    batch = spark.createDataFrame(rows, "message_id long, type string, body string")
    kept = M.decode_types(batch, KINDS).persist()
    try:
        for kind in KINDS:
            read = M.decoded_of(kept, kind)
            plan = read.filter("message_id > 0")._jdf.queryExecution().optimizedPlan().toString()
            assert "from_json" not in plan.split("InMemoryRelation")[0], plan
            as_before = M.of_type(batch, kind)
            assert read.columns == as_before.columns
            assert sorted(map(str, read.collect())) == sorted(map(str, as_before.collect()))
    finally:
        kept.unpersist()


def test_a_batch_of_logins_writes_the_tokens_it_renews(spark, tmp_path):
    """Not the whole table once more; a login twice in a batch and a wrong one renew one token."""
    from linkloom.operators.schema import USER
    from linkloom.operators.sessions import credential
    from linkloom.streaming.service import Service
    users, tokens = SnapshotTable(spark, str(tmp_path / "users"), USER), SnapshotTable(spark, str(tmp_path / "tokens"), TOKEN, ["token"])
    now = F.lit(dt.datetime(2024, 5, 1)).cast("timestamp_ntz")
    users.write(spark.range(50).select("id", F.concat(F.lit("u"), "id").alias("email"), credential(F.lit("p")).alias("password"),
                                       F.lit("n").alias("name"), now.alias("created_date"), now.alias("last_login_date")))
    tokens.write(spark.range(40).select(F.concat(F.lit("t"), "id").alias("token"), F.col("id").alias("user_id"), now.alias("expire_date"), "id"))
    stats = spark.createDataFrame([], "domain string, author_id long, time timestamp_ntz, pages_count long")
    service = Service(users, tokens, stats, str(tmp_path / "out"))
    body = '{"email":"%s","password":"%s"}'
    asked = [(1, "login", body % ("u1", "p")), (2, "login", body % ("u1", "p")), (3, "login", body % ("u2", "x")), (4, "login", body % ("u45", "p"))]
    service.handler(now)(spark.createDataFrame(asked, "message_id long, type string, body string"), 0)
    written = spark.read.parquet(f"{tmp_path}/out/login-tokens").collect()
    assert sorted(r["user_id"] for r in written) == [1, 45]
    after = {r["user_id"]: (r["token"], r["expire_date"]) for r in tokens.read().collect()}
    assert len(after) == tokens.read().count() == 41 and after[1] == ("t1", dt.datetime(2024, 5, 2)) and after[2] == ("t2", dt.datetime(2024, 5, 1))
    assert after[45][1] == dt.datetime(2024, 5, 2)
    assert {r["message_id"]: r["status"] for r in service.replies("login").collect()} == {1: "Ok", 2: "Ok", 3: "error", 4: "Ok"}


def _empty_service(spark, tmp_path):
    from linkloom.operators.schema import USER
    from linkloom.streaming.service import Service
    users, tokens = SnapshotTable(spark, str(tmp_path / "users"), USER), SnapshotTable(spark, str(tmp_path / "tokens"), TOKEN, ["token"])
    now = F.lit(dt.datetime(2024, 5, 1)).cast("timestamp_ntz")
    users.write(spark.range(50).select("id", F.concat(F.lit("u"), "id").alias("email"), F.lit("d").alias("password"),
                                       F.lit("n").alias("name"), now.alias("created_date"), now.alias("last_login_date")))
    tokens.write(spark.range(40).select(F.concat(F.lit("t"), "id").alias("token"), F.col("id").alias("user_id"), now.alias("expire_date"), "id"))
    return Service(users, tokens, spark.createDataFrame([], "domain string, author_id long, time timestamp_ntz, pages_count long"), str(tmp_path / "out")), now


def _bodies(spark, *rows):
    return spark.createDataFrame(rows, "message_id long, type string, body string")


def test_a_batch_of_sign_ups_writes_the_rows_it_adds(spark, tmp_path):
    """Users and tokens that were there are not written again, a batch that is run again adds nothing, no password is written."""
    import glob

    import pyarrow.parquet as pq
    service, now = _empty_service(spark, tmp_path)
    handle = service.handler(now)
    body = '{"email":"%s","password":"secret","name":"N"}'
    first = _bodies(spark, (1, "singup", body % "a"), (1, "singup", body % "a"), (2, "singup", body % "u3"), (3, "singup", '{"email":"b"}'))
    for _ in range(2):
        handle(first, 0)
    handle(_bodies(spark, (4, "singup", body % "b"), (5, "singup", body % "a")), 1)

    def written(table, version):
        return sum(pq.read_metadata(f).num_rows for f in glob.glob(f"{tmp_path}/{table}/?{version:010d}*/*.parquet"))

    assert [written("users", v) for v in range(3)] == [50, 1, 1]
    assert [written("tokens", v) for v in range(3)] == [40, 2, 1]  # two messages of one id, a token each, as before
    assert service.users.versions() == [0, 1, 2]
    assert {(r["id"], r["email"]) for r in service.users.read().filter("id >= 50").collect()} == {(50, "a"), (51, "b")}
    assert service.users.read().count() == 52 and service.users.read(1).count() == 51 and service.users.read(0).count() == 50
    assert sorted((r["message_id"], r["message"]) for r in service.replies("signup").collect() if r["message"]) == [
        (2, "email is taken"), (3, "missing parameter"), (5, "email is taken")]
    assert all("secret" not in str(pq.read_table(f).to_pylist()) for f in glob.glob(f"{tmp_path}/out/*/*/*.parquet"))


def test_additions_are_merged_in_the_end(spark, tmp_path, monkeypatch):
    from linkloom.sources import snapshots
    monkeypatch.setattr(snapshots, "MOST_ADDITIONS", 2)
    store = SnapshotTable(spark, str(tmp_path / "t"), TOKEN, ["token"])

    def rows(*ids):
        at = dt.datetime(2024, 1, 1)
        return spark.createDataFrame([(f"t{i}", i, at, i) for i in ids], "token string, user_id long, expire_date timestamp_ntz, id long")

    for i in range(5):
        store.append(rows(i, i), ("q", i))
        store.append(rows(i), ("q", i))  # the batch again
    assert [n[0] for n in store._known().values()] == ["v", "a", "a", "v", "a"]
    assert [store.read(v).count() for v in store.versions()] == [1, 2, 3, 4, 5]
    store.upsert(rows(1, 9))
    assert sorted(r["user_id"] for r in store.read().collect()) == [0, 1, 2, 3, 4, 9]


def test_kinds_without_messages_cost_nothing(spark, tmp_path):
    service, now = _empty_service(spark, tmp_path)
    service.handler(now)(_bodies(spark, (1, "index", '{"domain":"d","token":"t3"}'), (2, "other", "{}"), (3, None, "{}")), 0)
    assert [tuple(r) for r in service.replies("index").collect()] == [(1, "d", 3, "accepted")]
    assert service.tokens.versions() == [0] and service.users.versions() == [0]  # nothing written again
    assert [service.replies(k).count() for k in ("signup", "login", "current")] == [0, 0, 0]
    key = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    assert spark.conf.get(key) in ("0", "0b")  # as it was


def test_batches_with_splits_enough_are_not_shuffled(spark):
    from linkloom.streaming.service import spread_messages

    def plan(parts):
        rows = spark.range(400, numPartitions=parts).select(F.col("id").alias("message_id"), F.lit("index").alias("type"), F.lit("{}").alias("body"))
        return spread_messages(rows)._jdf.queryExecution().logical().toString()

    assert "Repartition" in plan(1) and "Repartition" not in plan(4)


def test_sessions_are_checked_against_the_tokens_asked_for(spark, tmp_path, monkeypatch):
    """What is grouped, joined with users and shuffled again follows the batch, not the table."""
    from linkloom.operators import sessions as N
    service, now = _empty_service(spark, tmp_path)
    seen, check = [], N.check_sessions
    monkeypatch.setattr(N, "check_sessions", lambda asked, tokens, *rest: (seen.append(tokens.count()), check(asked, tokens, *rest))[1])
    body = '{"token":"%s"}'
    service.handler(F.lit(dt.datetime(2024, 4, 30)).cast("timestamp_ntz"))(
        _bodies(spark, (1, "current", body % "t3"), (2, "current", body % "t3"), (3, "current", body % "t99"), (4, "current", '{"token":null}')), 0)
    assert seen == [1]
    assert sorted((r["message_id"], r["message"], r["id"], r["email"]) for r in service.replies("current").collect()) == [
        (1, None, 3, "u3"), (2, None, 3, "u3"), (3, "token is not valid", None, None), (4, "forbidden", None, None)]

"""Running rates, unanswered requests and sessions that end, each beside plain Python."""

import datetime as dt
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkloom.operators import stats
from linkloom.streaming import expiry, messages
from linkloom.streaming.run import write_stream

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def batches(spark, path, schema, *files):
    """A stream with one micro-batch a file."""
    for number, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{number}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def run(spark, stream, path):
    write_stream(stream, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return [tuple(r) for r in spark.read.schema(stream.schema).parquet(f"{path}/out").collect()]


@pytest.mark.parametrize("width", [1, 3, 0.5])
def test_sliding_rate(spark, width):
    draw = random.Random(2)
    rows = [("hot", at(draw.randrange(0, 4000) / 50)) for _ in range(900)] + [("cold", at(k * 1.0)) for k in range(20)]
    rows += [(None, at(5)), (None, at(5)), ("cold", None), ("edge", at(0)), ("edge", at(width))]
    df = spark.createDataFrame(rows, "who string, at timestamp")
    found = {tuple(r) for r in stats.sliding_rate(df, ["who"], "at", 1, dt.timedelta(seconds=width)).collect()}
    plain = set()
    for who, t in rows:
        if t is not None:
            n = sum(w == who and u is not None and t - dt.timedelta(seconds=width) < u <= t for w, u in rows)
            if n > 1:
                plain.add((who, t, n))
    assert found == plain and not any(who == "edge" for who, _, _ in found)


def test_a_hot_key_is_spread_over_slices_of_time(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 9 > 0, "hot").otherwise("cold").alias("who"), F.timestamp_micros(F.col("id") * 100_000).alias("at"))
    plan = stats.sliding_rate(df, ["who"], "at", 9)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "_slice" in plan.split("Window [")[1].split("\n")[0]
    assert "hashpartitioning(who" in plan and "_slice" in plan.split("hashpartitioning(who")[1].split(")")[0]


def test_rate_stream(spark, tmp_path):
    schema = "who string, at timestamp"
    files = [[("a", at(0.1)), ("a", at(0.6)), ("b", at(0.2))], [("a", at(0.9)), ("a", at(30))], [("q", at(31))], [("a", at(0.5))], [("z", at(900))]]
    stream = stats.rate_stream(batches(spark, tmp_path / "in", schema, *files), ["who"], "at", 2, "1 second", "500 milliseconds", "5 seconds")
    # the last row of a comes after the watermark and counts no more
    assert [(w, s, n) for w, s, n in run(spark, stream, tmp_path) if w == "a"] == [("a", at(0), 3)]


def test_answered_or_not(spark, tmp_path):
    asked = "message_id bigint, asked timestamp"
    told = "message_id bigint, answered timestamp, body string"
    requests = batches(spark, tmp_path / "requests", asked, [(1, at(0)), (2, at(1)), (3, at(2))], [(4, at(3000))], [(5, at(3100))], [(9, at(99999))], [(10, at(199999))])
    replies = batches(spark, tmp_path / "replies", told, [(1, at(5), "one")], [(2, at(2000), "over patience"), (4, at(3001), "four")],
                      [(8, at(3100), "")], [(3, at(3), "within patience, far too late"), (9, at(99999), "")], [(10, at(199999), "")])
    found = run(spark, messages.answered_or_not(requests, replies, "asked", "answered"), tmp_path)
    outcomes = {r[0]: (r[3], r[-1]) for r in found if r[0] < 9}
    assert outcomes == {1: ("one", "answered"), 2: (None, "timeout"), 3: (None, "timeout"), 4: ("four", "answered"), 5: (None, "timeout")}
    assert sorted(r[0] for r in found if r[0] < 9) == [1, 2, 3, 4, 5]  # each once


def test_sessions_end_once_and_leave_no_state(spark, tmp_path):
    hour = 3600
    files = [
        [("a", at(0)), ("a", at(20 * hour)), ("b", at(0)), (None, at(3 * hour))],
        [("a", at(19 * hour)), ("b", at(24 * hour)), ("b", at(23 * hour)), ("c", None)],  # b: the later login joins both
        [("a", at(44 * hour)), ("b", at(100 * hour))],  # a: just at its end, so a new session
        [("z", at(9999 * hour))], [("y", at(19999 * hour))],
    ]
    stream = batches(spark, tmp_path / "in", "who string, at timestamp", *files)
    found = run(spark, expiry.expired_sessions(stream, "who", "at", "2 hours"), tmp_path)
    micros = lambda hours: int((at(hours * hour) - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    expected = {("a", 0, 44), ("a", 44, 68), ("b", 0, 48), ("b", 100, 124), (None, 3, 27), ("z", 9999, 10023)}
    assert sorted(found, key=str) == sorted(((w, micros(a), micros(b)) for w, a, b in expected), key=str)
    state = spark.read.format("statestore").option("path", str(tmp_path / "checkpoint")).option("stateVarName", "open").option("flattenCollectionTypes", "true").load()
    assert {r[0] for r in state.select("key.who").collect()} == {"y"}  # all others have ended


def test_spans():
    assert expiry.merged([(5, 9), (0, 4), (3, 6), (9, 12)]) == [(0, 9), (9, 12)]
    assert expiry.merged([]) == []


class Calls:
    """One key's state and timers, counting the calls."""

    def __init__(self):
        self.value, self.timers, self.count = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.count += 1
        return self.value

    def update(self, value):
        self.count, self.value = self.count + 1, value

    def clear(self):
        self.count, self.value = self.count + 1, None

    def registerTimer(self, at):
        self.count += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.count += 1
        self.timers.remove(at)


class Times:
    def __init__(self, now):
        self.now = now

    getCurrentWatermarkInMs = getExpiryTimeInMs = lambda self: self.now


def test_a_key_costs_four_calls_a_batch_whatever_its_sessions():
    draw, told, calls = random.Random(5), [], Calls()
    processor, _ = expiry.expiring("who", "string")
    processor.init(calls)
    logins, now = [], 0
    for batch in range(30):
        arrived = [] if batch % 5 == 4 else [now * 1000 + draw.randrange(0, 400_001) for _ in range(draw.randrange(1, 12))]
        logins += arrived
        before = calls.count
        if arrived:
            told += processor.handleInputRows(("a",), [{"first": t, "end": t + 20_500} for t in arrived], Times(now))
            assert calls.count - before <= 4
        for timer in sorted(t for t in calls.timers if t <= now):
            before = calls.count
            told += [tuple(r) for r in processor.handleExpiredTimer(("a",), Times(now), Times(timer))]
            calls.timers.discard(timer)
            assert calls.count - before <= 4
        assert len(calls.timers) <= 1
        now += draw.randrange(100, 400)
        assert all(t > 0 for t in calls.timers)
    told += [tuple(r) for timer in list(calls.timers) for r in processor.handleExpiredTimer(("a",), Times(10**9), Times(timer))]
    assert [tuple(r)[1:] for r in told] == expiry.merged([(t, t + 20_500) for t in logins])
    assert calls.value is None


def test_spans_of_one_arrow_batch():
    draw = random.Random(6)
    rows = [(draw.choice(["a", "b", None]), draw.choice([None, *range(0, 400, 7)])) for _ in range(300)]
    found = expiry.login_spans(pa.array([k for k, _ in rows]), pa.array([t for _, t in rows], "int64"), 9)
    expected = {(k, *span) for k in {k for k, _ in rows} for span in expiry.merged([(t, t + 9) for w, t in rows if w == k and t is not None])}
    assert set(zip(*(c.to_pylist() for c in found))) == expected and len(found[0]) == len(expected)
    assert [len(c) for c in expiry.login_spans(pa.array(["a"]), pa.array([None], "int64"), 9)] == [0, 0, 0]

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.functions.scalars import truthy
from linkloom.operators import rows as R
from linkloom.operators import schema as M
from linkloom.operators.ranks import first_per_key, running_number
from linkloom.sources.snapshots import SnapshotTable

PEOPLE = [(1, "a", True, 147.1), (2, "b", False, 155.0), (3, "c", True, 170.5), (4, "d", True, 147.1), (5, "e", False, 160.0)]


def people(spark):
    return spark.createDataFrame(PEOPLE, "id long, name string, sex boolean, height double")


def test_models():
    assert M.PERSON.names == ["id", "name", "sex", "height"]
    assert M.MAN.names == ["id", "name", "sex", "height", "age"] and M.MAN.table_name == "Man"
    with pytest.raises(ValueError):
        M.Model("", [])
    changed = M.MAN.extend("Other", [M.float_field("name")])
    assert changed.names == M.MAN.names and changed.struct["name"].dataType == T.DoubleType()
    first, second = M.Model("F", [M.int_field("x"), M.int_field("y")]), M.Model("S", [M.string_field("z"), M.string_field("x")])
    both = M.Model("B", [M.int_field("own")], (first, second))
    assert both.names == ["z", "x", "y", "own"] and both.struct["x"].dataType == T.LongType()


def test_bind(spark):
    with pytest.raises(ValueError):
        M.MAN.bind(people(spark))
    assert M.PERSON.bind(people(spark).toDF("q", "w", "e", "r")).columns == M.PERSON.names


def _verdict(spark, field, value, kind, **options):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField(field.name, kind)]))
    checked = M.validate(df, M.Model("m", [field]), **options)
    rows, rejects = checked.rows.collect(), checked.rejects.collect()
    assert len(rows) + len(rejects) == 1
    return "reject" if rejects else rows[0][0]


def test_validation_table(spark):
    long, text, double = T.LongType(), T.StringType(), T.DoubleType()
    cases = [
        (M.int_field("v"), 5, long, 5, 5), (M.int_field("v"), "5", text, "reject", "reject"),
        (M.int_field("v"), None, long, "reject", None), (M.float_field("v"), 1.5, double, 1.5, 1.5),
        (M.float_field("v"), 1, long, "reject", "reject"), (M.float_field("v"), None, double, "reject", None),
        (M.string_field("v"), "a", text, "a", "a"), (M.string_field("v"), 12, long, "reject", "reject"),
        (M.string_field("v"), None, text, "reject", None), (M.bool_field("v"), 0, long, False, False),
        (M.bool_field("v"), "0", text, True, True), (M.bool_field("v"), "", text, False, False),
        (M.bool_field("v"), None, text, False, None), (M.int_field("v", required=False), None, long, None, None),
        (M.bool_field("v", required=False), None, long, None, None),
    ]
    for field, value, kind, strict, tolerant in cases:
        assert _verdict(spark, field, value, kind) == strict, (field, value)
        assert _verdict(spark, field, value, kind, strict=False) == tolerant, (field, value)
    assert _verdict(spark, M.int_field("v"), "5", text, text_input=True) == 5
    assert _verdict(spark, M.int_field("v"), "five", text, text_input=True) == "reject"


def test_validation_extras(spark):
    rows = spark.createDataFrame([(1, 12, "0", 180.1, 22)], "id long, name long, sex string, height double, age long")
    checked = M.validate(rows, M.MAN)
    assert checked.rows.count() == 0
    assert [(r["field"], r["reason"]) for r in checked.rejects.collect()] == [("name", "not a string")]
    with pytest.raises(Exception, match="rejected"):
        M.validate(rows, M.MAN, fail_fast=True).rows.collect()
    with pytest.raises(AttributeError):
        M.validate(rows.withColumn("extra", F.lit(1)), M.MAN)
    missing = M.validate(people(spark).drop("name"), M.PERSON)
    assert missing.rows.count() == 0 and missing.rejects.count() == 5
    good = M.validate(people(spark), M.PERSON, fail_fast=True).rows
    assert good.count() == 5


def test_truth(spark):
    row = spark.createDataFrame([(0.0, 2, "0", "", [1], True)], "a double, b int, c string, d string, e array<int>, f boolean")
    out = row.select(*[truthy(F.col(f.name), f.dataType).alias(f.name) for f in row.schema.fields]).first()
    assert list(out) == [False, True, True, False, True, True]


def test_conditions(spark):
    df = people(spark)
    ids = lambda d: [r["id"] for r in d.orderBy("id").collect()]
    assert ids(R.where(df, id__gt=1)) == [2, 3, 4, 5]
    assert ids(R.where(df, id__ge=2, height__lt=160.0, sex=False)) == [2]
    assert ids(R.where(df, id__le=2)) == [1, 2] and ids(R.where(df)) == [1, 2, 3, 4, 5]
    odd = df.withColumn("x__no", F.col("id"))
    assert ids(R.where(odd, x__no=3)) == [3]
    with pytest.raises(AttributeError):
        R.lookup(df, [F.col("id")], nope=1)


def test_slices(spark):
    df = people(spark).repartition(3)
    ids = lambda d: [r["id"] for r in d.collect()]
    for s in (slice(1, 3), slice(0, None), slice(None, None, 2), slice(1, 5, 3), slice(4, 2), slice(-2, None), slice(0, -1), slice(3, 99)):
        got = ids(R.slice_rows(df, ["id"], s.start or 0, s.stop, s.step or 1))
        assert got == [1, 2, 3, 4, 5][s], s
    assert R.item_at(df, ["id"], 4).first()["id"] == 5 and R.item_at(df, ["id"], 5).first() is None
    assert R.item_at(df, ["id"], -1).first()["id"] == 5


def test_long_slices_are_numbered(spark, monkeypatch):
    monkeypatch.setattr(R, "TOP_ROWS", 10)
    df = spark.range(1000).repartition(5)
    assert [r[0] for r in R.slice_rows(df, ["id"], 700, 720).collect()] == list(range(700, 720))
    assert [r[0] for r in R.slice_rows(df, ["id"], 3, None, 7).collect()] == list(range(3, 1000, 7))
    assert [r[0] for r in R.slice_rows(df, ["id"]).collect()] == list(range(1000))
    assert R.item_at(df, ["id"], -300).first()[0] == 700 and R.item_at(df, ["id"], -2000).first() is None


def test_running_number(spark):
    """One key holds most rows, one is null; numbers are whole and start at 1 in each key."""
    rows = [("hot", i) for i in range(900)] + [(None, i) for i in range(30)] + [(f"k{i}", 5) for i in range(70)]
    df = spark.createDataFrame(rows, "k string, o int").repartition(6)
    for parts in (1, 9):
        out = running_number(df, ["k"], [F.col("o").desc()], partitions=parts).collect()
        assert len(out) == 1000
        assert {(r["o"], r["n"]) for r in out if r["k"] == "hot"} == {(i, 900 - i) for i in range(900)}
        assert {(r["o"], r["n"]) for r in out if r["k"] is None} == {(i, 30 - i) for i in range(30)}
        assert all(r["n"] == 1 for r in out if r["k"] and r["k"] != "hot")
    whole = running_number(df.filter("k = 'hot'"), [], [F.col("o")], partitions=4).collect()
    assert {(r["o"], r["n"]) for r in whole} == {(i, i + 1) for i in range(900)}


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2), (None, 9)], "k string, o int")
    assert {tuple(r) for r in first_per_key(df, ["k"], [F.col("o")]).collect()} == {("a", 1), ("b", 2), (None, 9)}


def test_changes(spark):
    df = people(spark)
    out = R.update_where(df, R.conditions(height__lt=150.0), name="Change")
    assert {r["id"] for r in out.collect() if r["name"] == "Change"} == {1, 4}
    holed = df.withColumn("height", F.when(F.col("id") != 2, F.col("height")))
    assert R.delete_where(holed, F.col("height") < 150.0).count() == 3  # a null condition deletes nothing
    keys = spark.createDataFrame([(1,), (1,), (5,), (77,)], "id long")
    assert R.update_keys(df, keys, ["id"], name="K").filter("name = 'K'").count() == 2
    assert R.delete_keys(df, keys, ["id"]).count() == 3


def test_upsert(spark):
    updates = spark.createDataFrame([(2, "x", True, 1.0, 1), (2, "y", True, 2.0, 2), (9, "n", True, 3.0, 1)],
                                    "id long, name string, sex boolean, height double, seq int")
    once = R.upsert(people(spark), updates, ["id"], [F.col("seq").desc()])
    assert {r["id"]: r["name"] for r in once.collect()} == {1: "a", 2: "y", 3: "c", 4: "d", 5: "e", 9: "n"}
    twice = R.upsert(once, updates, ["id"], [F.col("seq").desc()])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_stored_table(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "people"), M.PERSON)
    assert t.read().count() == 0 and t.get(id=1) is None
    assert t.insert(people(spark)).count() == 0
    assert t.create(id=7, name="g", sex=True, height=1.5) is None
    with pytest.raises(Exception):
        t.create(id="8", name="h", sex=True, height=1.5)
    with pytest.raises(AttributeError):
        t.create(nope=1)
    assert t.read().count() == 6 and t.get(name="g", sex=True)["id"] == 7
    with pytest.raises(AttributeError):
        t.get(nope=1)
    with pytest.raises(AttributeError):
        t.filter(nope__gt=1)
    some = t.filter(id__gt=1).filter(height__lt=160.0)
    assert sorted(r["id"] for r in some) == [2, 4, 7]
    assert some[1]["id"] == 4 and some[9] is None and some[0:2].count() == 2
    t.filter(id=4).update(name="Change")
    assert t.get(id=4)["name"] == "Change" and len(t.versions()) == 3
    t.filter(id=1).delete()
    assert t.get(id=1) is None and t.all().count() == 5
    rejects = t.save(spark.createDataFrame([(2, "new", True, 2.0), (8, "h", False, 1.0), (9, None, True, 1.0)], "id long, name string, sex boolean, height double"))
    assert [r["field"] for r in rejects.collect()] == ["name"]
    with pytest.raises(Exception):
        t.save(spark.createDataFrame([(9, None, True, 1.0)], "id long, name string, sex boolean, height double"), fail_fast=True)
    assert t.get(id=2)["name"] == "new" and t.all().count() == 6
    t.delete_keys(spark.createDataFrame([(8,)], "id long"))
    t.update_keys(spark.createDataFrame([(7,)], "id long"), height=9.0)
    assert t.get(id=7)["height"] == 9.0 and t.all().count() == 5
    assert t.read(version=0).count() == 5 and t.read(version=1).count() == 6
    before = t.versions()
    t.write(t.read(), ("query", 0))  # a batch is written once, whatever its number and the table's versions
    t.write(t.read().limit(0), ("query", 0))
    assert len(t.versions()) == len(before) + 1 and t.read().count() == 5
    t.write(t.read(), ("other", 0))
    assert len(t.versions()) == len(before) + 2


def test_defaults_and_text_times(spark):
    rows = spark.createDataFrame([(1, None), (2, "x")], "id long, name string")
    assert [r["name"] for r in M.with_defaults(rows, {"name": "none"}).orderBy("id").collect()] == ["none", "x"]
    stats = spark.createDataFrame([("d", 1, dt.datetime(2024, 1, 2, 3, 4, 5), 10)], "domain string, author_id long, time timestamp_ntz, pages_count long")
    assert M.text_times(stats, M.CRAWLER_STATS).first()["time"] == "2024-01-02 03:04:05"


def test_random_ids(spark):
    from linkloom.functions.scalars import random_coupon_number, random_id

    out = spark.range(500).select(random_id().alias("i"), random_coupon_number().alias("c")).collect()
    assert len({r["i"] for r in out}) == 500
    assert all(0 <= r["c"] <= 0xFFFFF for r in out)


def test_paging_beyond_an_int(spark):
    from linkloom.operators import requests as Q

    rows = [(1, "a", "5000000000", "3000000000"), (2, "a", "-1", "-2"), (3, "a", "5", "-2"), (4, "a", "x", None)]
    asked = spark.createDataFrame(rows, "event_id int, q string, limit string, offset string")
    read = {r["event_id"]: (r["limit"], r["offset"]) for r in Q.lenient_paging(asked).accepted.collect()}
    assert read == {1: (5000000000, 3000000000), 2: (10, 0), 3: (5, 0), 4: (10, 0)}
    checked = Q.strict_paging(asked)
    assert checked.accepted.count() == 0
    assert {r["event_id"]: r["reason"] for r in checked.rejected.collect()} == {1: "bad value", 2: "bad value", 3: "bad value", 4: "missing parameter"}

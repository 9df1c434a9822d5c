"""Typed tables: conditions, lookups, slices, validation, changes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from linkloom.functions.scalars import body_field, truthy
from linkloom.operators import requests as Q
from linkloom.operators import rows as R
from linkloom.operators.ranks import running_number
from linkloom.operators import schema as M
from linkloom.operators import stats
from linkloom.plans.registry import query
from linkloom.session import work_path
from linkloom.sources.parts import PartTable
from linkloom.sources.snapshots import SnapshotTable
from linkloom.sources.tables import table


@query("""
SELECT * FROM orders
WHERE o_orderkey > 100 AND o_custkey <= 1400 AND o_totalprice >= 1000 AND o_totalprice < 400000
  AND o_orderstatus = 'F'
""")
def filter_conditions(spark, sf):
    orders = table(spark, sf, "orders")
    return R.where(
        orders, o_orderkey__gt=100, o_custkey__le=1400, o_totalprice__ge=1000.0,
        o_totalprice__lt=400000.0, o_orderstatus="F",
    )


@query("SELECT * FROM part")
def filter_nothing(spark, sf):
    return R.where(table(spark, sf, "part"))


@query("""
SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 7 ORDER BY c_custkey LIMIT 1
""")
def lookup_first(spark, sf):
    return R.lookup(
        table(spark, sf, "customer"), [F.col("c_custkey")], c_mktsegment="BUILDING", c_nationkey=7
    )


@query("""
SELECT o_orderkey, o_custkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS place FROM orders
  WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))
WHERE place = 1
""")
def lookup_many(spark, sf):
    keys = table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    found = R.lookup_many(table(spark, sf, "orders"), keys, ["o_custkey"], [F.col("o_orderkey")])
    return found.select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 400 OFFSET 100")
def slice_rows(spark, sf):
    return R.slice_rows(table(spark, sf, "orders"), ["o_orderkey"], 100, 500)


@query("""
SELECT row_number() OVER (ORDER BY o_orderkey) AS position, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (ORDER BY o_orderkey) AS place FROM orders)
WHERE place > 10 AND (place - 11) % 7 = 0
""")
def slice_positions(spark, sf):
    """A slice with a step, its rows in their order."""
    rows = R.slice_rows(table(spark, sf, "orders"), ["o_orderkey"], 10, None, 7).select("o_orderkey", "o_totalprice")
    placed = rows.withColumn("_id", F.monotonically_increasing_id())  # follows the order of the sorted rows
    return running_number(placed, [], [F.col("_id")], "position").select("position", "o_orderkey", "o_totalprice")


@query("""
SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS place FROM orders)
WHERE place > 10 AND (place - 11) % 7 = 0
""")
def slice_step(spark, sf):
    return R.slice_rows(table(spark, sf, "orders"), ["o_orderkey"], 10, None, 7)


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 1 OFFSET 123")
def item_at(spark, sf):
    return R.item_at(table(spark, sf, "orders"), ["o_orderkey"], 123)


EVENT = M.Model(
    "Event",
    [M.int_field("event_id"), M.int_field("user_id"), M.string_field("event_type"), M.float_field("value")],
)


def _events_with_gaps(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", "user_id", F.expr("nullif(event_type, 'error')").alias("event_type"), "value"
    )


@query("""
SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'error'
""")
def validate_strict(spark, sf):
    return M.validate(_events_with_gaps(spark, sf), EVENT).rows


@query("""
SELECT event_id AS row, 'event_type' AS field, 'null in a required field' AS reason
FROM events WHERE event_type = 'error'
""")
def validate_rejects(spark, sf):
    return M.validate(_events_with_gaps(spark, sf), EVENT, row_id="event_id").rejects


@query("""
SELECT event_id, user_id, nullif(event_type, 'error') AS event_type, value FROM events
""")
def validate_nullable(spark, sf):
    return M.validate(_events_with_gaps(spark, sf), EVENT, strict=False).rows


@query("""
SELECT event_id, TRY_CAST(k AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS field, CAST(NULL AS VARCHAR) AS reason
FROM (SELECT event_id, CASE WHEN event_type = 'click' THEN 'k' || (props ->> '$.k') ELSE props ->> '$.k' END AS k
      FROM events)
WHERE TRY_CAST(k AS BIGINT) IS NOT NULL
UNION ALL
SELECT event_id, NULL, 'k', 'not a bigint' FROM events WHERE event_type = 'click'
""")
def validate_text(spark, sf):
    """Whole numbers read out of text; a text that is none is a reject."""
    model = M.Model("Keyed", [M.int_field("event_id"), M.int_field("k")])
    k = body_field(F.col("props"), "k")
    rows = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "click", F.concat(F.lit("k"), k)).otherwise(k).alias("k")
    )
    checked = M.validate(rows, model, text_input=True, row_id="event_id")
    none = F.lit(None).cast("string")
    return checked.rows.select("event_id", "k", none.alias("field"), none.alias("reason")).unionByName(
        checked.rejects.select(
            F.col("row").alias("event_id"), F.lit(None).cast("bigint").alias("k"), "field", "reason"
        )
    )


@query("""
SELECT l_orderkey, l_linenumber, l_discount <> 0 AS discounted, length(l_returnflag) > 0 AS flagged
FROM lineitem
""")
def bool_truthiness(spark, sf):
    lines = table(spark, sf, "lineitem")
    types = {f.name: f.dataType for f in lines.schema.fields}
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        truthy(F.col("l_discount"), types["l_discount"]).alias("discounted"),
        truthy(F.col("l_returnflag"), types["l_returnflag"]).alias("flagged"),
    )


@query("""
SELECT c_custkey AS id, c_name AS name, c_acctbal <> 0 AS sex, c_acctbal AS height,
       CAST(c_nationkey AS BIGINT) AS age
FROM customer
""")
def inherit_schema(spark, sf):
    """Inherited columns come first; columns are bound by position and typed by the model."""
    rows = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.col("c_acctbal"), F.col("c_acctbal").alias("c2"), "c_nationkey"
    )
    return M.validate(M.MAN.bind(rows), M.MAN).rows


@query("""
SELECT event_id, user_id, coalesce(nullif(event_type, 'error'), 'none') AS event_type, value FROM events
""")
def insert_defaults(spark, sf):
    """Stored rows of an insert; a null column takes the store's default."""
    store = SnapshotTable(spark, work_path(spark, "events"), EVENT, ["event_id"])
    store.insert(_events_with_gaps(spark, sf), strict=False, defaults={"event_type": "none"})
    return store.read()


@query("""
SELECT event_id, user_id, coalesce(nullif(event_type, 'error'), 'none') AS event_type, value FROM events
""")
def insert_appended(spark, sf):
    """The same by appends to a table in parts: the second insert adds files and touches none."""
    store = PartTable(spark, work_path(spark, "events"), EVENT, ["event_id"], parts=16)
    rows = _events_with_gaps(spark, sf)
    for half in (0, 1):
        store.insert(rows.filter(F.col("event_id") % 2 == half), strict=False, defaults={"event_type": "none"})
    return store.read()


ACCOUNT = M.Model("Account", [M.int_field("id"), M.string_field("name"), M.float_field("balance")])

_UPDATES = """
  SELECT id, name, balance FROM (
    SELECT o_custkey + 700 AS id, o_orderpriority AS name, o_totalprice AS balance,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
    FROM orders) WHERE place = 1
"""


def _accounts(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )


def _account_updates(spark, sf):
    return table(spark, sf, "orders").select(
        (F.col("o_custkey") + 700).alias("id"), F.col("o_orderpriority").alias("name"),
        F.col("o_totalprice").alias("balance"), "o_orderdate", "o_orderkey",
    )


def _newest():
    return [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]


@query(f"""
WITH updates AS ({_UPDATES})
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
WHERE c_custkey NOT IN (SELECT id FROM updates)
UNION ALL SELECT id, name, balance FROM updates
""")
def upsert_rows(spark, sf):
    return R.upsert(_accounts(spark, sf), _account_updates(spark, sf), ["id"], _newest())


@query(f"""
WITH updates AS ({_UPDATES})
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
WHERE c_custkey NOT IN (SELECT id FROM updates)
UNION ALL SELECT id, name, balance FROM updates
""")
def save_stored(spark, sf):
    """The same through a stored table: insert, then save, each a version on disk."""
    store = SnapshotTable(spark, work_path(spark, "accounts"), ACCOUNT)
    store.insert(_accounts(spark, sf))
    store.upsert(_account_updates(spark, sf), _newest())
    return store.read()


_PARTS_SQL = """
SELECT id, name, balance FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY place DESC) AS n FROM (
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, -1 AS place FROM customer
    UNION ALL SELECT o_custkey + CASE WHEN o_orderkey % 3 = 0 THEN 1000000 ELSE 0 END, o_orderpriority, o_totalprice, o_orderkey
    FROM orders WHERE o_custkey % 100 = 1))
WHERE n = 1
"""


def _few_updates(spark, sf):
    """Every order of one customer in a hundred, a third of them under new keys."""
    key = F.col("o_custkey") + F.when(F.col("o_orderkey") % 3 == 0, 1000000).otherwise(0)
    return table(spark, sf, "orders").filter("o_custkey % 100 = 1").select(
        key.cast("bigint").alias("id"), F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("balance"), F.col("o_orderkey").alias("place"))


@query(_PARTS_SQL)
def save_parts(spark, sf):
    """A save of few keys, repeated and new ones among them, into a table in parts: only their parts are written."""
    store = PartTable(spark, work_path(spark, "parts"), ACCOUNT, ["id"], parts=64)
    store.save(_accounts(spark, sf))
    store.save(_few_updates(spark, sf), [F.col("place").desc()])
    return store.read()


@query(_PARTS_SQL)
def save_repeated(spark, sf):
    """The same through a versioned table, whose save takes one row of each repeated key too."""
    store = SnapshotTable(spark, work_path(spark, "repeated"), ACCOUNT)
    store.insert(_accounts(spark, sf))
    store.save(_few_updates(spark, sf).orderBy("place").drop("place"))  # the last given wins
    return store.read()


@query("""
SELECT o_orderkey AS id, 'name' AS field, 'null in a required field' AS reason FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL
SELECT c_custkey, 'stored', 'customer' FROM customer WHERE c_custkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT')
UNION ALL
SELECT o_orderkey, 'stored', 'order' FROM orders WHERE o_orderpriority <> '1-URGENT'
""")
def save_rejects(spark, sf):
    """A bulk save with bad rows: the rejects, and what the table holds afterwards."""
    store = SnapshotTable(spark, work_path(spark, "accounts"), ACCOUNT)
    store.insert(_accounts(spark, sf).withColumn("name", F.lit("customer")))
    bad = F.when(F.col("o_orderpriority") != "1-URGENT", F.lit("order"))
    rejects = store.save(table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), bad.alias("name"), F.col("o_totalprice").alias("balance")))
    told = rejects.select(F.get_json_object("row", "$.id").cast("bigint").alias("id"), "field", "reason")
    return told.union(store.read().select("id", F.lit("stored"), "name"))


@query("""
SELECT o_orderkey, o_custkey,
       CASE WHEN o_totalprice > 300000 AND o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority
FROM orders
""")
def update_where(spark, sf):
    matched = R.conditions(o_totalprice__gt=300000.0, o_orderpriority="1-URGENT")
    return R.update_where(table(spark, sf, "orders"), matched, o_orderstatus="X")


@query("SELECT * FROM orders WHERE NOT (o_totalprice <= 100000 AND o_orderstatus = 'P')")
def delete_where(spark, sf):
    return R.delete_where(table(spark, sf, "orders"), R.conditions(o_totalprice__le=100000.0, o_orderstatus="P"))


@query("""
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49) THEN 'B' ELSE o_orderstatus END
         AS o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority
FROM orders
""")
def bulk_update(spark, sf):
    keys = R.where(table(spark, sf, "lineitem"), l_quantity__gt=49.0)
    keys = keys.select(F.col("l_orderkey").alias("o_orderkey"))
    return R.update_keys(table(spark, sf, "orders"), keys, ["o_orderkey"], o_orderstatus="B")


@query("""
SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49)
""")
def bulk_delete(spark, sf):
    keys = R.where(table(spark, sf, "lineitem"), l_quantity__gt=49.0)
    keys = keys.select(F.col("l_orderkey").alias("o_orderkey"))
    return R.delete_keys(table(spark, sf, "orders"), keys, ["o_orderkey"])


_REQUESTS = """
  SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS q,
         CASE WHEN event_type = 'signup' THEN 'many' ELSE CAST(CAST(props ->> '$.k' AS INTEGER) * 2 AS VARCHAR) END AS lim,
         CASE WHEN event_type = 'view' THEN NULL ELSE props ->> '$.k' END AS off
  FROM events
"""


def _search_requests(spark, sf):
    k = body_field(F.col("props"), "k")
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        "event_id",
        F.when(kind != "error", kind).alias("q"),
        F.when(kind == "signup", F.lit("many")).otherwise((k.cast("int") * 2).cast("string")).alias("limit"),
        F.when(kind != "view", k).alias("offset"),
    )


@query(f"""
SELECT event_id, q, coalesce(TRY_CAST(lim AS BIGINT), 10) AS "limit",
       coalesce(TRY_CAST(off AS BIGINT), 0) AS "offset"
FROM ({_REQUESTS}) WHERE q IS NOT NULL
""")
def paging_lenient(spark, sf):
    return Q.lenient_paging(_search_requests(spark, sf)).accepted


@query(f"""
SELECT event_id, q, TRY_CAST(lim AS BIGINT) AS "limit", TRY_CAST(off AS BIGINT) AS "offset"
FROM ({_REQUESTS})
WHERE q IS NOT NULL AND TRY_CAST(lim AS BIGINT) <= 100 AND TRY_CAST(off AS BIGINT) IS NOT NULL
""")
def paging_strict(spark, sf):
    return Q.strict_paging(_search_requests(spark, sf)).accepted


@query(f"""
SELECT event_id, CASE WHEN q IS NULL OR off IS NULL THEN 'missing parameter' ELSE 'bad value' END AS reason
FROM ({_REQUESTS})
WHERE q IS NULL OR off IS NULL OR TRY_CAST(lim AS BIGINT) IS NULL OR TRY_CAST(lim AS BIGINT) > 100
""")
def paging_rejects(spark, sf):
    return Q.strict_paging(_search_requests(spark, sf)).rejected.select("event_id", "reason")


@query(f"""
SELECT event_id, q, lim AS "limit", off AS "offset" FROM ({_REQUESTS}) WHERE q IS NOT NULL AND off IS NOT NULL
""")
def required_parameters(spark, sf):
    return Q.required(_search_requests(spark, sf), ["q", "limit", "offset"]).accepted


@query("""
SELECT user_id, date_trunc('minute', ts) AS start, count(*) AS requests
FROM events GROUP BY ALL HAVING count(*) > 1
""")
def rate_report(spark, sf):
    """Minutes in which a user made more than one request."""
    return stats.rate_report(table(spark, sf, "events"), ["user_id"], "ts", 1, "1 minute")


@query("""
SELECT event_type, ts, requests FROM (
  SELECT event_type, ts, count(*) OVER (
    PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL '3599.999999 seconds' PRECEDING AND CURRENT ROW) AS requests
  FROM events)
WHERE requests > 5
""")
def rate_sliding(spark, sf):
    """Moments at which a type had more than five events in the hour before, wherever the hour begins."""
    return stats.sliding_rate(table(spark, sf, "events"), ["event_type"], "ts", 5, dt.timedelta(hours=1))


@query("""
SELECT user_id, event_id, n FROM (
  SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
WHERE n % 10 = 0
""")
def every_tenth(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "ts")
    return stats.every_nth(events, ["user_id"], [F.col("ts"), F.col("event_id")]).select(
        "user_id", "event_id", "n"
    )

"""The walk over bucketed links and seen urls: what moves, what is left behind, odd rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from linkloom.operators import reach as R

BUCKETS = 4


def walk(pairs, roots):
    near = {}
    for root in roots:
        level, depth = {root}, 0
        while level:
            near.update({(root, u): depth for u in level if (root, u) not in near})
            depth += 1
            level = {d for s, d in pairs if s in level and (root, d) not in near}
    return near


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark):
    tables = R._Tables(spark, BUCKETS)
    tables.write_links(spark.createDataFrame([(f"a{k}", f"a{k * 7 % 100}") for k in range(100)], "src string, dst string"), ["src"])
    start = spark.createDataFrame([("a1", "a1")], "root string, url string")
    tables.create_seen(start.schema)
    tables.add(start, 0)
    yield tables
    tables.close()


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_neither_links_nor_seen_urls_move(spark, tables, broadcast):
    settings = {"spark.sql.autoBroadcastJoinThreshold": broadcast, "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
                "spark.sql.shuffle.partitions": str(BUCKETS)}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        level = R.next_level(tables.level(0), spark.table(tables.links), spark.table(tables.seen), False, F.col("dst"))
        plan = plan_of(level)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    lines = [line for line in plan.splitlines() if line.strip()]
    depth_of = lambda line: len(re.match(r"[\s:+|-]*", line)[0])
    for at, line in enumerate(lines):
        if "FileScan" not in line:
            continue
        above, depth = [], depth_of(line)
        for upper in reversed(lines[:at]):
            if depth_of(upper) < depth:
                above.append(upper)
                depth = depth_of(upper)
        if tables.links in line:
            assert "Bucketed: true" in line
            chain = above[: next(k for k, x in enumerate(above) if "Join" in x)]
            assert not any("Exchange" in x or "Sort " in x for x in chain), plan
        elif "PartitionFilters: []" in line:  # the seen urls; the level is read by its depth
            assert "Bucketed: true" in line and not any("Exchange" in x for x in above), plan
    moved = plan.count("Exchange ") + plan.count("BroadcastExchange")
    assert plan.count("Exchange hashpartitioning(root") == 1 and moved <= 3, plan


def test_a_walk_leaves_no_tables_and_no_settings(spark):
    before = {r.tableName for r in spark.sql("SHOW TABLES").collect()}
    setting = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    kept = spark.conf.get(setting)
    edges = spark.createDataFrame([("a", "b"), ("b", "c")], "src string, dst string")
    found = R.reach(edges, spark.createDataFrame([("a",)], "root string"), buckets=3)
    assert {(r.url, r.depth) for r in found.collect()} == {("a", 0), ("b", 1), ("c", 2)}
    assert {r.tableName for r in spark.sql("SHOW TABLES").collect()} == before and spark.conf.get(setting) == kept
    with pytest.raises(Exception):
        R.reach(edges.withColumn("dst", F.raise_error(F.lit("bad"))), spark.createDataFrame([("a",)], "root string"))
    assert {r.tableName for r in spark.sql("SHOW TABLES").collect()} == before and spark.conf.get(setting) == kept


def test_random_graphs_several_roots(spark):
    draw = random.Random(6)
    pairs = [(f"u{draw.randrange(60)}", f"u{draw.randrange(60)}") for _ in range(90)]
    pairs += [(f"u{k}", "hub") for k in range(60)] + [("hub", f"v{k}") for k in range(200)]
    roots = ["u1", "u2", "u3", "alone"]
    edges = spark.createDataFrame(pairs, "src string, dst string")
    near = walk(pairs, roots)
    for buckets in (1, 5):
        found = R.reach(edges, spark.createDataFrame([(r,) for r in roots], "root string"), buckets=buckets).collect()
        assert {(r.root, r.url): r.depth for r in found} == near and len(found) == len(near)
    cut = R.reach(edges, spark.createDataFrame([(r,) for r in roots], "root string"), max_depth=1).collect()
    assert {(r.root, r.url): r.depth for r in cut} == {k: d for k, d in near.items() if d <= 1}


def test_links_of_one_root_each_and_odd_rows(spark):
    rows = [("r", "r", "x"), ("s", "r", "y"), ("r", "x", None), ("r", None, "z"), (None, "r", "q"), ("r", "x", "r"), ("r", "r", "x")]
    edges = spark.createDataFrame(rows, "root string, src string, dst string")
    roots = spark.createDataFrame([("r",), ("r",), (None,)], "root string")
    assert {(r.root, r.url, r.depth) for r in R.reach(edges, roots).collect()} == {("r", "r", 0), ("r", "x", 1)}
    assert R.reach(edges, roots.limit(0)).count() == 0
    assert {tuple(r) for r in R.reach(edges.limit(0), roots).collect()} == {("r", "r", 0)}


def test_roots_of_a_set_follow_a_link_once(spark):
    """Seventy roots, more than a set holds, reach one page: a link of it is one row for each set, and no stored table moves."""
    pairs = [(f"u{k}", "hub") for k in range(70)] + [("hub", f"v{k}") for k in range(50)] + [("v1", "u3"), ("v2", None), (None, "u5")]
    roots = [f"u{k}" for k in range(70)]
    edges = spark.createDataFrame(pairs, "src string, dst string")
    found = R.reach(edges, spark.createDataFrame([(r,) for r in roots], "root string")).collect()
    near = walk([(s, d) for s, d in pairs if s and d], roots)
    assert {(r.root, r.url): r.depth for r in found} == near and len(found) == len(near)
    starts = spark.createDataFrame([(r, "hub") for r in roots] + [("u1", "v9")], "root string, url string")
    first, places = R.in_sets(starts)
    tables = R._Tables(spark, BUCKETS)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.legacy.bucketedTableScan.outputOrdering": "true", "spark.sql.shuffle.partitions": str(BUCKETS)}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        tables.write_links(edges, ["src"])
        tables.create_seen(first.schema)
        assert tables.add(first, 0) == 3  # (set, hub) twice, (set, v9)
        fresh = R.next_sets(tables.level(0), spark.table(tables.links), spark.table(tables.seen))
        assert fresh.count() == 100 and fresh.filter("url = 'v9'").count() == 2
        plan = plan_of(fresh)
        assert plan.count("Exchange hashpartitioning(root") == 1 and plan.count("Exchange ") == 2, plan
        tables.add(fresh, 1)
        levels = spark.table(tables.seen)
        told = {(r.root, r.url, r.depth) for r in R.out_of_sets(levels, places).collect()}
        assert told == {(r, "hub", 0) for r in roots} | {("u1", "v9", 0)} | {(r, f"v{k}", 1) for r in roots for k in range(50)} - {("u1", "v9", 1)}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
        tables.close()

"""Every registered query beside its SQL, on the smallest tables."""

import glob
import os
import re
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from check import rows_of  # noqa: E402
from linkloom.plans import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = E.queries()[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    result = con.execute(E.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, got) == rows_of(columns, result.fetchall())


def test_entry(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 10


def test_no_cut_of_inputs():
    """Rules of the code base that are easy to break by accident."""
    for path in glob.glob(f"{ROOT}/linkloom/**/*.py", recursive=True):
        if "/llm/" in path:  # tested on its own
            continue
        source = open(path).read()
        assert "localCheckpoint" not in source and "crossJoin" not in source, path
        assert not re.search(r"\.sample\(|toPandas\(|\.rdd\.(map|collect)", source), path

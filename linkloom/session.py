"""Session settings, the shared work folder, and written intermediate tables."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are designed for. A cluster session should carry the same ones.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more shuffle after the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "linkloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Set the recommended runtime settings on a session somebody else built."""
    for key, value in RECOMMENDED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# Up to this size of each of its parts a join's side is taken for a hash table.
HASH_JOIN_PART = "64m"


@contextlib.contextmanager
def joining_by_hash(*sessions: SparkSession) -> Iterator[None]:
    """Inside, AQE joins without sorting wherever every part of a side turns out to be small; other joins sort as ever."""
    key = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = [(s, s.conf.get(key)) for s in sessions]
    try:
        for session in sessions:
            session.conf.set(key, HASH_JOIN_PART)
        yield
    finally:
        for session, value in reversed(before):
            session.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Only a local master may go without it; a folder of one machine is no good on a cluster.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):  # local-cluster has executors of its own
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    existing = getattr(context, "_linkloom_folder", None)
    if existing is None:
        existing = tempfile.mkdtemp(prefix="linkloom-")
        context._linkloom_folder = existing
    return existing


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, in the part that belongs to this application."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/linkloom/{spark.sparkContext.applicationId}"


def clear_work(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, once their results are not needed."""
    fs, target = _hadoop(spark, _own_folder(spark))
    fs.delete(target, True)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage, so a lost executor costs only its own tasks, and freezes rows whose layout
    (for example sampled range bounds) must not change between two uses.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_bucketed(df: DataFrame, label: str, by: str) -> DataFrame:
    """``settle`` that keeps the placement by a column: groups and joins of it shuffle nothing more.

    The table leaves the catalog at once; the plan that is returned keeps the files it reads and their buckets.
    """
    spark, path = df.sparkSession, work_path(df.sparkSession, label)
    buckets, name = int(spark.conf.get("spark.sql.shuffle.partitions")), "settled_" + path[-32:]
    df.repartition(buckets, by).write.bucketBy(buckets, by).option("path", path).saveAsTable(name)
    settled = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return settled


def spread(df: DataFrame, key: str) -> DataFrame:
    """Place rows by key when the table has fewer splits than the cluster has cores.

    Meant before costly work per row (parsing pages). A large table has splits enough and is left
    alone, so nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder (metadata only); empty when the folder is missing."""
    fs, target = _hadoop(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target)]

"""Row numbers and first rows that hold up when one key owns most of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkloom.session import settle

# Spark cuts a group to its first k rows before the shuffle while k stays within
# spark.sql.optimizer.windowGroupLimitThreshold, whose default is this.
GROUP_LIMIT = 1000
# Beyond this many rows a sorted top-k would fill one task, so rows are numbered instead: the same rows in the same order.
TOP_ROWS = 10_000


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key in the given order.

    The literal bound lets Spark keep one row per key and task before it shuffles
    (WindowGroupLimit), so a key with any number of copies stays cheap.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= 1).drop("_place")


# parts over which rows without a key are spread
NULL_PARTS = 1024


def join_keeping(rows: DataFrame, known: DataFrame, on: list[str], spread_by: str) -> DataFrame:
    """Left join of many rows with a table that has each key at most once.

    Rows with a null key match nothing, but a plain join would send all of them to one task: they
    are spread by another column. AQE splits any other hot key, as the rows are the left side.
    """
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    part = F.when(missing, F.pmod(F.hash(spread_by), F.lit(NULL_PARTS))).otherwise(F.lit(0))
    # always 0, but not a constant to the optimizer, which would drop it from the join key
    zero = F.pmod(F.hash(*on), F.lit(1))
    joined = rows.withColumn("_part", part).join(known.withColumn("_part", zero), [*on, "_part"], "left")
    return joined.drop("_part")


def running_number(
    df: DataFrame, keys: list[str], order: list[Column], name: str = "n", partitions: int | None = None
) -> DataFrame:
    """``row_number()`` per key (or over all rows, without keys), never one key in one task.

    Rows are range-partitioned by key and order, numbered inside each partition, and lifted by
    the number of rows their key has in earlier partitions. ``order`` must be unique within a key.
    The range bounds come from a sample, so the laid-out rows are written once and both uses read
    the same layout.
    """
    spark = df.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = settle(
        df.repartitionByRange(count, *[F.col(k) for k in keys], *order).withColumn(
            "_part", F.spark_partition_id()
        ),
        "ranked",
    )
    sizes = laid.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_size"))
    by_key = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_part")
    earlier = F.sum("_size").over(by_key.rowsBetween(Window.unboundedPreceding, -1))
    # only the first key of a partition can have begun before it: at most one row per partition
    lifts = sizes.select("_part", *keys, earlier.alias("_before")).filter(F.col("_before") > 0)
    lifts = lifts.toDF("_b_part", *[f"_b_{k}" for k in keys], "_before")
    inside = F.row_number().over(Window.partitionBy("_part", *keys).orderBy(*order))
    match = F.col("_part") == F.col("_b_part")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_b_{k}"))
    numbered = laid.withColumn("_inside", inside).join(F.broadcast(lifts), match, "left")
    number = F.coalesce("_before", F.lit(0)) + F.col("_inside")
    return numbered.select(*df.columns, number.cast("bigint").alias(name))


def numbered_between(
    df: DataFrame, keys: list[str], order: list[Column], first: int, last: int | None, name: str = "n"
) -> DataFrame:
    """Rows numbered ``first..last`` (from 1, both included) within each key."""
    if last is not None and last <= GROUP_LIMIT and keys:
        # the bare row number is compared, or Spark would not recognise the bound
        raw = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        kept = raw.filter(F.col(name) <= last)
        return kept.filter(F.col(name) >= first).withColumn(name, F.col(name).cast("bigint"))
    ranked = running_number(df, keys, order, name)
    kept = ranked.filter(F.col(name) >= first)
    return kept if last is None else kept.filter(F.col(name) <= last)

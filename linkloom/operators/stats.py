"""Crawl statistics and rates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.operators.ranks import running_number

# Fixed value: a statistics row is due at every tenth page.
STEP = 10


def pages_per(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("pages_count"))


def crawl_statistics(crawled: DataFrame) -> DataFrame:
    """(domain, author_id, time, pages_count) of crawled pages (domain, author_id, time)."""
    return crawled.groupBy("domain", "author_id").agg(
        F.max("time").alias("time"), F.count(F.lit(1)).alias("pages_count")
    )


def every_nth(df: DataFrame, keys: list[str], order: list[Column], step: int = STEP) -> DataFrame:
    """Every tenth row of each key, with its running count ``n``."""
    return running_number(df, keys, order).filter(F.col("n") % step == 0)


def rate_report(df: DataFrame, keys: list[str], ts: str, limit: int, width: str = "1 second") -> DataFrame:
    """(keys, start, requests): windows in which a key made more requests than allowed."""
    return (
        df.groupBy(*keys, F.window(ts, width).alias("_w"))
        .agg(F.count(F.lit(1)).alias("requests"))
        .filter(F.col("requests") > limit)
        .select(*keys, F.col("_w.start").alias("start"), "requests")
    )


def sliding_rate(df: DataFrame, keys: list[str], ts: str, limit: int, width: dt.timedelta = dt.timedelta(seconds=1)) -> DataFrame:
    """(keys, ts, requests): the moments at which a key had made more requests than allowed within the last ``width``.

    The frame runs with the requests, so a burst across the edge of a calendar second counts. It begins
    after ``ts - width`` and holds the moment itself. Requests of one moment are added up first. A key's time is cut into
    slices of one width; a moment is counted in its slice and shown to the next, so a task meets a
    slice of a key and never all of a hot key. Rows without time count nowhere; a null key is a key.
    """
    micros = int(width / dt.timedelta(microseconds=1))
    if micros < 1:
        raise ValueError("the width must be a microsecond or more")
    moments = df.filter(F.col(ts).isNotNull()).groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("_n"))
    placed = moments.withColumn("_at", F.unix_micros(F.col(ts).cast("timestamp")))
    placed = placed.withColumn("_own", F.expr(f"(_at - pmod(_at, {micros})) div {micros}"))
    shown = placed.withColumn("_slice", F.explode(F.array(F.col("_own"), F.col("_own") + 1)))
    frame = Window.partitionBy(*keys, "_slice").orderBy("_at").rangeBetween(1 - micros, 0)
    counted = shown.withColumn("requests", F.sum("_n").over(frame))
    return counted.filter((F.col("_slice") == F.col("_own")) & (F.col("requests") > limit)).select(*keys, ts, "requests")


def rate_stream(
    stream: DataFrame, keys: list[str], ts: str, limit: int, width: str = "1 second", step: str = "100 milliseconds", late: str = "10 seconds"
) -> DataFrame:
    """(keys, start, requests) over a stream: windows of ``width``, one beginning every ``step``, with too many requests.

    Counts are added up before the shuffle; a window is given out once the watermark (``late``) has passed it,
    and its state is dropped.
    """
    windows = stream.withWatermark(ts, late).groupBy(*keys, F.window(ts, width, step).alias("_w")).agg(F.count(F.lit(1)).alias("requests"))
    return windows.filter(F.col("requests") > limit).select(*keys, F.col("_w.start").alias("start"), "requests")

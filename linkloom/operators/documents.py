"""Documents of pages: text, latest version, index name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.html import html_text
from linkloom.functions.urls import index_name
from linkloom.operators.ranks import first_per_key
from linkloom.session import child_names, path_exists

DOCUMENT = "index_name string, url string, content string"


def page_documents(pages: DataFrame, root: Column | None = None, *extra: str) -> DataFrame:
    """(index_name, url, content): one document per page, in the index of its root."""
    out = [F.col("url"), html_text(F.col("html")).alias("content"), *[F.col(c) for c in extra]]
    if root is None:
        return pages.select(*out)
    return pages.select(index_name(root).alias("index_name"), *out)


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last written row of every key; ``order`` says what is later."""
    return first_per_key(df, keys, [c.desc() for c in order])


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``latest`` where the order columns are unique within a key: keys and order alone are compared.

    The rows, however wide, meet the choice once, and are not shuffled at all where it is small.
    """
    chosen = latest(df.select(*keys, *order), keys, [F.col(c) for c in order])
    return df.join(chosen, [*keys, *order], "left_semi")


def write_documents(documents: DataFrame, path: str, order: list[Column]) -> None:
    """Store documents (index_name, url, content) by index and url; the last one of a url counts.

    Documents stored before stay unless one with their index and url comes now. A write makes a new version
    beside the last, so a failed one is never seen. Ranges of (index, url) keep an index in neighbouring
    files, split where it is large: the number of files follows the data, not the number of sites.
    """
    spark, keys = documents.sparkSession, ["index_name", "url"]
    now = latest(documents, keys, order).select(*keys, "content")
    before = read_documents(spark, path)
    rows = before.join(now.select(*keys), keys, "left_anti").unionByName(now)
    placed = rows.repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    placed.write.mode("overwrite").parquet(f"{path}/v{_newest(spark, path) + 1:010d}")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the newest complete version; none before the first write."""
    newest = _newest(spark, path)
    if newest < 0:
        return spark.createDataFrame([], DOCUMENT)
    return spark.read.schema(DOCUMENT).parquet(f"{path}/v{newest:010d}")


def _newest(spark: SparkSession, path: str) -> int:
    numbers = [n[1:] for n in child_names(spark, path) if n[:1] == "v" and n[1:].isdigit()]
    return max((int(n) for n in numbers if path_exists(spark, f"{path}/v{n}/_SUCCESS")), default=-1)

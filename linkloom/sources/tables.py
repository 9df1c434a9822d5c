"""Stored tables and streams over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.session import is_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages")


def usable_pages(df: DataFrame, dropped: tuple[int, ...] = (404,)) -> DataFrame:
    """Pages whose fetch worked. Only the listed statuses are dropped; no status counts as fine."""
    if "status" not in df.columns:
        return df
    return df.filter(F.col("status").isNull() | ~F.col("status").isin(*dropped))


def table_stream(
    spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None
) -> DataFrame:
    """A stored table read as a stream of its files.

    A file stream wants a folder: a table that is one file is picked out of its parent by name.
    """
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)

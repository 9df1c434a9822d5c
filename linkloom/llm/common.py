"""What the operators share: column picking, row keys, byte texts and Python tasks over Arrow batches."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.session import work_path

WHITE_SPACE = r"\x20\x09-\x0D"


def named(name: str) -> Column:
    """A column by its literal name, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def texts(df: DataFrame, id_column: str, text_column: str, **more: Column) -> DataFrame:
    """Only the columns an operator needs: id, the whole text as UTF-8 bytes, and ``more``.

    Other columns of the input, whatever their names, never reach the operator.
    """
    picked = [value.alias(name) for name, value in more.items()]
    return df.select(named(id_column).alias("id"), named(text_column).cast("binary").alias("text"), *picked)


def remainder(name: str, modulus: int) -> Column:
    """crc32 of an id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(named(name).cast("string").cast("binary")) % modulus


def map_batches(df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """Run ``task`` on the Arrow batches of a partition; it yields dicts of equally long column lists."""
    arrow = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in task(batches):
            arrays = [
                column if isinstance(column, pa.Array) else pa.array(column, field.type)
                for field, column in ((field, columns[field.name]) for field in arrow)
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def partition_number() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


def row_keys(first: int, count: int) -> list[int]:
    """Keys of rows within one job: the partition's number above 33 bits of running number.

    They name rows, so repeated or missing ids do no harm. Whoever uses them twice writes them first.
    """
    base = partition_number() << 33
    return list(range(base + first, base + first + count))


def broadcast_value(df: DataFrame, value):
    return df.sparkSession.sparkContext.broadcast(value)


def settle_dense(df: DataFrame, label: str) -> DataFrame:
    """``settle`` for tables of repeated text, which zstd packs far better than the usual codec."""
    path = work_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now instead of at some later garbage collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()

"""Sinks of the streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from linkloom.session import work_path


def write_stream(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None):
    """Append the stream to a Parquet folder until the input at hand is used up."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).outputMode("append").start(path)


def run_to_table(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over the input at hand and read what it wrote."""
    spark = stream.sparkSession
    base = work_path(spark, label)
    write_stream(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def batch_name(batch: DataFrame, number: int, fallback: str) -> tuple[str, int]:
    """(query id, batch number) of a micro-batch. The id lives in the checkpoint, so a new checkpoint gives a new one."""
    running = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return running or fallback, number


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand every micro-batch to a function, with its number."""
    (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )



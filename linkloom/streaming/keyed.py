"""Per-key state: seen keys and counters."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from linkloom.operators.stats import STEP


def seen_once(stream: DataFrame, key: str, spread_by: Column | None = None, spread: int = 16) -> DataFrame:
    """Each key goes on once.

    With ``spread_by`` a key is first deduplicated in ``spread`` slices, so that a key holding a
    large part of the stream is not met by one task; at most ``spread`` rows of it go further.
    """
    if spread_by is not None:
        sliced = stream.withColumn("_slice", F.pmod(F.hash(spread_by), F.lit(spread)))
        stream = sliced.dropDuplicates([key, "_slice"]).drop("_slice")
    return stream.dropDuplicates([key])


def seen_within(stream: DataFrame, key: str, ts: str, memory: str = "1 hour") -> DataFrame:
    """Each key goes on once within the watermark; older keys are forgotten, so state is bounded."""
    return stream.withWatermark(ts, memory).dropDuplicatesWithinWatermark([key])


def step_counter(key: str, key_type: str, step: int):
    """A state processor that keeps a count and emits it whenever it passes a multiple of the step."""

    class StepCounter(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self._count = handle.getValueState("count", "n bigint")

        def handleInputRows(self, keys, rows, timerValues) -> Iterator[pd.DataFrame]:
            before = self._count.get()[0] if self._count.exists() else 0
            after = before + sum(int(part["n"].sum()) for part in rows)
            self._count.update((after,))
            reached = range((before // step + 1) * step, after + 1, step)
            # plain objects: Arrow-backed text columns of pandas do not fit the state runner
            named = pd.Series([keys[0]] * len(reached), dtype=object)
            yield pd.DataFrame({key: named, "n": pd.Series(reached, dtype="int64")})

        def close(self) -> None:
            pass

    return StepCounter(), f"{key} {key_type}, n bigint"


def count_steps(stream: DataFrame, key: str, step: int = STEP) -> DataFrame:
    """(key, n): n = 10, 20, ... as the count of the key's rows passes each of them.

    Rows are counted per Arrow batch before the shuffle, so a hot key sends a few partial counts.
    """
    key_type = dict(stream.dtypes)[key]
    schema = f"{key} {key_type}, n bigint"

    def partial(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            counted = part.groupby(key, dropna=False).size().reset_index(name="n")
            yield counted.astype({key: object})

    processor, out = step_counter(key, key_type, step)
    return (
        stream.select(key)
        .mapInPandas(partial, schema)
        .groupBy(key)
        .transformWithStateInPandas(processor, out, "append", "none")
    )

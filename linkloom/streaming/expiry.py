"""Sessions that say when they end: state with timers in event time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

DAY = 24 * 3600 * 1_000_000  # microseconds; fixed value: how long a login is good for


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans (first login, end) in order, those joined where one begins before the other ends."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def expiring(name: str, key_type: str):
    """A processor over spans (key, first, end in microseconds) that emits each session when the watermark passes its end.

    A key costs a few calls to the state a batch: its spans are one value, and its only timer is at its next end. What
    the watermark has passed is told where the key's rows are handled, so mostly keys without rows need their timer.
    """

    class Expiring(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self._handle = handle
            # times: first and end of every span, in order
            self._open = handle.getValueState("open", "times array<bigint>")

        def _spans(self) -> list[tuple[int, int]]:
            held = self._open.get()
            return list(zip(held[0][::2], held[0][1::2])) if held else []

        def _keep(self, held: list[tuple[int, int]], spans: list[tuple[int, int]]) -> None:
            if spans and spans != held:
                self._open.update(([t for span in spans for t in span],))
            elif held and not spans:
                self._open.clear()

        def _told(self, value, held: list[tuple[int, int]], spans: list[tuple[int, int]], now: int, fired: int | None) -> Iterator[Row]:
            """The spans that have ended by ``now`` (milliseconds); the others are kept, with a timer for the next end."""
            left = [s for s in spans if due(s[1]) > now]
            self._keep(held, left)
            before, wanted = due(held[0][1]) if held else None, due(left[0][1]) if left else None
            if before != wanted:
                if before is not None and before != fired:  # Spark takes away the one that fired
                    self._handle.deleteTimer(before)
                if wanted is not None:
                    self._handle.registerTimer(wanted)
            for first, end in spans[:len(spans) - len(left)]:
                yield Row(**{name: value, "first": first, "end": end})

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            held = self._spans()
            spans = merged(held + [(r["first"], r["end"]) for r in rows])
            yield from self._told(key[0], held, spans, timerValues.getCurrentWatermarkInMs(), None)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            held = self._spans()
            yield from self._told(key[0], held, held, timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())

        def close(self) -> None:
            pass

    return Expiring(), f"{name} {key_type}, first bigint, end bigint"


def due(end: int) -> int:
    """Milliseconds of a timer for an end in microseconds: never before it."""
    return -(-end // 1000)


def login_spans(keys: pa.Array, at: pa.Array, life: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(keys, first, end) of the spans that logins (microseconds) open and extend; those without a time are none."""
    timed = pc.is_valid(at)
    keys, at = keys.filter(timed), at.filter(timed).to_numpy(zero_copy_only=False)
    code = keys.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    order = np.lexsort((at, code))
    code, at = code[order], at[order]
    opens = np.r_[True, (code[1:] != code[:-1]) | (at[1:] - at[:-1] >= life)][:len(at)]
    begin = np.flatnonzero(opens)
    last = np.r_[begin[1:], len(at)][:len(begin)] - 1
    return keys.take(pa.array(order[begin])), pa.array(at[begin]), pa.array(at[last] + life)


def expired_sessions(logins: DataFrame, key: str, ts: str, late: str = "1 hour", life: int = DAY) -> DataFrame:
    """(key, first, end) in microseconds: every session once, when the watermark passes its end; then its state is gone.

    A login (``ts``) opens a session for ``life`` microseconds or, before its end, makes it longer. Sessions do not depend on
    the order of the logins as long as none comes ``late``. The logins of a key in one Arrow batch become spans
    before the shuffle, so a hot key sends a few rows.
    """
    key_type = dict(logins.dtypes)[key]

    def spans(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield pa.RecordBatch.from_arrays([*login_spans(part.column(0), part.column(1), life)], [key, "first", "end"])

    processor, schema = expiring(key, key_type)
    arrived = logins.select(key, F.unix_micros(F.col(ts).cast("timestamp"))).mapInArrow(spans, f"{key} {key_type}, first bigint, end bigint")
    timed = arrived.withColumn("last", F.timestamp_micros(F.col("end") - life)).withWatermark("last", late)
    return timed.groupBy(key).transformWithState(processor, schema, "append", "EventTime")

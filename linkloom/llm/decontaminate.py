"""Benchmark decontamination by Wu-Manber search over words.

The test strings are windows of ten words (whole items where they have fewer). Strings of one length
form a class with a shift table over blocks of two words: a block that occurs in no string lets the
search skip the length less one, others as far as their last occurrence allows. Where the shift is zero,
the block is some string's suffix; the strings of that suffix bucket are compared word by word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import broadcast_value, map_batches, named, texts

WINDOW = 10
# A-Z become a-z, digits, a-z and everything from 0x80 stay, the rest parts words
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORDS).split() if text else []


@dataclass
class LengthClass:
    """All strings of one length in words."""

    length: int
    shift: dict = field(default_factory=dict)
    buckets: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.block = min(2, self.length)
        self.furthest = self.length - self.block + 1

    def add(self, window: tuple[bytes, ...], item: str | None) -> None:
        for end in range(self.block, self.length + 1):
            block = window[end - self.block:end]
            self.shift[block] = min(self.shift.get(block, self.furthest), self.length - end)
        bucket = self.buckets.setdefault(window[-self.block:], {})
        bucket.setdefault(window, set()).add(item)

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set]]:
        """(end, items) of each occurrence of a string."""
        shift, furthest, block, length = self.shift.get, self.furthest, self.block, self.length
        end, n = length, len(words)
        while end <= n:
            step = shift(tuple(words[end - block:end]), furthest)
            if step:
                end += step
                continue
            items = self.buckets[tuple(words[end - block:end])].get(tuple(words[end - length:end]))
            if items:
                yield end, items
            end += 1


@dataclass
class Patterns:
    classes: dict[int, LengthClass] = field(default_factory=dict)

    @staticmethod
    def of(items: list[tuple[str | None, bytes | None]], window: int = WINDOW) -> Patterns:
        made = Patterns()
        for item, text in items:
            words = words_of(text)
            length = min(window, len(words))
            if length:
                one = made.classes.setdefault(length, LengthClass(length))
                for at in range(len(words) - length + 1):
                    one.add(tuple(words[at:at + length]), item)
        return made

    def hits(self, words: list[bytes]) -> tuple[bytearray, set]:
        """A flag for each word inside an occurrence, and the items found."""
        flags, items = bytearray(len(words)), set()
        for length, one in self.classes.items():
            for end, found in one.search(words):
                flags[end - length:end] = b"\1" * length
                items |= found
        return flags, items


def shards(benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text", shard_mb: int = 16) -> list[list]:
    """The benchmark's items in lists of at most about ``shard_mb`` MB of text (a longer item is alone).

    A benchmark is a given list of tests, not corpus data; its tables go to every task one shard at a
    time. Items are read in order of their ids, one shard in memory at a time.
    """
    rows = benchmark.select(named(id_column).cast("string").alias("id"), named(text_column).cast("binary").alias("text"))
    made, size = [[]], 0
    for row in rows.where(F.col("text").isNotNull()).distinct().orderBy("id", "text").toLocalIterator():
        if made[-1] and size + len(row.text) > shard_mb << 20:
            made.append([])
            size = 0
        made[-1].append((row.id, bytes(row.text)))
        size += len(row.text)
    return [shard for shard in made if shard]


def search(df: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id",
           item_text_column: str = "text", window: int = WINDOW, shard_mb: int = 16,
           carry: dict[str, Column] | None = None) -> DataFrame:
    """For each row: ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated`` and what ``carry`` names.

    A word is hit if it lies inside any occurrence of a window. Items are the distinct ids with a window
    in the text, sorted as strings; an item without id marks words but is not listed. Null and wordless
    texts have no hit, and null items no window. Texts are searched where they lie: nothing is shuffled.
    With several shards a text passes through them one after another.
    """
    carry = carry or {}
    rows = df.select(named(text_column).cast("binary").alias("text"), F.struct(F.lit(0).alias("_"), *[v.alias(k) for k, v in carry.items()]).alias("carried"))
    carried = rows.schema["carried"].dataType.simpleString()
    lists = shards(benchmark, item_column, item_text_column, shard_mb) or [[]]
    rows = rows.withColumn("flags", F.lit(None).cast("binary")).withColumn("items", F.array().cast("array<string>"))
    for k, items in enumerate(lists):
        rows = _pass(rows, broadcast_value(df, items), window, carried, k == len(lists) - 1)
    return rows.select(*[F.col(f"carried.{k}").alias(k) for k in carry], "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


_TABLES: dict = {}  # of a Python worker: the compiled shard of the last broadcast


def _pass(rows: DataFrame, items, window: int, carried: str, last: bool) -> DataFrame:
    """Search one shard; the last pass counts."""
    if last:
        schema = f"carried {carried}, n_words long, n_hit long, n_items long, items_sha256 string"
    else:
        schema = f"text binary, carried {carried}, flags binary, items array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        if _TABLES.get("id") != (items.id if hasattr(items, "id") else id(items)):
            _TABLES.update(id=items.id if hasattr(items, "id") else id(items), patterns=Patterns.of(items.value, window))
        patterns = _TABLES["patterns"]
        for batch in batches:
            texts, before, seen = (batch.column(k).to_pylist() for k in (0, 2, 3))
            out = {"n_words": [], "n_hit": [], "n_items": [], "items_sha256": [], "flags": [], "items": []}
            for text, flags, names in zip(texts, before, seen):
                words = words_of(text)
                hit, found = patterns.hits(words)
                found |= set(names)
                if flags is not None:
                    hit = bytes(a | b for a, b in zip(hit, flags))
                listed = sorted(x for x in found if x is not None)
                out["n_words"].append(len(words))
                out["n_hit"].append(sum(hit))
                out["n_items"].append(len(listed))
                out["items_sha256"].append(hashlib.sha256(",".join(listed).encode()).hexdigest())
                out["flags"].append(bytes(hit))
                out["items"].append(listed)
            yield out | {"text": batch.column(0), "carried": batch.column(1)}

    return map_batches(rows, run, schema)

"""A bounded filter of keys that were seen: small enough for every task, exact where it is not sure.

The filter is a table of 64-bit words. A key's digest names one word and four of its bits; words are the OR of their keys'
bits, put together before the shuffle. A key with a bit missing was never seen. A key with all bits may have been, and
only such keys go on to the exact anti-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 22  # of a filter unless said otherwise: 65,536 words, about half a million keys at a few false hits in a hundred
BITS_A_KEY = 4


def _word(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits // 64)).cast("int")


def _mask(key: Column) -> Column:
    # a second digest, six bits at a time
    digest = F.xxhash64(key, F.lit("bits"))
    mask = F.lit(0).cast("bigint")
    for k in range(BITS_A_KEY):
        at = F.shiftrightunsigned(digest, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), at))
    return mask


def seen_filter(seen: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """(word, bits) of the keys: at most ``bits`` / 64 rows, whatever the number of keys."""
    if bits < 64 or bits % 64:
        raise ValueError("the size of a filter is a multiple of 64 bits")
    marked = seen.filter(F.col(key).isNotNull()).select(_word(F.col(key), bits).alias("word"), _mask(F.col(key)).alias("bits"))
    return marked.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def with_maybe(rows: DataFrame, words: DataFrame, key: str, bits: int = BITS, name: str = "maybe") -> DataFrame:
    """``rows`` and whether their key may have been seen. The filter is broadcast: its size is bounded by ``bits``."""
    asked = rows.withColumns({"_word": _word(F.col(key), bits), "_mask": _mask(F.col(key))})
    known = F.broadcast(words.select(F.col("word").alias("_word"), F.col("bits").alias("_bits")))
    hit = F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask")
    return asked.join(known, "_word", "left").withColumn(name, F.coalesce(hit, F.lit(False))).drop("_word", "_mask", "_bits")


def unseen(rows: DataFrame, seen: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """The rows whose key is not in ``seen``; exact whatever the filter's size.

    Keys the filter does not know are new and meet nothing else; the rest are joined with the seen keys. Rows
    with a null key are new.
    """
    asked = with_maybe(rows, seen_filter(seen, key, bits), key, bits, "_maybe")
    surely = asked.filter(~F.col("_maybe")).drop("_maybe")
    known = seen.filter(F.col(key).isNotNull()).select(key)
    checked = asked.filter("_maybe").drop("_maybe").join(known, key, "left_anti")
    return surely.select(*rows.columns).unionByName(checked.select(*rows.columns))

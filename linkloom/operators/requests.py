"""Checks of request parameters: present, numeric, within bounds, with a token."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the request rules.
DEFAULT_LIMIT = 10
DEFAULT_OFFSET = 0
LARGEST_LIMIT = 100


class Checked(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame


def all_present(names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def required(df: DataFrame, names: list[str]) -> Checked:
    """Requests with all the parameters, and the others."""
    whole = all_present(names)
    return Checked(df.filter(whole), df.filter(~whole).withColumn("reason", F.lit("missing parameter")))


def lenient_paging(df: DataFrame, q: str = "q", limit: str = "limit", offset: str = "offset") -> Checked:
    """Missing, unreadable or negative paging falls back to 10 and 0; a request needs only its query."""
    read = df.withColumns({
        name: F.coalesce(F.when(F.col(name).try_cast("bigint") >= 0, F.col(name).try_cast("bigint")), F.lit(usual).cast("bigint"))
        for name, usual in ((limit, DEFAULT_LIMIT), (offset, DEFAULT_OFFSET))
    })
    asked = F.col(q).isNotNull()
    return Checked(read.filter(asked), read.filter(~asked).withColumn("reason", F.lit("missing parameter")))


def strict_paging(df: DataFrame, q: str = "q", limit: str = "limit", offset: str = "offset") -> Checked:
    """All three parameters are needed, paging must be whole numbers from 0, at most 100 hits."""
    numbers = {n: F.col(n).try_cast("bigint") for n in (limit, offset)}
    reason = (
        F.when(~all_present([q, limit, offset]), F.lit("missing parameter"))
        .when(numbers[limit].isNull() | numbers[offset].isNull(), F.lit("bad value"))
        .when((numbers[limit] > LARGEST_LIMIT) | (numbers[limit] < 0) | (numbers[offset] < 0), F.lit("bad value"))
    )
    judged = df.withColumn("reason", reason)
    return Checked(
        judged.filter(F.col("reason").isNull()).drop("reason").withColumns(numbers),
        judged.filter(F.col("reason").isNotNull()),
    )


def token_outcome(token: Column) -> Column:
    """'forbidden' without a token, else null."""
    return F.when(token.isNull(), F.lit("forbidden"))

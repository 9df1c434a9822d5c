"""Conditions, lookups, slices and set-wise changes of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.operators.ranks import TOP_ROWS, first_per_key, running_number


def condition(name: str, value: object) -> Column:
    """``name=v``, ``name__lt=v``, ``name__le``, ``name__gt``, ``name__ge``.

    Any other suffix belongs to the column name and means equality.
    """
    column, _, suffix = name.rpartition("__")
    if column and suffix in ("lt", "le", "gt", "ge"):
        compare = getattr(F.col(column), f"__{suffix}__")
        return compare(F.lit(value))
    return F.col(name) == F.lit(value)


def conditions(**wanted: object) -> Column:
    """All conditions together; none at all is always true."""
    return reduce(lambda a, b: a & b, [condition(n, v) for n, v in wanted.items()], F.lit(True))


def where(df: DataFrame, **wanted: object) -> DataFrame:
    for name, value in wanted.items():
        df = df.filter(condition(name, value))
    return df


def lookup(df: DataFrame, order: list[Column], **keys: object) -> DataFrame:
    """At most one row: the first in the given order that equals all keys."""
    unknown = [k for k in keys if k not in df.columns]
    if unknown:
        raise AttributeError(f"no column {', '.join(unknown)}")
    for name, value in keys.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df.orderBy(*order).limit(1)


def lookup_many(df: DataFrame, keys: DataFrame, on: list[str], order: list[Column]) -> DataFrame:
    """The first matching row for every key of a key table.

    The key table goes first: where it is small, Spark sends it to the scan and only wanted rows are left; where
    it is not, AQE splits a hot key. Each task then keeps its first row of a key before the shuffle.
    """
    return first_per_key(df.join(keys.select(*on).distinct(), on, "left_semi"), on, order)


def slice_rows(
    df: DataFrame, order: list[str], start: int = 0, stop: int | None = None, step: int = 1
) -> DataFrame:
    """Python's ``rows[start:stop:step]`` over the rows in the given column order, and in that order.

    The order columns must be a key: unique and not null. ``TOP_ROWS`` chooses the plan, never the rows or
    their order.
    """
    if step < 1:
        raise ValueError("the step of a slice must be positive")
    if start < 0 or (stop is not None and stop < 0):
        size = df.count()
        start = max(size + start, 0) if start < 0 else start
        stop = max(size + stop, 0) if stop is not None and stop < 0 else stop
    if stop is not None and stop <= start:
        return df.limit(0)
    columns = [F.col(c) for c in order]
    if step == 1 and start == 0 and stop is None:
        return df.orderBy(*columns)
    if step == 1 and stop is not None and stop <= TOP_ROWS:
        return df.orderBy(*columns).offset(start).limit(stop - start)
    # only the order columns are numbered; whole rows meet the wanted numbers once
    ranked = running_number(df.select(*order), [], columns, "_place")
    wanted = ranked.filter(F.col("_place") > start)
    if stop is not None:
        wanted = wanted.filter(F.col("_place") <= stop)
    if step > 1:
        wanted = wanted.filter((F.col("_place") - 1 - start) % step == 0)
    return df.join(wanted.select(*order), order, "left_semi").orderBy(*columns)


def item_at(df: DataFrame, order: list[str], index: int) -> DataFrame:
    """The row at an index, or no row past the end; a negative index counts from the end."""
    if index < -TOP_ROWS:
        index += df.count()
        if index < 0:
            return df.limit(0)
    if index < 0:
        backwards = [F.col(c).desc() for c in order]
        return df.orderBy(*backwards).offset(-index - 1).limit(1)
    return slice_rows(df, order, index, index + 1)


def update_where(df: DataFrame, matched: Column, **values: object) -> DataFrame:
    """Set columns in the rows where the condition holds; a null condition does not."""
    types = dict(df.dtypes)
    hit = F.coalesce(matched, F.lit(False))
    changed = {
        n: F.when(hit, (v if isinstance(v, Column) else F.lit(v)).cast(types[n])).otherwise(F.col(n))
        for n, v in values.items()
    }
    return df.withColumns(changed)


def delete_where(df: DataFrame, matched: Column) -> DataFrame:
    return df.filter(~F.coalesce(matched, F.lit(False)))


def update_keys(df: DataFrame, keys: DataFrame, on: list[str], **values: object) -> DataFrame:
    """Set columns in all rows whose key is in the key table, in one join."""
    marked = df.join(keys.select(*on).distinct().withColumn("_hit", F.lit(True)), on, "left")
    return update_where(marked, F.col("_hit"), **values).select(*df.columns)


def delete_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys.select(*on), on, "left_anti")


def last_of_each(rows: DataFrame, on: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row of each key: the first by ``order``, or the last in the order of the input, as when rows are saved one by one."""
    if order:
        return first_per_key(rows, on, order)
    given = rows.withColumn("_given", F.monotonically_increasing_id())
    return first_per_key(given, on, [F.col("_given").desc()]).drop("_given")


def upsert(
    base: DataFrame, updates: DataFrame, on: list[str], order: list[Column] | None = None
) -> DataFrame:
    """Rows of ``updates`` replace rows with the same key; new keys are added.

    Where ``updates`` repeats a key, the first by ``order`` counts, without an order the last given.
    """
    latest = last_of_each(updates, on, order).select(*base.columns)
    return base.join(latest, on, "left_anti").select(*base.columns).unionByName(latest)


class RowSet:
    """A lazy set of rows of a stored table; conditions add up until something is asked for."""

    def __init__(self, table, matched: Column | None = None, df: DataFrame | None = None):
        self._table = table
        self._matched = matched
        self._df = df

    def all(self) -> DataFrame:
        df = self._table.read() if self._df is None else self._df
        return df if self._matched is None else df.filter(self._matched)

    def filter(self, **wanted: object) -> "RowSet":
        self._table.model.check_names(
            n.rpartition("__")[0] if n.rpartition("__")[2] in ("lt", "le", "gt", "ge") and "__" in n else n
            for n in wanted
        )
        added = conditions(**wanted)
        return RowSet(
            self._table, added if self._matched is None else self._matched & added, self._df
        )

    def get(self, **keys: object):
        """The first row equal on all keys, or None."""
        self._table.model.check_names(keys)
        return lookup(self.all(), [F.col(k) for k in self._table.key], **keys).first()

    def __getitem__(self, item):
        if isinstance(item, slice):
            return slice_rows(
                self.all(), self._table.key, item.start or 0, item.stop, item.step or 1
            )
        return item_at(self.all(), self._table.key, item).first()

    def __iter__(self):
        """Rows for the caller, one partition at a time; no operator uses this."""
        return self.all().toLocalIterator()

    def update(self, **values: object) -> "RowSet":
        self._table.update(F.lit(True) if self._matched is None else self._matched, **values)
        return self

    def delete(self) -> None:
        self._table.delete(F.lit(True) if self._matched is None else self._matched)

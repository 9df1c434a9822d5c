"""A table kept as versioned Parquet folders.

Parquet has no UPDATE or DELETE. A change, an insert too, is one set-wise plan over the current version,
written as the next version; readers take the newest version that Spark marked complete (``_SUCCESS``),
so a failed write is never seen. A version made of a streaming batch carries the names of its query and
batch, so that a batch that is run again is told from another query's batch of the same number.
Rows whose keys are known to be new need no plan over the table: ``append`` writes them alone, and a reader takes
the newest whole version with what was added to it since.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from linkloom.operators import rows as R
from linkloom.operators.schema import Model, Validated, validate, with_defaults
from linkloom.session import child_names, path_exists

# Additions a reader puts together; the next one is written with all rows, as a whole version.
MOST_ADDITIONS = 16


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, model: Model, key: list[str] | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.model = model
        self.key = key or ["id"]

    def _known(self) -> dict[int, str]:
        """Folders of the complete versions, oldest first: ``v`` and its number where it is whole, ``a`` for an addition."""
        found = {}
        for name in child_names(self.spark, self.path):
            number = name.partition(".")[0]
            if number[:1] in ("v", "a") and number[1:].isdigit() and path_exists(self.spark, f"{self.path}/{name}/_SUCCESS"):
                found[int(number[1:])] = name
        return dict(sorted(found.items()))

    @staticmethod
    def _parts(known: dict[int, str], version: int) -> list[str]:
        """Folders that hold a version: the whole one before or at it, and the additions since."""
        whole = max(v for v, name in known.items() if v <= version and name.startswith("v"))
        return [name for v, name in known.items() if whole <= v <= version]

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        return list(self._known())

    def read(self, version: int | None = None) -> DataFrame:
        known = self._known()
        if not known:
            return self.spark.createDataFrame([], self.model.struct)
        chosen = max(known) if version is None else version
        return self.spark.read.schema(self.model.struct).parquet(*[f"{self.path}/{p}" for p in self._parts(known, chosen)])

    def applied(self, batch: tuple[str, int]) -> int | None:
        """The version made of this batch (query id, number), if there is one."""
        mark = ".{}.{}".format(*batch)
        return next((v for v, name in self._known().items() if name.endswith(mark)), None)

    def write(self, df: DataFrame, batch: tuple[str, int] | None = None) -> int:
        """Store rows as the next version. A batch that made a version before is not written again."""
        return self._write(df, batch, "v")

    def _write(self, df: DataFrame, batch: tuple[str, int] | None, kind: str) -> int:
        if batch is not None and (done := self.applied(batch)) is not None:
            return done
        known = self._known()
        version = max(known) + 1 if known else 0
        mark = ".{}.{}".format(*batch) if batch else ""
        df.select(*self.model.names).write.mode("overwrite").parquet(f"{self.path}/{kind}{version:010d}{mark}")
        return version

    def append(self, rows: DataFrame, batch: tuple[str, int] | None = None) -> int:
        """Add rows whose keys the table does not hold, without reading it; of rows with one key the last given counts."""
        known, rows = self._known(), R.last_of_each(rows, self.key).select(*self.model.names)
        if known and len(self._parts(known, max(known))) <= MOST_ADDITIONS:
            return self._write(rows, batch, "a")
        return self._write(self.read().unionByName(rows), batch, "v")

    def insert(
        self,
        df: DataFrame,
        strict: bool = True,
        defaults: dict[str, object] | None = None,
        text_input: bool = False,
        fail_fast: bool = False,
    ) -> DataFrame | None:
        """Add validated rows and return the rejects."""
        checked: Validated = validate(df, self.model, strict, text_input, fail_fast=fail_fast)
        good = with_defaults(checked.rows, defaults) if defaults else checked.rows
        self.write(self.read().unionByName(good.select(*self.model.names)))
        return checked.rejects

    def upsert(
        self, updates: DataFrame, order: list[Column] | None = None, batch: tuple[str, int] | None = None
    ) -> int:
        return self.write(R.upsert(self.read(), updates, self.key, order), batch)

    def update(self, matched: Column, **values: object) -> int:
        self.model.check_names(values)
        return self.write(R.update_where(self.read(), matched, **values))

    def delete(self, matched: Column) -> int:
        return self.write(R.delete_where(self.read(), matched))

    def save(self, rows: DataFrame, order: list[Column] | None = None, fail_fast: bool = False) -> DataFrame | None:
        """Validated upsert of a row set; returns the rejects, or raises on the first with ``fail_fast``."""
        checked: Validated = validate(rows, self.model, fail_fast=fail_fast)
        self.upsert(checked.rows, order)
        return checked.rejects

    def delete_keys(self, keys: DataFrame) -> int:
        return self.write(R.delete_keys(self.read(), keys, self.key))

    def update_keys(self, keys: DataFrame, **values: object) -> int:
        self.model.check_names(values)
        return self.write(R.update_keys(self.read(), keys, self.key, **values))

    def all(self) -> DataFrame:
        return self.read()

    def filter(self, **wanted: object) -> R.RowSet:
        return R.RowSet(self).filter(**wanted)

    def get(self, **keys: object):
        return R.RowSet(self).get(**keys)

    def create(self, **values: object) -> DataFrame | None:
        """Insert one row given as keyword values; a bad value raises."""
        self.model.check_names(values)
        row = self.spark.createDataFrame([tuple(values.values())], list(values))
        return self.insert(row, fail_fast=True)


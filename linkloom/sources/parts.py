"""A stored table in parts by key, of which a change writes only those it touches.

Rows lie in folders ``part=p`` by a hash of their key. A save reads the parts its keys fall into, resolves them, and
gives them to Spark's dynamic partition overwrite; no other file is read for it or written. Spark replaces one part after
another: after a failure some parts may have been replaced and others not, and the same save again brings all to the same state.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from linkloom.operators import rows as R
from linkloom.operators.schema import Model, validate, with_defaults
from linkloom.session import child_names, path_exists, settle


class PartTable:
    def __init__(self, spark: SparkSession, path: str, model: Model, key: list[str], parts: int | None = None):
        """``parts`` is kept beside a table; give it for a new one, some per core and small enough to be rewritten."""
        self.spark, self.path, self.model, self.key = spark, path.rstrip("/"), model, key
        stored = self._layout()
        if stored and parts and stored != parts:
            raise ValueError(f"the table at {self.path} has {stored} parts, not {parts}")
        self.parts = stored or parts or 64
        if not stored:
            said = spark.createDataFrame([(json.dumps({"parts": self.parts}),)], "value string")
            said.coalesce(1).write.text(f"{self.path}/layout")

    def _layout(self) -> int | None:
        if not path_exists(self.spark, f"{self.path}/layout/_SUCCESS"):
            return None
        return int(json.loads(self.spark.read.text(f"{self.path}/layout").first()[0])["parts"])

    def _placed(self, df: DataFrame) -> DataFrame:
        return df.select(*self.model.names).withColumn("part", F.pmod(F.xxhash64(*self.key), F.lit(self.parts)).cast("int"))

    def _stored(self) -> DataFrame:
        schema = StructType([*self.model.struct.fields, StructField("part", IntegerType())])
        if not [n for n in child_names(self.spark, f"{self.path}/rows") if n.startswith("part=")]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/rows")

    def read(self) -> DataFrame:
        return self._stored().select(*self.model.names)

    def _overwrite(self, rows: DataFrame) -> None:
        placed = rows.repartition("part")
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(f"{self.path}/rows")

    def _touched(self, keys: DataFrame) -> DataFrame:
        """The stored rows of the parts in which the keys lie; their folders are named in the scan."""
        # at most as many numbers as there are parts
        numbers = [r["part"] for r in keys.select("part").distinct().collect()]
        return self._stored().filter(F.col("part").isin(numbers))

    def save(self, updates: DataFrame, order: list[Column] | None = None) -> None:
        """Rows replace those with their key or are added; of a repeated key the first by ``order`` counts, else the last given.

        ``order`` may use columns beside the table's own.
        """
        once = settle(self._placed(R.last_of_each(updates, self.key, order)), "updates")
        kept = self._touched(once).join(once.select(*self.key), self.key, "left_anti")
        self._overwrite(settle(kept.unionByName(once), "touched"))

    def insert(self, rows: DataFrame, strict: bool = True, defaults: dict[str, object] | None = None) -> DataFrame:
        """Append validated rows, nulls by ``defaults`` filled, and return the rejects. No stored file is read or written.

        Whether a key is stored already is not looked up; ``save`` does that. Append is not idempotent: after a failed
        one, ``save`` the rows.
        """
        checked = validate(rows, self.model, strict)
        good = with_defaults(checked.rows, defaults) if defaults else checked.rows
        self._placed(good).repartition("part").write.mode("append").partitionBy("part").parquet(f"{self.path}/rows")
        return checked.rejects

    def delete_keys(self, keys: DataFrame) -> None:
        """Rows with these keys go. Spark overwrites the parts it has rows for; those left without any are emptied by name."""
        gone = settle(keys.select(*self.key).distinct().withColumn(
            "part", F.pmod(F.xxhash64(*self.key), F.lit(self.parts)).cast("int")), "keys")
        touched = self._touched(gone)
        kept = settle(touched.join(gone.select(*self.key), self.key, "left_anti"), "touched")
        self._overwrite(kept)
        emptied = gone.select("part").distinct().join(kept.select("part").distinct(), "part", "left_anti").collect()
        for row in emptied:  # at most as many as there are parts
            empty = self.spark.createDataFrame([], self.model.struct)
            empty.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/rows/part={row['part']}")

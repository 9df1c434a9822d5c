"""A stored inverted index: three external Parquet tables below one folder.

``postings`` is bucketed by url and sorted by index and term. All postings of a document share a
bucket, so scores per document add up without a shuffle; a common term or a large index is spread
over all buckets, so none is hot; and the sort lets a scan for one index or a few terms skip row
groups. The index is a column and no folder, since there may be as many indexes as sites.
``terms`` (document frequencies) and ``totals`` are stored with it.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators import search as S
from linkloom.session import child_names, path_exists


class IndexStore:
    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int | None = None):
        """``buckets`` is how many tasks read the postings, twice the cores unless given: make it
        large for a large corpus. A store built before is opened with the number it was built with.
        """
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
            raise ValueError("an index store is named like a table")
        self.spark = spark
        self.name = name
        self.path = path.rstrip("/")
        stored = self._stored_buckets()
        if stored and buckets and stored != buckets:
            raise ValueError(f"the index at {self.path} has {stored} buckets, not {buckets}")
        self.buckets = stored or buckets or 2 * spark.sparkContext.defaultParallelism
        self._attach()

    def _stored_buckets(self) -> int | None:
        """The bucket count written beside the index. Files without it could be read with a wrong one: refused."""
        if path_exists(self.spark, f"{self.path}/layout"):
            return int(json.loads(self.spark.read.text(f"{self.path}/layout").first()[0])["buckets"])
        if any(n.startswith("part-") for n in child_names(self.spark, f"{self.path}/postings")):
            raise ValueError(f"the index at {self.path} does not say how many buckets it has")
        return None

    def _attach(self) -> None:
        """Declare the tables over their folders, whose files may already be there."""
        layouts = {
            "postings": (
                "index_name STRING, url STRING, term STRING, tf BIGINT, dl BIGINT",
                f"CLUSTERED BY (url) SORTED BY (index_name, term) INTO {self.buckets} BUCKETS",
            ),
            "terms": ("index_name STRING, term STRING, df BIGINT, occurrences BIGINT", ""),
            "totals": ("index_name STRING, n BIGINT, total BIGINT", ""),
        }
        for part, (columns, buckets) in layouts.items():
            table = self._table(part)
            if self.spark.catalog.tableExists(table):
                said = {r.col_name: r.data_type for r in self.spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
                same = said.get("Location", "").partition(":")[2].lstrip("/") == f"{self.path}/{part}".rpartition(":")[2].lstrip("/")
                if not same or part == "postings" and said.get("Num Buckets") != str(self.buckets):
                    raise ValueError(f"table {table} stands for another index")
            else:
                self.spark.sql(
                    f"CREATE TABLE {table} ({columns}) USING parquet {buckets} LOCATION '{self.path}/{part}'"
                )

    def _table(self, part: str) -> str:
        return f"{self.name}_{part}"

    def _replace(self, part: str, df: DataFrame) -> None:
        order = self.spark.table(self._table(part)).columns
        df.select(*order).write.mode("overwrite").insertInto(self._table(part))

    def build(self, documents: DataFrame) -> None:
        """Build the store from documents (index_name, url, content), one per index and url.

        Documents are placed by url once; counting terms and writing buckets need no other
        shuffle. Texts are read and split once: the statistics come from the stored postings, and
        the number of documents needs no text.
        """
        said = self.spark.createDataFrame([(json.dumps({"format": 1, "buckets": self.buckets}),)], "value string")
        said.coalesce(1).write.mode("overwrite").text(f"{self.path}/layout")
        placed = documents.select("index_name", "url", "content").repartition(self.buckets, "url")
        rows = S.postings(placed).sortWithinPartitions("index_name", "term")
        self._replace("postings", rows)
        self._replace("terms", S.term_statistics(self.postings()))
        written = self.term_stats().groupBy("index_name").agg(F.sum("occurrences").alias("total"))
        # documents without any token have no postings but still count
        counted = documents.groupBy("index_name").agg(F.count(F.lit(1)).alias("n"))
        totals = counted.join(written, "index_name", "left").withColumn(
            "total", F.coalesce("total", F.lit(0)).cast("bigint")
        )
        self._replace("totals", totals)

    def close(self) -> None:
        """Take the tables out of the catalog; the files stay."""
        for part in ("postings", "terms", "totals"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(part)}")

    def postings(self) -> DataFrame:
        return self.spark.table(self._table("postings"))

    def term_stats(self) -> DataFrame:
        return self.spark.table(self._table("terms"))

    def totals(self) -> DataFrame:
        return self.spark.table(self._table("totals"))

    def search_many(self, queries: DataFrame, deepest: int | None = None) -> DataFrame:
        """Ranked, paged hits of a query table (query_id, q, limit, offset, index_name)."""
        wanted = S.for_words(queries, self.postings())
        return S.search_many(queries, wanted, self.term_stats(), self.totals(), deepest)

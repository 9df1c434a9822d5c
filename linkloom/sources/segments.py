"""A stored index that grows by segments.

An upsert writes one new segment: the blocks of its documents, marks of the earlier documents they replace, and
by how much each term's and the index's statistics change. Nothing stored before is touched. Statistics are sums
over segments, so scores are those of an index built anew from the live documents. ``merge`` puts the live
documents of all segments into one.

The blocks are one bucketed table with a partition for each segment; a document's shard, and so its bucket, is the same
in every segment. A segment counts once its commit is written, which also says which segments it stands for.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from linkloom.operators import blocks as K
from linkloom.operators import search as S
from linkloom.operators.documents import latest
from linkloom.operators.ranks import numbered_between
from linkloom.session import child_names, path_exists, settle

TERMS = "index_name string, term string, df bigint, occurrences bigint"
TOTALS = "index_name string, n bigint, total bigint"
SHARDS_A_BUCKET = 2  # shards are hashed to buckets: several of them make buckets even


class SegmentIndex:
    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int | None = None):
        """``name`` is the table's in the catalog. ``buckets`` is how many tasks read a segment, twice the cores unless
        given; an index stored before is opened with the number it was built with. A shard is worked on in memory:
        with some hundred thousand documents a bucket it stays small.
        """
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
            raise ValueError("an index is named like a table")
        self.spark, self.name, self.path = spark, name, path.rstrip("/")
        stored = self._layout()
        if stored and buckets and stored != buckets:
            raise ValueError(f"the index at {self.path} has {stored} buckets, not {buckets}")
        self.buckets = stored or buckets or 2 * spark.sparkContext.defaultParallelism
        self.shards = SHARDS_A_BUCKET * self.buckets
        if not stored:
            said = spark.createDataFrame([(json.dumps({"format": 1, "buckets": self.buckets}),)], "value string")
            said.coalesce(1).write.text(f"{self.path}/layout")
        spark.sql(
            f"CREATE TABLE {name} ({K.BLOCK}, segment int) USING parquet PARTITIONED BY (segment) "
            f"CLUSTERED BY (shard) SORTED BY (shard, index_name, term) INTO {self.buckets} BUCKETS LOCATION '{self.path}/blocks'")
        if child_names(spark, f"{self.path}/blocks"):
            spark.catalog.recoverPartitions(name)

    def _layout(self) -> int | None:
        if not path_exists(self.spark, f"{self.path}/layout/_SUCCESS"):
            return None
        return int(json.loads(self.spark.read.text(f"{self.path}/layout").first()[0])["buckets"])

    def close(self) -> None:
        """Take the table out of the catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def _commits(self) -> dict[int, list[int]]:
        """Committed segments, each with the segments it stands for."""
        found = {}
        for name in child_names(self.spark, f"{self.path}/commits"):
            if path_exists(self.spark, f"{self.path}/commits/{name}/_SUCCESS"):
                said = json.loads(self.spark.read.text(f"{self.path}/commits/{name}").first()[0])
                found[said["segment"]] = said["replaces"]
        return found

    def segments(self) -> list[int]:
        """The segments that count."""
        commits = self._commits()
        gone = {s for replaced in commits.values() for s in replaced}
        return sorted(set(commits) - gone)

    def blocks(self) -> DataFrame:
        return self.spark.table(self.name).filter(F.col("segment").isin(self.segments()))

    def _stored(self, part: str, schema: str) -> DataFrame:
        rows = self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/{part}/segment={s}" for s in self.segments()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else rows

    def term_stats(self) -> DataFrame:
        """(index_name, term, df, occurrences): sums over the segments; words of no live document are none."""
        return self._stored("terms", TERMS).groupBy("index_name", "term").agg(
            F.sum("df").alias("df"), F.sum("occurrences").alias("occurrences")).filter(F.col("df") > 0)

    def totals(self) -> DataFrame:
        return self._stored("totals", TOTALS).groupBy("index_name").agg(
            F.sum("n").alias("n"), F.sum("total").alias("total")).filter(F.col("n") > 0)

    def documents(self) -> DataFrame:
        """(segment, shard, index_name, range, doc, url, dl) of the live documents."""
        rows = self.blocks()
        return K.block_documents(rows).join(K.dead_documents(rows), K.PLACE, "left_anti")

    def upsert(self, documents: DataFrame, order: list[str] | None = None) -> int:
        """Store documents (index_name, url, content) as a new segment; those of known urls replace the earlier ones.

        Where the documents repeat a url, the greatest by the columns ``order`` counts, then the greatest text.
        Texts are not moved unless urls repeat: words are counted where a text lies, and the counts go to the
        shards. Rows without url or index are no documents; a null text has no words.
        """
        keys = ["index_name", "url"]
        repeated = documents.groupBy(*keys).count().filter("count > 1").limit(1).count()
        if repeated:
            documents = latest(documents, keys, [F.col(c) for c in (*(order or []), "content")])
        rows = settle(K.counted(documents, self.shards), "counted")
        live = self.documents() if self.segments() else None
        replaced = None
        if live is not None:
            replaced = settle(live.join(rows.select("shard", *keys), ["shard", *keys], "left_semi"), "replaced")
        return self._write(rows, replaced, [])

    def merge(self) -> int:
        """One segment of all live documents in place of the segments there are."""
        before = self.segments()
        rows = self.blocks()
        # urls are left behind while the words are gathered; every document is one row again
        words = K.opened(rows.filter(F.col("term") != K.DOCUMENTS)).groupBy(*K.PLACE).agg(
            F.collect_list(F.struct("term", "tf")).alias("words"))
        whole = self.documents().join(words, K.PLACE, "left").withColumn(
            "words", F.coalesce("words", F.array().cast("array<struct<term:string,tf:bigint>>")))
        rows = settle(whole.select("index_name", "url", "dl", "words", "shard"), "merged")
        return self._write(rows, None, before)

    def _write(self, rows: DataFrame, replaced: DataFrame | None, replaces: list[int]) -> int:
        taken = [int(n.partition("=")[2]) for n in child_names(self.spark, f"{self.path}/blocks") if n.startswith("segment=")]
        segment = max([*taken, *self._commits(), -1]) + 1  # a segment that never was committed keeps its number
        # one shuffle: blocks are made, sorted and written where the counts of their shard were sent
        K.blocks(rows.repartition(self.buckets, "shard")).withColumn("segment", F.lit(segment)).write.insertInto(self.name)
        if replaced is not None:
            dead = K.dead_blocks(replaced.repartition(self.buckets, "shard"))
            dead.withColumn("segment", F.lit(segment)).write.insertInto(self.name)
        each = rows.select("index_name", F.explode("words").alias("w")).select("index_name", "w.term", "w.tf", F.lit(1).cast("bigint").alias("one"))
        sizes = rows.select("index_name", "dl", F.lit(1).cast("bigint").alias("one"))
        if replaced is not None:
            gone = K.opened(self.blocks().filter(F.col("term") != K.DOCUMENTS)).join(replaced.select(*K.PLACE), K.PLACE, "left_semi")
            each = each.unionByName(gone.select("index_name", "term", (-F.col("tf")).alias("tf"), F.lit(-1).cast("bigint").alias("one")))
            sizes = sizes.unionByName(replaced.select("index_name", (-F.col("dl")).alias("dl"), F.lit(-1).cast("bigint").alias("one")))
        terms = each.groupBy("index_name", "term").agg(F.sum("one").alias("df"), F.sum("tf").alias("occurrences"))
        terms.sort("index_name", "term").write.mode("overwrite").parquet(f"{self.path}/terms/segment={segment}")
        totals = sizes.groupBy("index_name").agg(F.sum("one").alias("n"), F.sum("dl").alias("total"))
        totals.write.mode("overwrite").parquet(f"{self.path}/totals/segment={segment}")
        said = self.spark.createDataFrame([(json.dumps({"segment": segment, "replaces": replaces}),)], "value string")
        said.coalesce(1).write.mode("overwrite").text(f"{self.path}/commits/{segment}")
        return segment

    def postings(self) -> DataFrame:
        """(index_name, url, term, tf, dl) of the live documents."""
        posts = K.opened(self.blocks().filter(F.col("term") != K.DOCUMENTS))
        return posts.join(self.documents().select(*K.PLACE, "url"), K.PLACE).select("index_name", "url", "term", "tf", "dl")

    def search_many(self, queries: DataFrame, watch: Observation | None = None) -> DataFrame:
        """Ranked, paged hits (query_id, rank, url, score) of queries (query_id, q, limit, offset, index_name).

        The words of the queries go to the tasks while they are at most ``FEW_TERMS``; a shard then sends its best
        hits only. Beyond that the postings are joined with them. ``watch`` gets ``blocks``, how many blocks the
        queries' words have, and ``opened``, how many of them were looked into.
        """
        asked = S.asked_queries(queries, ["index_name"])
        keys = ["index_name", "scored_as"]
        if asked.term_count > S.FEW_TERMS:
            hits = S.score(self.postings(), self.term_stats(), self.totals(), asked.terms, keys)
            return asked.pages(numbered_between(hits, keys, S.hit_order(), 1, asked.deepest, "place"))
        words = asked.terms.select("index_name", "term").distinct()
        known = self.term_stats().join(F.broadcast(words), ["index_name", "term"], "left_semi")
        weighted = S.weighted_terms(known, self.totals(), asked.terms, keys)
        # bounded: at most FEW_TERMS rows
        rows = weighted.join(asked.unique.select(*keys, "deepest"), keys).collect()
        raw = self._hits(rows, asked.unique.schema["scored_as"].dataType.simpleString())
        if watch is not None:
            raw = raw.observe(watch, F.sum("blocks").alias("blocks"), F.sum("opened").alias("opened"))
        found = raw.filter(F.col("url").isNotNull()).select(*keys, "url", "score")
        return asked.pages(numbered_between(found, keys, S.hit_order(), 1, asked.deepest, "place"))

    def _hits(self, rows: list, key_type: str) -> DataFrame:
        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import StructType

        hits = K.HITS.format(key_type)
        if not rows:
            return self.spark.createDataFrame([], hits)
        queries: dict[tuple, K.Query] = {}
        for r in sorted(rows, key=lambda r: (r["index_name"], str(r["scored_as"]), r["term"])):
            query = queries.setdefault((r["index_name"], r["scored_as"]), K.Query(r["index_name"], r["scored_as"], [], r["avgdl"], r["deepest"]))
            query.weights.append((r["term"], r["weight"]))
        given = self.spark.sparkContext.broadcast(list(queries.values()))
        wanted = sorted({(q.index, t) for q in queries.values() for t, _ in q.weights})
        wanted += sorted({(q.index, t) for q in queries.values() for t in (K.DOCUMENTS, K.DEAD)})
        words = F.broadcast(self.spark.createDataFrame(wanted, "index_name string, term string"))
        stored = self.blocks().join(words, ["index_name", "term"], "left_semi")
        return stored.groupBy("shard").applyInArrow(K.answer(given, to_arrow_schema(StructType.fromDDL(hits))), hits)

"""Which pages a root reaches, level by level."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from linkloom.functions.html import hrefs
from linkloom.functions.urls import url_join
from linkloom.operators.links import LINK_STOPS, PAGE_STOPS, contains_any, in_site
from linkloom.operators.ranks import running_number
from linkloom.session import settle, work_path

# roots in one row of a walk by sets: bits of a long without its sign
SET_ROOTS = 63


class _Tables:
    """The links and the seen urls of one walk as bucketed tables below one folder.

    Links are bucketed and sorted by where they start, seen urls by (root, url) with a partition for each depth. Both
    are read bucket by bucket, so in the joins of a level only the level itself and its targets move.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = work_path(spark, "reach")
        tag = self.folder.rpartition("-")[2]
        self.links, self.seen = f"reach_links_{tag}", f"reach_seen_{tag}"

    def write_links(self, edges: DataFrame, by: list[str]) -> None:
        # one task a bucket writes one file, so that the order within a bucket is kept
        placed = edges.repartition(self.buckets, *by)
        placed.write.bucketBy(self.buckets, *by).sortBy(*by).option("path", f"{self.folder}/links").saveAsTable(self.links)

    def create_seen(self, start: StructType) -> None:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in start)
        self.spark.sql(
            f"CREATE TABLE {self.seen} ({columns}, depth INT) USING parquet PARTITIONED BY (depth) "
            f"CLUSTERED BY (root, url) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/seen'")

    def add(self, urls: DataFrame, depth: int) -> int:
        """Store a level; how many urls it has comes with the write, without another job."""
        size = Observation()
        urls = urls.observe(size, F.count(F.lit(1)).alias("urls"))
        urls.withColumn("depth", F.lit(depth)).write.insertInto(self.seen)
        return size.get["urls"]

    def level(self, depth: int) -> DataFrame:
        return self.spark.table(self.seen).filter(F.col("depth") == depth).drop("depth")

    def close(self) -> None:
        """Take the tables out of the catalog; the files stay."""
        for table in (self.links, self.seen):
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")


def next_level(level: DataFrame, links: DataFrame, seen: DataFrame, per_root: bool, target: Column) -> DataFrame:
    """(root, url) that a level leads to and that no level has.

    ``links`` and ``seen`` are bucketed: neither is shuffled. Targets are made distinct before they meet the seen
    urls, partly before they move, so a page that everything links to is a few rows.
    """
    match = F.col("url") == F.col("src")
    if per_root:
        match = match & (F.col("root") == F.col("_edge_root"))
    found = level.join(links, match).select("root", target.alias("url"))
    found = found.filter(F.col("url").isNotNull()).distinct()
    # merged bucket by bucket at every size; a broadcast would send all seen urls to all executors
    return found.join(seen.select("root", "url").hint("merge"), ["root", "url"], "left_anti")


def in_sets(starts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Starts (root, url) as (root, url, bits), and the roots' places (name, root, bit).

    ``root`` is then the number of a set of up to ``SET_ROOTS`` roots, ``bits`` those of them that reach the url.
    """
    numbered = running_number(starts.select(F.col("root").alias("name")).distinct(), [], [F.col("name")], "_n")
    place = F.col("_n") - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % SET_ROOTS).cast("int"))
    places = settle(numbered.select("name", F.floor(place / SET_ROOTS).alias("root"), bit.alias("bit")), "places")
    named = starts.select(F.col("root").alias("name"), "url").join(places, "name")
    return named.groupBy("root", "url").agg(F.bit_or("bit").alias("bits")), places


def next_sets(level: DataFrame, links: DataFrame, seen: DataFrame) -> DataFrame:
    """``next_level`` for sets of roots (root, url, bits): a link is followed once for all roots of a set.

    What is left are the bits by which no level has the url.
    """
    found = level.join(links, F.col("url") == F.col("src")).select("root", F.col("dst").alias("url"), "bits")
    found = found.filter(F.col("url").isNotNull()).groupBy("root", "url").agg(F.bit_or("bits").alias("bits"))
    known = seen.groupBy("root", "url").agg(F.bit_or("bits").alias("_seen"))  # in its buckets: nothing moves
    left = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("_seen", F.lit(0).cast("bigint"))))
    fresh = found.join(known.hint("merge"), ["root", "url"], "left").select("root", "url", left.alias("bits"))
    return fresh.filter(F.col("bits") != 0)


def out_of_sets(levels: DataFrame, places: DataFrame) -> DataFrame:
    """(root, url, depth) of the levels (root, url, bits, depth) of sets."""
    match = (levels["root"] == places["root"]) & (F.col("bits").bitwiseAND(F.col("bit")) != 0)
    return levels.join(places, match).select(F.col("name").alias("root"), "url", "depth")


def reach(
    edges: DataFrame,
    roots: DataFrame,
    follow: Callable[[], Column] | None = None,
    max_depth: int | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """(root, url, depth): every url once per root, at its smallest depth; roots at depth 0.

    ``edges`` is (src, dst) for all roots or (root, src, dst) for edges of one root each.
    ``roots`` is (root) or (root, url) when the start differs from the root. ``follow`` may give
    the target from the columns ``root``, ``url`` and those of ``edges``; null is not followed.

    Links are written once, bucketed by where they start; seen urls go to a table with the same number of
    buckets, a partition for each depth. A level is one job: the level moves to the links (or is broadcast where
    Spark finds it small), its targets move to the seen urls, and neither table moves. The table of
    seen urls is the loop state that survives lost executors, and at the end the result. All roots advance
    in the same jobs. ``buckets`` is ``spark.sql.shuffle.partitions`` unless given; a shuffle and a bucketed
    table with the same number of parts need no further exchange.

    Where the links are the same for all roots and the target needs no root, roots walk in sets: a url is one row for
    the roots of a set that reach it at a depth, so links are followed once for all of them.
    """
    spark = edges.sparkSession
    per_root = "root" in edges.columns
    if per_root:
        edges = edges.withColumnRenamed("root", "_edge_root")
    start = roots.select("root", (F.col("url") if "url" in roots.columns else F.col("root")).alias("url"))
    start = start.filter(F.col("root").isNotNull() & F.col("url").isNotNull()).distinct()
    target = follow() if follow else F.col("dst")
    by_sets = not (per_root or follow)
    first, places = in_sets(start) if by_sets else (start, None)
    tables = _Tables(spark, buckets)
    # a bucket of one file is sorted as it was written; without this Spark sorts the links again at every level
    settings = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true", "spark.sql.shuffle.partitions": str(tables.buckets)}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        tables.write_links(edges, ["_edge_root", "src"] if per_root else ["src"])
        tables.create_seen(first.schema)
        tables.add(first, 0)
        links, seen = spark.table(tables.links), spark.table(tables.seen)
        depth = 0
        while max_depth is None or depth < max_depth:
            level = tables.level(depth)
            fresh = next_sets(level, links, seen) if by_sets else next_level(level, links, seen, per_root, target)
            depth += 1
            if not tables.add(fresh, depth):
                break
            seen = spark.table(tables.seen)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
        tables.close()
    levels = spark.read.schema(StructType(first.schema.fields + [StructField("depth", IntegerType())]))
    levels = levels.parquet(f"{tables.folder}/seen")
    return out_of_sets(levels, places) if by_sets else levels.select("root", "url", "depth")


def candidate_links(
    pages: DataFrame, link_stops: list[str] = LINK_STOPS, page_stops: list[str] = PAGE_STOPS
) -> DataFrame:
    """(src, href, target, plain): links that some root may accept.

    Whether a link that holds the root counts is known only in the crawl of that root, so the link
    is kept raw beside its resolved form. ``plain`` links pass the stop lists whatever the root.
    """
    links = pages.select(F.col("url").alias("src"), F.explode(hrefs(F.col("html"))).alias("href"))
    stopped = contains_any(F.col("href"), link_stops) | contains_any(F.col("src"), page_stops)
    links = links.withColumn("plain", ~stopped)
    # an anchor fails the site test and is on the stop list, unless the caller took it off
    links = links.filter(F.col("plain") | ~F.contains(F.col("href"), F.lit("#")))
    target = url_join(F.col("src"), F.col("href"))
    return links.select("src", "href", target.alias("target"), "plain").distinct()


def crawl(
    pages: DataFrame,
    roots: DataFrame,
    strict_extensions: bool = False,
    root_match: str = "contains",
    max_depth: int | None = None,
) -> DataFrame:
    """Reach of every root over the links of stored pages, (root, url, depth)."""
    return reach(
        candidate_links(pages),
        roots.filter(F.length("root") > 0),
        follow=lambda: F.when(
            in_site(F.col("href"), F.col("root"), strict_extensions, root_match), F.col("href")
        ).when(F.col("plain"), F.col("target")),
        max_depth=max_depth,
    )


def crawl_requests(pages: DataFrame, requests: DataFrame) -> DataFrame:
    """Reach for requested roots (root, author_id[, url]) with who asked, (root, author_id, url, depth).

    A root asked for several times is crawled once, from all the starts asked for.
    """
    starts = requests.select("root", *(["url"] if "url" in requests.columns else [])).distinct()
    reached = crawl(pages, starts)
    return requests.select("root", "author_id").distinct().join(reached, "root")

"""From requested roots to an index: what a crawl of stored pages adds to it."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.html import html_text
from linkloom.functions.urls import index_name
from linkloom.operators.reach import crawl
from linkloom.operators.sessions import moment
from linkloom.session import settle
from linkloom.sources.tables import usable_pages


class Crawled(NamedTuple):
    documents: DataFrame
    statistics: DataFrame


def crawl_index(pages: DataFrame, requests: DataFrame, as_of: Column | None = None, **options) -> Crawled:
    """Crawl stored pages (url, html[, status]) for requests (root, author_id[, url]).

    ``documents`` (index_name, url, content) are the pages each root reaches, in the root's index; a failed fetch is
    neither indexed nor followed. ``statistics`` (domain, author_id, time, pages_count) has a row for each root and
    who asked for it, none indexed pages included. A root asked for several times is crawled once; a page
    reached from several roots is read once and indexed for each. ``options`` go to ``crawl``.
    """
    usable = usable_pages(pages)
    starts = requests.select("root", *(["url"] if "url" in requests.columns else [])).distinct()
    reached = crawl(usable, starts, **options).select("root", "url")
    stored = settle(reached.join(usable.select("url").distinct(), "url", "left_semi"), "reached")
    # only reached pages are parsed, each once
    read = usable.join(stored.select("url").distinct(), "url", "left_semi")
    texts = read.select("url", html_text(F.col("html")).alias("content"))
    documents = texts.join(stored, "url").select(index_name(F.col("root")).alias("index_name"), "url", "content")
    counts = stored.groupBy("root").agg(F.count(F.lit(1)).alias("pages_count"))
    asked = requests.select("root", "author_id").distinct()
    statistics = asked.join(counts, "root", "left").select(
        F.col("root").alias("domain"), "author_id", moment(as_of).alias("time"), F.coalesce("pages_count", F.lit(0)).alias("pages_count")
    )
    return Crawled(documents, statistics)

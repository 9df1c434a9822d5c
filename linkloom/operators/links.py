"""Links of pages: extract, accept, resolve, edges, frontier."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.html import hrefs
from linkloom.functions.urls import host, url_join
from linkloom.operators.membership import BITS, unseen

# They decide which links are followed.
LINK_STOPS = ["#", "zip", "epub", "bz2", ".io", "/fr/", "/ja/", "/ko/", "/zh-cn/", "http", ":"]
PAGE_STOPS = ["#", "zip", "epub", "bz2", ".io", "/fr/", "/ja/", "/ko/", "/zh-cn/"]
FILE_EXTENSIONS = [".zip", "epub", ".bz2"]


def contains_any(text: Column, parts: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in parts], F.lit(False))


def has_extension(link: Column, extensions: list[str] = FILE_EXTENSIONS) -> Column:
    """The last four characters are one of the extensions."""
    return F.right(link, F.lit(4)).isin(*extensions)


def in_site(link: Column, root: Column, strict_extensions: bool = False, root_match: str = "contains") -> Column:
    """An absolute link of the site: it holds the root and no anchor.

    The test looks for the root anywhere in the link, as ``root_match='contains'`` says; ``'host'``
    compares hosts. The extension list only counts with ``strict_extensions``.
    """
    held = host(link) == host(root) if root_match == "host" else F.contains(link, root)
    inside = held & ~F.contains(link, F.lit("#"))
    return inside & ~has_extension(link) if strict_extensions else inside


def link_kind(
    link: Column,
    page_url: Column,
    root: Column,
    link_stops: list[str] = LINK_STOPS,
    page_stops: list[str] = PAGE_STOPS,
    strict_extensions: bool = False,
    root_match: str = "contains",
) -> Column:
    """'absolute' (kept as it is), 'relative' (to be resolved) or null (not followed)."""
    stopped = contains_any(link, link_stops) | contains_any(page_url, page_stops)
    return F.when(in_site(link, root, strict_extensions, root_match), F.lit("absolute")).when(
        ~stopped, F.lit("relative")
    )


def extract(pages: DataFrame, *extra: str) -> DataFrame:
    """(url, href) for the distinct hrefs of every page; no shuffle."""
    return pages.select("url", *extra, F.explode(hrefs(F.col("html"))).alias("href"))


def edges(
    pages: DataFrame,
    root: Column,
    strict_extensions: bool = False,
    root_match: str = "contains",
    same_host: bool = False,
    link_stops: list[str] = LINK_STOPS,
    page_stops: list[str] = PAGE_STOPS,
) -> DataFrame:
    """Distinct (root, src, dst): accepted links of every page as absolute URLs."""
    links = extract(pages.withColumn("root", root).filter(F.length("root") > 0), "root")
    kinds = links.withColumn(
        "kind",
        link_kind(
            F.col("href"), F.col("url"), F.col("root"), link_stops, page_stops, strict_extensions, root_match
        ),
    ).filter(F.col("kind").isNotNull())
    joined = url_join(F.col("url"), F.col("href"))
    target = F.when(F.col("kind") == "absolute", F.col("href")).otherwise(joined)
    found = kinds.select("root", F.col("url").alias("src"), target.alias("dst"))
    if same_host:
        found = found.filter(host(F.col("dst")) == host(F.col("root")))
    return found.distinct()


def frontier(edges: DataFrame, pages: DataFrame) -> DataFrame:
    """Distinct link targets for which there is no page."""
    return (
        edges.select(F.col("dst").alias("url")).distinct().join(pages.select("url"), "url", "left_anti")
    )


def new_links(links: DataFrame, seen: DataFrame) -> DataFrame:
    """Links not seen before, each once."""
    return links.select("url").distinct().join(seen.select("url"), "url", "left_anti")


def new_links_filtered(links: DataFrame, seen: DataFrame, bits: int = BITS) -> DataFrame:
    """``new_links`` by a filter of ``bits`` bits sent to the links: only those it knows are joined with the seen ones."""
    return unseen(links.select("url").distinct(), seen.select("url"), "url", bits)


def seen_union(seen: DataFrame, links: DataFrame) -> DataFrame:
    return seen.select("url").unionByName(links.select("url")).distinct()

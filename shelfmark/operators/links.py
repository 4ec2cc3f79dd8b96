"""Links and the crawl frontier."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.html import Page
from shelfmark.operators.fields import match_pages

# Listing pages of one crawl, and the class of a product tile.
LISTING_PAGES = 51
PRODUCT_TILE = "product-item"
_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:]*)"


def listing_urls(spark: SparkSession, listing: str, pages: int = LISTING_PAGES) -> DataFrame:
    """``url`` of every listing page (S1); ``listing`` ends in the page parameter."""
    return spark.range(1, pages + 1).select(
        F.concat(F.lit(listing), F.col("id").cast("string")).alias("url")
    )


def absolute(base: Column | str, path: Column) -> Column:
    """Site address and path run together."""
    return F.concat(F.lit(base) if isinstance(base, str) else base, path)


def explode_links(pages: DataFrame, paths: Column, base: Column | str) -> DataFrame:
    """One row per link (P2-P4): kept columns, ``pos`` on the page, ``url``.

    Empty paths are dropped before positions are counted.
    """
    kept = [c for c in pages.columns if c not in ("html", "paths", "url")]
    filled = F.filter(paths, lambda p: p != "")
    return (
        pages.select(*kept, absolute(base, F.lit("")).alias("base"), filled.alias("paths"))
        .select(*kept, "base", F.posexplode("paths").alias("pos", "path"))
        .select(*kept, "pos", F.concat("base", "path").alias("url"))
    )


def pattern_links(pages: DataFrame, base: Column | str, pattern: str) -> DataFrame:
    """Links by pattern, without leaving the JVM.

    ``pattern`` has one group, the path. For pages whose links are told apart
    by their own markup; ``tile_links`` selects by enclosing element.
    """
    paths = F.regexp_extract_all("html", F.lit(pattern), F.lit(1))
    return explode_links(pages, paths, base)


def _tile_paths(page: Page, tile: str) -> list[str]:
    links = {a for t in page.classed(tile) for a in page.tagged("a", t)}
    return [page.value(a, "href") for a in sorted(links)]


def tile_links(pages: DataFrame, base: Column | str, tile: str = PRODUCT_TILE) -> DataFrame:
    """Links inside elements of a class, at any depth."""
    found = match_pages(pages, {"paths": partial(_tile_paths, tile=tile)}, (tile,))
    return explode_links(found, F.col("paths"), base)


def host(url: Column) -> Column:
    """Host of an address in lower case; null where there is none.

    By pattern: a blank or bar in the path, as crawls have them, makes an
    address that a strict parser refuses. User part and port are left out.
    """
    found = F.regexp_extract(url, _AUTHORITY, 1)
    return F.lower(F.when(found != "", found))


def in_domains(url: Column, domains: list[str]) -> Column:
    """The host is one of the domains or lies under one (P5)."""
    name = host(url)
    tests = [(name == d.lower()) | F.endswith(name, F.lit("." + d.lower())) for d in domains]
    test = tests[0]
    for other in tests[1:]:
        test = test | other
    return F.coalesce(test, F.lit(False))


def normal_url(url: Column) -> Column:
    """Address without fragment and trailing slash: one spelling per page."""
    return F.rtrim(F.substring_index(url, "#", 1), F.lit("/"))


def frontier(found: DataFrame, visited: DataFrame | None = None) -> DataFrame:
    """Addresses still to visit, each once.

    ``distinct`` merges inside each task first, so an address that a third of
    all pages link to costs one row per task. Earlier visits are anti-joined.
    """
    urls = found.select(normal_url(F.col("url")).alias("url")).distinct()
    if visited is None:
        return urls
    seen = visited.select(normal_url(F.col("url")).alias("url"))
    return urls.join(seen, "url", "left_anti")

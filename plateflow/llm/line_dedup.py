"""Boilerplate lines by their frequency within a site.

The method: a page's HTML is cut into lines at block elements; per host, the pages that contain a line
are counted and divided by the pages of the host; a line on more than ``MAX_RATIO`` of them is
boilerplate of that site and is dropped from its pages.  Hosts with fewer than ``MIN_PAGES`` pages, and
pages without a host, keep all lines.

Only DataFrame functions run here.  A page counts each of its lines once and counts are pre-aggregated
before the shuffle, by host and digest, so a hot host is spread over its lines and a line on all of
its pages is a few partial counts.  A host has at most ``average lines a page / MAX_RATIO`` boilerplate
lines, so they fit an array per host; the arrays are written, and broadcast only where that table is
small, else adaptive execution splits the join at a hot host.

Defined results: null URLs and HTML are empty.  Hosts are compared in lower case.  Repeated rows count
as pages.  An empty table gives an empty result.  Other columns are kept, except that those called like
a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateflow.llm.common import fresh_names, materialise, other_columns

MAX_RATIO = 0.5
MIN_PAGES = 5

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
UNSEEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
BREAKS = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header"
    r"|hr|html|li|main|nav|ol|option|p|pre|section|table|tbody|td|th|thead|title|tr|ul)\b[^>]*>"
)
TAGS = r"<[^>]*>"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def page_lines(html: Column) -> Column:
    """The lines of a page with something to read, in order."""
    seen = F.regexp_replace(F.coalesce(html, F.lit("")), UNSEEN, "\n")
    plain = F.regexp_replace(F.regexp_replace(seen, BREAKS, "\n"), TAGS, "")
    lines = F.transform(F.split(plain, "\n", -1), lambda line: F.btrim(line, F.lit(" \t\r\f\x0b")))
    return F.array_remove(lines, "")


def _digest(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("low"), line).alias("b"))


def boilerplate(pages: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, host_pages, lines)`` with the digests of boilerplate lines, from ``pages (host, lines)``."""
    totals = pages.filter("host != ''").groupBy("host").agg(F.count("*").alias("host_pages"))
    digests = F.array_distinct(F.transform("lines", _digest))
    counts = (
        pages.filter("host != ''")
        .select("host", F.explode(digests).alias("line"))
        .groupBy("host", "line")
        .agg(F.count("*").alias("pages"))
        .filter(F.col("pages") > 1)
    )
    often = (
        counts.join(totals, "host")
        .filter((F.col("host_pages") >= min_pages) & (F.col("pages") > max_ratio * F.col("host_pages")))
        .groupBy("host")
        .agg(F.collect_list("line").alias("boilerplate"))
    )
    return totals.join(often, "host", "left")


def drop_boilerplate(
    pages: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """The pages with host, host_pages, n_lines, n_dropped and kept_text."""
    others = other_columns(pages, "host", "host_pages", "n_lines", "n_dropped", "kept_text")
    lines, dropped, kept = fresh_names(pages, "page_lines", "site_lines", "page_kept")
    cut = pages.select(
        *others, host_of(F.col("url")).alias("host"), page_lines(F.col("html")).alias(lines)
    )
    sites = materialise(
        boilerplate(cut.select("host", F.col(lines).alias("lines")), max_ratio, min_pages), "boilerplate"
    ).toDF("host", "host_pages", dropped)
    rest = F.filter(lines, lambda line: ~F.array_contains(F.col(dropped), _digest(line)))
    return (
        cut.join(sites, "host", "left")
        .withColumn(kept, F.when(F.col(dropped).isNull(), F.col(lines)).otherwise(rest))
        .select(
            *others,
            "host",
            F.coalesce("host_pages", F.lit(0)).alias("host_pages"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(kept)).cast("long").alias("n_dropped"),
            F.array_join(kept, "\n").alias("kept_text"),
        )
    )

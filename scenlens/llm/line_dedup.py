"""Drop boilerplate lines by their frequency on the site.

The lines of a page are its text between tags, without scripts, styles and comments. Pages are grouped by
host; a line that stands on more than ``RATIO`` of the host's pages, and on ``MIN_PAGES`` at least, is
boilerplate there and goes from all of them.

A host has at most (its lines per page) / ``RATIO`` such lines, so the list that joins back to its pages
stays short for any number of pages. Lines travel as 64-bit hashes; counts are summed before the shuffle.

Defined results: a null page has no lines and null stays null; a url without a host, or null, belongs to
the host ''. A repeated row is a page of its own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scenlens.operators.joins import left_join

RATIO = 0.1
MIN_PAGES = 3

HIDDEN = r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->"
TAG = r"<[^>]*>"
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#@]*@)?([^/:?#]+)"


def page_lines(html: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(html, HIDDEN, "\n"), TAG, "\n")
    return F.filter(F.transform(F.split(bare, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, HOST, 2), F.lit("")))


def boilerplate(lines: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines) per page to (host, host_pages, dropped): hashes of each host's boilerplate lines."""
    totals = lines.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    once = F.array_distinct(F.transform("lines", lambda x: F.xxhash64(x)))
    counts = (
        lines.select("host", F.explode(once).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("pages"))
    )
    often = (
        left_join(counts.filter(F.col("pages") >= min_pages), totals, "host", spread=True)
        .filter(F.col("pages") > F.col("host_pages") * ratio)
        .groupBy("host")
        .agg(F.collect_list("line").alias("dropped"))
    )
    return left_join(totals, often, "host")


def drop_boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, host, host_pages, n_lines, n_dropped and the text that stays, of each page."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), "html")
    known = boilerplate(rows.select("host", page_lines(F.col("html")).alias("lines")), ratio, min_pages)
    joined = left_join(rows, known, "host", spread=True).withColumn("lines", page_lines(F.col("html")))
    dropped = F.coalesce(F.col("dropped"), F.array().cast("array<bigint>"))
    kept = F.filter("lines", lambda x: ~F.array_contains(dropped, F.xxhash64(x)))
    n_lines = F.coalesce(F.size("lines"), F.lit(0)).cast("long")
    return (
        joined.withColumn("kept", kept)
        .withColumn("n_lines", F.when(F.col("lines").isNull(), F.lit(0)).otherwise(n_lines).cast("long"))
        .select(
            "page_id",
            "host",
            "host_pages",
            "n_lines",
            F.when(F.col("lines").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("kept")).cast("long").alias("n_dropped"),
            F.array_join("kept", "\n").alias("text"),
        )
    )

"""Site-relative line frequency: drop a host's boilerplate lines.

A line is boilerplate on a host when it stands on more than ``max_ratio`` of
the host's pages. (``min_pages`` can ask for a number of pages besides; by
default the ratio alone decides, so a host of few pages keeps little.) DataFrame
functions only. Pages count once per line however often they repeat it; counts
are pre-aggregated before they shuffle, so neither a host nor a line with a
third of all rows is a hot group, and lines meet counts by digest (two 64-bit
hashes) only. Pages are cut into lines once and written down with the digests;
the counts read the digests alone.

Lines are compared without the ASCII white space at their ends, and kept with
what is not spaces of it.

Defined cases: null html or url is an empty page of the empty host; empty
lines are no lines; repeated rows (page_id and text equal) are pages of their
own in the counts and get a row each; ratios equal to the limit stay; with
``min_pages`` hosts of fewer pages are left as they are; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.llm.common import broadcast_if_small, saved

MAX_RATIO = 0.1
MIN_PAGES = 1

# Markup that holds no text, inline elements, and line ends.
HIDDEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
INLINE = r"(?i)</?(?:a|abbr|b|code|em|i|small|span|strong|sub|sup|u)(?:\s[^<>]*)?>"
LINE_END = r"<[^<>]*>|\n"


def html_lines(html: str | Column) -> Column:
    """The visible lines of a page, trimmed, in order: text between block
    tags or line feeds."""
    html = F.col(html) if isinstance(html, str) else html
    text = F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "\n"), INLINE, "")
    return F.array_remove(F.transform(F.split(text, LINE_END), lambda x: F.trim(x)), "")


def text_lines(text: str | Column) -> Column:
    """The lines of a plain text, trimmed, in order."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"),
                                      lambda x: F.trim(x)), "")


def _digest(line: Column) -> Column:
    line = F.btrim(line, F.lit(" \t\n\x0b\f\r"))
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(3), line).alias("b"))


def boilerplate(pages: DataFrame, max_ratio: float = MAX_RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line, n_pages, n_host_pages) of the lines over the limit;
    ``pages`` has host and digests, ``line`` is a digest."""
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n_host_pages"))
    each = pages.select("host", F.explode(F.array_distinct("digests")).alias("line"))
    counts = (each.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_pages"))
                  .where(F.col("n_pages") >= min_pages))
    totals = broadcast_if_small(saved(totals.where(F.col("n_host_pages") >= min_pages),
                                      "host-pages"), 128)
    return counts.join(totals, "host").where(
        F.col("n_pages") > F.col("n_host_pages") * F.lit(float(max_ratio)))


def drop_boilerplate(pages: DataFrame, max_ratio: float = MAX_RATIO,
                     min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` (key, host, lines) with n_lines, n_dropped and the lines kept,
    in their order. ``key`` names a row's content: equal keys have equal host
    and lines."""
    pages = saved(pages.withColumn("digests", F.transform("lines", _digest)), "page-lines")
    bad = saved(boilerplate(pages, max_ratio, min_pages).select("host", "line"), "boilerplate")
    each = pages.select("key", "host", F.explode(F.array_distinct("digests")).alias("line"))
    hit = (each.join(broadcast_if_small(bad, 128), ["host", "line"], "left_semi")
               .groupBy(F.col("key").alias("k")).agg(F.collect_set("line").alias("bad")))
    hit = broadcast_if_small(saved(hit, "boilerplate-pages"), 1024)
    joined = pages.join(hit, F.col("key") == F.col("k"), "left")
    kept = F.when(F.col("bad").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x, i: ~F.array_contains(F.col("bad"), F.get("digests", i))))
    return (joined.withColumn("kept", kept)
                  .withColumn("n_lines", F.size("lines").cast("long"))
                  .withColumn("n_dropped", (F.size("lines") - F.size("kept")).cast("long"))
                  .drop("k", "bad", "lines", "digests").withColumnRenamed("kept", "lines"))


def clean_pages(pages: DataFrame, host: Column, lines: Column, **options) -> DataFrame:
    """(page_id, host, n_lines, n_dropped, text) for every page; ``text`` is
    the kept lines, one to a line."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"),
                        lines.alias("lines"))
    key = F.struct("page_id", F.xxhash64("host", "lines").alias("h"))
    out = drop_boilerplate(rows.withColumn("key", F.xxhash64(key)), **options)
    return out.select("page_id", "host", "n_lines", "n_dropped",
                      F.array_join("lines", "\n").alias("text"))

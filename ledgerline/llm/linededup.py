"""Boilerplate lines of a site: line frequency relative to the site's pages.

For each host, a line's share is the number of the host's pages that contain it divided
by the number of its pages; lines above a ratio are boilerplate and dropped from that
host's pages.  Lines are counted by 64-bit hash with partial aggregation, so neither a
large host nor a very common line gathers in one task.  At most (lines per page) /
ratio lines of a host can exceed the ratio, so a host's boilerplate is a short list,
which is joined to the pages by host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import written
from .urlrules import host_of

RATIO, MIN_COPIES = 0.3, 2
_UNSEEN = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->"
_BLOCK = r"(?i)</?(?:p|li|ul|ol|div|h[1-6]|br|nav|article|section|header|footer|main|title|table|tr|td|th|pre|blockquote)\b[^>]*>"


def html_lines(html: Column) -> Column:
    """The non-empty text lines of a page: block tags and line feeds end a line, other tags,
    scripts, styles and comments go, white space is single blanks."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), _UNSEEN, "")
    text = F.regexp_replace(F.regexp_replace(text, _BLOCK, "\n"), "<[^>]*>", "")
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.trim(F.regexp_replace(x, r"[\x20\x09-\x0D]+", " ")))
    return F.filter(lines, lambda x: x != "")


def drop_boilerplate(pages: DataFrame, ratio: float = RATIO, id_col: str = "page_id",
                     url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, n_lines, n_dropped, text), one row per row of ``pages``: ``text`` are the
    kept lines, joined by line feeds.

    A line is dropped if more than ``ratio`` of the host's pages, and at least ``MIN_COPIES`` of
    them, contain it, however few pages the host has.

    * Null urls, or urls without a host, form the host "".  Null or empty html has no line.
    * Rows that repeat a page id are pages of their own; a line counts once a page.
    * An empty table gives an empty result.  Other columns are ignored.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"),
                        html_lines(F.col(html_col)).alias("lines"))
    hashes = F.array_distinct(F.transform("lines", lambda x: F.xxhash64(x)))
    # one more entry a page (null) counts the page itself
    seen = rows.select("host", F.explode(F.concat(hashes, F.array(F.lit(None).cast("long")))).alias("line"))
    counts = written(seen.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(
        (F.col("n") >= MIN_COPIES) | F.col("line").isNull()), "lines")
    totals = counts.where("line is null").select("host", F.col("n").alias("total"))
    common = (counts.where("line is not null").join(totals, "host").where(F.col("n") > F.lit(ratio) * F.col("total"))
              .groupBy("host").agg(F.collect_list("line").alias("common")))
    judged = rows.join(written(common, "boilerplate"), "host", "left")
    known = F.coalesce("common", F.expr("cast(array() as array<long>)"))
    kept = F.filter("lines", lambda x: ~F.array_contains(F.col("known"), F.xxhash64(x)))
    out = judged.select("page_id", "host", "lines", known.alias("known")).select("page_id", "host", "lines", kept.alias("kept"))
    return out.select("page_id", "host", F.size("lines").cast("long").alias("n_lines"),
                      (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("text"))

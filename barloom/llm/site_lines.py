"""Line dedup by site-relative frequency.

Within each host, the pages that contain a line are divided by the host's pages;
lines above a boilerplate ratio (and on at least ``min_pages`` pages) are dropped
from every page of that host.

Only 128-bit line keys are shuffled for the counting.  A line's count is summed
map-side first, so a line on a third of all pages costs one row a task; the
line-to-boilerplate join splits hot lines at run time (adaptive skew join), and
whole texts move once, in the last join by page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import content_key, free_name

#: HTML parts without text, and the tags that end a line (fixed values).
HIDDEN = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->|<!doctype[^>]*>"
BREAKING = (r"(?i)</?(p|div|li|ul|ol|h1|h2|h3|h4|h5|h6|br|tr|td|th|table|nav|article|section|header|footer|aside"
            r"|main|title|head|body|html|blockquote|pre|form|meta|link)(\s[^>]*)?/?>")
TAG = r"<[^>]*>"


def html_lines(html: str) -> Column:
    """Text of a page with one line per block element (inline tags vanish)."""
    c = F.regexp_replace(F.col(html), HIDDEN, "\n")
    return F.regexp_replace(F.regexp_replace(c, BREAKING, "\n"), TAG, "")


def url_host(url: str) -> Column:
    """Host of a URL, lower case, without port; the empty string if there is none."""
    return F.lower(F.regexp_extract(F.col(url), r"://([^/:?#]+)", 1))


def split_lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def site_line_counts(pages: DataFrame, host_col: str, text_col: str) -> tuple[DataFrame, DataFrame, Column]:
    """Pages per distinct (host, line key), pages per host, and the host key expression.

    A line is compared after trimming blanks; blank lines are not counted.
    A null host is a host of its own.
    """
    lines = F.array_distinct(F.transform(
        F.filter(F.transform(split_lines(text_col), lambda x: F.trim(x)), lambda x: x != ""),
        lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(7), x).alias("b"))))
    host = F.struct(F.isnull(host_col).alias("none"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("name"))
    per_line = (pages.select(host.alias("host"), F.explode(lines).alias("l"))
                .groupBy("host", "l").agg(F.count(F.lit(1)).alias("n_pages")))
    per_host = pages.groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("host_pages"))
    return per_line, per_host, host


def drop_site_lines(pages: DataFrame, host_col: str, text_col: str, key_cols: list[str],
                    max_ratio: float = 0.1, min_pages: int = 3) -> DataFrame:
    """``pages`` with boilerplate lines cut from ``text_col``; adds ``n_lines`` and ``n_removed``.

    A line goes when ``n_pages / host_pages > max_ratio`` and ``n_pages >= min_pages``
    within its host; all its occurrences on the page go.  Kept lines stay
    unchanged and in order.  No row is dropped: a page whose lines all go keeps
    an empty text, a null text stays null with zero lines (``n_lines`` counts
    non-blank lines).  Repeated rows count as pages of their own and get the
    same result.  ``key_cols`` (with host and text) identify a row; extra
    columns pass through, even under the names used here.
    """
    per_line, per_host, host = site_line_counts(pages, host_col, text_col)
    boiler = (per_line.where(F.col("n_pages") >= min_pages)
              .join(per_host, "host").where(F.col("n_pages") > F.lit(max_ratio) * F.col("host_pages"))
              .select("host", "l"))
    k1, k2 = content_key(*key_cols, host_col, text_col)
    numbered = F.transform(split_lines(text_col), lambda x, i: F.struct(
        i.alias("at"), F.xxhash64(F.trim(x)).alias("a"), F.xxhash64(F.lit(7), F.trim(x)).alias("b"), F.trim(x).alias("t")))
    each = (pages.select(k1, k2, host.alias("host"),
                         F.explode(F.filter(numbered, lambda x: x["t"] != "")).alias("n"))
            .select("k1", "k2", "host", F.struct("n.a", "n.b").alias("l"), F.col("n.at").alias("at")))
    cuts = (each.join(boiler, ["host", "l"], "left_semi")
            .groupBy("k1", "k2").agg(F.collect_set("at").alias("cut")))
    n1, n2 = free_name(pages, "n_lines"), free_name(pages, "n_removed")
    t1, t2, tc, tl = (free_name(pages, x) for x in ("_k1", "_k2", "_cut", "_lines"))
    cuts = cuts.select(F.col("k1").alias(t1), F.col("k2").alias(t2), F.col("cut").alias(tc))
    joined = pages.withColumns({t1: k1, t2: k2}).join(cuts, [t1, t2], "left").withColumn(tl, split_lines(text_col))
    lines, text = F.col(tl), F.col(text_col)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(tc))
    kept = F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    return (joined
            .withColumns({
                n1: F.size(F.filter(lines, lambda x: F.trim(x) != "")).cast("long"),
                n2: F.coalesce(F.size(tc), F.lit(0)).cast("long"),
                text_col: F.when(text.isNull() | F.col(tc).isNull(), text).otherwise(kept)})
            .select(*pages.columns, n1, n2))

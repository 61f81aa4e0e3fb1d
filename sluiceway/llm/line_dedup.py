"""Line deduplication by site-relative frequency.

A line that stands on more than a share of a host's pages is the site's boilerplate, and is
dropped from them. Lines are counted as hashes, combined before the shuffle; a host with a
third of all pages is spread by its lines, and the totals of the largest hosts are broadcast. Only the places of dropped lines are joined back
to the pages, so texts are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import join_by_key, materialize

# What is no text of a page, tags that end a line, and any other tag.
NO_TEXT = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
LINE_TAGS = r"(?i)</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|td|th|table|article|section|nav|header|footer|title|body|head|html|blockquote|pre|aside|main|form)(?:[\s/][^>]*)?>"
ANY_TAG = r"<[^>]*>"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
TRIMMED = " \t\r\x0b\x0c"


def html_lines(html: Column) -> Column:
    """The trimmed, non-empty lines of a page's text; an empty array for null."""
    text = F.regexp_replace(html, NO_TEXT, "")
    text = F.regexp_replace(F.regexp_replace(text, LINE_TAGS, "\n"), ANY_TAG, "")
    return text_lines(text)


def text_lines(text: Column) -> Column:
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x, F.lit(TRIMMED)))
    return F.filter(lines, lambda x: x != "")


def host(url: Column) -> Column:
    """The host in lower case; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def drop_boilerplate(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", is_html: bool = True, ratio: float = 0.2, least_pages: int = 2) -> DataFrame:
    """One row per input row: id, host, n_lines, n_dropped, text (the kept lines).

    A line is dropped from a host's pages if at least least_pages of them have it and these
    are more than `ratio` of the host's pages. A page counts a line once; rows repeated
    entirely count as one page, and each is returned. Null or empty pages have no lines and
    an empty text, but count as pages; pages without a host are one site, ''. Empty table:
    no rows. Other columns are ignored.
    """
    lines = html_lines(F.col(text_col)) if is_html else text_lines(F.col(text_col))
    rows = pages.select(  # written, so that pages are parsed once
        F.col(id_col).alias("id"),
        host(F.col(url_col)).alias("host"),
        lines.alias("lines"),
        F.xxhash64(F.col(id_col), F.coalesce(F.col(url_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))).alias("page"),
    )
    rows = materialize(rows)
    # of each page, its lines' places by their hashes
    placed = materialize(rows.select("host", "page", F.posexplode_outer("lines").alias("pos", "line")).select("host", "page", "pos", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b")))
    totals = placed.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    seen = placed.filter("pos is not null").select("host", "a", "b", "page").distinct().groupBy("host", "a", "b").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= least_pages)
    common = join_by_key(materialize(seen), totals, "host", "total").filter(F.col("pages") > F.lit(ratio) * F.col("total")).select("host", "a", "b")
    dropped = placed.join(common, ["host", "a", "b"]).groupBy("page").agg(F.collect_set("pos").alias("dropped"))
    out = rows.join(dropped, "page", "left").withColumn("dropped", F.coalesce("dropped", F.array().cast("array<int>")))
    every = F.when(F.size("lines") > 0, F.sequence(F.lit(0), F.size("lines") - 1)).otherwise(F.array().cast("array<int>"))
    kept = F.transform(F.array_except(every, "dropped"), lambda i: F.get("lines", i))  # by hashing: in proportion to the page's lines
    return out.select(F.col("id").alias(id_col), "host", F.size("lines").cast("long").alias("n_lines"), F.size("dropped").cast("long").alias("n_dropped"), F.array_join(kept, "\n").alias("text"))

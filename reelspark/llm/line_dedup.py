"""Dropping a site's repeated lines by their frequency on that site, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark import scratch

#: A line goes if it is on more than RATIO of its host's pages, and on two of them at least: what is on one page only repeats nothing.
RATIO, MIN_PAGES = 0.3, 2
#: Dropped (host, line) pairs up to which they are sent to every executor instead of joined: about 4 MB.
BROADCAST_LINES = 100_000

# Patterns that Spark and DuckDB read alike.
_UNSEEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<title\b.*?</title\s*>"
_BREAKS = r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|nav|ol|option|p|pre|section|select|table|td|th|tr|ul)(?:\s[^>]*|/)?>"
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next /, ? or #, A-Z lower-cased; null where there is none."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.regexp_replace(url, r"(?s)^.*?://", ""), "/", 1))
    host = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(host != "", host)


def html_lines(html: Column) -> Column:
    """Visible lines of a page: text between block tags, common references decoded, white space made single."""
    text = F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), _UNSEEN, ""), r"[ \t\n\x0b\f\r]+", " ")
    text = F.regexp_replace(F.regexp_replace(text, _BREAKS, "\n"), r"<[^>]*>", "")
    for name, char in _ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    trimmed = F.transform(F.split(text, "\n"), lambda x: F.trim(x))
    return F.filter(trimmed, lambda x: x != "")


def drop_site_lines(pages: DataFrame, id_col: str, host: Column, lines: Column, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per row of ``pages``: page_id, host, n_lines, n_dropped, text (the lines that stay, joined by newlines).

    A line goes if more than ``ratio`` of its host's pages hold it, and ``min_pages`` at least; on a
    page every repeat of it goes. ``lines`` is an array of strings. Pages with a null host belong
    to no site and keep all lines; null or empty lines give an empty text. Repeated rows count as
    pages of their own. Other columns are not read. Empty in, empty out.

    Frequencies are sums over (host, 128-bit hash of line) combined in the map tasks, so a hot host or line
    moves one row a task. The lines dropped on a host number at most (lines per page) / ``ratio``,
    so they fit in one array a host; the pages meet them by a broadcast if they are few in all,
    else by a join whose hot hosts adaptive execution splits.
    """
    rows = scratch.written(pages.select(F.col(id_col).alias("page_id"), host.alias("host"), F.coalesce(lines, F.array().cast("array<string>")).alias("lines")), "line-pages")
    sited = rows.filter(F.col("host").isNotNull())
    totals = sited.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    name = lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(x, F.lit(1)).alias("b"))  # noqa: E731  128 bits
    each = sited.select("host", F.explode(F.array_distinct(F.transform("lines", name))).alias("line"))
    on = each.groupBy("host", "line").agg(F.count(F.lit(1)).alias("on_pages")).filter(F.col("on_pages") >= min_pages)
    common = on.join(totals, "host").filter(F.col("on_pages") > F.lit(ratio) * F.col("pages"))
    common = scratch.written(common.groupBy("host").agg(F.collect_list("line").alias("common")), "line-common")
    few = (common.agg(F.sum(F.size("common"))).first()[0] or 0) <= BROADCAST_LINES
    found = rows.join(F.broadcast(common) if few else common, "host", "left")
    kept = F.when(F.col("common").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains(F.col("common"), name(x))))
    found = found.withColumn("kept", kept)
    return found.select(
        "page_id", "host", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("text")
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return drop_site_lines(pages, "page_id", host_of(F.col("url")), html_lines(F.col("html")))


def _sql_text() -> str:
    text = f"regexp_replace(regexp_replace(coalesce(html, ''), '{_UNSEEN}', '', 'g'), '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, '{_BREAKS}', chr(10), 'g'), '<[^>]*>', '', 'g')"
    for name, char in _ENTITIES:
        text = f"replace({text}, '{name}', '{char.replace(chr(39), chr(39) * 2)}')"
    return text


OP4_SQL = rf"""
WITH p AS (
  SELECT page_id, nullif(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         list_filter(list_transform(string_split({_sql_text()}, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS ls
  FROM pages),
t AS (SELECT host, count(*) AS n FROM p WHERE host IS NOT NULL GROUP BY host),
o AS (SELECT host, l, count(*) AS k FROM (SELECT host, unnest(list_distinct(ls)) AS l FROM p WHERE host IS NOT NULL) GROUP BY host, l),
c AS (SELECT o.host, list(l) AS cl FROM o JOIN t ON o.host = t.host WHERE k >= {MIN_PAGES} AND k > {RATIO} * n GROUP BY o.host),
f AS (SELECT p.page_id, p.host, p.ls, CASE WHEN c.cl IS NULL THEN p.ls ELSE list_filter(p.ls, lambda x: NOT list_contains(c.cl, x)) END AS kl
      FROM p LEFT JOIN c ON p.host = c.host)
SELECT page_id, host, CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(kl) AS BIGINT) AS n_dropped, coalesce(array_to_string(kl, chr(10)), '') AS text FROM f
"""

"""Operator 10, line dedup: site-relative line frequency.

Documents are grouped by host. For every (host, line) the share of the host's
distinct pages that contain the line is counted, and lines above ``ratio`` are
dropped from all pages of that host. Copies of one page count as one page, so a
page that was crawled many times does not look like boilerplate.

Only (host, page hash, line hash) longs are shuffled, each pair once per page
and combined before the shuffle, so a host with a third of all pages is spread
by its lines. What comes back is one row per host with its boilerplate lines:
at most (mean distinct lines of its pages) / ``ratio`` hashes, whatever the
number of pages. That table is measured: up to ``BROADCAST_HASHES`` hashes it is
broadcast and no text is shuffled; beyond, the join is an ordinary shuffle join
whose hot host AQE splits.

Defined results. A null text stays null and contains no line; a null host is a
host of its own; blank lines are never counted nor dropped. A host with fewer
than ``min_pages`` distinct pages loses nothing, and neither does a line found
on fewer than ``min_pages`` of them. Repeated rows are cleaned alike. If every
line of a page is dropped its text becomes empty. Other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winback.llm.common import stored

RATIO = 0.1
MIN_PAGES = 5
BROADCAST_HASHES = 2_000_000    # 16 MB; a larger host table is joined by a shuffle


def _key(line: Column) -> Column:
    """A line's identity: its text without surrounding blanks, 64-bit hash."""
    return F.xxhash64(F.btrim(line, F.lit(" \t\x0b\f\r")))


def _blank(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\x0b\f\r")) == ""


def boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """(host hash, array of boilerplate line hashes), one row per host that has any."""
    d = docs.select(F.xxhash64(F.coalesce(F.col(host).cast("string"), F.lit("")),
                               F.col(host).isNull()).alias("_host"),
                    F.xxhash64("text").alias("_page"), "text").where(F.col("text").isNotNull())
    pages = d.select("_host", "_page").distinct().groupBy("_host").agg(F.count("*").alias("_pages"))
    lines = (d.select("_host", "_page", F.explode(F.array_distinct(F.transform(
                 F.filter(F.split("text", "\n"), lambda x: ~_blank(x)), _key))).alias("_line"))
             .distinct()
             .groupBy("_host", "_line").agg(F.count("*").alias("_n"))
             .where(F.col("_n") >= min_pages))
    return (lines.join(pages, "_host")
            .where((F.col("_pages") >= min_pages) & (F.col("_n") > ratio * F.col("_pages")))
            .groupBy("_host").agg(F.sort_array(F.collect_list("_line")).alias("_lines")))


def drop_boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, counts: bool = False) -> DataFrame:
    """``docs`` with the boilerplate lines of its host cut from ``text``; with
    ``counts`` also n_lines and n_dropped (non-blank lines before, lines cut)."""
    cols = docs.columns
    table = boilerplate(docs, host, ratio, min_pages)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols if c != "text"]).alias("_row"),
                        F.col("text"), F.xxhash64(F.coalesce(F.col(host).cast("string"), F.lit("")),
                                                  F.col(host).isNull()).alias("_host"))
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda x: _blank(x) | ~F.array_contains(F.col("_lines"), _key(x)))
    table = stored(table, "boilerplate")
    hashes = table.agg(F.sum(F.size("_lines") + 2)).first()[0] or 0
    if hashes <= BROADCAST_HASHES:
        table = F.broadcast(table)
    j = (whole.join(table, "_host", "left")
         .withColumn("_kept", F.when(F.col("_lines").isNotNull(), kept)))
    text = F.when(F.col("_kept").isNull(), F.col("text")).otherwise(F.array_join("_kept", "\n"))
    out = [text.alias("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in cols]
    if counts:
        n = F.coalesce(F.size(F.filter(lines, lambda x: ~_blank(x))), F.lit(0))
        out += [F.when(F.col("text").isNull(), 0).otherwise(n).cast("long").alias("n_lines"),
                F.when(F.col("_kept").isNull(), 0).otherwise(F.size(lines) - F.size("_kept"))
                .cast("long").alias("n_dropped")]
    return j.select(*out)

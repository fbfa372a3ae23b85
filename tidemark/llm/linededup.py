"""Line dedup by site-relative frequency, with DataFrame functions only.

Pages are grouped by host. A line that stands in more than ``max_ratio`` of the host's pages (and in ``min_pages`` at
least) is boilerplate there, and every page of that host loses it.

Lines travel as 64-bit keys, each once a page and with partial counts before the shuffle. A host's boilerplate lines are
gathered into one array: as each stands in more than ``max_ratio`` of the pages, there are fewer than (mean lines a page)
/ ``max_ratio`` of them, however many pages the host has. The arrays of all hosts go to the pages by broadcast where they
are known to take up to ``BROADCAST_BYTES``, so that no text moves. Beyond that, pages and arrays are joined by host
with nothing that needs a host's pages together, so that Spark deals out a hot host's pages over many tasks.

Defined results: null or empty text has no lines and stays as it is; a line of white space alone is never boilerplate;
lines are compared without white space around them; a null host is a host of its own; hosts under ``min_pages`` pages
lose nothing; repeated rows count as pages; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.tables import staged

MAX_RATIO = 0.05
MIN_PAGES = 5
#: Bytes of all hosts' boilerplate keys up to which they are broadcast.
BROADCAST_BYTES = 32 << 20
_SPACE = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.split(text, "\n")).otherwise(F.array().cast("array<string>"))


def line_key(line: Column) -> Column:
    """Equal for equal lines; null for a line without a visible character."""
    bare = F.trim(line, F.lit(_SPACE))
    return F.when(bare != "", F.xxhash64(bare))


def boilerplate(pages: DataFrame, host: str, text: str, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per host with boilerplate: host, keys (of its boilerplate lines)."""
    totals = pages.groupBy(host).agg(F.count(F.lit(1)).alias("__pages"))
    keys = F.array_compact(F.array_distinct(F.transform(_lines(F.col(text)), line_key)))
    counts = pages.select(host, F.explode(keys).alias("__key")).groupBy(host, "__key").agg(F.count(F.lit(1)).alias("__n"))
    often = counts.where(F.col("__n") >= min_pages)
    t = totals.withColumnRenamed(host, "__t")
    return (
        often.join(t, F.col(host).eqNullSafe(F.col("__t")))
        .where(F.col("__n") > F.col("__pages") * F.lit(max_ratio))
        .groupBy(host)
        .agg(F.collect_list("__key").alias("keys"))
    )


def drop_boilerplate(
    pages: DataFrame, host: str = "source", text: str = "text", ident: str = "doc_id", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """One row per page: ident, host, n_lines, n_dropped, kept_text (null text stays null)."""
    slim = pages.select(F.col(ident).alias("ident"), F.col(host).alias("host"), F.col(text).alias("text"))
    found = staged(boilerplate(slim, "host", "text", max_ratio, min_pages).withColumnRenamed("host", "__host"), "boilerplate")
    size = found.agg(F.sum(64 + F.coalesce(F.octet_length(F.col("__host").cast("string")), F.lit(0)) + 8 * F.size("keys"))).first()[0] or 0
    joined = slim.join(F.broadcast(found) if size <= BROADCAST_BYTES else found, F.col("host").eqNullSafe(F.col("__host")), "left")
    lines = (
        joined.withColumn("lines", _lines(F.col("text")))
        .withColumn("line_keys", F.when(F.col("keys").isNotNull(), F.transform("lines", line_key)))
        .withColumn("hits", F.array_intersect("line_keys", "keys"))
        .withColumn(
            "kept",
            F.when(
                F.size("hits") > 0,
                F.filter("lines", lambda x, i: ~F.coalesce(F.array_contains("hits", F.get("line_keys", i)), F.lit(False))),
            ).otherwise(F.col("lines")),
        )
    )
    return lines.select(
        F.col("ident").alias(ident),
        F.col("host").alias(host),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.when(F.col("text").isNotNull(), F.array_join("kept", "\n")).alias("kept_text"),
    )

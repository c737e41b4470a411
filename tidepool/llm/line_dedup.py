"""Line dedup by site-relative frequency.

A line is boilerplate of a host when more than ``ratio`` of the host's pages
(and at least ``min_pages`` of them) contain it; such lines are dropped from
every page of that host.  Lines count trimmed, once per page; blank lines stay.
Rows of a host with the same text are one page: a page that was copied often
does not turn its lines into boilerplate.

Only hashes of lines are counted and joined (two independent ones, 96 bits,
and the host besides).  Counting combines on the map side; the boilerplate
lines of a host number at most its mean page length over ``ratio``, and Spark
broadcasts or sort-merges them by their size, splitting hot hosts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import apply_recommended_conf
from .store import written

RATIO, MIN_PAGES = 0.02, 4
BLANKS = " \t\x0b\x0c\r"


def host_of(url: str | Column) -> Column:
    """Lower-case host of a URL, without user, port and ``www.``."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(F.lower(host), r"^www\.", "")


def _hash(line: Column) -> Column:
    trimmed = F.btrim(line, F.lit(BLANKS))
    return F.when(trimmed != "", F.struct(F.xxhash64(trimmed).alias("x"), F.hash(trimmed).alias("y")))


def boilerplate_lines(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, h)`` of the boilerplate lines of ``pages(host, lines)``, where
    ``lines`` holds the distinct hashes of a page's lines."""
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    counts = pages.select("host", F.explode("lines").alias("h")).groupBy("host", "h").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages)
    t = totals.withColumnRenamed("host", "t_host")
    return (counts.join(t, F.col("host").eqNullSafe(F.col("t_host")))
            .filter(F.col("n").cast("double") / F.col("pages") > ratio).select("host", "h"))


def drop_boilerplate(docs: DataFrame, host: str | Column = "source", text_col: str = "text",
                     ratio: float = RATIO, min_pages: int = MIN_PAGES, dropped: str | None = None) -> DataFrame:
    """``docs`` with the boilerplate lines taken out of ``text_col``; with
    ``dropped`` a further column of that name counts them.

    A null text stays null and an empty one empty; a text that is all
    boilerplate becomes empty, its row stays.  A null host is a host of its
    own.  Rows that repeat a host and text are one page.  Other columns stay as they
    are, whatever their names; an empty table stays empty.
    """
    apply_recommended_conf(docs.sparkSession)
    hashes = lambda text: F.transform(F.split(text, "\n", -1), _hash)
    host = F.col(host) if isinstance(host, str) else host
    # A page is known by its host and text: equal pages lose the same lines.
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), host.cast("string").alias("host"), F.col(text_col).alias("text"))
    page_id = F.struct(F.xxhash64("text", "host").alias("x"), F.hash("host", "text").alias("y"))
    pages = keyed.select("host", page_id.alias("id"), F.array_compact(F.array_distinct(hashes("text"))).alias("lines"))
    bad = written(boilerplate_lines(pages.dropDuplicates(["id"]), ratio, min_pages), "boilerplate").withColumnsRenamed({"host": "b_host", "h": "b_h"})
    found = (pages.select("host", "id", F.explode("lines").alias("h"))
             .join(bad, F.col("host").eqNullSafe(F.col("b_host")) & (F.col("h") == F.col("b_h")))
             .groupBy(F.col("id").alias("f_id")).agg(F.collect_set("h").alias("bad")))
    rows = keyed.withColumn("id", page_id).join(found, F.col("id") == F.col("f_id"), "left")
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda x: ~F.coalesce(F.array_contains("bad", _hash(x)), F.lit(False)))
    rows = rows.withColumn("kept", F.when(F.col("bad").isNotNull(), kept))
    text = F.when(F.col("bad").isNull(), F.col("text")).otherwise(F.array_join("kept", "\n"))
    out = [text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    if dropped:
        out.append(F.when(F.col("bad").isNull(), F.lit(0)).otherwise(F.size(lines) - F.size("kept")).cast("long").alias(dropped))
    return rows.select(*out)

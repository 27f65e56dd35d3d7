"""Lines that too many pages of a site share, removed: built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shredloom.llm.common import digest, numbered, settled, without

MAX_RATIO = 0.02
MIN_PAGES = 5
BROADCAST_ROWS = 200_000


def line_key(line: Column) -> Column:
    """Identity of a line without the white space around it."""
    return digest(F.btrim(line, F.lit(" \t\r\f\x0b")))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def boilerplate_lines(docs: DataFrame, host: str = "source", text: str = "text",
                      max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, key) of lines on more than `max_ratio` and at least `min_pages` of a host's pages.

    A page that repeats another one of its host word for word counts once, on both sides of
    the ratio, so that copies of a page do not turn its own lines into boilerplate. Null hosts
    form one host. Each line counts once per page. Texts are hashed before anything moves:
    counting shuffles (host, line, page) hashes, pre-aggregated in each task.
    """
    page = F.xxhash64(F.col(text))
    pages = docs.where(F.col(text).isNotNull()).select(
        F.col(host).alias("_host"), page.alias("_page"), F.col(text).alias("_text"))
    totals = pages.select("_host", "_page").distinct().groupBy("_host").agg(
        F.count(F.lit(1)).alias("_pages"))
    lines = pages.select("_host", "_page", F.explode(F.array_distinct(F.transform(
        lines_of(F.col("_text")), lambda x: F.btrim(x, F.lit(" \t\r\f\x0b"))))).alias("_line"))
    counts = (
        lines.where(F.col("_line") != "")
        .select("_host", "_page", digest(F.col("_line")).alias("_key"))
        .distinct().groupBy("_host", "_key").agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") >= min_pages))
    # One row per host: small, or joined by hash like any other table.
    return counts.join(totals.withColumnRenamed("_host", "_of"),
                       F.col("_host").eqNullSafe(F.col("_of"))).where(
        F.col("_n") > F.lit(max_ratio) * F.col("_pages")).select("_host", "_key", "_n", "_pages")


def dedup_lines(docs: DataFrame, host: str = "source", text: str = "text",
                max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES,
                broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Drops boilerplate lines of each host; adds `n_lines`, `n_dropped` and replaces the text.

    A host has at most (mean lines per page) / max_ratio such lines, so its list rides along
    with each of its pages. The lists are broadcast when their measured rows fit, so that texts
    do not move; otherwise they are joined by host, which adaptive execution splits when one
    host is hot. Both ways give the same rows.

    Null texts stay null with 0 lines; empty texts have one empty line, which is never dropped.
    A page that is nothing but boilerplate keeps an empty text. Repeated rows stay, each cleaned.
    Columns of the input named as those added here are replaced.
    """
    docs = without(docs, ("n_lines", "n_dropped"))
    columns, names = docs.columns, numbered(docs)
    docs, host, text = docs.toDF(*names.values()), names[host], names[text]
    flagged = settled(boilerplate_lines(docs, host, text, max_ratio, min_pages))
    lists = flagged.groupBy(F.col("_host").alias("_list_host")).agg(
        F.collect_list("_key").alias("_keys"))
    if flagged.count() <= broadcast_rows:
        lists = F.broadcast(lists)
    joined = docs.join(
        lists, F.col(host).eqNullSafe(F.col("_list_host")), "left")
    found = joined.withColumn("_lines", lines_of(F.col(text)))
    good = F.filter("_lines", lambda x: ~F.array_contains(F.col("_keys"), line_key(x)))
    cleaned = found.withColumn("_good", F.when(F.col("_keys").isNull(), F.col("_lines"))
                               .otherwise(good))
    return cleaned.select(
        *[F.array_join("_good", "\n") if c == text else F.col(c) for c in docs.columns],
        F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_lines") - F.size("_good"), F.lit(0)).cast("long").alias("n_dropped")
    ).toDF(*columns, "n_lines", "n_dropped")

"""Connected components of links by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shredloom.llm.common import dropped
from shredloom.session import scratch_path


BROADCAST_LINKS = 400_000  # up to so many links, minima (a node and a label each) are broadcast
LINKS_PER_TASK = 50_000


def connected_components(links: DataFrame, a: str = "a", b: str = "b",
                         broadcast_links: int = BROADCAST_LINKS) -> DataFrame:
    """(node, component) of every node that has a link; a component is its smallest node.

    Large-star and small-star rounds: each joins the links with one minimum per node and is
    written to the shared folder, where it replaces the round before. Minima are combined in
    each task before they move; they are broadcast while the counted links bound their size,
    else joined, and a node with very many links only makes the many side of that join hot,
    which adaptive execution splits. While broadcast, links are kept in as few tasks and files as
    their number asks for: rounds over few links are many, and would leave the files of all
    shuffle partitions. Nothing but a count and a checksum of the links reaches
    the driver. Ends after about log(n) rounds. Null ends and links to oneself count for nothing.
    """
    spark = links.sparkSession

    def written(rows: DataFrame) -> tuple[DataFrame, str]:
        path = scratch_path(spark, "links")
        rows.write.parquet(path)
        return spark.read.schema("u long, v long").parquet(path), path

    now, place = written(links.select(
        F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    seen = state(now)
    while True:
        small = seen[0] <= broadcast_links
        tasks = max(1, seen[0] // LINKS_PER_TASK) if small else 0
        kept = packed(now, tasks)
        new, new_place = written(packed(small_star(large_star(kept, tasks), tasks), tasks))
        dropped(spark, place)
        now, place = new, new_place
        reached = state(now)
        if reached == seen:
            break
        seen = reached
    # Every link now goes from a node to the smallest of its component.
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select("v", "v").distinct())


def state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
                 .first())


def packed(rows: DataFrame, tasks: int) -> DataFrame:
    """In that many tasks at most; 0 leaves them as they are."""
    return rows.coalesce(tasks) if tasks else rows


def with_least(links: DataFrame, least: DataFrame, tasks: int) -> DataFrame:
    return links.join(F.broadcast(packed(least, tasks)) if tasks else least,
                      F.col("u") == F.col("w"))


def large_star(links: DataFrame, tasks: int) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = links.union(links.select("v", "u")).toDF("u", "v")
    least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).select(
        "w", F.least("w", "m").alias("m"))
    return with_least(both.where(F.col("v") > F.col("u")), least, tasks).select(
        F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v"))


def small_star(links: DataFrame, tasks: int) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them; each link once."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    moved = with_least(down, least, tasks).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.toDF("u", "v")).where(F.col("u") != F.col("v")).distinct()

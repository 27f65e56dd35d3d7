"""Words, inputs, shared tables and running positions used by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shredloom.session import scratch_path, shared_dir

# The white space between words.
BLANK = r"[\x20\x09-\x0D]"
NOT_BLANK = r"[^\x20\x09-\x0D]"

REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def numbered(df: DataFrame) -> dict[str, str]:
    """A name for each column of an input that no column of an operator's own has."""
    return {name: f"in{place}" for place, name in enumerate(df.columns)}


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The other columns of an input."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in names])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once below the shared folder and read back by column.

    Later stages read it again instead of computing it again, also after a lost executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Removes a table that `stored` wrote and nothing reads any more."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, Spark removes the shuffle files of an action as soon as the action ends.

    Otherwise they stay until the driver collects garbage. For actions that share no shuffle
    with later ones.
    """
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(REMOVE_SHUFFLES)
        else:
            spark.conf.set(REMOVE_SHUFFLES, before)


def settled(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut by a checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def digest(column: Column) -> Column:
    """128 bits of a text as two longs: equal texts agree, others practically never."""
    return F.struct(F.xxhash64(column).alias("a"), F.xxhash64(F.lit(17), column).alias("b"))


def text_key(text: Column) -> Column:
    """Identity of a whole text, null for null: a 128-bit hash of its bytes."""
    return F.unhex(F.md5(F.encode(text, "utf-8")))


def pieces(text: Column) -> Column:
    """The text split at every single white space character; null gives an empty array."""
    return F.coalesce(F.split(text, BLANK), F.array().cast("array<string>"))


def words(text: Column) -> Column:
    """Words of a text, none for null."""
    return F.array_remove(pieces(text), "")


def running_sum(df: DataFrame, groups: Sequence[str], order: Sequence[Column], value: Column,
                name: str = "before") -> DataFrame:
    """Adds the sum of `value` over the rows before this one in its group, and `<name>_total`.

    A group of any size spreads over many tasks: rows are dealt by ranges of group and order,
    added up inside each range, and shifted by the totals of the ranges before. Only one row
    per range and group it touches meets in the window over ranges.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    keys = [f"_o{k}" for k in range(len(order))]
    ranged = settled(
        df.withColumns(dict(zip(keys, order)) | {"_v": value,
                                                  "_tie": F.monotonically_increasing_id()})
        .repartitionByRange(parts, *groups, *keys, "_tie")
        .withColumn("_range", F.spark_partition_id()))
    sums = ranged.groupBy(*groups, "_range").agg(F.sum("_v").alias("_s"))
    group = Window.partitionBy(*groups)
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select(
        *[F.col(g).alias(f"_g{k}") for k, g in enumerate(groups)], F.col("_range").alias("_at"),
        F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_shift"),
        F.sum("_s").over(group).alias("_total"))
    same = F.col("_range") == F.col("_at")
    for k, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{k}"))
    inside = (Window.partitionBy(*groups, "_range").orderBy(*keys, "_tie")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (ranged.withColumn("_inside", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
            .join(shifts, same)
            .select(*df.columns, (F.col("_shift") + F.col("_inside")).alias(name),
                    F.col("_total").alias(f"{name}_total")))

"""Which landed documents are new: one rule for batches, updates and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shredloom.functions.ids import object_id
from shredloom.operators.sizing import broadcast_if_small
from shredloom.session import shared_dir


def matched(left: DataFrame, right: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """Join on columns of the same names, null equal to null; they appear once."""
    renamed = right.withColumnsRenamed({name: f"_right_{name}" for name in names})
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).eqNullSafe(F.col(f"_right_{name}"))
    return left.join(renamed, condition, how).drop(*[f"_right_{name}" for name in names])


def admit(landed: DataFrame, keys: DataFrame,
          bases: Sequence[str] | None = None) -> tuple[DataFrame | None, DataFrame]:
    """The documents `(url, xml, TaxYear)` to store, or None, and those that must not be.

    A filing is its (TaxYear, OBJECTID). One that `keys` have is not stored again. Of documents
    that share an id the one with the smallest URL is taken, of repeats of a URL the smallest
    text. Other URLs with that id are the same filing at another host if `bases` were given to
    say so; else they are refused as `(TaxYear, url, stage, reason)`, never mixed in. All is
    decided on ids and URLs; of the documents only repeated ones move.
    """
    shared_dir(landed.sparkSession)
    filing = ["TaxYear", "_id"]
    urls = (landed.select("TaxYear", "url", object_id(F.col("url"), bases).alias("_id"))
            .groupBy("TaxYear", "_id", "url").agg(F.count(F.lit(1)).alias("_n")).checkpoint())
    years = [row.TaxYear for row in urls.select("TaxYear").distinct().collect()]
    in_years = F.col("TaxYear").isin([year for year in years if year is not None])
    if None in years:
        in_years = in_years | F.col("TaxYear").isNull()
    stored = keys.where(in_years).select(
        "TaxYear", F.col("OBJECTID").alias("_id"), F.col("URL").alias("_stored"))
    listed = broadcast_if_small(urls.select(*filing).distinct())
    stored = matched(stored, listed, filing, "left_semi")
    first = urls.groupBy(*filing).agg(F.min("url").alias("_first"))
    known = stored.groupBy(*filing).agg(F.min("_stored").alias("_stored"),
                                        F.lit(True).alias("_known"))
    judged = matched(matched(urls, first, filing, "inner"), known, filing, "left").select(
        "TaxYear", "url", "_n", "_first", F.coalesce("_stored", "_first").alias("_owner"),
        F.coalesce("_known", F.lit(False)).alias("_known")).checkpoint()
    refused = judged.where(F.col("url") != F.col("_owner")).select(
        "TaxYear", "url", F.lit("identity").alias("stage"),
        F.concat(F.lit("has the filing id of "), F.col("_owner")).alias("reason"))
    if bases is not None:
        refused = refused.limit(0)
    fresh = judged.where(~F.col("_known") & (F.col("url") == F.col("_first")))
    if fresh.isEmpty():
        return None, refused
    by = ["TaxYear", "url"]

    def documents(some: DataFrame) -> DataFrame:
        some = broadcast_if_small(some.select(*by))
        return matched(landed, some, by, "left_semi").select("url", "xml", "TaxYear")

    if fresh.where(F.col("_n") > 1).isEmpty():
        return documents(fresh), refused
    twice = documents(fresh.where(F.col("_n") > 1)).groupBy("url", "TaxYear").agg(
        F.min("xml").alias("xml")).select("url", "xml", "TaxYear")
    return documents(fresh.where(F.col("_n") == 1)).unionByName(twice), refused

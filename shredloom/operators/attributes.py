"""Attribute retrieval and usage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shredloom import schemas
from shredloom.functions.ids import object_id
from shredloom.operators.sizing import broadcast_if_small
from shredloom.operators.top_rows import top_rows

INLINE_IDS = 1_000


def retrieve_attributes(attributes: DataFrame, objectid: Sequence[str] | DataFrame | None = None,
                        url: str | Sequence[str] | None = None, limit: int | None = None,
                        url_bases: Sequence[str] | None = None) -> DataFrame:
    """Attribute rows, all or of some filings, named by id or by URL (URLs win).

    With a limit, the first rows by id, path and name.
    """
    names = schemas.ATTRIBUTES.fieldNames()
    rows = attributes.select(*names)
    if url is not None:
        urls = [url] if isinstance(url, str) else list(url)
        listed = attributes.sparkSession.createDataFrame([(u,) for u in urls], "url string")
        objectid = listed.select(object_id(F.col("url"), url_bases).alias("OBJECTID"))
    if isinstance(objectid, str):
        objectid = [objectid]
    if objectid is not None and not isinstance(objectid, DataFrame):
        ids = list(objectid)
        if len(ids) <= INLINE_IDS:
            rows, objectid = rows.where(F.col("OBJECTID").isin(ids)), None
        else:
            objectid = attributes.sparkSession.createDataFrame(
                [(i,) for i in ids], "OBJECTID string")
    if objectid is not None:
        rows = rows.join(broadcast_if_small(objectid.select("OBJECTID")), "OBJECTID", "left_semi")
    if limit is not None:
        rows = top_rows(rows, names, limit)
    return rows.select(*names)


def summarize_attributes(attributes: DataFrame) -> DataFrame:
    """Per attribute name: rows, filings, distinct values (null is one) and an example value."""
    missing = {"OBJECTID", "attr_name", "attr_value"} - set(attributes.columns)
    if missing:
        raise ValueError(f"columns missing: {sorted(missing)}")

    def distinct(name: str):
        nulls = F.coalesce(F.max(F.col(name).isNull().cast("int")), F.lit(0))
        return F.count_distinct(F.col(name)) + nulls

    # Spark expands the two distinct counts and removes duplicates on (name, value) before
    # anything is gathered by name, so one dominant attribute name is no hot spot.
    return (
        attributes.groupBy("attr_name")
        .agg(F.count(F.lit(1)).alias("n_records"),
             distinct("OBJECTID").alias("n_objects"),
             distinct("attr_value").alias("n_unique_vals"),
             F.min(F.when(F.col("attr_value") != "", F.col("attr_value"))).alias("example_value"))
        .orderBy(F.desc("n_records"), "attr_name")
    )


def attribute_sets(attributes: DataFrame) -> DataFrame:
    """Per attribute name, its distinct values and filings, each with its number of rows.

    Both are counted in one pass; rows are combined in their tasks before they are shuffled by
    name and item, so neither a dominant name nor a frequent value is a hot spot.
    """
    carried = ["TaxYear"] if "TaxYear" in attributes.columns else []
    kinds = F.array(
        F.struct(F.lit("value").alias("kind"), F.col("attr_value").alias("item")),
        F.struct(F.lit("filing").alias("kind"), F.col("OBJECTID").alias("item")))
    return (
        attributes.select(*carried, "attr_name", F.explode(kinds).alias("of"))
        .groupBy(*carried, "attr_name", F.col("of.kind").alias("kind"), F.col("of.item").alias("item"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def summarize_sets(sets: DataFrame) -> DataFrame:
    """`summarize_attributes` from the sets of a store, whose batches and years merge.

    No attribute row is read. A value or filing that several batches have is one.
    """
    value = F.col("kind") == "value"
    return (
        sets.groupBy("attr_name", "kind", "item").agg(F.sum("n_rows").alias("n_rows"))
        .groupBy("attr_name")
        .agg(F.sum(F.when(value, F.col("n_rows"))).alias("n_records"),
             F.count_if(~value).alias("n_objects"), F.count_if(value).alias("n_unique_vals"),
             F.min(F.when(value & (F.col("item") != ""), F.col("item"))).alias("example_value"))
        .orderBy(F.desc("n_records"), "attr_name")
    )


def summarize_attribute_table(attributes: DataFrame) -> DataFrame:
    """Usage of all attributes of a stored table."""
    return summarize_attributes(retrieve_attributes(attributes))

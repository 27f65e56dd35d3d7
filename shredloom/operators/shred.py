"""Shredding: XML filings to long tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shredloom import schemas
from shredloom.functions.ids import object_id
from shredloom.functions.paths import PATH_PREFIXES, local_name, node_type, root_version
from shredloom.operators.crosswalk import map_concordance
from shredloom.operators import xml_rows

# The parser travels with the job, so executors need nothing installed.
cloudpickle.register_pickle_by_value(xml_rows)

# Paths of the filing metadata, the first one present wins. Public element names of the
# return schemas; pass another mapping for other documents.
KEY_PATHS: dict[str, tuple[str, ...]] = {
    "EIN": ("/Return/ReturnHeader/Filer/EIN",),
    "ORG_NAME": (
        "/Return/ReturnHeader/Filer/BusinessName/BusinessNameLine1Txt",
        "/Return/ReturnHeader/Filer/BusinessName/BusinessNameLine1",
        "/Return/ReturnHeader/Filer/Name/BusinessNameLine1",
    ),
    "FORM_TYPE": ("/Return/ReturnHeader/ReturnTypeCd", "/Return/ReturnHeader/ReturnType"),
    "TAX_YEAR": ("/Return/ReturnHeader/TaxYr", "/Return/ReturnHeader/TaxYear"),
    "RETURN_TS": ("/Return/ReturnHeader/ReturnTs", "/Return/ReturnHeader/Timestamp"),
    "IS_AMENDED": (
        "/Return/ReturnHeader/AmendedReturnInd",
        "/Return/ReturnData/IRS990/AmendedReturnInd",
        "/Return/ReturnData/IRS990EZ/AmendedReturnInd",
        "/Return/ReturnHeader/AmendedReturn",
        "/Return/ReturnData/IRS990/AmendedReturn",
        "/Return/ReturnData/IRS990EZ/AmendedReturn",
    ),
    "IS_GROUP": (
        "/Return/ReturnData/IRS990/GroupReturnForAffiliatesInd",
        "/Return/ReturnData/IRS990/GroupReturnForAffiliates",
    ),
    "IS_PARTIAL": (),
}
# The period of a return; one shorter than a year makes it partial.
PERIOD_PATHS = {
    "begin": ("/Return/ReturnHeader/TaxPeriodBeginDt", "/Return/ReturnHeader/TaxPeriodBeginDate"),
    "end": ("/Return/ReturnHeader/TaxPeriodEndDt", "/Return/ReturnHeader/TaxPeriodEndDate"),
}


def parse_filings(filings: DataFrame, parent_text: bool = True,
                  parallelism: int | None = None,
                  derived: xml_rows.PathTexts | None = None, root_text: bool = True,
                  once: tuple[str, ...] = ()) -> DataFrame:
    """One row per element of every document; needs `url` and `xml`, carries other columns.

    Documents are parsed where they lie. `parallelism` spreads them first, for landings that
    sit in too few splits. `derived` adds what follows from the path alone. Columns named in
    `once` are carried on a document's first row only; without `root_text` its root has no text.
    """
    if parallelism:
        filings = filings.repartition(parallelism)
    carried = [field for field in filings.schema.fields if field.name != "xml"]
    schema = T.StructType(carried + [
        T.StructField("ORDER", T.IntegerType()),
        T.StructField("XPATH", T.StringType()),
        T.StructField("N_CHILDREN", T.IntegerType()),
        T.StructField("VALUE", T.StringType()),
        T.StructField("ATTRS", schemas.ATTRIBUTE_LIST),
        T.StructField("ERROR", T.StringType()),
        T.StructField("VERSION", T.StringType()),
    ] + ([T.StructField(name, T.StringType()) for name in ("XPATH2", "TABLE_ID", "TABLE_HEADER")]
         if derived else []))
    return filings.mapInArrow(
        xml_rows.element_batches(parent_text, derived, root_text, once), schema)


def attribute(name: str) -> Column:
    """Value of one attribute of the element on this row, null without it."""
    return F.get(F.filter("ATTRS", lambda pair: pair["attr_name"] == name), 0)["attr_value"]


def long_rows(filings: DataFrame, crosswalk: DataFrame | None = None, *,
              parent_text: bool = True, legacy_paths: bool = False,
              url_bases: Sequence[str] | None = None,
              parallelism: int | None = None) -> DataFrame:
    """All element rows in stored form, failed documents included (ERROR is set there).

    Ids are made once per document, texts of paths once per distinct path of a batch. A root
    shows its version instead of the document's text, so that text and repeated URLs stay behind.
    """
    first = F.col("ORDER") == 1
    named = filings.withColumn("OBJECTID", object_id(F.col("url"), url_bases))
    elements = (
        parse_filings(named, parent_text, parallelism,
                      xml_rows.PathTexts(PATH_PREFIXES, legacy_paths), root_text=False,
                      once=("url",))
        .withColumn("VALUE", F.when(first, root_version(F.col("VERSION")))
                    .otherwise(F.col("VALUE")))
        .withColumnRenamed("url", "URL")
        .withColumn("TYPE", node_type(F.col("N_CHILDREN")))
    )
    mapped = map_concordance(elements, crosswalk)
    extra = [name for name in filings.columns if name not in ("url", "xml")]
    return mapped.select(*extra, *schemas.FLATXML_STORED.fieldNames())


def good_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("ERROR").isNull())


def shred_elements(filings: DataFrame, crosswalk: DataFrame | None = None,
                   **options) -> DataFrame:
    """FLATXML: one row per element with its path, table, variable and text."""
    rows = good_rows(long_rows(filings, crosswalk, **options))
    return rows.select(*schemas.FLATXML.fieldNames())


def attributes_of(rows: DataFrame) -> DataFrame:
    """ATTRIBUTES out of stored rows: one row per attribute of every element."""
    carried = [F.col("TaxYear")] if "TaxYear" in rows.columns else []
    return (
        rows.where((F.size("ATTRS") > 0) & F.col("ERROR").isNull())
        .select(*carried, "OBJECTID", "XPATH", F.explode("ATTRS").alias("pair"))
        .select(*carried, "OBJECTID", local_name(F.col("XPATH")).alias("node_name"),
                F.col("XPATH").alias("xpath"), F.col("pair.attr_name").alias("attr_name"),
                F.col("pair.attr_value").alias("attr_value"))
    )


def shred_attributes(filings: DataFrame, **options) -> DataFrame:
    """ATTRIBUTES straight from documents."""
    options.setdefault("parent_text", False)
    return attributes_of(long_rows(filings, None, **options))


def keys_of(rows: DataFrame, key_paths: Mapping[str, Sequence[str]] = KEY_PATHS) -> DataFrame:
    """KEYS out of stored rows: one row per filing. Only the rows read are shuffled.

    IS_PARTIAL without paths of its own is "X" for a period that ends before its year is over.
    """
    wanted = sorted({path for paths in (*key_paths.values(), *PERIOD_PATHS.values())
                     for path in paths})
    root = F.col("ORDER") == 1
    carried = ["TaxYear"] if "TaxYear" in rows.columns else []

    def first_of(paths: Sequence[str]) -> Column:
        found = [F.max(F.when(F.col("XPATH2") == path, F.col("VALUE"))) for path in paths]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    begin, end = (F.to_date(F.try_to_timestamp(first_of(PERIOD_PATHS[k]), F.lit("yyyy-MM-dd")))
                  for k in ("begin", "end"))
    short = F.when(F.date_add(end, 1) < F.add_months(begin, 12), F.lit("X"))
    picked = [(short if name == "IS_PARTIAL" and not paths else first_of(paths)).alias(name)
              for name, paths in key_paths.items()]
    return (
        rows.where(F.col("ERROR").isNull() & (root | F.col("XPATH2").isin(wanted)))
        .select(*carried, "OBJECTID", "XPATH2", "ORDER", "URL",
                F.when(~root, F.col("VALUE")).alias("VALUE"),
                F.when(root, attribute("returnVersion")).alias("VERSION"))
        .groupBy(*carried, "OBJECTID")
        .agg(F.max("URL").alias("URL"), F.max("VERSION").alias("VERSION"), *picked)
    )


def paths_of(rows: DataFrame) -> DataFrame:
    """PATHS out of stored rows: elements of each path, table and version, by year.

    Every row knows the version of its filing, so rows are counted where they lie; what is
    shuffled are the few combinations of each task.
    """
    carried = ["TaxYear"] if "TaxYear" in rows.columns else []
    return good_rows(rows).groupBy(*carried, "XPATH2", "TYPE", "RDB_TABLE", "VERSION").agg(
        F.count(F.lit(1)).alias("n_rows"))


def extract_keys(filings: DataFrame, key_paths: Mapping[str, Sequence[str]] = KEY_PATHS,
                 **options) -> DataFrame:
    """KEYS straight from documents."""
    options.setdefault("parent_text", False)
    return keys_of(long_rows(filings, None, **options), key_paths)


def failures_of(rows: DataFrame) -> DataFrame:
    """Dead letters out of stored rows: URL, stage and reason."""
    carried = ["TaxYear"] if "TaxYear" in rows.columns else []
    return rows.where(F.col("ERROR").isNotNull()).select(
        *carried, F.col("URL").alias("url"), F.lit("parse").alias("stage"),
        F.col("ERROR").alias("reason"))


def failed_filings(filings: DataFrame, **options) -> DataFrame:
    """Dead letters straight from documents."""
    options.setdefault("parent_text", False)
    return failures_of(long_rows(filings, None, **options))


def shred_counts(rows: DataFrame) -> DataFrame:
    """Filings shredded, filings failed and elements, in one row."""
    return rows.agg(
        F.count_if(F.col("ORDER") == 1).alias("n_filings"),
        F.count_if(F.col("ERROR").isNotNull()).alias("n_failed"),
        F.count_if(F.col("ERROR").isNull()).alias("n_elements"))

"""Filings, crosswalk and index made from the order tables, for queries, tests and the bench.

One document per order. Nothing is stored here: each fixture is a DataFrame over the tables
of one folder.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shredloom import schemas
from shredloom.session import scratch_path
from shredloom.sources.filings import pack_filings
from shredloom.sources.store import LongStore

URL_BASE = "https://filings.example.org/xml/"
HEADER_TABLE, LINES_TABLE = "OF-P00-T00-HEADER", "OF-P01-T01-LINES"

_HEADER, _FORM = "/Return/ReturnHeader", "/Return/ReturnData/Form"
CONCORDANCE_ROWS = [
    (f"{_HEADER}/Filer/EIN", "OF_00_EIN", HEADER_TABLE, "F-PART-00-LINE-01"),
    (f"{_HEADER}/Filer/BusinessName/BusinessNameLine1Txt", "OF_00_NAME", HEADER_TABLE,
     "F-PART-00-LINE-02"),
    (f"{_HEADER}/TaxYr", "OF_00_TAX_YEAR", HEADER_TABLE, "F-PART-00-LINE-03"),
    (f"{_HEADER}/ReturnTypeCd", "OF_00_FORM", HEADER_TABLE, "F-PART-00-LINE-04"),
    (f"{_HEADER}/AmendedReturnInd", "OF_00_AMENDED", HEADER_TABLE, "F-PART-00-LINE-05"),
    (f"{_FORM}/TotalAmt", "OF_00_TOTAL", HEADER_TABLE, "F-PART-00-LINE-06"),
    (f"{_FORM}/PriorityTxt", "OF_00_PRIORITY", HEADER_TABLE, "F-PART-00-LINE-07"),
    (f"{_FORM}/LineItemGrp/LineNum", "OF_01_LINE", LINES_TABLE, "F-PART-01-LINE-01"),
    (f"{_FORM}/LineItemGrp/PartNum", "OF_01_PART", LINES_TABLE, "F-PART-01-LINE-02"),
    (f"{_FORM}/LineItemGrp/SuppNum", "OF_01_SUPP", LINES_TABLE, "F-PART-01-LINE-03"),
    (f"{_FORM}/LineItemGrp/QtyNum", "OF_01_QTY", LINES_TABLE, "F-PART-01-LINE-04"),
    (f"{_FORM}/LineItemGrp/Amt", "OF_01_AMT", LINES_TABLE, "F-PART-01-LINE-05"),
    (f"{_HEADER}/NeverPresent", "OF_00_UNUSED", HEADER_TABLE, "F-PART-00-LINE-99"),
]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)").cast("string")


def padded(column: str) -> Column:
    return F.lpad(F.col(column).cast("string"), 9, "0")


def order_year() -> Column:
    return F.year("o_orderdate").cast("string")


def order_url() -> Column:
    return F.concat(F.lit(URL_BASE), padded("o_orderkey"), F.lit("_public.xml"))


def order_form() -> Column:
    return (F.when(F.col("o_orderstatus") == "F", F.lit("990"))
            .when(F.col("o_orderstatus") == "O", F.lit("990EZ")).otherwise(F.lit("990PF")))


def _escaped(text: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def _tag(name: str, text: Column, attribute: str = "") -> Column:
    return F.concat(F.lit(f"<{name}{attribute}>"), text, F.lit(f"</{name}>"))


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`URL, TaxYear, FormType`, one row per order."""
    return read(spark, sf_dir, "orders").select(
        order_url().alias("URL"), order_year().alias("TaxYear"), order_form().alias("FormType"))


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`url, xml, TaxYear, o_orderkey`, one document per order."""
    line = F.concat(
        F.lit("<LineItemGrp>"),
        _tag("LineNum", F.col("l_linenumber").cast("string")),
        _tag("PartNum", F.col("l_partkey").cast("string")),
        _tag("SuppNum", F.col("l_suppkey").cast("string")),
        _tag("QtyNum", money("l_quantity")),
        _tag("Amt", money("l_extendedprice"), ' currency="USD"'),
        F.lit("</LineItemGrp>"))
    entries = F.array_sort(F.collect_list(F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        line.alias("text"))))
    # Dealt by order first, so that columns are shuffled and not the text made of them.
    items = read(spark, sf_dir, "lineitem")
    parts = max(spark.sparkContext.defaultParallelism, items.count() // LINES_PER_TASK)
    lines = (
        items
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                "l_extendedprice")
        .repartition(parts, "l_orderkey").groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(entries.alias("entries"))
        .select("o_orderkey", F.size("entries").alias("n_lines"),
                F.array_join(F.col("entries.text"), "").alias("lines"))
    )
    orders = (
        read(spark, sf_dir, "orders")
        .join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(lines.hint("merge"), "o_orderkey", "left")  # texts are too many to broadcast
    )
    amended = F.when(F.col("o_orderpriority") == "1-URGENT",
                     F.lit("<AmendedReturnInd>X</AmendedReturnInd>")).otherwise(F.lit(""))
    version = F.concat(order_year(), F.lit("v"),
                       (F.lit(1) + F.col("o_orderkey") % 3).cast("string"), F.lit(".0"))
    xml = F.concat(
        F.lit('<Return returnVersion="'), version, F.lit('"><ReturnHeader><Filer>'),
        _tag("EIN", padded("c_custkey")),
        _tag("BusinessName", _tag("BusinessNameLine1Txt", _escaped(F.col("c_name")))),
        F.lit("</Filer>"),
        _tag("TaxYr", order_year()), _tag("ReturnTypeCd", order_form()), amended,
        F.lit('</ReturnHeader><ReturnData documentCount="'),
        F.coalesce("n_lines", F.lit(0)).cast("string"), F.lit('"><Form>'),
        _tag("TotalAmt", money("o_totalprice")),
        _tag("PriorityTxt", _escaped(F.col("o_orderpriority"))),
        _tag("SegmentTxt", _escaped(F.col("c_mktsegment"))),
        F.coalesce("lines", F.lit("")), F.lit("</Form></ReturnData></Return>"))
    return orders.select(order_url().alias("url"), xml.alias("xml"),
                         order_year().alias("TaxYear"), "o_orderkey")


def broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real web pages as documents: none is well-formed XML."""
    return read(spark, sf_dir, "pages").select("url", F.col("html").alias("xml"))


def concordance(spark: SparkSession) -> DataFrame:
    """The crosswalk of the fixture with all its columns."""
    rows = [
        tuple({"xpath": xpath, "variable_name": variable, "rdb_table": table,
               "location_code_family": place, "rdb_relationship":
               "ONE" if "-T00-" in table else "MANY", "latest_version": "2001",
               "current_version": "false"}.get(name)
              for name in schemas.CONCORDANCE.fieldNames())
        for xpath, variable, table, place in CONCORDANCE_ROWS
    ]
    return spark.createDataFrame(rows, schemas.CONCORDANCE)


def table_headers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(LINES_TABLE, "//Form/LineItemGrp")], schemas.TABLE_HEADERS)


FILE_ROWS = 1_000  # filings in a landed file: Spark then packs few of them into one task
LINES_PER_TASK = 200_000

_LANDED: dict[tuple, str] = {}
_STORES: dict[tuple, LongStore] = {}


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filings landed once as Parquet below the shared folder, as a crawl would leave them."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _LANDED:
        path = scratch_path(spark, "landed")
        pack_filings(filings(spark, sf_dir), path, dealt=False, file_rows=FILE_ROWS)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


def long_store(spark: SparkSession, sf_dir: str) -> LongStore:
    """The whole fixture shredded once into a store below the shared folder."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _STORES:
        store = LongStore(spark, scratch_path(spark, "store"))
        store.append(landed(spark, sf_dir).select("url", "xml", "TaxYear"), concordance(spark))
        _STORES[key] = store
    return _STORES[key]

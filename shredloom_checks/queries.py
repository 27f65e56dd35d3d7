"""One query per operator, each over the whole tables of a folder."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shredloom import schemas
from shredloom.functions import ids, paths, versions
from shredloom.operators import (
    attributes, crosswalk, filing_index, merge, pathset, profile, reports, shred, wide)
from shredloom.plans import jobs
from shredloom.session import scratch_path
from shredloom.sources import crosswalk_files, filings as landing, tables
from shredloom.sources.store import LongStore, open_snapshot
from shredloom.streaming.updates import update_stream as start_update
from shredloom_checks import fixtures as fx

YEARS = [str(year) for year in range(1995, 2002)]
DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")
AS_OF_YEAR = 2001

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# -- inputs ---------------------------------------------------------------------------------

def documents(spark, sf):
    return fx.landed(spark, sf).select("url", "xml")


def mixed(spark, sf):
    """Good filings and web pages that are no XML."""
    return documents(spark, sf).unionByName(fx.broken(spark, sf))


def flat(spark, sf, years=None):
    return fx.long_store(spark, sf).table("FLATXML", years)


def keys(spark, sf, years=None):
    return fx.long_store(spark, sf).table("KEYS", years)


def path_summary(spark, sf):
    return fx.long_store(spark, sf).table("PATHS")


def stored_attributes(spark, sf):
    return fx.long_store(spark, sf).table("ATTRIBUTES").drop("TaxYear")


def element_paths(spark, sf):
    return flat(spark, sf).select("XPATH", "TYPE").distinct()


def path_set(spark, sf):
    """Element paths and the paths of web pages, none of them in any order."""
    return flat(spark, sf).select(F.col("XPATH").alias("xpath")).unionByName(
        fx.read(spark, sf, "pages").select(F.col("url").alias("xpath")))


def order_number(column: str = "OBJECTID"):
    return F.substring(F.col(column), 5, 9).cast("long")


def even(df: DataFrame) -> DataFrame:
    return df.where(order_number() % 2 == 0)


# -- shredding ------------------------------------------------------------------------------

@query
def shred_elements(spark, sf):
    return shred.shred_elements(documents(spark, sf), fx.concordance(spark))


@query
def shred_elements_without_parent_text(spark, sf):
    rows = shred.shred_elements(documents(spark, sf), fx.concordance(spark), parent_text=False)
    return rows.groupBy("TYPE").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("VALUE").alias("n_values"))


@query
def shred_attributes(spark, sf):
    return shred.shred_attributes(documents(spark, sf))


@query
def extract_keys(spark, sf):
    return shred.extract_keys(documents(spark, sf))


@query
def failed_filings(spark, sf):
    return shred.failed_filings(mixed(spark, sf)).select("url", "stage")


@query
def shred_batch_counts(spark, sf):
    store = LongStore(spark, scratch_path(spark, "batch"))
    store.append(mixed(spark, sf).withColumn("TaxYear", F.lit("all")), fx.concordance(spark))
    return store.commits().drop("BATCH")


@query
def root_version(spark, sf):
    return flat(spark, sf).where(F.col("ORDER") == 1).select("OBJECTID", "VALUE")


# -- derived columns ------------------------------------------------------------------------

@query
def object_id(spark, sf):
    """Filings of a known folder, the same names in an unknown folder, and web pages."""
    filed = fx.index(spark, sf).select("URL")
    elsewhere = filed.select(F.replace("URL", F.lit("/xml/"), F.lit("/other/")).alias("URL"))
    urls = filed.unionByName(elsewhere).unionByName(
        fx.read(spark, sf, "pages").select(F.col("url").alias("URL")))
    known = ids.object_id(F.col("URL"), bases=(fx.URL_BASE,))
    return ids.normalize_ids(urls).withColumn("OBJECTID_KNOWN_BASE", known)


def dirty_eins(spark, sf):
    """Customer keys as organisation numbers in all the forms people write them."""
    key = F.col("c_custkey").cast("string")
    nine = fx.padded("c_custkey")
    written = F.array(
        key, nine, F.concat(F.lit("EIN-"), F.substring(nine, 1, 2), F.lit("-"),
                            F.substring(nine, 3, 7)),
        F.concat(nine, F.lit("77")), F.concat(F.lit(" "), key, F.lit("-")), F.lit(""))
    return fx.read(spark, sf, "customer").select(
        "c_custkey", F.posexplode(written).alias("form", "EIN"))


@query
def format_ein_id(spark, sf):
    return ids.normalize_ids(dirty_eins(spark, sf)).select("c_custkey", "form", "EIN", "EIN_ID")


@query
def format_ein_n(spark, sf):
    return ids.normalize_ids(dirty_eins(spark, sf)).select("c_custkey", "form", "EIN", "EIN_N")


@query
def normalize_xpath(spark, sf):
    return paths.derive_paths(element_paths(spark, sf)).select("XPATH", "XPATH2")


@query
def last_index(spark, sf):
    return element_paths(spark, sf).select(
        "XPATH", paths.last_index(F.col("XPATH")).alias("last_index"))


@query
def table_id(spark, sf):
    return paths.derive_paths(element_paths(spark, sf)).select("XPATH", "TABLE_ID")


@query
def table_header(spark, sf):
    return paths.derive_paths(element_paths(spark, sf)).select("XPATH", "TYPE", "TABLE_HEADER")


@query
def leaf_name(spark, sf):
    return paths.derive_paths(element_paths(spark, sf)).select("XPATH", "LEAF_NAME")


@query
def parent_paths(spark, sf):
    return pathset.parent_paths(path_set(spark, sf))


@query
def terminal_paths(spark, sf):
    return pathset.terminal_paths(path_set(spark, sf))


@query
def node_type(spark, sf):
    return pathset.classify_paths(path_set(spark, sf))


@query
def merge_version_lists(spark, sf):
    """Each customer's version list, uneven and with repeats; empty for the late orders only."""
    orders = fx.read(spark, sf, "orders")
    version = F.concat(fx.order_year(), F.lit("v"),
                       (F.lit(1) + F.col("o_orderkey") % 3).cast("string"), F.lit(".0"))
    entry = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(" ")).otherwise(
        F.concat(F.lit(" "), version))
    entries = orders.select("o_custkey", "o_orderstatus", "o_orderpriority",
                            entry.alias("entry")).distinct()
    lists = entries.groupBy("o_custkey", "o_orderstatus").agg(
        F.array_join(F.collect_list("entry"), ",").alias("schema_versions"))
    return versions.summarize_versions(lists)


# -- index ----------------------------------------------------------------------------------

@query
def chunk_label(spark, sf):
    return filing_index.label_chunks(fx.index(spark, sf), 25)


@query
def split_index_by_year(spark, sf):
    path = scratch_path(spark, "index")
    landing.split_index_by_year(fx.index(spark, sf), [1995, *YEARS], path)
    return spark.read.parquet(path).select(
        "URL", F.col("TaxYear").cast("string").alias("TaxYear"), "FormType")


@query
def index_crosstab(spark, sf):
    return filing_index.index_crosstab(fx.index(spark, sf))


@query
def missing_filings(spark, sf):
    return filing_index.missing_filings(fx.index(spark, sf), even(keys(spark, sf)))


@query
def missing_filings_of_year(spark, sf):
    return filing_index.missing_filings(fx.index(spark, sf), even(keys(spark, sf)), 1997)


@query
def pending_filings(spark, sf):
    stored = keys(spark, sf)
    failed = stored.where(order_number() % 4 == 1).select(F.col("URL").alias("url"))
    return filing_index.pending_filings(fx.index(spark, sf), even(stored), failed)


# -- crosswalk ------------------------------------------------------------------------------

def found_concordance(spark, sf):
    """A crosswalk with every path found in the filings."""
    return flat(spark, sf).select(
        F.col("XPATH2").alias("xpath"), F.col("VARIABLE_NAME").alias("variable_name"),
        F.col("RDB_TABLE").alias("rdb_table"), F.col("TYPE").alias("rdb_relationship")).distinct()


@query
def project_concordance(spark, sf):
    once = crosswalk.project_concordance(found_concordance(spark, sf))
    return crosswalk.project_concordance(once)


@query
def read_concordance(spark, sf):
    path = scratch_path(spark, "concordance")
    found = found_concordance(spark, sf)
    full = tables.align_columns(found, crosswalk_files.schemas.CONCORDANCE.fieldNames())
    tables.write_csv(full, path)
    return crosswalk_files.read_concordance(spark, path).select("xpath", "variable_name", "rdb_table")


@query
def map_concordance(spark, sf):
    """The tax year is listed under a second name: its rows double."""
    second = spark.createDataFrame(
        [("/Return/ReturnHeader/TaxYr", "OF_00_YEAR_TWIN", fx.HEADER_TABLE)],
        "xpath string, variable_name string, rdb_table string")
    names = crosswalk.project_concordance(fx.concordance(spark)).unionByName(
        crosswalk.project_concordance(second))
    bare = flat(spark, sf).drop("VARIABLE_NAME", "RDB_TABLE")
    return crosswalk.map_concordance(bare, names).select(
        "OBJECTID", "ORDER", "XPATH2", "VARIABLE_NAME", "RDB_TABLE")


# -- storage and merging --------------------------------------------------------------------

def people(spark, sf):
    customers = fx.read(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        fx.money("c_acctbal").alias("balance"))
    suppliers = fx.read(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"),
        F.col("s_nationkey").alias("nation"))
    return customers, suppliers


@query
def append_long_tables(spark, sf):
    customers, suppliers = people(spark, sf)
    root = scratch_path(spark, "append")
    tables.append_long_tables([{"KEYS": customers}], root)
    tables.append_long_tables([{"KEYS": suppliers}], root)
    return tables.read_rows(spark, f"{root}/KEYS")


@query
def align_columns(spark, sf):
    customers, suppliers = people(spark, sf)
    return tables.align_columns(tables.as_text(suppliers), customers.columns)


@query
def create_and_insert(spark, sf):
    customers, _ = people(spark, sf)
    path = scratch_path(spark, "copy")
    tables.create_as(customers.where("key % 2 = 0"), path)
    tables.insert_as(customers.where("key % 2 = 1"), path)
    return spark.read.parquet(path)


def shards(spark, sf):
    """The stored tables by order number modulo 4: one shard lacks ATTRIBUTES, one has more KEYS."""
    store = fx.long_store(spark, sf)
    parts = []
    for i in range(4):
        part = {name: store.table(name).where(order_number() % 4 == i)
                for name in merge.MERGE_TABLES}
        if i == 2:
            del part["ATTRIBUTES"]
        if i == 3:
            part["KEYS"] = part["KEYS"].withColumn("SHARD", F.lit("3"))
        parts.append(part)
    return parts


@query
def merge_shards(spark, sf):
    return merge.merge_shards(shards(spark, sf))["KEYS"]


@query
def merge_shard_counts(spark, sf):
    return merge.count_tables(merge.merge_shards(shards(spark, sf)), "main")


@query
def validate_merge(spark, sf):
    parts = shards(spark, sf)
    merged = merge.merge_shards(parts)
    merged["FLATXML"] = merged["FLATXML"].where(F.col("ORDER") > 1)
    parts[0] = {**parts[0], "EXTRA": parts[0]["KEYS"]}
    merged["ONLY_MAIN"] = merged["KEYS"]
    return merge.validate_merge(merged, parts).na.fill(-1).withColumn(
        "match", F.col("match").cast("string"))


@query
def mismatches(spark, sf):
    """The tables whose rows do not add up, of a merge that lost the first elements."""
    parts = shards(spark, sf)
    merged = merge.merge_shards(parts)
    merged["FLATXML"] = merged["FLATXML"].where(F.col("ORDER") > 1)
    return merge.mismatches(merge.validate_merge(merged, parts)).withColumn(
        "match", F.col("match").cast("string"))


@query
def merge_update(spark, sf):
    """Even orders updated with every filing: the even ones come again and change nothing."""
    store = fx.long_store(spark, sf)
    full = {name: store.table(name) for name in merge.MERGE_TABLES}
    base = {name: even(df) for name, df in full.items()}
    once = merge.merge_update(base, full)
    twice = merge.merge_update(once, full)
    return twice["KEYS"].select("OBJECTID", "URL", "VERSION", "TaxYear")


@query
def merge_update_rows(spark, sf):
    store = fx.long_store(spark, sf)
    full = {name: store.table(name) for name in merge.MERGE_TABLES}
    merged = merge.merge_update({name: even(df) for name, df in full.items()}, full)
    return merged["FLATXML"].groupBy("TaxYear", "XPATH2").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def merge_update_attributes(spark, sf):
    """The attributes of the merged shards, old and new, each once."""
    store = fx.long_store(spark, sf)
    full = {name: store.table(name) for name in merge.MERGE_TABLES}
    merged = merge.merge_update({name: even(df) for name, df in full.items()}, full)
    return merged["ATTRIBUTES"].select(*schemas.ATTRIBUTES.fieldNames())


@query
def open_snapshot_returns(spark, sf):
    return open_snapshot(spark, fx.long_store(spark, sf).root)


# -- jobs -----------------------------------------------------------------------------------

def yearly_counts(store: LongStore) -> DataFrame:
    counted = [store.table(name).groupBy("TaxYear").agg(F.count(F.lit(1)).alias("n_rows"))
               .withColumn("table_name", F.lit(name)) for name in merge.MERGE_TABLES]
    return functools.reduce(DataFrame.unionByName, counted)


@query
def build_year(spark, sf):
    """All years of the index in one job."""
    store = LongStore(spark, scratch_path(spark, "build"))
    jobs.build_years(store, documents(spark, sf), fx.index(spark, sf),
                     crosswalk=fx.concordance(spark))
    return store.table("KEYS")


@query
def build_single_year(spark, sf):
    """One year asked for: the index's other years stay out."""
    store = LongStore(spark, scratch_path(spark, "year"))
    jobs.build_year(store, documents(spark, sf), 1996, fx.concordance(spark),
                    fx.index(spark, sf))
    return store.table("KEYS")


@query
def resume_year(spark, sf):
    """Half of each year is stored and the pages are known to fail; the rest is pending."""
    store = LongStore(spark, scratch_path(spark, "resume"))
    bad = fx.broken(spark, sf).select(
        F.col("url").alias("URL"), F.lit("1997").alias("TaxYear"), F.lit("990").alias("FormType"))
    index = fx.index(spark, sf).unionByName(bad)
    ours = F.col("URL").startswith(fx.URL_BASE)
    first = index.where(F.substring("URL", -12, 1).isin(list("02468")) | ~ours)
    docs, names = mixed(spark, sf), fx.concordance(spark)
    jobs.build_years(store, docs, first, crosswalk=names)
    jobs.resume_years(store, docs, index, crosswalk=names)
    if jobs.resume_years(store, docs, index, crosswalk=names) is not None:
        raise AssertionError("nothing may be pending any more")
    return store.table("FLATXML").drop("TaxYear")


@query
def update_year(spark, sf):
    """All years built from even orders, then updated twice from everything landed."""
    store = LongStore(spark, scratch_path(spark, "update"))
    docs, index = documents(spark, sf), fx.index(spark, sf)
    evens = docs.where(F.substring("url", -12, 1).isin(list("02468")))
    names = fx.concordance(spark)
    jobs.build_years(store, evens, index, YEARS, names)
    jobs.build_years(store, docs, index, YEARS, names)
    if jobs.build_years(store, docs, index, YEARS, names) is not None:
        raise AssertionError("the store must be up to date")
    return yearly_counts(store)


@query
def update_stream(spark, sf):
    """Even orders land, then all of them: each is stored once."""
    root = scratch_path(spark, "stream")
    store = LongStore(spark, f"{root}/store")
    docs = fx.landed(spark, sf)
    names = fx.concordance(spark)
    for part in (docs.where(F.col("o_orderkey") % 2 == 0), docs):
        part.select("url", "xml", "TaxYear").write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema("url string, xml string, TaxYear string").parquet(
            f"{root}/landing")
        start_update(stream, store, f"{root}/offsets", names).awaitTermination()
    return store.table("ATTRIBUTES").drop("TaxYear")


@query
def update_stream_two_sources(spark, sf):
    """Two landings, each with its own checkpoint, fill one store with default arguments."""
    root = scratch_path(spark, "streams")
    store = LongStore(spark, f"{root}/store")
    docs = fx.landed(spark, sf)
    for part in (0, 1):
        docs.where(F.col("o_orderkey") % 2 == part).select("url", "xml", "TaxYear").write.parquet(
            f"{root}/landing{part}")
        stream = spark.readStream.schema("url string, xml string, TaxYear string").parquet(
            f"{root}/landing{part}")
        start_update(stream, store, f"{root}/offsets{part}", fx.concordance(spark)).awaitTermination()
    return store.table("FLATXML").drop("TaxYear")


@query
def compact_store(spark, sf):
    """Three batches and one unreadable landing, rewritten as one batch."""
    store = LongStore(spark, scratch_path(spark, "compact"))
    docs = fx.landed(spark, sf)
    for part in range(3):
        store.append(docs.where(F.col("o_orderkey") % 3 == part), fx.concordance(spark))
    store.append(fx.broken(spark, sf).withColumn("TaxYear", F.lit("2000")), fx.concordance(spark))
    store.compact()
    store.remove_replaced()
    if store.commits().count() != 1 or store.table("FAILED_URLS").isEmpty():
        raise AssertionError("one batch with the dead letters must be left")
    return store.table("FLATXML").drop("TaxYear")


@query
def read_filings(spark, sf):
    """Web pages as one file each, read back as documents."""
    path = scratch_path(spark, "files")
    fx.read(spark, sf, "pages").select("html", "page_id").write.partitionBy("page_id").text(path)
    got = landing.read_filings(spark, f"{path}/page_id=*")
    page = F.regexp_extract("url", r"page_id=(\d+)", 1).cast("long")
    return got.select(page.alias("page_id"), F.md5(F.regexp_replace(F.col("xml").cast("string"), "\n$", "")).alias("md5"))


@query
def list_tables(spark, sf):
    """The given tables as views, listed, with their rows."""
    for name in DRIVER_TABLES:
        fx.read(spark, sf, name).createOrReplaceTempView(name)
    listed = [name for name in tables.list_tables(spark) if name in DRIVER_TABLES]
    return merge.count_tables({name: spark.table(name) for name in listed}, "view")


# -- wide tables ----------------------------------------------------------------------------

@query
def table_rows(spark, sf):
    return wide.table_rows(flat(spark, sf), fx.HEADER_TABLE).select(
        "OBJECTID", "VARIABLE_NAME", "VALUE")


@query
def header_rows(spark, sf):
    """Whole segments only: `//ReturnHeader/Filer` and not what merely starts like `//Form/Line`."""
    return wide.header_rows(flat(spark, sf), ["//ReturnHeader/Filer", "//Form/Line"]).groupBy(
        "XPATH2").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def header_rows_legacy(spark, sf):
    return wide.header_rows(flat(spark, sf), ["//ReturnHeader/Filer", "//Form/Line"], True).groupBy(
        "XPATH2").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def flatten_table(spark, sf):
    return wide.flatten_table(flat(spark, sf).drop("TaxYear"), fx.HEADER_TABLE,
                              wide.variable_order(fx.concordance(spark), fx.HEADER_TABLE))


@query
def flatten_table_observed(spark, sf):
    return wide.flatten_table(flat(spark, sf).drop("TaxYear"), fx.HEADER_TABLE)


@query
def pivot_duplicates(spark, sf):
    """A name that repeats keeps its largest text, so "9" beats "10"."""
    rows = fx.read(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("OBJECTID"),
        F.col("event_type").alias("VARIABLE_NAME"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("VALUE"))
    return wide.pivot_values(rows, ["OBJECTID"], ["click", "error", "purchase", "signup", "view"])


@query
def add_keys(spark, sf):
    """Keys of even orders only: the other rows stay, without keys."""
    small = wide.flatten_table(flat(spark, sf).drop("TaxYear"), fx.HEADER_TABLE, ["OF_00_TOTAL", "OF_00_FORM"])
    some = even(keys(spark, sf)).select("OBJECTID", "URL", "VERSION")
    return wide.add_keys(small, some, ["OF_00_FORM", "OF_00_TOTAL"])


@query
def build_table(spark, sf):
    return wide.build_table(flat(spark, sf), keys(spark, sf).drop("TaxYear"),
                            fx.concordance(spark), fx.HEADER_TABLE)


@query
def build_rdb_table(spark, sf):
    headers = wide.header_list(fx.table_headers(spark), fx.LINES_TABLE)
    return wide.build_rdb_table(flat(spark, sf), keys(spark, sf).drop("TaxYear"),
                                fx.concordance(spark), headers, fx.LINES_TABLE,
                                paths=path_summary(spark, sf))


@query
def extract_tables(spark, sf):
    """The CSV files of both tables and all years, read back: each row's names and cells in order."""
    manifest = jobs.extract_tables(
        flat(spark, sf), keys(spark, sf), fx.concordance(spark), fx.table_headers(spark),
        [fx.HEADER_TABLE, fx.LINES_TABLE], YEARS, scratch_path(spark, "csv"),
        paths=path_summary(spark, sf))
    read = []
    for row in manifest.collect():
        rows = tables.read_csv(spark, row.path)
        if rows.count() != row.n_rows:
            raise AssertionError(f"{row.path} has not the rows of the manifest")
        cells = [F.concat(F.lit(f"{name}="), F.coalesce(F.col(f"`{name}`"), F.lit("")))
                 for name in rows.columns]
        read.append(rows.select(F.lit(row.table_name).alias("table_name"),
                                F.lit(row.TaxYear).alias("TaxYear"),
                                F.concat_ws("|", *cells).alias("cells")))
    return functools.reduce(DataFrame.union, read)


@query
def write_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "roundtrip")
    made = wide.build_rdb_table(
        flat(spark, sf), keys(spark, sf).select("OBJECTID", "VERSION"), fx.concordance(spark),
        ["//Form/LineItemGrp"], fx.LINES_TABLE)
    tables.write_csv(made, path)
    return tables.read_csv(spark, path, made.schema).na.fill("")


# -- attributes, profiles and reports -------------------------------------------------------

@query
def retrieve_attributes(spark, sf):
    some = even(keys(spark, sf)).select("OBJECTID")
    return attributes.retrieve_attributes(stored_attributes(spark, sf), some)


@query
def retrieve_attributes_limit(spark, sf):
    return attributes.retrieve_attributes(stored_attributes(spark, sf), limit=100)


@query
def summarize_attributes(spark, sf):
    """Over attributes where every seventh filing's currency is null."""
    holes = stored_attributes(spark, sf).withColumn("attr_value", F.when(
        ~((F.col("attr_name") == "currency") & (order_number() % 7 == 0)), F.col("attr_value")))
    return attributes.summarize_attributes(holes)


@query
def summarize_attribute_table(spark, sf):
    """From the sets of the store, all years merged."""
    return attributes.summarize_sets(fx.long_store(spark, sf).table("ATTRIBUTE_SETS"))


@query
def summarize_attribute_rows(spark, sf):
    """The same from the attribute rows themselves."""
    return attributes.summarize_attribute_table(stored_attributes(spark, sf))


@query
def profile_tables(spark, sf):
    opened = {name: functools.partial(fx.read, spark, sf, name)
              for name in (*DRIVER_TABLES, "no_such_table")}
    out = profile.profile_tables(spark, opened)
    return out.na.fill(-1).withColumn("failed", F.col("error").isNotNull()).drop("error")


@query
def preview_table(spark, sf):
    opened = {"customer": fx.read(spark, sf, "customer")}
    return profile.preview_table(opened, "customer", 25)


@query
def xpath_report(spark, sf):
    """From the stored path summary, which must say the same as all elements and keys."""
    return reports.summary_report(path_summary(spark, sf))


@query
def xpath_report_of_elements(spark, sf):
    return reports.xpath_report(flat(spark, sf), keys(spark, sf))


@query
def xpath_report_by_year(spark, sf):
    return reports.summary_report(path_summary(spark, sf), by=["TaxYear"])


REPORT_COLUMNS = ["xpath", "count_occurrences", "schema_versions", "first_year", "last_year",
                  "latest_version", "current_version", "variable_name",
                  "concordance_latest_version", "path_type"]


def plain(report):
    """No null numbers or booleans, which pandas would turn into other types."""
    return report.select(*REPORT_COLUMNS).na.fill(-1, ["count_occurrences"]).withColumn(
        "current_version", F.col("current_version").cast("string"))


@query
def process_xpaths(spark, sf):
    return plain(reports.process_summary(
        path_summary(spark, sf), YEARS, fx.concordance(spark), as_of_year=AS_OF_YEAR))


@query
def process_xpaths_of_elements(spark, sf):
    return plain(reports.process_xpaths(
        flat(spark, sf), keys(spark, sf), YEARS, fx.concordance(spark), as_of_year=AS_OF_YEAR))


@query
def write_xpath_reports(spark, sf):
    """The same by way of yearly CSV reports; the last years add to those of the first."""
    store, out = fx.long_store(spark, sf), scratch_path(spark, "reports")
    jobs.write_store_reports(store, YEARS[:3], out, as_of_year=AS_OF_YEAR)
    return plain(jobs.write_store_reports(
        store, YEARS[3:], out, fx.concordance(spark), as_of_year=AS_OF_YEAR))

"""Fixed schemas of the long tables and of the inputs."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


INDEX = T.StructType(_strings("URL", "TaxYear", "FormType"))

ATTRIBUTE = T.StructType(_strings("attr_name", "attr_value"))
ATTRIBUTE_LIST = T.ArrayType(ATTRIBUTE)

FLATXML = T.StructType([
    T.StructField("OBJECTID", T.StringType()),
    T.StructField("ORDER", T.IntegerType()),
    *_strings("XPATH", "XPATH2", "TABLE_HEADER", "TABLE_ID", "TYPE", "RDB_TABLE",
              "VARIABLE_NAME", "VALUE"),
])

# The stored form also keeps what ATTRIBUTES and KEYS are derived from, so that a filing is
# parsed once: the URL on the first element of a filing, each element's attributes, and the
# version of its filing.
FLATXML_STORED = T.StructType([
    *FLATXML.fields,
    T.StructField("URL", T.StringType()),
    T.StructField("ATTRS", ATTRIBUTE_LIST),
    T.StructField("ERROR", T.StringType()),
    T.StructField("VERSION", T.StringType()),
])

ATTRIBUTES = T.StructType(_strings("OBJECTID", "node_name", "xpath", "attr_name", "attr_value"))

KEYS = T.StructType(_strings(
    "OBJECTID", "URL", "VERSION", "EIN", "ORG_NAME", "FORM_TYPE", "TAX_YEAR", "RETURN_TS",
    "IS_AMENDED", "IS_GROUP", "IS_PARTIAL"))

# How many elements a batch has of each path, table and version: what reports are made of.
PATHS = T.StructType([
    *_strings("XPATH2", "TYPE", "RDB_TABLE", "VERSION"), T.StructField("n_rows", T.LongType())])

# The distinct values and filings of each attribute name in a batch: what usage is counted from.
ATTRIBUTE_SETS = T.StructType([
    *_strings("attr_name", "kind", "item"), T.StructField("n_rows", T.LongType())])

FAILED_URLS = T.StructType(_strings("url", "stage", "reason"))

COMMITS = T.StructType([
    T.StructField("BATCH", T.StringType()),
    T.StructField("n_filings", T.LongType()),
    T.StructField("n_failed", T.LongType()),
    T.StructField("n_elements", T.LongType()),
])
# What is stored: a compaction also names the batches it takes the place of.
COMMITS_STORED = T.StructType([
    *COMMITS.fields, T.StructField("REPLACES", T.ArrayType(T.StringType()))])

CONCORDANCE = T.StructType(_strings(
    "xpath", "variable_name", "rdb_relationship", "rdb_table", "label", "description",
    "location_code_xsd", "location_code_family", "location_code", "form", "form_type",
    "form_part", "form_line_number", "variable_scope", "data_type_xsd", "data_type_simple",
    "required", "versions", "latest_version", "duplicated", "current_version",
    "production_rule", "validated"))

TABLE_HEADERS = T.StructType(_strings("rdb_table", "header"))

XPATH_REPORT = T.StructType([
    T.StructField("xpath", T.StringType()),
    T.StructField("count_occurrences", T.LongType()),
    T.StructField("schema_versions", T.StringType()),
])

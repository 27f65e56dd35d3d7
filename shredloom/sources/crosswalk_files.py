"""Crosswalk and header files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shredloom import schemas


def read_concordance(spark: SparkSession, path: str) -> DataFrame:
    """The crosswalk with its 23 columns, from a landed CSV file with a header line."""
    return spark.read.csv(path, header=True, schema=schemas.CONCORDANCE, quote='"', escape='"',
                          multiLine=True)


def read_table_headers(spark: SparkSession, path: str) -> DataFrame:
    """Header paths of the one-to-many tables: `rdb_table, header`."""
    return spark.read.csv(path, header=True, schema=schemas.TABLE_HEADERS)

"""Table profiles and previews."""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shredloom.operators.top_rows import top_rows

PROFILE = "table_name string, n_rows long, n_cols int, error string"

Tables = Mapping[str, DataFrame | Callable[[], DataFrame]]


def profile_tables(spark: SparkSession, tables: Tables, first_rows: int = 0) -> DataFrame:
    """Rows and columns of each table; one that cannot be opened or read has nulls and the reason.

    A table is a DataFrame or a function that opens one. With `first_rows`, so many of its first
    rows come along as JSON, as they lie. All tables are counted in one job, which of Parquet files
    reads footers only; a table is counted by itself only where that job fails.
    """
    opened, found = {}, {}
    for name, table in tables.items():
        try:
            opened[name] = table if isinstance(table, DataFrame) else table()
        except (PySparkException, Py4JJavaError) as problem:
            found[name] = (name, None, None, str(problem), None)
    try:
        counts = _counts(opened)
    except (PySparkException, Py4JJavaError):
        counts = {}
    for name, df in opened.items():
        try:
            n_rows = counts[name] if name in counts else _counts({name: df})[name]
            lines = df.select(F.to_json(F.struct("*"))).limit(first_rows).collect() if (
                first_rows) else []
            found[name] = (name, n_rows, len(df.columns), None, [row[0] for row in lines])
        except (PySparkException, Py4JJavaError) as problem:
            found[name] = (name, None, None, str(problem), None)
    schema = PROFILE + (", first_rows array<string>" if first_rows else "")
    rows = [row if first_rows else row[:4] for row in found.values()]
    return spark.createDataFrame(rows, schema).orderBy("table_name")


def _counted(tables: Mapping[str, DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.union, [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name, df in tables.items()])


def _counts(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    return {row.name: row.n for row in _counted(tables).collect()} if tables else {}


def preview_table(tables: Mapping[str, DataFrame], name: str, n: int = 25) -> DataFrame:
    """The first `n` rows of one table in the order of its columns."""
    if name not in tables:
        raise ValueError(f"table {name!r} not found, there are: {', '.join(sorted(tables))}")
    df = tables[name]
    return top_rows(df, df.columns, n)


def preview_tables(tables: Mapping[str, DataFrame], n: int = 10) -> dict[str, DataFrame]:
    """The first rows of every table."""
    return {name: preview_table(tables, name, n) for name in tables}

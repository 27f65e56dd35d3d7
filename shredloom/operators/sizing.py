"""Broadcast only what was measured to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 200_000
MAX_BYTES = 64 << 20


def fits_broadcast(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """Whether the rows and the text bytes stay within the bound: one aggregate, no shuffle."""
    width = F.lit(0)
    for name in df.columns:
        width = width + F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0))
    rows, size = df.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """The same rows, marked for broadcast when they fit; otherwise Spark shuffles."""
    return F.broadcast(df) if fits_broadcast(df) else df


def few_values(df: DataFrame, column: str) -> list[str]:
    """Distinct values of a column that names columns or tables, sorted: schema, not data."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().collect()
    return sorted(row[0] for row in rows)

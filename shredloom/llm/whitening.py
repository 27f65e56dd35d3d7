"""Embedding whitening: covariance by Spark, its leading eigenvectors, projection by broadcast."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shredloom.llm.eigen import leading_pairs

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000   # of the whole numbers that stand for vector entries
LARGEST = 2.0 ** 40            # entries from here on count as not finite: sums must fit into longs
ROWS = 4_096                   # vectors of a task worked on at once


def finite(vector: Column) -> Column:
    """Whether a vector is there with finite entries only."""
    def good(x: Column) -> Column:
        x = x.cast("double")
        return F.coalesce((x > -LARGEST) & (x < LARGEST), F.lit(False))

    return F.coalesce((F.size(vector) > 0) & F.forall(vector, good), F.lit(False))


def whole_numbers(vector: Column) -> Column:
    """floor(64 c) + 1,000,000 of each entry c as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE) + SHIFT)


def matrices(batches: Iterator[pa.RecordBatch], column: str, kind, width: int):
    """(rows, matrix of their vectors), a few thousand at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            rows = batch.slice(start, ROWS)
            flat = rows.column(column).flatten().to_numpy(zero_copy_only=False)
            yield rows, flat.astype(kind, copy=False).reshape(-1, width)


def sums(vectors: DataFrame, column: str, width: int) -> tuple[int, np.ndarray]:
    """Number of vectors and the exact sums of their whole-number entries."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, np.int64)
        for rows, x in matrices(batches, column, np.int64, width):
            n += len(x)
            total += x.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_pydict({"place": np.arange(-1, width, dtype=np.int32),
                                              "total": np.concatenate([[n], total])})

    rows = vectors.select(column).mapInArrow(add, "place int, total long").groupBy("place").agg(
        F.sum("total").alias("total")).collect()  # a row per dimension
    found = {row.place: row.total for row in rows}
    return found.get(-1, 0), np.array([found.get(k, 0) for k in range(width)], np.int64)


def covariance(vectors: DataFrame, column: str, width: int, centred) -> np.ndarray:
    """Mean of the products of all pairs of columns, of what `centred` makes of the vectors.

    Each task multiplies its own rows; a row of its matrix per column goes on, and those of all
    tasks are added by column. Only the sum, of fixed size, reaches the driver.
    """
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, products = 0, 0.0
        for _, x in matrices(batches, column, None, width):
            y = centred(x)
            n += len(y)
            products = products + y.T @ y
        if n:
            size = len(products)
            i, j = np.triu_indices(size)
            yield pa.RecordBatch.from_pydict({
                "i": np.append(i, -1).astype(np.int32), "j": np.append(j, -1).astype(np.int32),
                "total": np.append(products[i, j], float(n))})

    rows = vectors.select(column).mapInArrow(multiply, "i int, j int, total double").groupBy(
        "i", "j").agg(F.sum("total").alias("total")).toPandas()
    count = rows.loc[rows["i"] < 0, "total"].sum()
    rows = rows[rows["i"] >= 0]
    size = int(rows["i"].max()) + 1 if len(rows) else 0
    out = np.zeros((size, size))
    out[rows["i"], rows["j"]] = rows["total"] / count
    return out + np.triu(out, 1).T


def whiten(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id",
           components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: `vec_id`, `component`, `n`, `deviation`, `whitened`,
    `explained`, `identity_error`.

    Vectors that are null or empty or hold null or non-finite entries are left out, and so are
    those of another length than most of them have (the longer of two equally frequent ones).
    Entries become whole numbers, whose count and sums are exact; the others' mean is taken off
    before anything is multiplied. Components are the eigenvectors of the covariance by falling
    eigenvalue, as many as asked for and as its rank has; vectors that are all equal, or fewer
    than two, have none and give no rows. Rows with one id, or none, are vectors of their own.
    `deviation` is null where it does not fit into a long.
    """
    good = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("_v")).where(
        finite(F.col("_v")))
    width = good.groupBy(F.size("_v").alias("width")).count().orderBy(
        F.desc("count"), F.desc("width")).first()
    schema = (f"vec_id {vectors.schema[vec_id].dataType.simpleString()}, component int, n long, "
              "deviation long, whitened double, explained double, identity_error double")
    if width is None:
        return vectors.sparkSession.createDataFrame([], schema)
    width = width["width"]
    rows = good.where(F.size("_v") == width).select("vec_id", whole_numbers(F.col("_v")).alias("x"))
    n, total = sums(rows, "x", width)

    # total = n * middle + rest, so that whole numbers are small before they become doubles.
    middle = total // max(n, 1)
    rest = total - n * middle

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - middle) - rest / n

    v = covariance(rows, "x", width, centred)
    values, axes = leading_pairs(v, min(components, width))
    trace = np.trace(v)
    rank = int((values > trace * width * np.finfo(np.float64).eps).sum())
    if not rank:
        return vectors.sparkSession.createDataFrame([], schema)
    values, axes = values[:rank], axes[:rank]
    projection = vectors.sparkSession.sparkContext.broadcast(axes.T / np.sqrt(values))

    def whitened(x: np.ndarray) -> np.ndarray:
        return centred(x) @ projection.value

    mean = means(rows, "x", width, whitened)
    spread = covariance(rows, "x", width, lambda x: whitened(x) - mean)
    error = float(np.abs(spread - np.eye(rank)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in matrices(batches, "x", np.int64, width):
            deviation = square_sums(x - middle, n, rest)
            count = len(x)
            yield pa.RecordBatch.from_arrays([
                part.column("vec_id").take(pa.array(np.repeat(np.arange(count), rank))),
                pa.array(np.tile(np.arange(1, rank + 1, dtype=np.int32), count)),
                pa.array(np.full(count * rank, n, np.int64)),
                pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(count), rank))),
                pa.array(whitened(x).ravel()), pa.array(np.tile(values / trace, count)),
                pa.array(np.full(count * rank, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained",
                       "identity_error"])

    return rows.mapInArrow(project, schema)


def means(vectors: DataFrame, column: str, width: int, made) -> np.ndarray:
    """Means of the columns of what `made` makes of the vectors."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0.0
        for _, x in matrices(batches, column, np.int64, width):
            n, total = n + len(x), total + made(x).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_pydict({
                "place": np.arange(-1, len(total), dtype=np.int32),
                "total": np.concatenate([[float(n)], total])})

    found = {row.place: row.total for row in vectors.select(column).mapInArrow(
        add, "place int, total double").groupBy("place").agg(F.sum("total").alias("total")).collect()}
    return np.array([found[k] for k in range(len(found) - 1)]) / found[-1]


def square_sums(x: np.ndarray, n: int, rest: np.ndarray) -> list[int | None]:
    """Exact sums of the squares of n * x - rest by rows, None beyond a long."""
    if (np.abs(x).max(initial=0) + 1.0) * n < 2.0 ** 31 / np.sqrt(x.shape[1]):
        return ((n * x - rest) ** 2).sum(axis=1)
    exact = ((n * x.astype(object) - rest) ** 2).sum(axis=1)
    return [int(value) if value < 2 ** 63 else None for value in exact]

"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors are rotated and cut into blocks. A pair within squared distance t differs by at
most its proportional share of t in at least one block, so it is enough to join each block by
range. A block's space is cut into cells; a vector visits every other cell that its ball
touches. What meets in a cell and passes the block's budget is verified on the whole vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shredloom.llm.common import settled, stored
from shredloom.llm.components import connected_components
from shredloom.operators.sizing import broadcast_if_small

MIN_COSINE = 0.95
BLOCK_DIMS = 8
TILE = 4_096         # vectors of one side of a tile
MAX_BITS = 8         # cells of a block: two for each of so many of its dimensions
SEED = 2
ROWS = 512           # rows of a tile compared at once
SLACK = 1e-9         # of squared distances, above rounding, below any decision on cosines


def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere for one size."""
    draw = np.random.default_rng([seed, dims]).standard_normal((dims, dims))
    q, r = np.linalg.qr(draw)
    return q * np.sign(np.diag(r))


def blocks_of(dims: int, block_dims: int) -> list[slice]:
    count = max(1, round(dims / block_dims))
    edges = [dims * k // count for k in range(count + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def unit_vectors(packed: list[bytes], kind: str) -> np.ndarray:
    raw = np.frombuffer(b"".join(packed), kind).reshape(len(packed), -1).astype(np.float64)
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)  # no overflow in the squares
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def item_kind(vectors: DataFrame, vector: str) -> str:
    """Single precision components move as such; all arithmetic is in double precision."""
    return "f4" if vectors.schema[vector].dataType.elementType == T.FloatType() else "f8"


def pack_vectors(vectors: DataFrame, vector: str, vec_id: str) -> DataFrame:
    """(id, packed): the components of each valid vector as bytes, null for any other."""
    item = item_kind(vectors, vector)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for value in batch.column("v"):
                raw = None
                if value.is_valid and len(value) and not value.values.null_count:
                    x = value.values.to_numpy(zero_copy_only=False).astype(item) + 0
                    if np.isfinite(x).all() and x.any():
                        raw = x.tobytes()
                packed.append(raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(packed, pa.binary())], names=["id", "packed"])

    kind = vectors.schema[vec_id].dataType.simpleString()
    return vectors.select(F.col(vec_id).alias("id"), F.col(vector).alias("v")).mapInArrow(
        pack, f"id {kind}, packed binary")


def deal(classes: DataFrame, kind: str, bits: int, max_distance: float,
         block_dims: int) -> DataFrame:
    """(dims, block, cell, visitor, node, weight, packed): homes and visits of every vector."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for size, group in frame.groupby(frame["packed"].str.len()):
                dims = int(size) // np.dtype(kind).itemsize
                turned = unit_vectors(list(group["packed"]), kind) @ rotation(dims)
                for number, part in enumerate(blocks_of(dims, block_dims)):
                    used = min(bits, part.stop - part.start)
                    x = turned[:, part.start:part.start + used]
                    home = (x > 0) @ (1 << np.arange(used, dtype=np.int64))
                    budget = max_distance * (part.stop - part.start) / dims + SLACK
                    for flips in range(1 << used):
                        chosen = [k for k in range(used) if flips >> k & 1]
                        # The ball around x reaches a cell if crossing the borders costs no more.
                        near = (x[:, chosen] ** 2).sum(axis=1) <= budget
                        cell = home ^ flips
                        # Each pair of cells is looked at once, in the larger cell.
                        take = near & (cell > home) if flips else near
                        if take.any():
                            rows = group[take]
                            yield pa.RecordBatch.from_pandas(pd.DataFrame({
                                "dims": np.int32(dims), "block": np.int32(number),
                                "cell": cell[take], "visitor": bool(flips),
                                "node": rows["node"], "weight": rows["weight"],
                                "packed": rows["packed"]}), preserve_index=False)

    return classes.select("node", "weight", "packed").mapInArrow(
        place, "dims int, block int, cell long, visitor boolean, node long, weight long, "
               "packed binary")


def compare(kind: str, min_cosine: float, block_dims: int):
    """Compares the two sides of a tile: links counted per vector, and a forest of them."""
    max_distance = 2.0 - 2.0 * min_cosine

    def tile(table: pa.Table) -> pa.Table:
        frame = table.to_pandas()
        dims, block = int(frame["dims"].iloc[0]), int(frame["block"].iloc[0])
        parts = blocks_of(dims, block_dims)
        shares = [max_distance * (p.stop - p.start) / dims + SLACK for p in parts]
        left = frame[frame["side"] == 0]
        own = not (frame["side"] == 1).any()
        right = left if own else frame[frame["side"] == 1]
        links = {}
        forest: dict[int, int] = {}

        def root(x: int) -> int:
            while forest.get(x, x) != x:
                forest[x] = forest.get(forest[x], forest[x])
                x = forest[x]
            return x

        edges = []
        if len(left) and len(right):
            x = unit_vectors(list(left["packed"]), kind)
            y = unit_vectors(list(right["packed"]), kind)
            turn = rotation(dims)
            a, b = x @ turn, y @ turn
            at = parts[block]
            ids = left["node"].to_numpy(), right["node"].to_numpy()
            weights = left["weight"].to_numpy(), right["weight"].to_numpy()
            totals = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
            norm = (b[:, at] ** 2).sum(axis=1)
            for start in range(0, len(left), ROWS):
                rows = a[start:start + ROWS]
                near = ((rows[:, at] ** 2).sum(axis=1)[:, None] + norm
                        - 2.0 * (rows[:, at] @ b[:, at].T)) <= shares[block]
                if own:
                    near &= np.arange(start, start + len(rows))[:, None] < np.arange(len(right))
                i, j = np.nonzero(near)
                for first in range(0, len(i), 1 << 16):
                    p, q = i[first:first + (1 << 16)], j[first:first + (1 << 16)]
                    for earlier in range(block):  # counted in the first block that finds it
                        gap = rows[p, parts[earlier]] - b[q, parts[earlier]]
                        new = (gap * gap).sum(axis=1) > shares[earlier]
                        p, q = p[new], q[new]
                    good = np.einsum("ij,ij->i", x[p + start], y[q]) >= min_cosine
                    p, q = p[good] + start, q[good]
                    np.add.at(totals[0], p, weights[1][q])
                    np.add.at(totals[1], q, weights[0][p])
                    for u, v in zip(ids[0][p].tolist(), ids[1][q].tolist()):
                        if (ru := root(u)) != (rv := root(v)):
                            forest[max(ru, rv)] = min(ru, rv)
                            edges.append((u, v))
            for side in (0, 1):
                for node, n in zip(ids[side].tolist(), totals[side].tolist()):
                    if n:
                        links[node] = links.get(node, 0) + n
        return pa.table({
            "node": pa.array([u for u, _ in edges] + list(links), pa.int64()),
            "other": pa.array([v for _, v in edges] + [None] * len(links), pa.int64()),
            "links": pa.array([None] * len(edges) + list(links.values()), pa.int64())})

    return tile


def near_vectors(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id",
                 min_cosine: float = MIN_COSINE, block_dims: int = BLOCK_DIMS,
                 tile: int = TILE) -> DataFrame:
    """One row per vector: `vec_id`, `n_links`, `component_id`, `kept`.

    Vectors link when the cosine of their doubles is at least `min_cosine`. Equal vectors are
    one class with a weight, so copies never make pairs: a class of any size is one vector, and
    its members' links are counted by weight. Vectors of different length never link. Null,
    empty and zero vectors and those with null or non-finite components link with nothing; their
    component is their own id. Rows with one id count as separate vectors. Rows without an id
    take part; they get a null component when no id is in it, and are kept.

    A cell with more than `tile` vectors is cut by hash, and each pair of its cuts is one task's
    group: at most twice `tile` vectors. The counts that decide this are few: blocks times cells.
    """
    packed = stored(pack_vectors(vectors, vector, vec_id), "vectors")
    classes = settled(packed.where(F.col("packed").isNotNull()).groupBy("packed").agg(
        F.count(F.lit(1)).alias("weight"), F.min("id").alias("least")).withColumn(
        "node", F.monotonically_increasing_id()))
    n = classes.count()
    bits = min(MAX_BITS, max(0, math.ceil(math.log2(max(n, 1) / tile))))
    max_distance = 2.0 - 2.0 * min_cosine

    placed = deal(classes, item_kind(vectors, vector), bits, max_distance, block_dims)
    where = ["dims", "block", "cell"]
    cuts = settled(placed.groupBy(*where).agg(
        F.ceil(F.count(F.when(~F.col("visitor"), 1)) / F.lit(tile)).cast("int").alias("homes"),
        F.ceil(F.count(F.when(F.col("visitor"), 1)) / F.lit(tile)).cast("int").alias("visits")))
    dealt = placed.join(broadcast_if_small(cuts), where).withColumn(
        "cut", F.pmod(F.xxhash64("node"), F.when(F.col("visitor"), F.col("visits"))
                      .otherwise(F.col("homes"))).cast("int"))
    # A home meets the homes of its own and later cuts as the right side, of earlier cuts as the
    # left; and all visits. A visit meets all homes.
    none = F.array().cast("array<struct<i:int,j:int,side:int>>")

    def spread(count, entry):
        return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), entry)).otherwise(none)

    def entry(i, j, side):
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"),
                        side.cast("int").alias("side"))

    cut = F.col("cut")
    homes = F.concat(
        spread(F.col("homes"), lambda k: entry(
            F.least(cut, k), F.greatest(cut, k), (cut > k).cast("int"))),
        spread(F.col("visits"), lambda k: entry(cut, -1 - k, F.lit(0))))
    visits = spread(F.col("homes"), lambda k: entry(k, -1 - cut, F.lit(1)))
    tiles = dealt.withColumn("_e", F.explode(F.when(F.col("visitor"), visits).otherwise(homes)))
    found = stored(tiles.select(*where, "_e.i", "_e.j", "_e.side", "node", "weight", "packed")
                   .groupBy(*where, "i", "j").applyInArrow(
                       compare(item_kind(vectors, vector), min_cosine, block_dims), "node long, other long, links long"),
                   "vector-links")
    parts = connected_components(found.where(F.col("other").isNotNull()), "node", "other")
    counts = found.where(F.col("links").isNotNull()).groupBy("node").agg(
        F.sum("links").alias("links"))
    labelled = classes.select("node", "packed", "weight", "least").join(
        counts, "node", "left").join(parts, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    per_class = labelled.join(least, "component").select(
        "packed", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        "component_id")
    valid = packed.where(F.col("packed").isNotNull()).join(per_class, "packed").select(
        "id", "n_links", "component_id")
    lone = packed.where(F.col("packed").isNull()).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return valid.union(lone).select(
        F.col("id").alias("vec_id"), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.col("id").isNull()).alias("kept"))

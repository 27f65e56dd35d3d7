"""Hierarchical packing of documents into windows of several context sizes."""

from __future__ import annotations

import os
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shredloom.llm.common import stored
from shredloom.llm.word_tokens import ID, WordTokenizer
from shredloom.operators.sizing import broadcast_if_small

TIERS = (512, 1_024, 2_048, 4_096)  # context sizes, each twice the one before
END_ID = 2               # ends every document
POOL_TOKENS = 1 << 21    # tokens packed together; what is left over joins the next pool
STEP_TOKENS = 1 << 18    # of the sequences of one training step, all of one context size
TEXT_BYTES = 2 << 20     # texts tokenized at once
ROWS_OUT = 2_048         # pieces in a batch handed back


class Pool:
    """Pieces of documents waiting for a window, by length within their tier.

    A piece is (length, number, start): `number` names the document, `start` its first token.
    """

    def __init__(self, tiers: tuple[int, ...]):
        self.tiers = tiers
        self.waiting: dict[int, list[tuple[int, int, int]]] = {tier: [] for tier in tiers}

    def route(self, piece: tuple[int, int, int]) -> None:
        """Into the smallest tier that holds the piece."""
        insort(self.waiting[self.tiers[bisect_left(self.tiers, piece[0])]], piece)

    def add(self, number: int, length: int) -> Iterator[tuple[int, list]]:
        """A document: windows that it fills alone; the rest waits in its tier."""
        top = self.tiers[-1]
        full = length - length % top
        for start in range(0, full, top):
            yield top, [(top, number, start)]
        if length > full:
            self.route((length - full, number, full))

    def longest_within(self, gap: int, tiers: tuple[int, ...]) -> tuple[int, int, int] | None:
        """Takes the longest waiting piece of those tiers that fits into the gap."""
        for tier in reversed(tiers):
            queue = self.waiting[tier]
            place = bisect_right(queue, (gap, np.inf, 0))
            if place:
                return queue.pop(place - 1)
        return None

    def head_of_shortest(self, gap: int, tiers: tuple[int, ...]) -> tuple[int, int, int] | None:
        """Takes as much as the gap holds from the shortest waiting piece, which is longer."""
        for tier in tiers:
            if self.waiting[tier]:
                length, number, start = self.waiting[tier].pop(0)
                self.route((length - gap, number, start + gap))
                return gap, number, start
        return None

    def pack(self) -> Iterator[tuple[int, list]]:
        """Full windows (tier, pieces), long tiers first, until the pieces run out.

        A tier's longest piece opens a window. The gap takes the longest pieces that fit, which
        are of shorter tiers, then the head of a short one. Pieces of a last window that nothing
        is left to fill go on waiting, less than a window of the longest tier.
        """
        for at in reversed(range(len(self.tiers))):
            tier, upto = self.tiers[at], self.tiers[:at + 1]
            while self.waiting[tier]:
                window = [self.waiting[tier].pop()]
                gap = tier - window[0][0]
                while gap:
                    piece = self.longest_within(gap, upto) or self.head_of_shortest(gap, upto)
                    if piece is None:
                        break
                    window.append(piece)
                    gap -= piece[0]
                if gap:
                    for piece in window:
                        self.route(piece)
                    return
                yield tier, window

    def rest(self) -> Iterator[tuple[int, list]]:
        """What is left at the end, cut into windows at powers of two, so that none is padded."""
        pieces = [piece for tier in self.tiers for piece in self.waiting[tier]]
        left = sum(length for length, _, _ in pieces)
        while left:
            window, size = [], 1 << (left.bit_length() - 1)
            gap = size
            while gap:
                length, number, start = pieces.pop()
                if length > gap:
                    pieces.append((length - gap, number, start + gap))
                    length = gap
                window.append((length, number, start))
                gap -= length
            yield size, window
            left -= size
        self.waiting = {tier: [] for tier in self.tiers}


class Pieces:
    """Rows of packed pieces on their way back to Spark."""

    NAMES = ("doc_id", "start", "length", "ids", "doc_tokens", "task", "window", "place", "offset")

    def __init__(self, task: int, id_type: pa.DataType):
        self.task, self.id_type = task, id_type
        self.documents: dict[int, tuple[object, np.ndarray]] = {}
        self.sequences: dict[int, int] = {}
        self.rows: list[tuple] = []

    def take(self, size: int, window: list[tuple[int, int, int]]) -> None:
        place = self.sequences.get(size, 0)
        self.sequences[size] = place + 1
        offset = 0
        for length, number, start in window:
            doc_id, ids = self.documents[number]
            self.rows.append((doc_id, start, length, ids[start:start + length].tobytes(),
                              len(ids), self.task, size, place, offset))
            offset += length

    def batches(self, least: int = ROWS_OUT) -> Iterator[pa.RecordBatch]:
        while len(self.rows) >= max(least, 1):
            rows, self.rows = self.rows[:ROWS_OUT], self.rows[ROWS_OUT:]
            kinds = [self.id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(),
                     pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)],
                names=list(self.NAMES))


def pack_pieces(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
                tiers: tuple[int, ...] = TIERS, end_id: int = END_ID,
                pool_tokens: int = POOL_TOKENS) -> DataFrame:
    """The pieces of all documents in the windows of their task, before sequences are numbered.

    `vocabulary` is the content of a file of the tokenizers library. Each task packs pools of
    `pool_tokens`; nothing moves between tasks.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Spark has the tasks; threads of the library would only keep memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer, pool = WordTokenizer(vocabulary), Pool(tiers)
        out, number, held = None, 0, 0
        for batch in batches:
            if out is None:
                out = Pieces(TaskContext.get().partitionId(), batch.schema.field("id").type)
            for rows in slices(batch):
                coded = tokenizer.encode_all(rows.column("text").to_pylist())
                for name, ids in zip(rows.column("id").to_pylist(), coded):
                    ids = np.append(ids, np.array([end_id], ID))
                    out.documents[number] = name, ids
                    for window in pool.add(number, len(ids)):
                        out.take(*window)
                        yield from out.batches()
                    number += 1
                    held += len(ids)
                if held >= pool_tokens:
                    for window in pool.pack():
                        out.take(*window)
                    waiting = {piece[1] for queue in pool.waiting.values() for piece in queue}
                    out.documents = {k: out.documents[k] for k in waiting}
                    held = 0
                yield from out.batches()
        if out is not None:
            for window in [*pool.pack(), *pool.rest()]:
                out.take(*window)
            yield from out.batches(1)

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).mapInArrow(
        pack, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, task int, "
              "window int, place long, offset long")


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in slices of about `TEXT_BYTES`."""
    sizes = pc.binary_length(batch.column("text")).fill_null(0).to_numpy(
        zero_copy_only=False)
    part = np.cumsum(sizes) // TEXT_BYTES
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, stop in zip(edges, edges[1:]):
        yield batch.slice(start, stop - start)


def number_sequences(pieces: DataFrame, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """The pieces with `sequence_id` and `step`, in place of task and place; written once.

    Sequences are numbered without gaps by size of window, task and place, from counts per task
    and size. A step is `step_tokens` of sequences of one size, so steps hold equally many
    tokens, but for the last of each size.
    """
    pieces = stored(pieces, "packed")
    counts = pieces.groupBy("task", "window").agg((F.max("place") + 1).alias("n"))
    totals = counts.groupBy("window").agg(F.sum("n").alias("total"))  # a row per size
    per_step = F.greatest(F.lit(step_tokens) / F.col("window"), F.lit(1)).cast("long")
    smaller = Window.orderBy(F.desc("window")).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "window", F.coalesce(F.sum("total").over(smaller), F.lit(0)).alias("base"),
        F.coalesce(F.sum(F.ceil(F.col("total") / per_step)).over(smaller), F.lit(0)).alias("steps"))
    earlier = Window.partitionBy("window").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.join(F.broadcast(bases), "window").select(
        "task", "window", "base", "steps",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("place")
    kept = [c for c in pieces.columns if c not in ("task", "window", "place")]
    return pieces.join(broadcast_if_small(offsets), ["task", "window"]).select(
        *kept, "window", (F.col("base") + rank).alias("sequence_id"),
        (F.col("steps") + F.floor(rank / per_step)).alias("step"))


def pack_documents(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
                   tiers: tuple[int, ...] = TIERS, end_id: int = END_ID) -> DataFrame:
    """One row per piece: `doc_id`, `start`, `length`, `ids`, `doc_tokens`, `offset`, `window`,
    `sequence_id`, `step`.

    Every document is its token ids and `end_id`; each id lies in one piece. Documents longer
    than the longest tier fill windows of their own; the rest of a document goes to the tier of
    the smallest context that holds it, and gaps of long windows are filled from shorter tiers.
    Only the last windows of a task are not as long as their tier, and those are cut at powers of
    two. `ids` are little-endian unsigned 32-bit numbers. A null or empty text is its end alone;
    rows with one id, or none, are documents of their own; other columns are left out.
    """
    return number_sequences(pack_pieces(docs, vocabulary, doc_id, text, tiers, end_id))

"""Byte-level BPE encoding and decoding.

Texts are cut by a pattern; each distinct piece of a task is folded once by ranked merges over
its bytes and its ids are kept for the next occurrence. Decoding concatenates the byte pieces of
the ids. Texts stay where they are: nothing is shuffled.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shredloom.llm.vocabulary import splitter

KEPT_WORDS = 400_000  # distinct words whose ids a task keeps; further ones are merged anew
LONGEST_KEPT = 1_024  # bytes
SHORT = 24            # bytes; longer words are merged with a heap
CHUNK = 256           # rows of one output batch


def merge_short(word: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Merges the leftmost pair of the lowest rank until no adjacent pair has one."""
    parts = [word[i:i + 1] for i in range(len(word))]
    none, rank = len(ranks) + 1, ranks.get
    scores = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
    while scores:
        lowest = min(scores)
        if lowest == none:
            break
        at = scores.index(lowest)
        parts[at] += parts.pop(at + 1)
        scores.pop(at)
        if at < len(scores):
            scores[at] = rank(parts[at] + parts[at + 1], none)
        if at:
            scores[at - 1] = rank(parts[at - 1] + parts[at], none)
    return parts


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The same result in n log n steps, for words of any length."""
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts at i
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(start: int) -> None:
        middle = end[start]
        if middle < n and (rank := ranks.get(word[start:end[middle]])) is not None:
            heapq.heappush(heap, (rank, start, end[middle]))

    for start in range(n - 1):
        offer(start)
    while heap:
        _, start, stop = heapq.heappop(heap)
        middle = end[start]
        if not alive[start] or middle >= n or end[middle] != stop:
            continue  # one of the two parts has been merged since
        end[start], alive[middle] = stop, False
        if stop < n:
            before[stop] = start
        offer(start)
        if before[start] >= 0:
            offer(before[start])
    return [word[i:end[i]] for i in range(n) if alive[i]]


class WordIds(dict):
    """Ids of the distinct words seen, as packed 32-bit numbers, computed when first asked for."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, word: str) -> bytes:
        raw = word.encode()
        merge = merge_short if len(raw) <= SHORT else merge_long
        parts = [raw] if raw in self.ranks else merge(raw, self.ranks)
        ids = array("i", map(self.ranks.__getitem__, parts)).tobytes()
        if len(self) < KEPT_WORDS and len(raw) <= LONGEST_KEPT:
            self[word] = ids
        return ids


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text",
           name: str = "ids") -> DataFrame:
    """The other columns with the ids of each whole text as array<int>, empty for a null text.

    Every single byte must have a rank. Texts of any length are encoded whole; repeated rows
    each get their ids; a column of the input with that name is replaced.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ranks)
    rest = [c for c in docs.columns if c not in (name, text)]
    schema = T.StructType([docs.schema[c] for c in rest]
                          + [T.StructField(name, T.ArrayType(T.IntegerType(), False))])

    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pattern_of = WordIds(shared.value), splitter(pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                rows = batch.slice(start, CHUNK)
                offsets, flat = [0], []
                for value in rows.column(text).to_pylist():
                    words = pattern_of.findall(value) if value else ()
                    ids = np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32)
                    flat.append(ids)
                    offsets.append(offsets[-1] + len(ids))
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(np.concatenate(flat)))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(c) for c in rest] + [lists], names=[*rest, name])

    return docs.select(*rest, text).mapInArrow(encode_batches, schema)


def decode(ids: Column, ranks: dict[bytes, int], spark) -> Column:
    """The bytes that a column of token ids stands for; null ids give empty bytes."""
    pieces: list[bytes] = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    shared = spark.sparkContext.broadcast(pieces)

    @F.arrow_udf("binary")
    def join_pieces(column: pa.Array) -> pa.Array:
        piece, values = shared.value, column.values.to_numpy()
        offsets = column.offsets.to_numpy().tolist()
        return pa.array([b"".join([piece[i] for i in values[start:stop].tolist()])
                         for start, stop in zip(offsets, offsets[1:])], pa.binary())

    return join_pieces(ids)

"""Tokens of each text under a unigram model, counted over a trie of distinct pre-tokens.

The model's pieces are a public vocabulary's. How likely they are is estimated from all texts by
a hard expectation step: each text is cut in the best way under the scores so far, the pieces
used are counted, and a piece's new score is the logarithm of its share.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shredloom.llm.vocabulary import splitter

MAX_NODES = 800_000   # of a task's trie; what does not fit is scored without being stored
UNKNOWN = object()    # score of what no piece ends with
MAX_WORDS = 200_000   # distinct pre-tokens counted before their pieces are passed on


def zipf_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    """Where estimation starts: log probabilities that follow Zipf's law by rank."""
    total = math.log(sum(1.0 / (rank + 1) for rank in ranks.values()))
    return {piece: -math.log(rank + 1) - total for piece, rank in ranks.items()}


class PrefixTrie:
    """Forward scores by node: the best log probability of the prefix that ends there.

    A node keeps (score, pieces, start of the last piece) of its prefix; inserting a pre-token
    computes only the nodes that no earlier one has. At equal scores the segmentation with fewer
    pieces wins, then the one with the longest last piece.
    """

    def __init__(self, scores: dict[bytes, float], max_nodes: int = MAX_NODES):
        # What no piece ends with is not here: then no longer one ends there either.
        self.scores: dict[bytes, float | None] = dict.fromkeys(
            piece[k:] for piece in scores for k in range(1, len(piece)))
        self.scores.update(scores)
        self.max_nodes = max_nodes
        self.children: dict[int, int] = {}
        self.best: list[tuple[float, int, int]] = [(0.0, 0, 0)]

    def forward(self, word: bytes, end: int,
                path: list[tuple[float, int, int]]) -> tuple[float, int, int]:
        """Best (score, pieces, start of the last) of word[:end], given all shorter prefixes'."""
        best, fewest, first, score = -math.inf, 0, 0, self.scores.get
        for start in range(end - 1, -1, -1):
            own = score(word[start:end], UNKNOWN)
            if own is None:
                continue
            if own is UNKNOWN:
                break
            total, pieces, _ = path[start]
            total += own
            if total > best or total == best and pieces <= fewest:
                best, fewest, first = total, pieces, start
        return best, fewest + 1, first

    def insert(self, word: bytes) -> int:
        """Number of pieces of the best segmentation, found at the pre-token's terminal."""
        return self.path(word)[-1][1]

    def segments(self, word: bytes) -> Iterator[bytes]:
        """The pieces of the best segmentation, the last one first."""
        path, end = self.path(word), len(word)
        while end:
            start = path[end][2]
            yield word[start:end]
            end = start

    def path(self, word: bytes) -> list[tuple[float, int, int]]:
        """The nodes of all prefixes of a pre-token, those it adds included."""
        children, best = self.children, self.best
        node, path = 0, [best[0]]
        for end, byte in enumerate(word, 1):
            key = node << 8 | byte
            node = children.get(key, -1) if node >= 0 else -1
            if node < 0:
                here = self.forward(word, end, path)
                if len(best) < self.max_nodes and key >= 0:
                    node = children[key] = len(best)
                    best.append(here)
                path.append(here)
            else:
                path.append(best[node])
        return path


class TokenCounts(dict):
    """Terminal counts of the distinct pre-tokens seen."""

    def __init__(self, scores: dict[bytes, float]):
        super().__init__()
        self.trie = PrefixTrie(scores)

    def __missing__(self, word: str) -> int:
        count = self.trie.insert(word.encode())
        if len(self) < self.trie.max_nodes // 2:
            self[word] = count
        return count


def piece_counts(docs: DataFrame, scores: dict[bytes, float], pattern: str,
                 text: str = "text", max_words: int = MAX_WORDS) -> DataFrame:
    """(piece, n): how often the best segmentations of all whole texts use each piece.

    A task counts its pre-tokens and passes on one row for each `max_words` or fewer distinct
    ones, so no frequent word is a hot spot. Each distinct pre-token of the corpus is then cut
    once, over a trie, and its pieces are added up: one row per piece and task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scores)

    def rows(name: str, counts: Counter, kind: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), kind), pa.array(list(counts.values()), pa.int64())],
            names=[name, "n"])

    def find_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, known = splitter(pattern).findall, Counter()
        for batch in batches:
            for value in batch.column(text):
                known.update(find(value.as_py() or ""))
                if len(known) > max_words:
                    yield rows("word", known, pa.string())
                    known = Counter()
        yield rows("word", known, pa.string())

    def cut_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, used = PrefixTrie(shared.value), Counter()
        for batch in batches:
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                for piece in trie.segments(word.encode()):
                    used[piece] += n
        yield rows("piece", used, pa.binary())

    def added(found: DataFrame, name: str) -> DataFrame:
        return found.groupBy(name).agg(F.sum("n").alias("n"))

    words = added(docs.select(text).mapInArrow(find_words, "word string, n long"), "word")
    return added(words.mapInArrow(cut_words, "piece binary, n long"), "piece")


def estimated_scores(docs: DataFrame, scores: dict[bytes, float], pattern: str,
                     text: str = "text", steps: int = 1) -> dict[bytes, float]:
    """Scores after `steps` expectation steps over all texts, each count one larger.

    Only the counts of the vocabulary's pieces reach the driver, a number that is fixed; a piece
    never used keeps a score, so every text still has a segmentation. Without texts all are equal.
    """
    for _ in range(steps):
        used = {bytes(row.piece): row.n for row in piece_counts(docs, scores, pattern, text).collect()}
        total = math.log(sum(used.values()) + len(scores))
        scores = {piece: math.log(used.get(piece, 0) + 1) - total for piece in scores}
    return scores


def count_tokens(docs: DataFrame, scores: dict[bytes, float], pattern: str,
                 text: str = "text") -> DataFrame:
    """The other columns with `n_pretokens` and `n_tokens` of each whole text; 0 for null or empty.

    Every single byte must have a score, so that each text has a segmentation. A trie lives as
    long as its task and is bounded in nodes; beyond the bound prefixes are scored anew. Nothing
    is shuffled. Repeated rows are counted each; columns of the input with these names are
    replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scores)
    kept = [c for c in docs.columns if c not in ("n_pretokens", "n_tokens", text)]
    schema = T.StructType([docs.schema[c] for c in kept] + [
        T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pattern_of = TokenCounts(shared.value), splitter(pattern)
        for batch in batches:
            n_pretokens, n_tokens = [], []
            for value in batch.column(text):
                words = pattern_of.findall(value.as_py() or "")
                n_pretokens.append(len(words))
                n_tokens.append(sum(map(known.__getitem__, words)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept]
                + [pa.array(n_pretokens, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=[*kept, "n_pretokens", "n_tokens"])

    return docs.select(*kept, text).mapInArrow(count_batches, schema)

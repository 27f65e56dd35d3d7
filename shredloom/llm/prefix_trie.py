"""Prefix trie of conversations from padded matrices of turn ids, sorted and dealt by ranges.

A conversation is cut into segments of `WIDTH` turns. A segment is known by what comes before it
(the sum of hashes of turn and position) and its own turn ids, and segments of equal beginnings
are neighbours once sorted. Each task takes its range of segments in chunks: a chunk is a padded
matrix in which the columns' changes, accumulated from the left, mark where nodes start. Nodes
inside a chunk are finished there. Those at its edges, and those that longer conversations carry
on from, leave partial rows, which are added up by node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shredloom.llm.common import running_sum, settled, stored, words
from shredloom.operators.sizing import broadcast_if_small

WIDTH = 32            # turns of a segment
CHUNK = 50_000        # segments of a chunk
RANGE = 200_000       # segments of a task
BLOCK = 1_024         # segments of one conversation added up in one window
LOW = 0xFFFFFFFF
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = ("chunk long, depth long, a long, b long, pa long, pb long, conv_id long, "
        "parent_conv_id long, n_convs long, far long, words long, n_children long, n_leaves long, "
        "saved long, sha string, ends string, first_end long, edge boolean, stub boolean, "
        "partial boolean, path array<struct<a:long,b:long>>")


# -- conversations ---------------------------------------------------------------------------

def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, words, n) of each turn: place from 0, hash of role and text, words of
    the text, and the turns of its conversation.

    Turns are ordered by `turn`, null first, and by hash where that is equal. Null roles and
    texts are empty. Rows without a conv_id belong to no conversation. A conversation of any
    size is numbered over many tasks.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(17), role, text).alias("b"),
        F.size(words(F.col("text"))).cast("long").alias("words"))
    order = [F.col("turn"), F.col("a"), F.col("b")]
    return stored(running_sum(turns, ["conv_id"], order, F.lit(1).cast("long"), "pos").select(
        "conv_id", "pos", "a", "b", "words", F.col("pos_total").alias("n")), "turns")


def with_shared_heads(turns: DataFrame, every: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of another: (turns, ids of turnless ones).

    Conversation c starts with the first h turns of c - c % every, all if those are fewer, none
    if it is absent; h is the CRC-32 of c in decimals, modulo `heads`. Its own turns after its
    first h follow.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads)).cast("int")
    entry = F.struct("pos", "a", "b", "words")
    head = turns.where((F.col("pos") < heads - 1) & (F.col("conv_id") % every == 0)).groupBy(
        F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(entry)).alias("head"))
    ids = turns.where(F.col("pos") == 0).select(
        "conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    taken = F.slice(F.coalesce("head", F.array().cast(head.schema["head"].dataType)), F.lit(1), F.col("h"))
    made = settled(ids.join(broadcast_if_small(head), "base", "left").select(
        "conv_id", "h", taken.alias("head"),
        (F.size(taken) + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("long").alias("n")))
    first = made.select("conv_id", "n", F.explode("head").alias("t")).select(
        "conv_id", "t.pos", "t.a", "t.b", "t.words", "n")
    lengths = made.select("conv_id", F.size("head").alias("taken"), F.col("n").alias("length"))
    own = turns.where(F.col("pos") >= h).withColumn("h", h).join(
        broadcast_if_small(lengths), "conv_id").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "a", "b", "words",
        F.col("length").alias("n"))
    return first.union(own), made.where(F.col("n") == 0).select("conv_id")


# -- segments --------------------------------------------------------------------------------

def joined(high: Column, low: Column) -> Column:
    """The sum modulo 2**64 of numbers whose upper and lower 32 bits were added up apart."""
    upper = (high + F.shiftrightunsigned(low, 32)).bitwiseAND(LOW)
    return F.shiftleft(upper, 32).bitwiseOR(low.bitwiseAND(LOW))


def earlier_sums(rows: DataFrame, columns: list[str], later: bool = False) -> DataFrame:
    """The sums of columns over the segments before each one of its conversation (or after it).

    Blocks of segments are added up first, so that no window holds a whole long conversation.
    """
    side = (1, Window.unboundedFollowing) if later else (Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", F.floor(F.col("seg") / BLOCK).alias("block")).agg(
        *[F.sum(c).alias(c) for c in columns])
    over = Window.partitionBy("conv_id").orderBy("block").rowsBetween(*side)
    shifts = blocks.select("conv_id", "block", *[
        F.coalesce(F.sum(c).over(over), F.lit(0)).alias(f"{c}_shift") for c in columns])
    inside = Window.partitionBy("conv_id", "block").orderBy("seg").rowsBetween(*side)
    return rows.withColumn("block", F.floor(F.col("seg") / BLOCK)).join(
        shifts, ["conv_id", "block"]).select("conv_id", "seg", *[
            (F.col(f"{c}_shift") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(c)
            for c in columns])


def segments(turns: DataFrame, turnless: DataFrame, width: int) -> DataFrame:
    """(conv_id, seg, n, ids, words, pa, pb): segments, and the id of what comes before them."""
    a, b = (F.xxhash64("pos", c, other) for c, other in (("a", "b"), ("b", "a")))
    halves = {f"{name}{part}": value for name, lane in (("a", a), ("b", b)) for part, value in (
        ("h", F.shiftrightunsigned(lane, 32)), ("l", lane.bitwiseAND(LOW)))}
    entry = F.sort_array(F.collect_list(F.struct("pos", a.alias("a"), b.alias("b"), "words")))
    rows = turns.withColumn("seg", F.floor(F.col("pos") / width)).groupBy("conv_id", "seg").agg(
        F.first("n").alias("n"), entry.alias("t"),
        *[F.sum(value).alias(name) for name, value in halves.items()])
    rows = stored(rows.select("conv_id", "seg", "n", F.transform("t", lambda t: F.struct(
        t["a"].alias("a"), t["b"].alias("b"))).alias("ids"), F.col("t.words").alias("words"),
        *halves), "segments")
    before = earlier_sums(rows.where(F.col("n") > width).select("conv_id", "seg", *halves),
                          list(halves))
    before = before.select("conv_id", "seg", joined(F.col("ah"), F.col("al")).alias("pa"),
                           joined(F.col("bh"), F.col("bl")).alias("pb"))
    zero = F.lit(0).cast("long")
    only = rows.where(F.col("n") <= width).drop(*halves).withColumns({"pa": zero, "pb": zero})
    long = rows.where(F.col("n") > width).drop(*halves).join(before, ["conv_id", "seg"])
    empty = turnless.select(
        "conv_id", zero.alias("seg"), zero.alias("n"), F.array().cast(
            rows.schema["ids"].dataType).alias("ids"),
        F.array().cast("array<bigint>").alias("words"), zero.alias("pa"), zero.alias("pb"))
    return only.unionByName(long).unionByName(empty)


# -- chunks ----------------------------------------------------------------------------------

def ranks(*columns: np.ndarray) -> np.ndarray:
    """Dense numbers of the distinct rows of some columns, the last one first in order."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), bool)
    for column in columns:
        new[1:] |= column[order][1:] != column[order][:-1]
    found = np.empty(len(order), np.int64)
    found[order] = np.cumsum(new)
    return found


def lane(lists: pa.ListArray, field: int) -> np.ndarray:
    return lists.flatten().field(field).to_numpy(zero_copy_only=False).view(np.uint64)


def chunk_nodes(rows: pa.Table, chunk: int, width: int) -> Iterator[pa.RecordBatch]:
    """Rows of the nodes of one chunk, by depth from the deepest."""
    ids, count = rows["ids"].combine_chunks(), len(rows)
    conv, seg, n, pa_, pb = (rows[c].to_numpy() for c in ("conv_id", "seg", "n", "pa", "pb"))
    sizes = pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64)
    columns = int(sizes.max(initial=0))
    at = np.repeat(np.arange(count), sizes), np.arange(sizes.sum()) - np.repeat(
        np.cumsum(sizes) - sizes, sizes)
    a, b = lane(ids, 0), lane(ids, 1)
    turn, sum_a, sum_b, word = (np.zeros((count, columns), t) for t in (
        np.int64, np.uint64, np.uint64, np.int64))
    # Ranks follow Spark's order, in which neighbouring chunks share nodes at their edges only.
    turn[at] = ranks(b.view(np.int64), a.view(np.int64)) + 1  # 0 pads
    sum_a[at], sum_b[at] = a, b
    word[at] = rows["words"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    group = ranks(pb, pa_, seg)
    order = np.lexsort((conv, *turn.T[::-1], group))
    turn, word, group = turn[order], word[order], group[order]
    conv, seg, n = conv[order], seg[order], n[order]
    before = pa_[order].view(np.uint64), pb[order].view(np.uint64)
    sum_a = before[0][:, None] + np.cumsum(sum_a[order], axis=1, dtype=np.uint64)
    sum_b = before[1][:, None] + np.cumsum(sum_b[order], axis=1, dtype=np.uint64)

    # Depth 0 of a segment is what comes before it; then a column each.
    change = np.ones(count, bool)
    change[1:] = group[1:] != group[:-1]
    starts = [np.flatnonzero(change)]
    for j in range(columns):
        change[1:] |= turn[1:, j] != turn[:-1, j]
        starts.append(np.flatnonzero(change))

    leaves, saved = np.zeros(count, np.int64), np.zeros(count, np.int64)
    children = np.zeros(count, np.int64)  # finished nodes one deeper, at their starts
    for j in range(columns, -1, -1):
        s = starts[j]
        stops = np.append(s[1:], count)
        depth = seg[s] * width + j
        edge = (s == 0) | (stops == count)
        far, least = np.maximum.reduceat(n, s), np.minimum.reduceat(conv, s)
        many = stops - s
        node = np.ones(len(s), bool) if j == 0 else turn[s, j - 1] > 0
        weight = np.zeros(len(s), np.int64) if j == 0 else word[s, j - 1]
        stub = (depth > 0) if j == 0 else np.zeros(len(s), bool)
        partial = edge | (far > depth) & (j == width) if j else np.ones(len(s), bool)
        own = node & ~edge & ~stub & (j > 0)
        saved[s[own]] += ((many - 1) * weight)[own]
        leaves[s[own & (far == depth)]] += 1
        below = np.add.reduceat(children, s)
        children[:] = 0
        children[s[node & ~edge]] = 1
        total_saved, total_leaves = np.add.reduceat(saved, s), np.add.reduceat(leaves, s)

        ends: list[str | None] = [None] * len(s)
        first = np.full(len(s), -1, np.int64)
        last = np.flatnonzero(n == seg * width + j)
        owner = np.searchsorted(s, last, "right") - 1
        last, owner = last[node[owner] & ~stub[owner]], owner[node[owner] & ~stub[owner]]
        cuts = np.flatnonzero(np.diff(owner, prepend=-1))
        for k, members in zip(owner[cuts], np.split(conv[last], cuts[1:]) if len(cuts) else []):
            ends[k], first[k] = ",".join(map(str, members.tolist())), members[0]

        keep = np.flatnonzero(node)
        up = None
        if j:
            up = np.searchsorted(starts[j - 1], s, "right") - 1
            parent_start = starts[j - 1][up]
            parent_stop = np.append(starts[j - 1][1:], count)[up]
            known = (j > 1) & (parent_start > 0) & (parent_stop < count)
            parent = np.minimum.reduceat(conv, starts[j - 1])[up]
        lane_a, lane_b = ((before[0][s], before[1][s]) if j == 0
                          else (sum_a[s, j - 1], sum_b[s, j - 1]))
        above = None if j == 0 else ((before[0][s], before[1][s]) if j == 1
                                     else (sum_a[s, j - 2], sum_b[s, j - 2]))
        for low in range(0, len(keep), 10_000):
            k = keep[low:low + 10_000]
            part = partial[k]
            size = len(k)

            def column(values, valid=None):
                return pa.array(values[k].view(np.int64) if values.dtype == np.uint64 else values[k],
                                mask=None if valid is None else ~valid[k])

            none = pa.nulls(size, pa.int64())
            paths = [[{"a": int(x), "b": int(y)} for x, y in zip(
                [before[0][i].view(np.int64), *sum_a[i, :j - 1].view(np.int64)],
                [before[1][i].view(np.int64), *sum_b[i, :j - 1].view(np.int64)])]
                if e and j else None for i, e in zip(s[k], edge[k])]
            texts = [ends[i] for i in k]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(size, chunk, np.int64)), column(depth), column(lane_a),
                column(lane_b), none if j == 0 else column(above[0]),
                none if j == 0 else column(above[1]), column(least),
                none if j == 0 else column(parent, known),
                column(np.where(stub, 0, many)), column(far), column(weight), column(below),
                column(total_leaves), column(total_saved),
                pa.array([None if p else NO_ENDS if text is None else
                          hashlib.sha256(text.encode()).hexdigest()
                          for text, p in zip(texts, part)], pa.string()),
                pa.array([text if p else None for text, p in zip(texts, part)], pa.string()),
                column(first), column(edge & ~stub), column(stub), column(partial),
                pa.array(paths, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))],
                names=[field.split()[0] for field in NODE.replace("struct<a:long,b:long>", "s")
                       .split(", ")])


def shard_nodes(width: int, chunk: int):
    """Cuts a task's sorted segments into chunks and yields the nodes of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                room = chunk - sum(part.num_rows for part in held)
                held.append(batch.slice(start, room))
                start += held[-1].num_rows
                if held[-1].num_rows == room:
                    yield from chunk_nodes(pa.Table.from_batches(held), number, width)
                    held, number = [], number + 1
        if held:
            yield from chunk_nodes(pa.Table.from_batches(held), number, width)

    return run


# -- boundary nodes --------------------------------------------------------------------------

def streamed_hashes(pieces: DataFrame) -> DataFrame:
    """(a, b, sha) of the lists of ends in pieces (a, b, first_end, ends), in order of first_end.

    A list is hashed piece by piece, so it is never held as a whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, done = None, None, []
        for batch in batches:
            for a, b, text in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ends"))):
                if (a, b) != node:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = (a, b), hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if len(done) > 5_000:
                yield as_batch(done)
                done = []
        if node:
            yield as_batch([*done, (*node, state.hexdigest())])

    def as_batch(rows):
        a, b, sha = zip(*rows)
        return pa.RecordBatch.from_pydict({"a": list(a), "b": list(b), "sha": list(sha)})

    return pieces.select("a", "b", "first_end", "ends").repartition("a", "b").sortWithinPartitions(
        "a", "b", "first_end").mapInArrow(run, "a long, b long, sha string")


def path_nodes(rows: DataFrame) -> DataFrame:
    """(a, b, n_leaves, saved): a segment's values for each node on its path."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2_000):
                part = batch.slice(low, 2_000)
                ids = part.column("ids")
                sizes = pc.list_value_length(ids).to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                head = np.cumsum(sizes) - sizes
                found = []
                for field, name in enumerate(("pa", "pb")):
                    x = lane(ids, field)
                    total = np.cumsum(x, dtype=np.uint64)
                    start = np.concatenate([np.zeros(1, np.uint64), total])[head]
                    own = part.column(name).to_numpy().view(np.uint64)
                    found.append((total - start[owner] + own[owner]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[0]), pa.array(found[1]),
                     part.column("n_leaves").take(pa.array(owner)),
                     part.column("saved").take(pa.array(owner))],
                    names=["a", "b", "n_leaves", "saved"])

    return rows.select("ids", "pa", "pb", "n_leaves", "saved").mapInArrow(
        run, "a long, b long, n_leaves long, saved long")


def prefix_trie(turns: DataFrame, turnless: DataFrame, width: int = WIDTH,
                chunk: int = CHUNK) -> DataFrame:
    """One row per node: `conv_id` (its smallest member), `depth`, `parent_conv_id`, `n_convs`,
    `n_children`, `n_leaves`, `saved_tokens`, `ends_sha256`.

    `turns` are (conv_id, pos, a, b, words, n): place from 0 without gaps, 128 bits that identify
    the turn, its words, and the turns of its conversation; `turnless` are the ids of the
    conversations without any. A node is a distinct sequence of first turns, its members the
    conversations that start with it. No conversations give no nodes.
    """
    spark = turns.sparkSession
    segs = stored(segments(turns, turnless, width), "segments")
    keys = ["seg", "pa", "pb", "ids", "conv_id"]
    rows = segs.count()
    parts = max(rows // RANGE, min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                   rows // 2_000), 1)
    nodes = stored(segs.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).mapInArrow(
        shard_nodes(width, chunk), NODE), "trie-nodes")
    partial = nodes.where(F.col("partial"))
    own = ~F.col("stub")

    def of(kind: Column, column: str) -> Column:
        return F.coalesce(F.sum(F.when(kind, F.col(column))), F.lit(0))

    merged = settled(partial.groupBy("a", "b").agg(
        F.max("depth").alias("depth"), F.max(F.struct("pa", "pb")).alias("up"),
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.max("far").alias("far"), F.max("words").alias("words"),
        F.sum("n_children").alias("n_children"), of(own, "n_leaves").alias("n_leaves"),
        of(own, "saved").alias("saved"), of(~own, "n_leaves").alias("stub_leaves"),
        of(~own, "saved").alias("stub_saved"), F.bool_or("edge").alias("edge"),
        F.min(F.when(F.col("stub"), F.col("conv_id"))).alias("carrier"),
        F.max("path").alias("path")))
    # What an edge node is worth can be told only now; it counts for itself and those above it.
    worth = merged.where("edge").select(
        "a", "b", "depth", F.coalesce("path", F.array().cast(merged.schema["path"].dataType)).alias("path"),
        (F.col("far") == F.col("depth")).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    for_self = worth.select("a", "b", F.lit(False).alias("stub"), "n_leaves", "saved")
    above = worth.select(F.posexplode("path").alias("k", "p"), "depth", "n_leaves", "saved").select(
        "p.a", "p.b", ((F.col("k") == 0) & (F.col("depth") > width)).alias("stub"), "n_leaves", "saved")
    extra = for_self.union(above).groupBy("a", "b").agg(
        of(own, "n_leaves").alias("more_leaves"), of(own, "saved").alias("more_saved"),
        of(~own, "n_leaves").alias("more_stub_leaves"), of(~own, "saved").alias("more_stub_saved"))
    children = merged.where("edge").where(F.col("up.pa").isNotNull()).groupBy(
        F.col("up.pa").alias("a"), F.col("up.pb").alias("b")).agg(
        F.count(F.lit(1)).alias("more_children"))
    zero = F.lit(0).cast("long")

    def plus(left: str, right: str) -> Column:
        return (F.col(left) + F.coalesce(right, zero)).alias(left)

    merged = settled(merged.join(extra, ["a", "b"], "left").join(children, ["a", "b"], "left").select(
        "a", "b", "depth", "up", "conv_id", "n_convs", "carrier", plus("n_children", "more_children"),
        plus("n_leaves", "more_leaves"), plus("saved", "more_saved"),
        plus("stub_leaves", "more_stub_leaves"), plus("stub_saved", "more_stub_saved")))

    # Sums below the end of a segment go up along the segments of one conversation through it.
    carried = merged.where(F.col("carrier").isNotNull()).select(
        F.col("carrier").alias("conv_id"), F.floor(F.col("depth") / width).alias("seg"),
        F.col("stub_leaves").alias("n_leaves"), F.col("stub_saved").alias("saved"))
    long = segs.where(F.col("n") > width)
    along = long.join(carried, ["conv_id", "seg"], "left").select(
        "conv_id", "seg", F.coalesce("n_leaves", zero).alias("n_leaves"),
        F.coalesce("saved", zero).alias("saved"))
    later = earlier_sums(along, ["n_leaves", "saved"], later=True).where(
        (F.col("n_leaves") > 0) | (F.col("saved") > 0))
    added = path_nodes(long.join(later, ["conv_id", "seg"]))
    root = later.where(F.col("seg") == 0).select(zero.alias("a"), zero.alias("b"), "n_leaves", "saved")
    added = settled(added.union(root).groupBy("a", "b").agg(
        F.sum("n_leaves").alias("deep_leaves"), F.sum("saved").alias("deep_saved")))

    hashes = streamed_hashes(partial.where(F.col("ends").isNotNull()))
    lookup = partial.select("chunk", "a", "b").distinct().join(
        merged.select("a", "b", "conv_id"), ["a", "b"]).select(
        "chunk", F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("found"))
    inner = nodes.where(~F.col("partial")).join(
        broadcast_if_small(settled(lookup)), ["chunk", "pa", "pb"], "left").select(
        "a", "b", "conv_id", "depth", F.coalesce("parent_conv_id", "found").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved", "sha")
    # A partial node's parent is partial itself, or finished inside the chunk that has them both.
    parents = partial.where(F.col("parent_conv_id").isNotNull()).groupBy("a", "b").agg(
        F.min("parent_conv_id").alias("near"))
    ups = merged.select(F.col("a").alias("ua"), F.col("b").alias("ub"), F.col("conv_id").alias("far"))
    outer = merged.join(parents, ["a", "b"], "left").join(
        ups, (F.col("up.pa") == F.col("ua")) & (F.col("up.pb") == F.col("ub")), "left").join(
        hashes, ["a", "b"], "left").select(
        "a", "b", "conv_id", "depth", F.coalesce("far", "near").alias("parent_conv_id"), "n_convs",
        "n_children", "n_leaves", "saved", F.coalesce("sha", F.lit(NO_ENDS)).alias("sha"))
    return inner.union(outer).join(broadcast_if_small(added), ["a", "b"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", plus("n_leaves", "deep_leaves"),
        plus("saved", "deep_saved").alias("saved_tokens"), F.col("sha").alias("ends_sha256"))

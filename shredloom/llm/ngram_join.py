"""N-gram Jaccard join of documents by PartEnum signatures."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shredloom.llm.common import settled, shuffles_removed, stored
from shredloom.llm.components import connected_components
from shredloom.llm.shingles import (
    PartEnum, links_within, most_common, profile, set_key, shingle_set, similar)
from shredloom.operators.sizing import fits_broadcast

LENGTH = 4
PERCENT = 85
TILE = 1_024          # sets of one side of a tile
GROUP = 256           # sets of small clusters compared in one group
FEW = 32              # classes of a signature whose pairs are looked up
GROUP_BYTES = 16 << 20  # sets compared in one group
CHUNK = 64            # documents whose signatures are made at once
SEEN = 1_000_000      # sets that a task remembers to have signed
ROUNDS = 4            # at most so many times texts are read to sign them
ROUND_FEATURES = 60_000_000  # of all sets, signed in one round while there are more rounds
BROADCAST_ROWS = 500_000


def small(df: DataFrame, otherwise: str | None = None) -> DataFrame:
    """Marked for broadcast if its measured rows and bytes fit, else left to a shuffle."""
    if fits_broadcast(df, BROADCAST_ROWS, 32 << 20):
        return F.broadcast(df)
    return df.hint(otherwise) if otherwise else df


def batches_of(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return (rows.slice(start, CHUNK) for start in range(0, rows.num_rows, CHUNK))


def node_of(key: bytes, seed: int) -> int:
    """64 bits of a set's identity, as a signed number."""
    return xxhash.xxh3_64_intdigest(key, seed) - (1 << 63)


def read_rows(docs: DataFrame, doc_id: str, text: str, length: int, seed: int) -> DataFrame:
    """(doc_id, n, key, node, profile): size, identity and profile of each document's set.

    Documents without words have n = 0 and nulls.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in batches_of(batch):
                sets = [shingle_set(t, length) for t in rows.column("text").to_pylist()]
                keys = [set_key(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array([None if k is None else node_of(k, seed) for k in keys], pa.int64()),
                    pa.array([profile(s).tobytes() if len(s) else None for s in sets],
                             pa.binary())], names=["doc_id", "n", "key", "node", "profile"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        read, f"doc_id {kind}, n long, key binary, node long, profile binary")


def read_sets(docs: DataFrame, doc_id: str, text: str, length: int, seed: int) -> DataFrame:
    """(doc_id, n, node, data): the features of each document's set, 64-bit numbers as bytes."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in batches_of(batch):
                sets = [shingle_set(t, length) for t in rows.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([node_of(set_key(s), seed) if len(s) else None for s in sets],
                             pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["doc_id", "n", "node", "data"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        read, f"doc_id {kind}, n long, node long, data binary")


def read_signatures(docs: DataFrame, text: str, length: int, percent: int, seed: int,
                    part: int = 0, parts: int = 1) -> DataFrame:
    """(sig, node): the signatures of each set, mostly once for the copies that a task reads.

    They are made from the texts as they are shuffled, so no table of them is written and no
    text moves. Only one of `parts` equal parts of all possible signatures is kept.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scheme, seen = PartEnum(percent), set()
        for batch in batches:
            for rows in batches_of(batch):
                new = {}
                for value in rows.column("text").to_pylist():
                    features = shingle_set(value, length)
                    if len(features):
                        node = node_of(set_key(features), seed)
                        if node not in seen:
                            new.setdefault(node, features)
                if len(seen) >= SEEN:  # memory only: repeats are dropped later
                    seen.clear()
                seen.update(new)
                signatures = scheme.signatures(list(new.values()))
                if new:
                    found = np.concatenate(signatures)
                    nodes = np.repeat(np.array(list(new), np.int64),
                                      [len(s) for s in signatures])
                    kept = found % np.uint64(parts) == part
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found[kept].view(np.int64)), pa.array(nodes[kept])],
                        names=["sig", "node"])

    return docs.select(F.col(text).alias("text")).mapInArrow(read, "sig long, node long")


def possible(percent: int):
    """Whether two sets can be similar, by sizes and profiles."""
    @F.arrow_udf("boolean")
    def check(n: pa.Array, profile: pa.Array, other_n: pa.Array, other: pa.Array) -> pa.Array:
        found = []
        for a, x, b, y in zip(n.to_pylist(), profile, other_n.to_pylist(), other):
            common = most_common(*(np.frombuffer(v.as_buffer(), np.uint8) for v in (x, y)))
            found.append(common is None or bool(similar(min(common, a, b), a, b, percent)))
        return pa.array(found, pa.bool_())

    return check


def compare_pairs(percent: int):
    """The similar ones of the pairs of a group, whose sets are in the group too."""
    def compare(table: pa.Table) -> pa.Table:
        is_set = pc.is_valid(table["data"])
        rows = table.filter(is_set)
        sets = {node: np.frombuffer(data, np.uint64) for node, data in zip(
            rows["a"].to_pylist(), rows["data"].to_pylist())}
        pairs = table.filter(pc.invert(is_set)).select(["a", "b"])
        found = []
        for a, b in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist()):
            x, y = sets[a], sets[b]
            common = len(np.intersect1d(x, y, assume_unique=True))
            found.append(bool(similar(common, len(x), len(y), percent)))
        return pairs.filter(pa.array(found, pa.bool_()))

    return compare


def compare_tiles(percent: int):
    """Links across components inside the clusters of a group, one for each pair joined."""
    def tile(table: pa.Table) -> pa.Table:
        frame = table.to_pandas()
        out: list[tuple[int, int]] = []
        for _, cluster in frame.groupby("cluster"):
            sides = [cluster[cluster["side"] == s] for s in (0, 1)]
            sets = [[np.frombuffer(d, np.uint64) for d in side["data"]] for side in sides]
            if not sets[0]:
                continue
            own = table.column("j")[0].as_py() == table.column("i")[0].as_py()
            right = sides[0] if own else sides[1]
            if not len(right):
                continue
            near = links_within(sets[0], None if own else sets[1], percent)
            a, b = sides[0]["component"].to_numpy(), right["component"].to_numpy()
            near &= a[:, None] != b[None, :]
            i, j = np.nonzero(near)
            pairs = np.stack([np.minimum(a[i], b[j]), np.maximum(a[i], b[j])], axis=1)
            out += map(tuple, np.unique(pairs, axis=0).tolist())
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()),
                         "b": pa.array([b for _, b in out], pa.int64())})

    return tile


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      length: int = LENGTH, percent: int = PERCENT) -> DataFrame:
    """(`doc_id`, `n_shingles`, `component_id`) of every document.

    Documents link when 100 * common shingles >= percent * all shingles of both; a component is
    named by its smallest id. Equal sets are one class and meet as one, whatever their number.
    Classes that share a signature are candidates, in two steps that together lose no link:

    1. each class of a signature is compared with the signature's first class;
    2. where a signature's other classes are still in different components, pairs that share
       signatures of few classes are compared; those of many are put into clusters, in which
       every pair is compared, in tiles of bounded size.

    So a group of copies makes candidates in proportion to its size, and all its pairs are
    looked at only where they do not hang together already. Documents without words, or with a
    null text, have size 0 and are their own component. Rows with one id are documents of their
    own; a null id takes part, and names a component only if no other id is in it.
    """
    seed = 0
    while True:
        rows = stored(read_rows(docs, doc_id, text, length, seed), "shingle-sets")
        classes = settled(rows.where(F.col("n") > 0).groupBy("node").agg(
            F.min("doc_id").alias("least"), F.first("n").alias("n"),
            (F.min("key") != F.max("key")).alias("clash")))
        if classes.where("clash").isEmpty():
            break
        seed += 1  # two sets with the same 64 bits: others tell them apart
    classes = classes.select("node", "least", "n")
    parts = class_components(docs, rows, classes, doc_id, text, length, percent, seed)
    labelled = classes.join(small(settled(parts)), "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    named = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    per_class = settled(labelled.join(named, "component").select("node", "component_id"))
    found = rows.select("doc_id", "n", "node").join(small(per_class), "node", "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(
        F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias(
        "component_id"))


def class_components(docs: DataFrame, rows: DataFrame, classes: DataFrame, doc_id: str,
                     text: str, length: int, percent: int, seed: int) -> DataFrame:
    """(node, component) of every class that links to another."""
    members = shared_signatures(docs, classes, text, length, percent, seed)
    met = small(settled(members.select("node").distinct()))
    profiles = stored(rows.select("node", "n", "profile").join(met, "node", "left_semi")
                      .dropDuplicates(["node"]), "profiles")
    sizes = classes.select("node", "n")

    def links_of(pairs: DataFrame) -> DataFrame:
        one, two = (profiles.select(F.col("node").alias(c), F.col("n").alias(f"{c}_n"),
                                    F.col("profile").alias(f"{c}_profile")) for c in ("a", "b"))
        close = settled(pairs.join(small(two), "b").join(small(one), "a").where(
            possible(percent)("a_n", "a_profile", "b_n", "b_profile")).select("a", "b"))
        return verified_links(docs, classes, close, doc_id, text, length, percent, seed)

    members = promising(members, sizes, percent)
    hubs = members.groupBy("sig").agg(F.min("node").alias("first"))
    members = stored(members.join(hubs, "sig"), "members")
    pairs = members.where(F.col("node") != F.col("first")).select(
        F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    parts = settled(connected_components(links_of(comparable(pairs, sizes, percent))))

    placed = members.where(F.col("node") != F.col("first")).join(
        small(parts), "node", "left").select(
        "sig", "node", F.coalesce("component", "node").alias("component"))
    # What a signature's first class left apart, and other classes could still join.
    apart = placed.groupBy("sig").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).where(
        F.col("low") < F.col("high")).select("sig")
    left = promising(stored(placed.join(apart, "sig"), "members"), sizes, percent)
    counts = left.groupBy("sig").agg(F.count(F.lit(1)).alias("rows"), F.min("node").alias("hub"))
    left = settled(left.join(counts, "sig"))
    # Of few classes every pair is looked up, of more the clusters are compared in tiles.
    few = left.where(F.col("rows") <= FEW)
    near = connected_components(links_of(comparable(
        pairs_of_few(few, sizes, percent), sizes, percent)))
    many = settled(left.where(F.col("rows") > FEW).select("hub", "node", "component").distinct())
    clusters = settled(connected_components(many, "hub", "node"))
    sets = sets_of(docs, classes, clusters.select("node"), doc_id, text, length, seed)
    tiles = tile_links(clusters, many, sets.dropDuplicates(["node"]), percent)
    # Later links are between components, so only those need to be joined again.
    both = near.join(small(parts.toDF("node", "of_node")), "node", "left").join(
        small(parts.toDF("component", "of_other")), "component", "left").select(
        F.coalesce("of_node", "node").alias("a"), F.coalesce("of_other", "component").alias("b"))
    joined = settled(connected_components(both.union(tiles)).toDF("component", "wider"))
    both = parts.join(small(joined), "component", "left").select(
        "node", F.coalesce("wider", "component").alias("component"))
    lone = joined.join(parts.select(F.col("node").alias("component")), "component", "left_anti")
    return both.union(lone)


def shared_signatures(docs: DataFrame, classes: DataFrame, text: str, length: int, percent: int,
                      seed: int) -> DataFrame:
    """(sig, node) of the signatures that more than one class has.

    Nearly all signatures are met once. The rows move one time, and stay if their signature has
    another class. A class comes once from each task that read one of its copies. Of many
    signatures a part moves at a time, and its shuffle files go before the next part is made, so
    that the disk never holds all of them.
    """
    features = classes.agg(F.sum("n")).first()[0] or 0
    parts = min(ROUNDS, max(1, -(-features // ROUND_FEATURES)))
    same = Window.partitionBy("sig")
    found = []
    for part in range(parts):
        with shuffles_removed(docs.sparkSession):
            found.append(stored(
                read_signatures(docs, text, length, percent, seed, part, parts).withColumns({
                    "_low": F.min("node").over(same), "_high": F.max("node").over(same)}).where(
                    F.col("_low") < F.col("_high")).select("sig", "node").dropDuplicates(),
                "members"))
    return reduce(DataFrame.union, found)


def comparable(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes allow them to be similar."""
    sizes = small(sizes)
    return settled(pairs.join(sizes.toDF("a", "a_n"), "a").join(sizes.toDF("b", "b_n"), "b").where(
        100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")).select("a", "b"))


def pairs_of_few(members: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(a, b): classes of different components that share signatures of at most `FEW` classes.

    None of them is the first of those signatures, so a pair that is similar shares two of them,
    unless one of its sets is small, or another signature of more classes.
    """
    one, two = (members.select("sig", F.col("node").alias(c), F.col("component").alias(f"{c}_in"),
                               (F.col("rows") <= FEW).alias(f"{c}_few")) for c in ("a", "b"))
    shared = one.join(two, "sig").where(
        (F.col("a") < F.col("b")) & (F.col("a_in") != F.col("b_in"))).groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("shared"))
    little = sizes.where(F.col("n") < PartEnum(percent).two_from)
    tiny = small(settled(members.select("node").distinct().join(little, "node").select("node")))
    return shared.join(tiny.select(F.col("node").alias("a"), F.lit(True).alias("a_tiny")), "a", "left").join(
        tiny.select(F.col("node").alias("b"), F.lit(True).alias("b_tiny")), "b", "left").where(
        (F.col("shared") > 1) | F.col("a_tiny") | F.col("b_tiny")).select("a", "b")


def verified_links(docs: DataFrame, classes: DataFrame, pairs: DataFrame, doc_id: str, text: str,
                   length: int, percent: int, seed: int) -> DataFrame:
    """The pairs that are similar. A set moves to the group of its cluster of pairs.

    Small clusters share groups of about `GROUP_BYTES`; a larger one is cut by hash, and a set
    goes where it has pairs, one for each two cuts at most. Only the given pairs are compared.
    """
    nodes = settled(connected_components(pairs)).toDF("node", "cluster").join(
        classes.select("node", "n"), "node")
    weights = settled(nodes.groupBy("cluster").agg(F.sum(8 * F.col("n")).alias("bytes")))
    groups = F.greatest(F.ceil(F.lit(
        weights.agg(F.sum("bytes")).first()[0] or 0) / F.lit(GROUP_BYTES)), F.lit(1))
    cuts = F.ceil(F.col("bytes") / F.lit(GROUP_BYTES)).cast("int")
    spots = settled(nodes.join(small(weights), "cluster").select(
        "node", cuts.alias("cuts"), F.pmod(F.xxhash64("node"), cuts).cast("int").alias("cut"),
        F.when(cuts == 1, -1 - F.pmod(F.xxhash64("cluster"), groups)).otherwise(
            F.col("cluster")).alias("home")))
    sides = [small(spots.select(F.col("node").alias(c), F.col("cut").alias(f"{c}_cut"), *more))
             for c, more in (("a", ["home"]), ("b", []))]
    group = ["home", "i", "j"]
    asked = settled(pairs.join(sides[0], "a").join(sides[1], "b").select(
        "home", F.least("a_cut", "b_cut").alias("i"), F.greatest("a_cut", "b_cut").alias("j"),
        "a", "b"))
    places = settled(asked.select(*group, F.explode(F.array("a", "b")).alias("node")).distinct())
    sets = sets_of(docs, classes, spots.select("node"), doc_id, text, length, seed).join(
        small(places), "node").select(
        *group, F.col("node").alias("a"), F.lit(None).cast("long").alias("b"), "data")
    return settled(asked.withColumn("data", F.lit(None).cast("binary")).union(sets).groupBy(
        *group).applyInArrow(compare_pairs(percent), "a long, b long"))


def promising(members: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The rows (sig, node, …) without the classes that can be in no further similar pair.

    Large enough sets share two signatures with any similar one: a class with one alone goes.
    """
    counts = members.groupBy("node").agg(F.count(F.lit(1)).alias("_signatures"))
    good = settled(counts.join(sizes, "node").where(
        (F.col("_signatures") > 1) | (F.col("n") < PartEnum(percent).two_from)).select("node"))
    return members.join(small(good), "node", "left_semi")


def sets_of(docs: DataFrame, classes: DataFrame, nodes: DataFrame, doc_id: str, text: str,
            length: int, seed: int) -> DataFrame:
    """(node, n, data): the features of classes, read from the texts; repeated rows give repeats.

    Ids too many to broadcast are hashed, so that texts are dealt but not sorted.
    """
    needed = settled(classes.join(nodes, "node", "left_semi").select("node", "least"))
    ids = small(needed.select("least").distinct(), "shuffle_hash")
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        ids, F.col("doc_id").eqNullSafe(F.col("least")), "left_semi")
    read = read_sets(texts, "doc_id", "text", length, seed)
    return read.join(small(needed), "node").where(
        F.col("doc_id").eqNullSafe(F.col("least"))).select("node", "n", "data")


def tile_links(clusters: DataFrame, members: DataFrame, sets: DataFrame,
               percent: int) -> DataFrame:
    """(a, b): components of one cluster that a similar pair joins."""
    inside = clusters.withColumnRenamed("component", "cluster").join(
        members.select("node", "component").distinct(), "node")
    sizes = inside.groupBy("cluster").agg(F.count(F.lit(1)).alias("_n"))
    groups = F.greatest(F.ceil(F.lit(inside.count()) / F.lit(GROUP)), F.lit(1))
    cut_in = F.ceil(F.col("_n") / F.lit(TILE)).cast("int")
    dealt = inside.join(small(settled(sizes)), "cluster").withColumns({
        "cuts": cut_in, "cut": F.pmod(F.xxhash64("node"), cut_in).cast("int"),
        # Small clusters share groups; a large one has its own.
        "home": F.when(cut_in == 1, -1 - F.pmod(F.xxhash64("cluster"), groups)).otherwise(
            F.col("cluster"))})
    entries = F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda k: F.struct(
        F.least(F.col("cut"), k).alias("i"), F.greatest(F.col("cut"), k).alias("j"),
        (F.col("cut") > k).cast("int").alias("side")))
    tiles = dealt.withColumn("_e", F.explode(entries)).select(
        "home", "_e.i", "_e.j", "_e.side", "cluster", "node", "component").join(
        sets.select("node", "data"), "node")
    return settled(tiles.groupBy("home", "i", "j").applyInArrow(
        compare_tiles(percent), "a long, b long").distinct())

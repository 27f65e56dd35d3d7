"""Shards that keep linked documents together, by balanced label propagation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shredloom.llm.common import running_sum, settled, stored
from shredloom.operators.sizing import broadcast_if_small

N_SHARDS = 8
ROUNDS = 4
SEED = 5
SHARES = 1_000_000  # steps of the draw that decides which wishes are granted


def quotas(total: int, n_shards: int) -> list[int]:
    """Rows of each shard under the law `rows`: at most one apart."""
    return [total // n_shards + (shard < total % n_shards) for shard in range(n_shards)]


def granted(wishes: dict[tuple[int, int], int], free: list[int]) -> dict[tuple[int, int], float]:
    """The share of the wishes of each (from, to) that no shard's free room forbids.

    Room that movers leave behind counts as free, so equal flows in both directions pass.
    """
    flow = {pair: float(n) for pair, n in wishes.items()}
    for _ in range(50):
        changed = False
        for shard in range(len(free)):
            into = sum(n for (_, to), n in flow.items() if to == shard)
            room = max(0.0, free[shard]) + sum(
                n for (away, _), n in flow.items() if away == shard)
            if into > room + 1e-9:
                changed = True
                for pair in flow:
                    if pair[1] == shard:
                        flow[pair] *= room / into
        if not changed:
            break
    return {pair: flow[pair] / n for pair, n in wishes.items() if n}


def propagate(rows: DataFrame, n_shards: int = N_SHARDS, rounds: int = ROUNDS,
              seed: int = SEED) -> DataFrame:
    """Adds `shard` and `slot` to rows of (`row` unique long, `hubs` array<long>, …).

    Rows that share a hub are linked. Every row starts in a shard by hash. In each round a hub
    counts its rows by shard, each row adds up the counts of its hubs and wishes to move where
    most of its neighbours are; ties are broken by hub, alike for all its rows. Wishes are
    granted while the linked rows of a shard stay within its quota: all rows of a hub together,
    unless the hub is too large for that. At the end shards above their quota give rows, those
    with the fewest neighbours there first, to shards below it.

    The law is `rows`: counts differ by one at most. Only counts by pairs of shards reach the
    driver. A hub that holds a third of all rows is counted in parts and fills several shards.
    Hubs of one row and null hubs link nothing.
    """
    total = rows.count()
    quota = quotas(total, n_shards)
    start = F.pmod(F.xxhash64(F.lit(seed), F.col("row")), F.lit(n_shards)).cast("int")
    links = rows.select("row", F.explode("hubs").alias("hub")).where(F.col("hub").isNotNull())
    shared = links.groupBy("hub").agg(F.count(F.lit(1)).alias("members")).where(
        F.col("members") > 1)
    links = settled(links.join(broadcast_if_small(settled(shared)), "hub"))
    moved = settled(links.select("row").distinct().withColumn("shard", start))

    def load_of(placed: DataFrame) -> list[int]:
        counts = dict(map(tuple, placed.groupBy("shard").count().collect()))
        return [counts.get(shard, 0) for shard in range(n_shards)]

    def votes_of(now: DataFrame) -> DataFrame:
        """For every linked row, the members of its hubs by shard, and its largest hub."""
        placed = links.join(now, "row")
        by_hub = placed.groupBy("hub").agg(*[
            F.count(F.when(F.col("shard") == s, 1)).alias(f"n{s}") for s in range(n_shards)])
        return placed.join(broadcast_if_small(by_hub), "hub").groupBy("row", "shard").agg(
            F.array(*[F.sum(f"n{s}") for s in range(n_shards)]).alias("votes"),
            F.max(F.struct("members", "hub")).alias("largest"))

    for _ in range(rounds):
        ranked = F.transform("votes", lambda n, s: n * n_shards + F.pmod(
            F.pmod(F.xxhash64("largest.hub"), F.lit(n_shards)) + s, F.lit(n_shards)))
        best = F.array_position(ranked, F.array_max(ranked)).cast("int") - 1
        wished = settled(votes_of(moved).withColumn("to", best))
        wishes = {(a, b): n for a, b, n in wished.where(F.col("to") != F.col("shard"))
                  .groupBy("shard", "to").count().collect()}
        if not wishes:
            break
        share = granted(wishes, [q - n for q, n in zip(quota, load_of(moved))])
        limits = F.create_map(*[x for (a, b), part in share.items() for x in (
            F.lit(a * n_shards + b), F.lit(int(part * SHARES)))])
        together = F.col("largest.members") <= max(1, min(quota) // 4)
        draw = F.pmod(F.xxhash64(F.lit(seed), F.when(
            together, F.col("largest.hub")).otherwise(F.col("row"))), F.lit(SHARES))
        goes = (F.col("to") != F.col("shard")) & (
            draw < F.coalesce(F.element_at(limits, F.col("shard") * n_shards + F.col("to")),
                              F.lit(0)))
        moved = settled(wished.select("row", F.when(goes, F.col("to")).otherwise(
            F.col("shard")).alias("shard")))

    neighbours = votes_of(moved).select("row", F.col("shard").alias("_shard"), F.element_at(
        "votes", F.col("shard") + 1).alias("_ties"), F.col("largest.hub").alias("_hub"))
    placed = settled(rows.join(neighbours, "row", "left").select(
        *rows.columns, F.coalesce("_shard", start).alias("shard"),
        F.coalesce("_ties", F.lit(0)).alias("_ties"), "_hub"))
    return fill(placed, load_of(placed), quota)


def fill(placed: DataFrame, load: list[int], quota: list[int]) -> DataFrame:
    """Moves what is above a shard's quota to the shards below theirs, and numbers the slots."""
    excess = [max(0, n - q) for n, q in zip(load, quota)]
    room = [max(0, q - n) for n, q in zip(load, quota)]
    over = [s for s, n in enumerate(excess) if n]
    rest = [c for c in placed.columns if c not in ("_ties", "_hub")]
    kept = placed.select(*rest)
    if over:
        numbered = settled(running_sum(
            placed.where(F.col("shard").isin(over)), ["shard"],
            [F.col("_ties"), F.col("_hub"), F.col("row")], F.lit(1), "_place"))
        given = [sum(excess[:s]) for s in range(len(excess))]
        values = lambda list_: F.array(*[F.lit(x) for x in list_])
        serial = F.get(values(given), F.col("shard")) + F.col("_place")
        goes = F.col("_place") < F.get(values(excess), F.col("shard"))
        target = F.lit(None).cast("int")
        for shard in reversed(range(len(room))):
            target = F.when(serial < sum(room[:shard + 1]), F.lit(shard)).otherwise(target)
        spilled = numbered.withColumn(
            "shard", F.when(goes, target).otherwise(F.col("shard")).cast("int")).select(*rest)
        kept = placed.where(~F.col("shard").isin(over)).select(*rest).unionByName(spilled)
    return running_sum(kept, ["shard"], [F.col("row")], F.lit(1), "slot").drop("slot_total")


def shard_documents(docs: DataFrame, hubs: Column, size: Column, n_shards: int = N_SHARDS,
                    doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS,
                    seed: int = SEED) -> DataFrame:
    """`doc_id`, `size`, `text_crc32`, `law`, `shard`, `slot`, `grown_shard` of every document.

    `hubs` gives the link keys of a document as array<long>. Null texts have the checksum of no bytes, 0.
    Repeated rows are documents of their own, and linked if their keys say so. Other columns of
    the input are left out. An empty table gives no rows.
    """
    rows = stored(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"),
        size.cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")).cast("long").alias("text_crc32"),
        hubs.alias("hubs")), "shard-rows")
    return propagate(rows, n_shards, rounds, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))

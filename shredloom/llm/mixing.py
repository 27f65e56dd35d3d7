"""Mixes sources to target weights by capped water-filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shredloom.llm.common import numbered, running_sum, settled
from shredloom.operators.sizing import broadcast_if_small

MAX_EPOCHS = 3
CYCLE = (1, 2, 3)
SEED = 8
TOLERANCE = 0.01  # of a target: a larger miss is worth another draw


def cycling_weights(totals: DataFrame, cycle: Sequence[int] = CYCLE) -> DataFrame:
    """Adds `weight`: the cycle repeated over the sources in code point order, null last."""
    placed = running_sum(totals, [], [F.col("source").isNull(), F.col("source")], F.lit(1), "_at")
    values = F.array(*[F.lit(float(w)) for w in cycle])
    return placed.withColumn("weight", F.get(values, (F.col("_at") % len(cycle)).cast("int"))
                             ).drop("_at", "_at_total")


def water_fill(totals: DataFrame, budget: float, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Adds `target` to sources (`source_size`, `weight`): shares of the budget by weight.

    A share above `max_epochs` times the source is clamped there and its excess goes to the
    others by weight, again and again until no share is above. Every round is one aggregate
    over the sources; only two sums reach the driver. Sources of size 0 get target 0.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level = F.lit(0.0)
    clamped = -1
    while True:
        # Sources that this level fills are clamped; the rest shares what remains.
        full = cap <= level * F.col("weight")
        spent, free, n = totals.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(full, 1))).first()
        if n == clamped or free == 0:
            break
        clamped, level = n, F.lit(max(budget - spent, 0.0) / free)
    return totals.withColumn("target", F.least(cap, level * F.col("weight")))


def mix(docs: DataFrame, size: Column, source: str = "source", doc_id: str = "doc_id",
        cycle: Sequence[int] = CYCLE, max_epochs: int = MAX_EPOCHS, seed: int = SEED
        ) -> DataFrame:
    """Adds `size`, `source_size`, `target`, `repeats` and `taken` (size times repeats).

    With target / size = q, each document of a source is taken floor(q) whole times; the
    fraction left goes to documents in seeded order, each one that still fits, until none does,
    then to the single document that comes nearest to the target. Where that misses by more
    than TOLERANCE, because large documents found no room, the draw is made again around the
    smallest of those, as long as this comes nearer. Documents are never cut, none is taken more
    than `max_epochs` times, and a rerun takes the same ones.

    Null sources form a source, after all others. Null and empty texts have size 0. A source
    without any words has target 0 and is not taken. Rows repeated with one id in one source
    are drawn together. Columns of the input named as those added here are replaced. An empty
    table gives an empty result.
    """
    added = [c for c in ("size", "source_size", "target", "repeats", "taken")
             if c not in (source, doc_id)]
    sized = docs.select(*[F.col(f"`{c}`") for c in docs.columns], size.cast("long"))
    sized = sized.toDF(*[f"in{place}" for place in range(len(docs.columns))], "_size")
    columns = [c for c in docs.columns if c not in added]
    names = numbered(docs)
    source, doc_id, kept = names[source], names[doc_id], [names[c] for c in columns]
    sized = sized.select(*kept, "_size")
    # Decisions are made on a few numbers per document; texts never move.
    units = settled(sized.groupBy(F.col(source).alias("source"), F.col(doc_id).alias("_id")).agg(
        F.sum("_size").alias("_size"), F.count(F.lit(1)).alias("_rows")).withColumn(
        "_place", place_of(F.col("_id"), seed)))
    totals = settled(cycling_weights(
        units.groupBy("source").agg(F.sum("_size").alias("source_size"))))
    budget = totals.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    filled = water_fill(totals, float(budget), max_epochs)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio)
    targets = settled(filled.withColumns({
        "_whole": whole,
        "_need": F.col("target") - whole * F.col("source_size")}))
    plan = draw(units.select("source", "_place", "_size"), targets).withColumnRenamed(
        "source", "_of")
    together = units.where(F.col("_rows") > 1).select(
        F.col("source").alias("_us"), F.col("_id").alias("_ui"), F.col("_size").alias("_unit"))
    if together.limit(1).count():
        sized = sized.join(broadcast_if_small(together), F.col(source).eqNullSafe(F.col("_us"))
                           & F.col(doc_id).eqNullSafe(F.col("_ui")), "left")
    else:
        sized = sized.withColumn("_unit", F.lit(None).cast("long"))
    extra = drawn(place_of(F.col(doc_id), seed), F.coalesce("_unit", "_size"), "_extra")
    repeats = (F.col("_whole") + extra.cast("long")).cast("long")
    return sized.join(broadcast_if_small(plan), F.col(source).eqNullSafe(F.col("_of"))).select(
        *kept, F.col("_size").alias("size"),
        "source_size", "target", repeats.alias("repeats"),
        (F.col("_size") * repeats).alias("taken")
    ).toDF(*columns, "size", "source_size", "target", "repeats", "taken")


def place_of(doc_id: Column, seed: int) -> Column:
    """Place in the seeded order."""
    return F.struct(F.xxhash64(F.lit(seed), doc_id).alias("u"), doc_id.alias("id"))


def drawn(place: Column, size: Column, single: str) -> Column:
    """Whether a rule or the list of single documents of the plan takes a document."""
    by_rule = F.exists("_rules", lambda r: size.between(r["least"], r["most"])
                       & (r["stop"].isNull() | (place < r["stop"])))
    return F.coalesce(by_rule, F.lit(False)) | F.coalesce(
        F.array_contains(single, place), F.lit(False))


def draw(units: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: `_rules` and `_extra`, which say what is taken once more (`drawn`)."""
    kind = units.schema["_place"].dataType.simpleString()
    plan = fill(units, targets.drop("weight").withColumns({
        "_forced": F.array().cast(f"array<{kind}>"), "_room": F.col("_need"),
        "_again": F.lit(True)}), kind)
    while True:
        missing = plan.where(F.col("_again") & (
            F.abs("_left") > TOLERANCE * F.col("target")))
        forced = smallest_left(units, missing, "_forced",
                               F.col("_size") < F.col("_room") + F.abs("_left"))
        tried = settled(missing.join(forced, F.col("source").eqNullSafe(F.col("_p"))).select(
            "source", "source_size", "target", "_whole", "_need", "_again",
            F.concat("_forced", F.array("_best._place")).alias("_forced"),
            (F.col("_room") - F.col("_best._size")).alias("_room"),
            F.abs("_left").alias("_miss")))
        if not tried.limit(1).count():
            break
        tried = fill(units, tried, kind)
        better = tried.where(F.abs("_left") < F.col("_miss")).drop("_miss")
        names = tried.select(F.col("source").alias("_p"))
        rest = plan.join(better.select(F.col("source").alias("_b")),
                         F.col("source").eqNullSafe(F.col("_b")), "left_anti")
        seen = rest.join(names.withColumn("_seen", F.lit(True)),
                         F.col("source").eqNullSafe(F.col("_p")), "left").withColumn(
            "_again", F.col("_again") & F.col("_seen").isNull()).drop("_p", "_seen")
        plan = settled(seen.unionByName(better))
    return plan.select("source", "source_size", "target", "_whole", "_rules", "_extra")


def fill(units: DataFrame, plan: DataFrame, kind: str) -> DataFrame:
    """Adds `_rules`, `_extra` and `_left`, what is missing, to sources that lack `_room`.

    A round takes documents no larger than what is missing, in seeded order, up to the first
    that does not fit (`stop`). It and all larger ones are passed over, and the next round goes
    on behind it with those that still fit: together one walk through the order. What is missing
    falls below the size of the document passed over, so the rounds are few.
    """
    rule = f"array<struct<least:int,most:double,stop:{kind}>>"
    plan = plan.withColumns({
        "_rules": F.array().cast(rule), "_left": F.col("_room").cast("double"),
        "_stop": F.lit(None).cast(kind), "_open": F.col("_room") > 0})
    least = 0  # the first round deals with empty documents
    while True:
        left = plan.where("_open").select(F.col("source").alias("_of"), "_left", "_stop")
        fit = units.join(broadcast_if_small(left), F.col("source").eqNullSafe(F.col("_of"))).where(
            F.col("_size").between(F.lit(least), F.col("_left"))
            & (F.col("_stop").isNull() | (F.col("_place") > F.col("_stop"))))
        fit = without_forced(fit, plan)
        summed = running_sum(fit, ["source"], [F.col("_place")], F.col("_size"), "_before")
        fits = F.col("_before") + F.col("_size") <= F.col("_left")
        found = settled(summed.groupBy(F.col("source").alias("_p")).agg(
            F.sum(F.when(fits, F.col("_size")).otherwise(0)).alias("_got"),
            F.min(F.when(~fits, F.col("_place"))).alias("_next")))
        if not found.limit(1).count():
            break
        taken = F.array(F.struct(F.lit(least).alias("least"), F.col("_left").alias("most"),
                                 F.col("_next").alias("stop")))
        plan = settled(plan.join(
            found, F.col("source").eqNullSafe(F.col("_p")), "left").withColumns({
                "_rules": F.when(F.col("_got").isNull(), F.col("_rules")).otherwise(
                    F.concat("_rules", taken.cast(rule))),
                "_left": F.col("_left") - F.coalesce("_got", F.lit(0)),
                "_stop": F.col("_next"), "_open": F.col("_next").isNotNull(),
            }).drop("_p", "_got", "_next"))
        least = 1
    nearest = smallest_left(units, plan, "_forced", F.col("_size") < 2 * F.col("_left"))
    return settled(plan.join(nearest, F.col("source").eqNullSafe(F.col("_p")), "left").withColumns({
        "_extra": F.when(F.col("_best").isNull(), F.col("_forced")).otherwise(
            F.concat("_forced", F.array("_best._place"))),
        "_left": F.col("_left") - F.coalesce(F.col("_best._size"), F.lit(0)),
    }).drop("_p", "_best", "_stop", "_open"))


def without_forced(fit: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows that are not taken in any case."""
    forced = plan.select(F.col("source").alias("_f"), F.explode("_forced").alias("_fp"))
    return fit.join(broadcast_if_small(forced), F.col("source").eqNullSafe(F.col("_f"))
                    & (F.col("_place") == F.col("_fp")), "left_anti")


def smallest_left(units: DataFrame, plan: DataFrame, single: str, good: Column) -> DataFrame:
    """(_p, _best): the smallest document of each source that is not taken yet, among the good."""
    asked = plan.select(F.col("source").alias("_of"), "_rules", single, "_room", "_left")
    return settled(units.join(
        broadcast_if_small(asked), F.col("source").eqNullSafe(F.col("_of"))).where(
        (F.col("_size") > 0) & good & ~drawn(F.col("_place"), F.col("_size"), single)
    ).groupBy(F.col("source").alias("_p")).agg(
        F.min(F.struct("_size", "_place")).alias("_best")))

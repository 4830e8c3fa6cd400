"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow. Its documents are put in a random order that depends on their ids and
texts only, not on how the input was split or ordered, up to three rounds of them after another, and each copy gets a virtual finish time: the tokens of its source up to
and with it, divided by the source's target. All flows are merged in order of finish time and
the merged list is cut at the total budget, which all sources reach at time 1, so that at any
point of it the sources stand in the proportion of their targets. A copy that would end after
time 1 is left out, so a source falls short of its target by less than one document.

Defined results: a null text has size 0; a null source is a source of its own, the last one;
documents of size 0 take no part in the queue and get ``taken`` 0; repeated rows with one id are
queued one by one and share nothing; of a very long text only its size goes on, and it is taken
or left whole; empty input gives an empty result; other columns are neither read nor returned.

Shape: texts are read once, to a staged table of sizes. The prefix sums of a flow come in two
steps, over slices of its random order and then inside each slice, so that no task holds a
source. The merged list is cut into slices of finish time, which are even by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluicegate.llm.staging import staged

SPACE_RUN = "[\\x20\\x09-\\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
ROUNDS = 3
#: Slices of a flow's random order; a slice holds 1/4096 of a source.
SLICES = 4096
#: Slices of the merged list in one unit of finish time.
TIME_SLICES = 4096


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, source and the number of words of each text."""
    words = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), SPACE_RUN), ""))
    return docs.select(
        "doc_id",
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        F.col("source").cast("string").alias("source"),
        words.cast("long").alias("size"),
    )


def targets(sized: DataFrame, weights=WEIGHTS, share: float = 1.0, most: int = ROUNDS) -> DataFrame:
    """Per source: its size and its target in words.

    Sources weigh ``weights`` in turn, in order of their names, null last. The budget, a
    ``share`` of all sizes, is divided by weight; no target exceeds ``most`` times its source's
    size, and what is left is divided again. One row per source; the level at which all
    targets meet their limits is found from sums over the sources in order of limit / weight.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    weighed = per_source.select(
        "source",
        "source_size",
        F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights) + 1).cast("int")).alias("w"),
        (F.col("source_size") * F.lit(float(most))).alias("limit"),
    )
    by_ratio = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summed = weighed.select(
        "*",
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("budget"),
        (F.sum("limit").over(upto) - F.col("limit")).alias("limits_before"),
        (F.sum("w").over(everything) - F.sum("w").over(upto) + F.col("w")).alias("w_from"),
    )
    # Where this source is the first that stays below its limit, the level is this one.
    level = (F.col("budget") - F.col("limits_before")) / F.col("w_from")
    tried = summed.withColumn("level", F.when(level * F.col("w") <= F.col("limit"), level))
    return tried.select(
        "source",
        "source_size",
        F.least("limit", F.coalesce(F.first("level", True).over(everything) * F.col("w"), F.col("limit"))).alias("target"),
    )


def queue(sized: DataFrame, goals: DataFrame, seed: int = 0, rounds: int = ROUNDS) -> DataFrame:
    """Every copy of every document with its finish time: doc_id, text_hash, row, source, size, round, place, finish."""
    place = F.xxhash64(F.lit(seed), "doc_id", "text_hash")
    flow = (
        sized.where("size > 0")
        .withColumn("place", place)
        .withColumn("slice", F.shiftrightunsigned("place", 64 - SLICES.bit_length() + 1))
    )
    per_slice = flow.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_slice.select("source", "slice", F.coalesce(F.sum("slice_size").over(before), F.lit(0)).alias("start"))
    starts = starts.join(goals, starts.source.eqNullSafe(goals.source), "inner").select(
        starts.source.alias("of"), F.col("slice").alias("in_slice"), "start", "source_size", "target"
    )
    inside = Window.partitionBy("source", "slice").orderBy("place", "doc_id", "text_hash", "row")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = flow.withColumn("within", F.sum("size").over(inside))
    joined = ordered.join(starts, ordered.source.eqNullSafe(F.col("of")) & (F.col("slice") == F.col("in_slice")))
    passed = F.col("round") * F.col("source_size") + F.col("start") + F.col("within")
    return (
        joined.withColumn("round", F.explode(F.array(*(F.lit(i) for i in range(rounds)))))
        .select("doc_id", "text_hash", "row", "source", "size", "round", "place", (passed / F.col("target")).alias("finish"))
        .where("finish <= 1")
    )


def schedule(queued: DataFrame, budget: float) -> DataFrame:
    """The merged queue cut at the budget, with ``upto``, the words taken up to each copy.

    Slices of finish time are summed first; only the words before a slice cross from one
    slice to another.
    """
    at = F.floor(F.col("finish") * TIME_SLICES).cast("int")
    sliced = queued.withColumn("slice", at)
    per_slice = sliced.groupBy("slice").agg(F.sum("size").alias("slice_size"))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_slice.select("slice", F.coalesce(F.sum("slice_size").over(before), F.lit(0)).alias("start"))
    # At most TIME_SLICES + 1 rows.
    starts = F.broadcast(starts.where(F.col("start") < budget))
    order = Window.partitionBy("slice").orderBy("finish", F.col("source").asc_nulls_last(), "round", "place", "doc_id", "text_hash", "row")
    upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("start")
    return sliced.join(starts, "slice").withColumn("upto", upto).where(F.col("upto") <= budget)


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.0, seed: int = 0) -> DataFrame:
    """How many words of each document the mix takes: doc_id, size, source_size, target, taken, copies.

    One row per row of ``docs``. ``taken`` is size times the copies that stand in the mix.
    """
    sized = staged(sizes(docs).withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    goals = staged(targets(sized, weights, share), "mix-targets")
    budget = goals.agg(F.sum("target")).first()[0] or 0.0
    chosen = schedule(queue(sized, goals, seed), budget)
    copies = chosen.groupBy(F.col("row").alias("of_row")).agg(F.count(F.lit(1)).alias("copies"))
    found = sized.join(copies, sized.row == copies.of_row, "left")
    back = goals.withColumnRenamed("source", "of")
    copies = F.coalesce("copies", F.lit(0)).cast("long")
    return found.join(back, found.source.eqNullSafe(back.of)).select(
        "doc_id",
        "size",
        "source_size",
        F.col("target").cast("double").alias("target"),
        (F.col("size") * copies).alias("taken"),
        copies.alias("copies"),
        "text_hash",
        "source",
    )


def mix_documents(docs: DataFrame, weights=WEIGHTS, share: float = 1.0, seed: int = 0) -> DataFrame:
    """The mix itself: each row of ``docs``, all columns, as often as the mix takes it.

    Rows of one id, source and text are told apart by nothing; their copies are added up.
    """
    keys = ["_id", "_source", "_hash"]
    mixed = mix(docs, weights, share, seed).where("copies > 0")
    taken = mixed.groupBy(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("_source"),
        F.col("text_hash").alias("_hash"),
    ).agg(F.sum("copies").cast("int").alias("_copies"))
    inner = [f"_in_{i}" for i in range(len(docs.columns))]
    place = {c.lower(): F.col(inner[i]) for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*inner).withColumns(
        {
            "_id": F.coalesce(place["doc_id"].cast("string"), F.lit("")),
            "_source": F.coalesce(F.concat(F.lit("="), place["source"].cast("string")), F.lit("")),
            "_hash": F.xxhash64(place["text"].cast("string")),
        }
    )
    one = Window.partitionBy(*keys).orderBy(F.lit(0))
    first = rows.join(taken, keys).withColumn("_n", F.row_number().over(one)).where("_n = 1")
    return first.withColumn("_n", F.explode(F.sequence(F.lit(1), "_copies"))).select(*inner).toDF(*docs.columns)

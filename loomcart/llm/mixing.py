"""Mixing sources to target weights by a curriculum that varies over training time.

Each source has a weight schedule over training time 0 .. 1. Its integral says what
share of the budget the source gets; targets stop at a multiple of the source's size and
the excess goes to the others by weight. Within a source, documents stand in the order of
a hash. Cumulative demand (target times the integral of the schedule up to t) is inverted
at each document's place in that order, which gives its position in training; the result
is range-sorted by position.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomcart.llm.common import NOT_WHITE, stored, text_hash, words

# Weight at the start and at the end of training, linear between; means 5, 2, 1.
SCHEDULE = ((7.5, 2.5), (2.0, 2.0), (0.5, 1.5))
BUDGET_PERCENT = 150
MOST_TIMES = 2
BLOCK_ROWS = 256  # rows of a block within which sizes are added up one after the other
KEY_BITS = 60


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, source, size in words and the ordering key of every row."""
    key = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, KEY_BITS // 4),
                 16, 10).cast("long")
    return docs.select(
        "doc_id", text_hash(F.col("text")).alias("text_hash"), "source", F.size(words(F.col("text"), NOT_WHITE)).cast("long").alias("size"),
        key.alias("key"))


def targets(sizes: DataFrame, schedule=SCHEDULE) -> DataFrame:
    """source, source_size, target and the schedule's slope, one row per source.

    Sources are numbered by code point, null last. A level L solves
    sum(min(cap, L * weight)) = budget: with sources ordered by cap / weight, it is the
    first for which the budget left, shared by the weights left, stays below the cap.
    The windows run over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = number % len(schedule)
    weight = slope = F.lit(0.0)
    for i, (start, end) in enumerate(schedule):
        mean = (start + end) / 2  # the integral over 0 .. 1
        weight = F.when(turn == i, F.lit(mean)).otherwise(weight)
        slope = F.when(turn == i, F.lit((end - start) / 2 / mean)).otherwise(slope)
    weighed = totals.select("source", "source_size", weight.alias("weight"), slope.alias("slope"),
                            (F.col("source_size") * MOST_TIMES).alias("cap"))
    order = [F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()]
    every = Window.partitionBy()
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    budget = F.sum("source_size").over(every) * (BUDGET_PERCENT / 100)
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    levels = weighed.withColumn("own_level", level)
    fits = F.when(F.col("own_level") * F.col("weight") <= F.col("cap"), F.col("own_level"))
    first = F.first(fits, ignorenulls=True).over(
        Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (levels.withColumn("level", first)
            .select("source", "source_size", "slope",
                    F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target")))


def position_at(words_before, target, slope):
    """Inverse of cumulative demand: F(t) = (1 - a) t + a t^2 of the target, a the slope."""
    share = F.least(F.lit(1.0), words_before / target)
    flat = F.lit(1.0) - slope
    return F.lit(2.0) * share / (flat + F.sqrt(flat * flat + F.lit(4.0) * slope * share))


def mix(docs: DataFrame, schedule=SCHEDULE) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, source, size, source_size,
    target, taken, copies, positions (one for each copy) and position (the first, null if
    there is none), sorted by position.

    A source takes its documents in whole passes as often as its target allows and the
    last pass up to the document whose middle the target reaches, so it misses its target
    by half a document at most.

    A null text has no words; a null source is a source of its own; null doc_ids share a
    place in the order, ties stand by size. Rows without words take nothing; they come
    along with the pass they stand in, and not at all if their source has no words. An
    empty table gives no rows; other columns are not read.
    """
    sizes = stored(sized(docs), "sizes")
    rows = sizes.count()
    bits = max(8, math.ceil(math.log2(max(1, rows / BLOCK_ROWS))))
    blocked = sizes.withColumn("block", F.shiftright("key", KEY_BITS - bits))
    # Prefix sums in two steps: over block totals, then within each block.
    sums = blocked.groupBy("source", "block").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("s"), F.col("block").alias("b"),
                         F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start"))
    goals = targets(sizes, schedule).withColumnRenamed("source", "s")
    starts = starts.join(goals, starts["s"].eqNullSafe(goals["s"])).drop(goals["s"])
    inside = (Window.partitionBy("source", "block").orderBy("key", "doc_id", "text_hash")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (blocked.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
              .withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))))
    passes = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0))
    rest = F.col("target") - passes * F.col("source_size")
    middle = F.col("before") + F.col("size") / 2
    extra = (F.col("source_size") > 0) & (middle <= rest)
    copies = (passes + extra.cast("long")).cast("long")
    done = placed.withColumn("copies", copies)
    passes_before = F.sequence(F.lit(0), F.col("copies").cast("int") - 1)
    places = F.when(F.col("copies") > 0, F.transform(passes_before, lambda k: position_at(
        k * F.col("source_size") + middle, F.col("target"), F.col("slope"))))
    return (done.withColumn("positions", F.coalesce(places, F.array().cast("array<double>")))
            .select("doc_id", "text_hash", "source", "size", "source_size", "target",
                    (F.col("copies") * F.col("size")).alias("taken"), "copies", "positions",
                    F.get("positions", F.lit(0)).alias("position"))
            .orderBy("position", "source", "doc_id"))

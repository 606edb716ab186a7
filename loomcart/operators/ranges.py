"""Whole-table order without one giant task.

``Window.orderBy`` with no partition moves every row to one task. Here the rows are
range-partitioned and sorted once, written to reliable storage, and numbered from the
partition sizes: one short row per partition is all that is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcart.session import cut_lineage

# The lower 33 bits of monotonically_increasing_id() number the rows of a partition.
_ROW_BITS = (1 << 33) - 1


def sorted_partitions(df: DataFrame, order: list[Column]) -> DataFrame:
    """Adds ``_pid`` and ``_pos``: partition and place in the total order.

    ``order`` must be unique per row; then partitions are even whatever the values.
    """
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumns({"_pid": F.spark_partition_id(),
                            "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))}))
    return cut_lineage(placed)


def _offsets(placed: DataFrame) -> DataFrame:
    """(``_pid``, ``_offset``): rows in earlier partitions. One row per partition."""
    sizes = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("_pid", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))


def with_row_index(df: DataFrame, order: list[Column], name: str = "_index") -> DataFrame:
    """Adds the 0-based position of every row in the total order."""
    placed = sorted_partitions(df, order)
    # One row per partition: bounded by the partition count.
    offsets = F.broadcast(_offsets(placed))
    return (placed.join(offsets, "_pid").withColumn(name, F.col("_offset") + F.col("_pos"))
            .drop("_pid", "_pos", "_offset"))


def with_global_rank(df: DataFrame, value: str, tie_break: list[str], name: str) -> DataFrame:
    """Adds RANK() OVER (ORDER BY value DESC NULLS FIRST) over all rows.

    ``tie_break`` must make the order unique; it spreads ties over partitions. A tie
    that reaches over partition borders takes the rank of its very first row, looked up
    in the one-row-per-partition summary.
    """
    descending = F.col(value).desc_nulls_first()
    placed = sorted_partitions(df, [descending, *[F.col(c).asc_nulls_first() for c in tie_break]])
    local = placed.withColumn(
        "_local", F.rank().over(Window.partitionBy("_pid").orderBy(descending)))

    edges = local.groupBy("_pid").agg(
        F.min_by(F.struct(F.col(value).alias("v")), "_pos").alias("_first"),
        F.max_by(F.struct(F.col(value).alias("v"), F.col("_local").alias("r")), "_pos").alias("_last"),
    )
    summary = edges.join(_offsets(placed), "_pid")
    # Where the value at each partition's end starts, as a rank over all rows.
    starts = summary.groupBy(F.struct(F.col("_last.v").alias("v")).alias("_value")).agg(
        F.min(F.struct("_pid", (F.col("_offset") + F.col("_last.r")).alias("r"))).alias("_start"))
    heads = (summary.join(starts, F.col("_first") == F.col("_value"), "left")
             .select("_pid", "_offset", "_first",
                     F.when(F.col("_start._pid") < F.col("_pid"), F.col("_start.r")).alias("_head")))
    # One row per partition: bounded by the partition count.
    ranked = local.join(F.broadcast(heads), "_pid")
    continued = F.col("_head").isNotNull() & (F.struct(F.col(value).alias("v")) == F.col("_first"))
    rank = F.when(continued, F.col("_head")).otherwise(F.col("_offset") + F.col("_local"))
    return ranked.withColumn(name, rank).select(*df.columns, name)

"""Rolling z-scores over the last values of a sequence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcart.operators.ranges import with_row_index

WINDOW_SIZE = 100
THRESHOLD = 3.0
MIN_AMOUNTS = 10
MIN_BATCHES = 5
# Rows per block of the global sequence.
BLOCK_ROWS = 1 << 17
STATISTICS = ["window_count", "window_mean", "window_stdev", "z_score", "is_alert"]


def _statistics(df: DataFrame, value: str, frame) -> DataFrame:
    number = F.col(value).cast("double")
    return df.withColumns({
        "window_count": F.count(number).over(frame),
        "window_mean": F.avg(number).over(frame),
        "window_stdev": F.stddev_samp(number).over(frame),
    })


def _alert(df: DataFrame, value: str, threshold: float, min_values: int) -> DataFrame:
    """Adds ``z_score`` (null while it is not defined or not finite) and ``is_alert``.

    Sums of huge amounts overflow to infinity or NaN, which Spark takes to be greater than
    any threshold."""
    ready = (F.col("window_count") >= min_values) & (F.col("window_stdev") > 0)
    z = F.when(ready, F.abs(F.col(value).cast("double") - F.col("window_mean"))
               / F.col("window_stdev"))
    finite = F.when(z < float("inf"), z)
    return df.withColumn("z_score", finite).withColumn(
        "is_alert", F.coalesce(F.col("z_score") > threshold, F.lit(False)))


def rolling_zscore(df: DataFrame, value: str, order_by: list[str], keys: list[str] | None = None,
                   window_size: int = WINDOW_SIZE, threshold: float = THRESHOLD,
                   min_values: int = MIN_AMOUNTS, history: DataFrame | None = None,
                   block_rows: int = BLOCK_ROWS, one_block: bool = False) -> DataFrame:
    """Z-score of each value against the last ``window_size`` values, itself included.

    The sequence is the whole table, or one per ``keys``; ``order_by`` must be unique.
    ``value`` must not be null. ``history`` holds earlier rows of the sequence (same
    order and value columns, ordered before ``df``) that count but are not returned.

    Rows are numbered in order and cut into blocks; the last ``window_size - 1`` rows of
    a block are also given to the next one, so that every frame is whole inside its
    block. Blocks are equal in size however the keys are spread. ``one_block`` skips
    the numbering; it is for tables the caller knows to be short, by a count.
    """
    keys = keys or []
    rows = df.withColumn("_own", F.lit(True))
    if history is not None:
        earlier = history.select(*keys, *order_by, value).withColumn("_own", F.lit(False))
        rows = rows.unionByName(earlier, allowMissingColumns=True)
    order = [F.col(c).asc_nulls_first() for c in dict.fromkeys([*keys, *order_by])]
    if one_block:
        frame = (Window.partitionBy(*keys).orderBy(*order)
                 .rowsBetween(-(window_size - 1), Window.currentRow))
        scored = _statistics(rows, value, frame).filter("_own")
        return _alert(scored, value, threshold, min_values).select(
            *df.columns, *STATISTICS)
    block_rows = max(block_rows, window_size)
    block = F.floor(F.col("_index") / block_rows)
    near_end = F.col("_index") % block_rows > block_rows - window_size
    blocked = (
        with_row_index(rows, order)
        .withColumn("_home", block)
        .withColumn("_block", F.explode(F.when(near_end, F.array("_home", F.col("_home") + 1))
                                        .otherwise(F.array("_home"))))
    )
    # Blocks are few bytes and much work: Spark would put dozens of them into one task.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocked = blocked.repartition(tasks, "_block", *keys)
    frame = (Window.partitionBy("_block", *keys).orderBy("_index")
             .rowsBetween(-(window_size - 1), Window.currentRow))
    scored = _statistics(blocked, value, frame).filter(
        (F.col("_block") == F.col("_home")) & F.col("_own"))
    result = _alert(scored, value, threshold, min_values)
    return result.select(*df.columns, *STATISTICS)


def _shown(number: Column) -> Column:
    """Nine decimals are kept before printing, so that the digits shown do not depend on
    the order in which a window was added up."""
    return F.round(number, 9)


def amount_alert_text(value: str = "amount") -> Column:
    return F.when(F.col("is_alert"), F.format_string(
        "ANOMALY: amount=%.2f is %.1f std deviations from mean=%.2f (stdev=%.2f)",
        F.col(value).cast("double"), _shown(F.col("z_score")), _shown(F.col("window_mean")),
        _shown(F.col("window_stdev"))))


def batch_alert_text(value: str = "batch_size") -> Column:
    return F.when(F.col("is_alert"), F.format_string(
        "ANOMALY: batch_size=%d is %.1f std deviations from mean=%.1f",
        F.col(value).cast("bigint"), _shown(F.col("z_score")), _shown(F.col("window_mean"))))


def check_amounts(df: DataFrame, order_by: list[str], amount: str = "amount", **options) -> DataFrame:
    """Rows with an amount, their rolling statistics and ``_anomaly_alert`` text."""
    scored = rolling_zscore(df.filter(F.col(amount).isNotNull()), amount, order_by, **options)
    return scored.withColumn("_anomaly_alert", amount_alert_text(amount))


def batch_sizes(df: DataFrame, batch: Column | str) -> DataFrame:
    """Row count per batch, the input of ``check_batch_sizes``."""
    key = F.col(batch) if isinstance(batch, str) else batch
    return df.groupBy(key.alias("batch_id")).agg(F.count(F.lit(1)).alias("batch_size"))


def check_batch_sizes(sizes: DataFrame, **options) -> DataFrame:
    options.setdefault("min_values", MIN_BATCHES)
    scored = rolling_zscore(sizes, "batch_size", ["batch_id"], **options)
    return scored.withColumn("_anomaly_alert", batch_alert_text())

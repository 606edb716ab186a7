"""Summaries that are kept by merging: a batch adds its share, and no day is read again.

Three tables below ``<root>/summaries`` hold what was added, by run and batch:

* ``volume``: per day and type the events, their amounts, and the users not seen there before;
* ``revenue``: per hour and currency the purchases with their total, largest and smallest;
* ``presence``: the (day, type, user) triples, each once, under the batch that brought it.

Counts, sums, largest and smallest values merge by themselves. Distinct users merge through
``presence``: a batch looks its own triples up in the table's key index, so its cost follows
the batch and not the day. A batch that is run again replaces its rows; triples that its
first run had added are counted again by their batch, so nothing is lost between the two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcart.operators.key_index import KeyIndex
from loomcart.operators.sinks import refresh
from loomcart.plans.marts import purchases, user_funnel
from loomcart.session import remove_path, store

# The type of a mean of amounts of the events table.
MEAN = "decimal(22,8)"
VOLUME_KEY = ["event_date", "event_type"]
REVENUE_KEY = ["hour", "currency"]


def _at(root: str, name: str, run: str, batch_id: int) -> str:
    return f"{root}/summaries/{name}/run={run}/batch_id={batch_id}"


def presence_rows(events: DataFrame) -> DataFrame:
    """The distinct (day, type, user) triples with a key; without user there is none."""
    parts = [F.col("event_date").cast("string"), F.col("event_type"), F.col("user_id")]
    # Lengths keep ("a", "bc") and ("ab", "c") apart.
    key = F.sha2(F.concat(*[F.concat(F.coalesce(F.char_length(p).cast("string"), F.lit("-")), F.lit(":"),
                                     F.coalesce(p, F.lit(""))) for p in parts]), 256)
    return (events.filter(F.col("user_id").isNotNull())
            .select(F.to_date("timestamp").alias("event_date"), "event_type", "user_id").distinct()
            .withColumn("presence_key", F.substring(key, 1, 32)))


def add_batch(events: DataFrame, root: str, run: str, batch_id: int) -> None:
    """Add ``events``, which no batch has added before, as this run's batch ``batch_id``.

    ``events`` must stay the same when a batch is repeated.
    """
    spark = events.sparkSession
    triples = store(presence_rows(events), f"{_at(root, '_triples', run, batch_id)}")
    presence, own = f"{root}/summaries/presence", _at(root, "presence", run, batch_id)
    found = KeyIndex(spark, presence, "presence_key").lookup(triples.select("presence_key"))
    fresh = triples.join(found.keys, "presence_key", "left_anti") if found.buckets_read else triples
    # Few rows make one file; many are not brought together in one task.
    fresh.select(*triples.columns).hint("rebalance").write.mode("append").parquet(own)
    remove_path(spark, _at(root, "_triples", run, batch_id))
    day = F.to_date("timestamp").alias("event_date")
    volume = events.groupBy(day, "event_type").agg(
        F.count(F.lit(1)).alias("event_count"), F.sum("amount").alias("total_amount"),
        F.count("amount").alias("amount_count"))
    added = spark.read.parquet(own).groupBy(*VOLUME_KEY).agg(F.count(F.lit(1)).alias("new_users"))
    volume = volume.join(added, VOLUME_KEY, "left")
    (volume.withColumn("new_users", F.coalesce("new_users", F.lit(0))).coalesce(1)
     .write.mode("overwrite").parquet(_at(root, "volume", run, batch_id)))
    hour = F.date_trunc("hour", F.col("timestamp").cast("timestamp")).alias("hour")
    revenue = purchases(events).groupBy(hour, "currency").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("amount").alias("total_revenue"),
        F.max("amount").alias("max_transaction"), F.min("amount").alias("min_transaction"))
    revenue.coalesce(1).write.mode("overwrite").parquet(_at(root, "revenue", run, batch_id))


def _merged(rows: DataFrame, key: list[str], sums: list[str], most: list[str] = (), least: list[str] = ()) -> DataFrame:
    return rows.groupBy(*key).agg(
        *[F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in sums],
        *[F.max(c).alias(c) for c in most], *[F.min(c).alias(c) for c in least])


def daily_event_volume(spark: SparkSession, root: str) -> DataFrame:
    """As ``marts.daily_event_volume`` over all that was added."""
    merged = _merged(spark.read.parquet(f"{root}/summaries/volume"), VOLUME_KEY,
                     ["event_count", "new_users", "total_amount", "amount_count"])
    return merged.select(*VOLUME_KEY, "event_count", F.col("new_users").alias("unique_users"), "total_amount",
                         F.try_divide("total_amount", "amount_count").cast(MEAN).alias("avg_amount"))


def hourly_revenue(spark: SparkSession, root: str) -> DataFrame:
    """As ``marts.hourly_revenue`` over all that was added."""
    merged = _merged(spark.read.parquet(f"{root}/summaries/revenue"), REVENUE_KEY,
                     ["transaction_count", "total_revenue"], ["max_transaction"], ["min_transaction"])
    return merged.select(*REVENUE_KEY, "transaction_count", "total_revenue",
                         F.try_divide("total_revenue", "transaction_count").cast(MEAN).alias("avg_transaction"),
                         "max_transaction", "min_transaction")


def store_views(spark: SparkSession, root: str) -> None:
    """Write the three views below ``<root>/views`` from the merged summaries; their keys
    are checked. They hold a row for each day or hour, whatever the number of events."""
    for name, view, key in (("daily_event_volume", daily_event_volume(spark, root), VOLUME_KEY),
                            ("hourly_revenue", hourly_revenue(spark, root), REVENUE_KEY)):
        refresh(view, f"{root}/views/{name}", key)
    volume = spark.read.parquet(f"{root}/views/daily_event_volume")
    refresh(user_funnel(volume), f"{root}/views/user_funnel", ["event_date"])

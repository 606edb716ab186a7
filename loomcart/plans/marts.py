"""Analytic tables over events and orders.

Joins with a dimension come after the fact is reduced to one row per key: less to
shuffle, and no hot key can reach the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomcart.operators.access import is_type
from loomcart.operators.ranges import with_global_rank


def daily_event_volume(events: DataFrame) -> DataFrame:
    """Per UTC day and type: events, distinct users, total and mean amount."""
    return (
        events.groupBy(F.to_date("timestamp").alias("event_date"), "event_type")
        .agg(F.count(F.lit(1)).alias("event_count"),
             F.count_distinct("user_id").alias("unique_users"),
             F.sum("amount").alias("total_amount"),
             F.avg("amount").alias("avg_amount"))
    )


def daily_event_volume_report(events: DataFrame) -> DataFrame:
    return daily_event_volume(events).orderBy(
        F.col("event_date").desc_nulls_first(), F.col("event_count").desc_nulls_first())


def purchases(events: DataFrame) -> DataFrame:
    return events.filter(is_type("PURCHASE") & F.col("amount").isNotNull()
                         & F.col("currency").isNotNull())


def hourly_revenue(events: DataFrame) -> DataFrame:
    """Per UTC hour and currency: purchases, their total, mean, largest and smallest."""
    return (
        purchases(events)
        .groupBy(F.date_trunc("hour", F.col("timestamp").cast("timestamp")).alias("hour"), "currency")
        .agg(F.count(F.lit(1)).alias("transaction_count"),
             F.sum("amount").alias("total_revenue"),
             F.avg("amount").alias("avg_transaction"),
             F.max("amount").alias("max_transaction"),
             F.min("amount").alias("min_transaction"))
    )


def hourly_revenue_report(events: DataFrame) -> DataFrame:
    return hourly_revenue(events).orderBy(F.col("hour").desc_nulls_first())


def user_funnel(daily_volume: DataFrame) -> DataFrame:
    """Signups, logins and purchases per day, from the daily volume table."""
    def total(event_type):
        return F.sum(F.when(is_type(event_type), F.col("event_count")).otherwise(F.lit(0)))

    counts = daily_volume.groupBy("event_date").agg(
        total("signup").alias("signups"), total("login").alias("logins"),
        total("purchase").alias("purchases"))
    share = F.col("purchases") * F.lit(100.0) / F.nullif("signups", F.lit(0))
    return (counts.withColumn("signup_to_purchase_pct", F.round(share, 2))
            .orderBy(F.col("event_date").desc_nulls_first()))


def event_metrics(events: DataFrame) -> DataFrame:
    """One row of totals over the whole events table."""
    return events.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("user_id").alias("unique_users"),
        F.sum(F.when(is_type("PURCHASE"), F.col("amount"))).alias("total_revenue"),
        F.count_if("_has_nulls").alias("null_flagged_count"),
        F.min("timestamp").alias("earliest_event"),
        F.max("timestamp").alias("latest_event"),
    )


def monthly_revenue(fact: DataFrame) -> DataFrame:
    month = F.date_trunc("month", F.col("order_date")).alias("month")
    return (fact.groupBy(month).agg(F.sum("revenue").alias("revenue"))
            .orderBy(F.col("month").asc_nulls_last()))


def customer_cohorts(fact: DataFrame) -> DataFrame:
    """The month of each customer's first order."""
    return fact.groupBy("customer_id").agg(
        F.date_trunc("month", F.min("order_date")).alias("cohort_month"))


def cohort_retention(fact: DataFrame) -> DataFrame:
    """Distinct customers per (month of first order, month of order).

    Orders are reduced to one row per customer and month before anything else, so the
    window over a customer holds at most one row per month.
    """
    months = fact.filter(F.col("customer_id").isNotNull()).select(
        "customer_id", F.date_trunc("month", F.col("order_date")).alias("order_month")).distinct()
    per_customer = Window.partitionBy("customer_id")
    return (
        months.withColumn("cohort_month", F.min("order_month").over(per_customer))
        .groupBy("cohort_month", "order_month").agg(F.count(F.lit(1)).alias("users"))
        .orderBy(F.col("cohort_month").asc_nulls_last(), F.col("order_month").asc_nulls_last())
    )


def _totals_by(fact: DataFrame, dim: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """(key, name, total): fact summed per key, joined with the dimension's names."""
    per_key = fact.groupBy(key).agg(F.sum(value).alias("_sum"))
    named = dim.select(key, "name").join(per_key, key)
    return named.groupBy(key, "name").agg(F.sum("_sum").alias(name))


def product_performance(products: DataFrame, fact: DataFrame) -> DataFrame:
    """Units sold per product and its rank over all products."""
    sold = _totals_by(fact, products, "product_id", "quantity", "total_sold")
    return with_global_rank(sold, "total_sold", ["product_id", "name"], "sales_rank")


def customer_revenue(customers: DataFrame, fact: DataFrame) -> DataFrame:
    """Revenue per customer and its rank over all customers."""
    totals = _totals_by(fact, customers, "customer_id", "revenue", "total_revenue")
    return with_global_rank(totals, "total_revenue", ["customer_id", "name"], "rank")


def top_customers(customers: DataFrame, fact: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` customers with the highest revenue; ties go to the smaller id.

    Every customer who beats a shown one is shown too, so ranking the shown rows gives
    the rank over all customers and no global rank is needed.
    """
    totals = _totals_by(fact, customers, "customer_id", "revenue", "total_revenue")
    best = totals.orderBy(F.col("total_revenue").desc_nulls_first(), "customer_id", "name").limit(n)
    by_revenue = Window.orderBy(F.col("total_revenue").desc_nulls_first())
    return best.withColumn("rank", F.rank().over(by_revenue)).orderBy("rank", "customer_id")


def daily_revenue(staged_orders: DataFrame) -> DataFrame:
    return staged_orders.groupBy("order_date").agg(F.sum("revenue").alias("daily_revenue"))

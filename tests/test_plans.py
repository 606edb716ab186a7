"""Physical plans: what reaches the scan, and what is reduced before a shuffle."""

import pytest
from pyspark.sql import functions as F

from loomcart.functions.joins import lookup_join
from loomcart.operators import access
from loomcart.operators.dedup import first_per_key
from loomcart.operators.validate import accepted, validate
from loomcart.plans import marts
from loomcart.plans.events_job import clean
from loomcart.sources.events import parse_kafka

EVENTS = "/root/testdata/sf0.001/events.parquet"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def events(spark):
    from loomcart.catalog import adapters

    return adapters.events(spark, "/root/testdata/sf0.001")


def test_filters_and_columns_reach_the_scan(events):
    text = plan(marts.hourly_revenue(events))
    assert "In(event_type, [PURCHASE,purchase])" in text
    assert "event_id" not in text.split("ReadSchema")[1]
    ranged = plan(access.events_by_type(events, "purchase", "2024-01-02", "2024-01-05"))
    assert "GreaterThanOrEqual(ts,2024-01-02T00:00)" in ranged


def test_copies_are_reduced_before_the_shuffle(events):
    text = plan(first_per_key(events, ["user_id"], ["timestamp", "event_id"]))
    below = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below and "Partial" in below
    counted = plan(first_per_key(events, ["user_id"], ["timestamp", "event_id"], copies="n"))
    assert "partial_min_by" in counted.split("Exchange hashpartitioning")[1]


def test_dimension_joins_come_after_the_reduction(spark, events):
    fact = events.select(F.col("user_id").alias("customer_id"), F.col("amount").alias("revenue"))
    dim = fact.select("customer_id", F.lit("n").alias("name")).distinct()
    text = plan(marts.top_customers(dim, fact))
    join = next(line for line in text.splitlines() if "Join" in line)
    assert "partial_sum" in text[text.index(join):]
    assert "TakeOrderedAndProject" in text


def test_messages_are_parsed_once(spark):
    from loomcart.catalog import adapters

    parsed = parse_kafka(adapters.raw_messages(spark, "/root/testdata/sf0.001"))
    text = plan(accepted(validate(clean(parsed))))
    # A filter on the outcome stays above the parse; below it nothing is filtered.
    above, below = text.split("Generate explode", 1)
    assert "- Filter" in above and "- Filter" not in below


def _events(spark, rows):
    return spark.createDataFrame(
        rows, "event_type string, user_id string, amount double, currency string, timestamp string").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp"))


def test_event_reports_come_in_order(spark):
    """Latest first and nulls ahead of them; of a day the commonest type first."""
    rows = [("LOGIN", "a", None, None, f"2024-01-0{day} 10:00:00") for day in (2, 1, 3) for _ in range(day)]
    rows += [("SIGNUP", "b", None, None, "2024-01-01 11:00:00")] * 4 + [("LOGIN", "c", None, None, None)]
    rows += [("PURCHASE", "a", 1.0, "EUR", f"2024-01-02 {hour}:00:00") for hour in ("09", "23", "12")]
    events = _events(spark, rows).repartition(5)
    volume = marts.daily_event_volume_report(events).collect()
    assert [(str(r.event_date), r.event_count) for r in volume] == [
        ("None", 1), ("2024-01-03", 3), ("2024-01-02", 3), ("2024-01-02", 2), ("2024-01-01", 4), ("2024-01-01", 1)]
    assert [r.hour.hour for r in marts.hourly_revenue_report(events).collect()] == [23, 12, 9]
    funnel = marts.user_funnel(marts.daily_event_volume(events)).collect()
    assert [str(r.event_date) for r in funnel] == ["None", "2024-01-03", "2024-01-02", "2024-01-01"]


def test_order_reports_come_in_order(spark):
    from loomcart.catalog import orders

    sf_dir = "/root/testdata/sf0.001"
    fact = orders.fact(spark, sf_dir).repartition(5)
    months = [r.month for r in marts.monthly_revenue(fact).collect()]
    assert len(months) > 2 and months == sorted(months)
    cohorts = [(r.cohort_month, r.order_month) for r in marts.cohort_retention(fact).collect()]
    assert len(cohorts) > 2 and cohorts == sorted(cohorts)
    top = marts.top_customers(orders.dim(spark, sf_dir, "customers"), fact).collect()
    totals = [r.total_revenue for r in top]
    assert len(top) == 10 and totals == sorted(totals, reverse=True)


def test_large_key_tables_are_not_broadcast(spark):
    """Salted copies look as small as the key table to the planner."""
    rows = spark.range(10).select(F.col("id").cast("string").alias("k"), "id")
    keys = spark.range(5).select(F.col("id").cast("string").alias("k"), F.lit(True).alias("known"))
    joined = lookup_join(rows, keys, ["k"], ["id"], limit=0)
    assert joined.filter("known").count() == 5 and joined.count() == 10
    assert "Broadcast" not in plan(joined)

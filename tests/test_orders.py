"""Order transforms, table checks, sinks, marts and generators on small tables."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loomcart.operators import sinks
from loomcart.operators.integrity import foreign_key_violations
from loomcart.operators.orders import transform_orders, transform_products
from loomcart.operators.quality import (
    DataQualityError, assert_unique, column_report, require_columns, validate_table,
)
from loomcart.plans import marts
from loomcart.plans.warehouse_job import run_daily
from loomcart.sources.generators import generate_customers, generate_orders, generate_products
from loomcart.sources.tables import date_dimension, read_table


def test_revenue(spark):
    df = spark.createDataFrame([("1", 2, 10.0, 0, "2023-01-01"), ("2", 1, 20.0, 10, "2023-01-02"),
                                ("2", 1, 20.0, 10, "2023-01-03")],
                               "order_id string, quantity int, price double, discount int, order_date string")
    rows = transform_orders(df).orderBy("order_id").collect()
    assert [r.revenue for r in rows] == [Decimal("20.00"), Decimal("18.00")]
    assert rows[1].order_date == date(2023, 1, 2)


def test_margin_without_price(spark):
    df = spark.createDataFrame([("a", Decimal("0.00"), Decimal("1.00")), ("b", Decimal("4.00"), Decimal("1.00"))],
                               "product_id string, price decimal(10,2), cost decimal(10,2)")
    got = {r.product_id: r.profit_margin for r in transform_products(df).collect()}
    assert got == {"a": None, "b": Decimal("0.7500")}


def test_required_columns(spark):
    df = spark.createDataFrame([(1, 3.0), (2, float("nan"))], "a int, b double")
    assert validate_table(df, ["a", "b"]) == {"a": 0, "b": 1}
    with pytest.raises(DataQualityError):
        require_columns(df, ["c"])
    missing = column_report(df, ["c"]).first()
    assert not missing.is_present and missing.null_count is None


def test_unique(spark):
    df = spark.createDataFrame([(1,), (1,)], "a int")
    with pytest.raises(DataQualityError):
        assert_unique(df, ["a"])
    assert_unique(df.distinct(), ["a"])


def test_foreign_keys(spark):
    fact = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "k string")
    dim = spark.createDataFrame([("b",)], "id string")
    row = foreign_key_violations(fact, {"k": (dim, "id")}).first()
    assert (row.violating_rows, row.violating_keys) == (3, 2)


def test_load_modes(spark, folder):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert sinks.load_table(df, folder) == 2
    assert sinks.load_table(df, folder, "append") == 2
    assert read_table(spark, folder).count() == 4
    assert sinks.load_table(df, folder, "replace") == 2
    with pytest.raises(Exception, match="exist"):
        sinks.load_table(df, folder, "fail")
    fresh = spark.createDataFrame([(2, "B"), (3, "C")], "id int, v string")
    assert sinks.load_table(fresh, folder, "upsert", ["id"]) == 2
    assert sorted(map(tuple, read_table(spark, folder).collect())) == [(1, "a"), (2, "B"), (3, "C")]


@pytest.mark.parametrize("limit", [500_000, 0])
def test_insert_ignore(spark, folder, monkeypatch, limit):
    monkeypatch.setattr(sinks, "fits_broadcast", lambda df: df.count() <= limit)
    schema = "event_id string, n int"
    first = spark.createDataFrame([("a", 1), ("b", 2)], schema)
    assert sinks.insert_ignore(first, folder) == {"inserted": 2, "skipped": 0}
    batch = spark.createDataFrame([("b", 9), ("c", 5), ("c", 4), ("d", 1)], schema)
    assert sinks.insert_ignore(batch, folder) == {"inserted": 2, "skipped": 2}
    assert sinks.insert_ignore(batch, folder) == {"inserted": 0, "skipped": 4}
    assert sorted(map(tuple, spark.read.parquet(folder).collect())) == [
        ("a", 1), ("b", 2), ("c", 4), ("d", 1)]


def test_run_log(spark, folder):
    first = {"run_id": "r", "started_at": datetime(2024, 1, 1), "completed_at": datetime(2024, 1, 1, 1),
             "records_ingested": 5, "records_rejected": 1, "status": "running"}
    sinks.log_run(spark, folder, first)
    sinks.log_run(spark, folder, {**first, "started_at": datetime(2024, 1, 2), "records_ingested": 9,
                                  "records_rejected": 7, "completed_at": None, "status": "completed"})
    row, = sinks.current_runs(spark.read.parquet(folder), ["logged_at"]).collect()
    assert (row.records_ingested, row.status, row.completed_at) == (9, "completed", None)
    assert (row.records_rejected, row.started_at) == (1, datetime(2024, 1, 1))


def test_refresh_touches_only_given_days(spark, folder):
    schema = "timestamp timestamp, event_type string, user_id string, amount decimal(18,4)"
    day1, day2 = datetime(2024, 1, 1, 5), datetime(2024, 1, 2, 5)
    old = spark.createDataFrame([(day1, "CLICK", "u", None), (day2, "CLICK", "u", None)], schema)
    days = old.select(F.to_date("timestamp").alias("d")).distinct()
    sinks.refresh_days(old, days, marts.daily_event_volume, folder)
    new = old.unionByName(old)
    sinks.refresh_days(new, days.filter("d = '2024-01-02'"), marts.daily_event_volume, folder)
    got = {str(r.event_date): r.event_count for r in spark.read.parquet(folder).collect()}
    assert got == {"2024-01-01": 1, "2024-01-02": 2}


def test_funnel_without_signups(spark):
    daily = spark.createDataFrame([(date(2024, 1, 1), "PURCHASE", 3), (date(2024, 1, 2), "SIGNUP", 8),
                                   (date(2024, 1, 2), "PURCHASE", 1)],
                                  "event_date date, event_type string, event_count long")
    rows = marts.user_funnel(daily).collect()
    assert [r.signup_to_purchase_pct for r in rows] == [12.5, None]


def test_null_revenue_ranks_first_and_ties_share(spark):
    customers = spark.createDataFrame([(c, c) for c in "abcd"], "customer_id string, name string")
    fact = spark.createDataFrame([("a", None), ("b", 5), ("c", 5), ("d", 1)], "customer_id string, revenue int")
    for build in (marts.customer_revenue, marts.top_customers):
        got = {r.customer_id: r["rank"] for r in build(customers, fact).collect()}
        assert got == {"a": 1, "b": 2, "c": 2, "d": 4}
    assert marts.top_customers(customers, fact, 2).count() == 2


def test_date_dimension(spark):
    bounds = spark.createDataFrame([(date(2024, 2, 28), date(2024, 3, 3))], "first_date date, last_date date")
    rows = date_dimension(bounds).orderBy("date").collect()
    assert len(rows) == 5 and rows[1].date == date(2024, 2, 29)
    assert [r.day_of_week for r in rows] == [3, 4, 5, 6, 0]


def test_generators(spark):
    customers = generate_customers(spark.range(50))
    products = generate_products(spark.range(20))
    orders = generate_orders(spark.range(100), 50, 20)
    assert (customers.count(), products.count(), orders.count()) == (50, 20, 100)
    assert customers.select("customer_id").distinct().count() == 50
    bad = orders.filter("quantity not between 1 and 10 or price not between 10 and 500 "
                        "or discount not between 0 and 50")
    assert bad.count() == 0
    assert orders.join(customers, "customer_id", "left_anti").count() == 0
    assert orders.join(products, "product_id", "left_anti").count() == 0


def test_daily_job(spark, folder):
    run = run_daily(generate_orders(spark.range(200), 50, 20, as_of="2024-12-31"),
                    generate_customers(spark.range(40)), generate_products(spark.range(20)), folder)
    assert run.loaded["fact_orders"] == 200 and run.loaded["dim_customers"] == 40
    assert run.null_counts["orders"]["order_id"] == 0
    missing, = run.violations.collect()
    assert missing.foreign_key == "customer_id" and missing.violating_rows > 0
    assert spark.table("stg_orders").count() == 200
    total = run.table(spark, "mart_daily_revenue").agg(F.sum("daily_revenue")).first()[0]
    assert total == run.table(spark, "fact_orders").agg(F.sum("revenue")).first()[0]


def test_daily_job_counts_what_it_loads(spark, folder):
    """An extract that differs each time it is computed is computed once."""
    customers = generate_customers(spark.range(400)).withColumn(
        "name", F.when(F.expr("rand()") < 0.5, F.col("name")))
    run = run_daily(generate_orders(spark.range(20), 50, 20), customers, generate_products(spark.range(20)), folder)
    loaded = run.table(spark, "dim_customers").filter("name is null").count()
    assert 0 < run.null_counts["customers"]["name"] == loaded


def test_daily_job_stops_on_missing_columns(spark, folder):
    with pytest.raises(DataQualityError):
        run_daily(spark.range(3), generate_customers(spark.range(4)), generate_products(spark.range(2)), folder)

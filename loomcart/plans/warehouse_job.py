"""The daily order job: check, transform, load the star schema, build the marts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcart.operators.anomaly import batch_sizes, check_batch_sizes
from loomcart.operators.integrity import foreign_key_violations
from loomcart.operators.orders import (
    stage_orders, transform_customers, transform_orders, transform_products,
)
from loomcart.operators.quality import require_columns, validate_table
from loomcart.operators.sinks import create_view, load_table
from loomcart.plans.marts import daily_revenue
from loomcart.session import remove_path, scratch_path, store
from loomcart.sources.tables import date_dimension, date_range

ORDER_COLUMNS = ["order_id", "customer_id", "product_id", "quantity", "price", "discount",
                 "order_date"]
CUSTOMER_COLUMNS = ["customer_id", "name", "signup_date"]
PRODUCT_COLUMNS = ["product_id", "name", "price", "cost"]


@dataclass
class DailyRun:
    """Where the tables are, what was loaded and what looked wrong."""

    root: str
    loaded: dict[str, int] = field(default_factory=dict)
    null_counts: dict[str, dict[str, int]] = field(default_factory=dict)
    violations: DataFrame | None = None
    alerts: DataFrame | None = None

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.root}/{name}")


def run_daily(orders: DataFrame, customers: DataFrame, products: DataFrame, root: str,
              if_exists: str = "replace", order_by: list[str] | None = None) -> DailyRun:
    """Check the extracts, transform them, load the warehouse and build the marts.

    Missing columns stop the run before anything is written. Each extract is computed once
    and staged, so what is counted is what is loaded, even if its source changes meanwhile.
    Rows with unknown foreign keys are loaded and reported in ``violations``; days with an
    unusual number of orders in ``alerts``.
    """
    spark = orders.sparkSession
    run = DailyRun(root)
    extracts = {
        "customers": (customers, CUSTOMER_COLUMNS, transform_customers, "dim_customers"),
        "products": (products, PRODUCT_COLUMNS, transform_products, "dim_products"),
        "orders": (orders, ORDER_COLUMNS, lambda df: transform_orders(df, order_by), "fact_orders"),
    }
    for extract, columns, _, _ in extracts.values():
        require_columns(extract, columns)
    for name, (extract, columns, transform, target) in extracts.items():
        path = scratch_path(spark, name)
        try:
            staged = store(extract, path)
            run.null_counts[name] = validate_table(staged, columns)
            run.loaded[target] = load_table(transform(staged), f"{root}/{target}", if_exists)
        finally:
            remove_path(spark, path)
    fact = run.table(spark, "fact_orders")
    days = date_dimension(date_range(fact, "order_date"))
    run.loaded["dim_date"] = load_table(days, f"{root}/dim_date", "replace")

    staged = stage_orders(fact)
    create_view(staged, "stg_orders")
    run.loaded["mart_daily_revenue"] = load_table(
        daily_revenue(staged), f"{root}/mart_daily_revenue", "replace")

    run.violations = foreign_key_violations(fact, {
        "customer_id": (run.table(spark, "dim_customers"), "customer_id"),
        "product_id": (run.table(spark, "dim_products"), "product_id"),
    }).filter(F.col("violating_rows") > 0)
    run.alerts = check_batch_sizes(batch_sizes(fact, "order_date")).filter("is_alert")
    return run

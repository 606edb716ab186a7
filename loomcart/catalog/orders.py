"""Queries over the order warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcart.catalog import adapters as given
from loomcart.catalog.oracle import FACT, RAW_ORDERS
from loomcart.catalog.registry import query, six, six_sql
from loomcart.operators import orders as ops
from loomcart.operators.integrity import foreign_key_violations
from loomcart.operators.quality import column_report, duplicate_keys
from loomcart.operators.sinks import load_table
from loomcart.plans import marts
from loomcart.plans.warehouse_job import DailyRun, run_daily
from loomcart.session import scratch_path
from loomcart.sources import generators as gen
from loomcart.sources.tables import date_dimension, date_range

_WAREHOUSES: dict[tuple[str, str], DailyRun] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> DailyRun:
    """The star schema of the given tables, loaded once per application by the daily job."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = run_daily(
            given.raw_orders(spark, sf_dir), given.raw_customers(spark, sf_dir),
            given.raw_products(spark, sf_dir), scratch_path(spark, "warehouse"))
    return _WAREHOUSES[key]


def fact(spark, sf_dir) -> DataFrame:
    return warehouse(spark, sf_dir).table(spark, "fact_orders")


def dim(spark, sf_dir, name) -> DataFrame:
    return warehouse(spark, sf_dir).table(spark, f"dim_{name}")


@query("monthly_revenue", f"""WITH {FACT}
SELECT date_trunc('month', order_date)::TIMESTAMP AS month, sum(revenue)::DOUBLE AS revenue
FROM fact GROUP BY 1""")
def _(spark, sf_dir):
    return marts.monthly_revenue(fact(spark, sf_dir)).withColumn(
        "revenue", F.col("revenue").cast("double"))


@query("customer_cohorts", f"""WITH {FACT}
SELECT customer_id, date_trunc('month', min(order_date))::TIMESTAMP AS cohort_month
FROM fact GROUP BY 1""")
def _(spark, sf_dir):
    return marts.customer_cohorts(fact(spark, sf_dir))


@query("cohort_retention", f"""WITH {FACT}, cohort AS (
  SELECT customer_id, date_trunc('month', min(order_date))::TIMESTAMP AS cohort_month
  FROM fact GROUP BY 1)
SELECT c.cohort_month, date_trunc('month', f.order_date)::TIMESTAMP AS order_month,
       count(DISTINCT c.customer_id) AS users
FROM cohort c JOIN fact f ON c.customer_id = f.customer_id GROUP BY 1, 2""")
def _(spark, sf_dir):
    return marts.cohort_retention(fact(spark, sf_dir))


@query("product_performance", f"""WITH {FACT}
SELECT p_partkey::VARCHAR AS product_id, p_name AS name, sum(quantity)::BIGINT AS total_sold,
       rank() OVER (ORDER BY sum(quantity) DESC NULLS FIRST) AS sales_rank
FROM part JOIN fact ON p_partkey::VARCHAR = product_id GROUP BY 1, 2""")
def _(spark, sf_dir):
    return marts.product_performance(dim(spark, sf_dir, "products"), fact(spark, sf_dir))


_CUSTOMER_REVENUE = f"""WITH {FACT}, totals AS (
SELECT c_custkey::VARCHAR AS customer_id, c_name AS name, sum(revenue) AS total_revenue
FROM customer JOIN fact ON c_custkey::VARCHAR = customer_id GROUP BY 1, 2)
SELECT customer_id, name, total_revenue::DOUBLE AS total_revenue,
       rank() OVER (ORDER BY total_revenue DESC NULLS FIRST) AS rank FROM totals"""


@query("customer_revenue", _CUSTOMER_REVENUE)
def _(spark, sf_dir):
    ranked = marts.customer_revenue(dim(spark, sf_dir, "customers"), fact(spark, sf_dir))
    return ranked.withColumn("total_revenue", F.col("total_revenue").cast("double"))


@query("top_customers", _CUSTOMER_REVENUE + " ORDER BY total_revenue DESC, customer_id LIMIT 10")
def _(spark, sf_dir):
    best = marts.top_customers(dim(spark, sf_dir, "customers"), fact(spark, sf_dir))
    return best.select("customer_id", "name", F.col("total_revenue").cast("double"),
                       F.col("rank").cast("bigint"))


@query("stg_orders", f"""WITH {FACT}
SELECT order_id, customer_id, product_id, quantity, price::DOUBLE AS price,
       discount::DOUBLE AS discount, order_date, status, revenue::DOUBLE AS revenue FROM fact""")
def _(spark, sf_dir):
    staged = ops.stage_orders(fact(spark, sf_dir))
    return staged.withColumns({c: F.col(c).cast("double") for c in ("price", "discount", "revenue")})


@query("daily_revenue_mart", f"""WITH {FACT}
SELECT order_date, sum(revenue)::DOUBLE AS daily_revenue FROM fact GROUP BY 1""")
def _(spark, sf_dir):
    staged = ops.stage_orders(fact(spark, sf_dir))
    return marts.daily_revenue(staged).withColumn(
        "daily_revenue", F.col("daily_revenue").cast("double"))


@query("order_revenue", f"""WITH {FACT}
SELECT order_id, order_date, revenue::DOUBLE AS revenue FROM fact""")
def _(spark, sf_dir):
    done = ops.transform_orders(given.raw_orders(spark, sf_dir))
    return done.select("order_id", "order_date", F.col("revenue").cast("double"))


@query("dedup_orders", f"""WITH {FACT}
SELECT order_id, customer_id, product_id, quantity, shipping_address FROM fact""")
def _(spark, sf_dir):
    done = ops.transform_orders(given.raw_orders(spark, sf_dir))
    return done.select("order_id", "customer_id", "product_id", "quantity", "shipping_address")


@query("product_margin", """
SELECT product_id, price::DOUBLE AS price, cost::DOUBLE AS cost,
       round((price - cost)::DECIMAL(18,4)::DOUBLE / price::DOUBLE, 4) AS profit_margin
FROM (SELECT p_partkey::VARCHAR AS product_id, p_retailprice::DECIMAL(10,2) AS price,
             (p_retailprice::DECIMAL(10,2) * p_size * 0.01)::DECIMAL(10,2) AS cost FROM part)""")
def _(spark, sf_dir):
    done = ops.transform_products(given.raw_products(spark, sf_dir))
    return done.select("product_id", *[F.col(c).cast("double")
                                       for c in ("price", "cost", "profit_margin")])


@query("customers_transformed", """
SELECT c_custkey::VARCHAR AS customer_id, c_name AS name, c_mktsegment AS segment,
       (DATE '2020-01-01' + (c_custkey % 1000 + 1)::INTEGER)::DATE AS signup_date FROM customer""")
def _(spark, sf_dir):
    done = ops.transform_customers(given.raw_customers(spark, sf_dir))
    return done.select("customer_id", "name", "segment", "signup_date")


@query("required_columns", f"""WITH {RAW_ORDERS}
SELECT column_name, column_name <> 'coupon_code' AS is_present, n AS row_count
FROM (SELECT unnest(['order_id', 'customer_id', 'quantity', 'coupon_code']) AS column_name),
     (SELECT count(*) AS n FROM raw_orders)""")
def _(spark, sf_dir):
    report = column_report(given.raw_orders(spark, sf_dir),
                           ["order_id", "customer_id", "quantity", "coupon_code"])
    return report.select("column_name", "is_present", "row_count")


@query("null_counts", f"""WITH {RAW_ORDERS}, holed AS (
  SELECT order_id, nullif(status, 'P') AS status, nullif(quantity, 13) AS quantity,
         CASE WHEN discount = 5 THEN 'NaN'::DOUBLE ELSE discount::DOUBLE END AS discount
  FROM raw_orders)
SELECT 'order_id' AS column_name, count(*) AS row_count, count_if(order_id IS NULL)::BIGINT AS null_count
FROM holed UNION ALL
SELECT 'status', count(*), count_if(status IS NULL)::BIGINT FROM holed UNION ALL
SELECT 'quantity', count(*), count_if(quantity IS NULL)::BIGINT FROM holed UNION ALL
SELECT 'discount', count(*), count_if(isnan(discount))::BIGINT FROM holed""")
def _(spark, sf_dir):
    holed = given.raw_orders(spark, sf_dir).select(
        "order_id", F.nullif("status", F.lit("P")).alias("status"),
        F.nullif("quantity", F.lit(13)).alias("quantity"),
        F.when(F.col("discount") == 5, F.lit(float("nan")))
         .otherwise(F.col("discount").cast("double")).alias("discount"))
    return column_report(holed, holed.columns).drop("is_present")


@query("fk_violations", f"""WITH {FACT}
SELECT 'customer_id' AS foreign_key, count(*) AS violating_rows,
       count(DISTINCT customer_id) AS violating_keys FROM fact
WHERE customer_id NOT IN (SELECT c_custkey::VARCHAR FROM customer WHERE c_acctbal > 0)
UNION ALL
SELECT 'product_id', count(*), count(DISTINCT product_id) FROM fact
WHERE product_id NOT IN (SELECT p_partkey::VARCHAR FROM part WHERE p_size <= 40)""")
def _(spark, sf_dir):
    solvent = given.table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").cast("string").alias("id"))
    small = given.table(spark, sf_dir, "part").filter("p_size <= 40").select(
        F.col("p_partkey").cast("string").alias("id"))
    return foreign_key_violations(fact(spark, sf_dir), {
        "customer_id": (solvent, "id"), "product_id": (small, "id")})


@query("date_dim", """
SELECT d::DATE AS date, year(d)::INTEGER AS year, month(d)::INTEGER AS month,
       quarter(d)::INTEGER AS quarter, dayofweek(d)::INTEGER AS day_of_week
FROM (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE,
                                    INTERVAL 1 DAY)) AS d
      FROM orders)""")
def _(spark, sf_dir):
    return date_dimension(date_range(given.table(spark, sf_dir, "orders"), "o_orderdate"))


@query("load_modes", """
SELECT m AS mode, n * k AS row_count
FROM (SELECT count(*) AS n FROM customer),
     (VALUES ('append', 2), ('replace', 1), ('upsert', 1)) AS v(m, k)""")
def _(spark, sf_dir):
    rows = ops.transform_customers(given.raw_customers(spark, sf_dir))
    found = []
    for mode in ("append", "replace", "upsert"):
        path = scratch_path(spark, f"load-{mode}")
        load_table(rows, path, "append")
        load_table(rows, path, mode, ["customer_id"])
        found.append(spark.read.parquet(path).agg(
            F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("row_count")))
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("duplicate_order_ids", f"""WITH {RAW_ORDERS}
SELECT order_id, count(*) AS key_count FROM raw_orders GROUP BY 1 HAVING count(*) > 1""")
def _(spark, sf_dir):
    return duplicate_keys(given.raw_orders(spark, sf_dir), ["order_id"])


@query("daily_job", f"""WITH {FACT}
SELECT order_date, count(*) AS orders, sum(revenue)::DOUBLE AS daily_revenue,
       year(order_date)::INTEGER AS year, quarter(order_date)::INTEGER AS quarter
FROM fact GROUP BY 1""")
def _(spark, sf_dir):
    """The marts and dimensions a daily run left behind, read back together."""
    run = warehouse(spark, sf_dir)
    orders = run.table(spark, "fact_orders").groupBy("order_date").agg(
        F.count(F.lit(1)).alias("orders"))
    return (run.table(spark, "mart_daily_revenue").join(orders, "order_date")
            .join(run.table(spark, "dim_date").withColumnRenamed("date", "order_date"), "order_date")
            .select("order_date", "orders", F.col("daily_revenue").cast("double"), "year", "quarter"))


@query("daily_order_alerts", f"""WITH {FACT}, sizes AS (
  SELECT order_date AS batch_id, count(*) AS batch_size FROM fact GROUP BY 1),
stats AS (
  SELECT *, count(*) OVER w AS n, avg(batch_size) OVER w AS mean, stddev_samp(batch_size) OVER w AS sd
  FROM sizes WINDOW w AS (ORDER BY batch_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW))
SELECT batch_id, batch_size, {six_sql('mean')} AS window_mean FROM stats
WHERE n >= 5 AND sd > 0 AND abs(batch_size - mean) / sd > 3.0""")
def _(spark, sf_dir):
    return warehouse(spark, sf_dir).alerts.select(
        "batch_id", "batch_size", six("window_mean").alias("window_mean"))


# --- generated tables: one row per row of a given table ---

_AS_OF = "2024-12-31"


def _draw_sql(tag: str, key: str, n) -> str:
    return f"(('0x' || substr(md5('0:{tag}:' || {key}), 1, 12))::BIGINT % {n})"


def _uuid_sql(tag: str, key: str) -> str:
    m = f"md5('0:{tag}:' || {key})"
    return (f"substr({m}, 1, 8) || '-' || substr({m}, 9, 4) || '-' || substr({m}, 13, 4) || '-' "
            f"|| substr({m}, 17, 4) || '-' || substr({m}, 21)")


def _pick_sql(tag: str, key: str, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"[{listed}][{_draw_sql(tag, key, len(values))} + 1]"


def _cents_sql(tag: str, key: str, low: int, high: int) -> str:
    return f"(({_draw_sql(tag, key, (high - low) * 100 + 1)} + {low * 100}) / 100.0)::DOUBLE"


@query("gen_customers", f"""
SELECT {_uuid_sql('customer', 'c_custkey')} AS customer_id,
       (DATE '2020-01-01' + {_draw_sql('signup', 'c_custkey', 1827)}::INTEGER)::DATE AS signup_date,
       {_pick_sql('segment', 'c_custkey', gen.CUSTOMER_SEGMENTS)} AS segment FROM customer""")
def _(spark, sf_dir):
    keys = given.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return gen.generate_customers(keys, as_of=_AS_OF).select("customer_id", "signup_date", "segment")


@query("gen_products", f"""
SELECT {_uuid_sql('product', 'p_partkey')} AS product_id,
       {_pick_sql('category', 'p_partkey', gen.PRODUCT_CATEGORIES)} AS category,
       {_cents_sql('price', 'p_partkey', 10, 1000)} AS price,
       {_cents_sql('cost', 'p_partkey', 5, 500)} AS cost FROM part""")
def _(spark, sf_dir):
    keys = given.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    return gen.generate_products(keys).select(
        "product_id", "category", F.col("price").cast("double"), F.col("cost").cast("double"))


@query("gen_orders", f"""
SELECT {_uuid_sql('order', 'o_orderkey')} AS order_id,
       {_uuid_sql('customer', _draw_sql('buyer', 'o_orderkey', '(SELECT count(*) FROM customer)'))}
         AS customer_id,
       {_uuid_sql('product', _draw_sql('item', 'o_orderkey', '(SELECT count(*) FROM part)'))}
         AS product_id,
       ({_draw_sql('quantity', 'o_orderkey', 10)} + 1)::INTEGER AS quantity,
       {_cents_sql('price', 'o_orderkey', 10, 500)} AS price,
       {_cents_sql('discount', 'o_orderkey', 0, 50)} AS discount,
       (DATE '2024-01-01' + {_draw_sql('order_date', 'o_orderkey', 366)}::INTEGER)::DATE
         AS order_date,
       {_pick_sql('status', 'o_orderkey', gen.ORDER_STATUSES)} AS status,
       {_pick_sql('payment', 'o_orderkey', gen.PAYMENT_METHODS)} AS payment_method
FROM orders""")
def _(spark, sf_dir):
    customers = given.table(spark, sf_dir, "customer").count()
    products = given.table(spark, sf_dir, "part").count()
    keys = given.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    made = gen.generate_orders(keys, customers, products, as_of=_AS_OF)
    return made.drop("shipping_address").withColumns(
        {c: F.col(c).cast("double") for c in ("price", "discount")})

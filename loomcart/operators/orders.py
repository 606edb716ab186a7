"""Order, customer and product transforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcart.operators.dedup import first_per_key

STAGED_COLUMNS = ["order_id", "customer_id", "product_id", "quantity", "price", "discount",
                  "order_date", "status", "revenue"]


# Extracts may carry the order in which their rows came; it is not loaded.
ARRIVAL = "_arrival"


def _first(df: DataFrame, key: str, order_by: list[str] | None) -> DataFrame:
    """The first row of every key: by ``order_by``, else by arrival where the extract has
    it, else (and among equals) by all other columns."""
    others = [c for c in df.columns if c not in (key, ARRIVAL)]
    arrival = [ARRIVAL] if ARRIVAL in df.columns else []
    return first_per_key(df, [key], order_by or [*arrival, *others]).drop(ARRIVAL)


def line_revenue(quantity: Column, price: Column, discount: Column) -> Column:
    """quantity * price * (1 - discount %), exact in decimals, rounded once per line."""
    amount = quantity.cast("decimal(10,0)") * price.cast("decimal(10,2)")
    share = (F.lit(100).cast("decimal(3,0)") - discount.cast("decimal(10,2)")) * F.lit(
        "0.01").cast("decimal(2,2)")
    return (amount * share).cast("decimal(10,2)")


def transform_orders(df: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """Typed dates and money, revenue per line, first row per order id.

    ``order_by`` says which row comes first; see ``_first`` for the default.
    """
    unique = _first(df, "order_id", order_by)
    return unique.withColumns({
        "order_date": F.to_date("order_date"),
        "quantity": F.col("quantity").cast("int"),
        "price": F.col("price").cast("decimal(10,2)"),
        "discount": F.col("discount").cast("decimal(10,2)"),
        "revenue": line_revenue(F.col("quantity"), F.col("price"), F.col("discount")),
    })


def transform_customers(df: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    unique = _first(df, "customer_id", order_by)
    return unique.withColumn("signup_date", F.to_date("signup_date"))


def transform_products(df: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """Adds profit_margin = (price - cost) / price; null where the price is zero."""
    unique = _first(df, "product_id", order_by)
    price, cost = F.col("price").cast("decimal(10,2)"), F.col("cost").cast("decimal(10,2)")
    return unique.withColumns({
        "price": price,
        "cost": cost,
        "profit_margin": F.try_divide(price - cost, price).cast("decimal(10,4)"),
    })


def stage_orders(fact: DataFrame) -> DataFrame:
    return fact.select(*STAGED_COLUMNS)

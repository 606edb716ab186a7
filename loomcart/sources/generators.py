"""Synthetic customers, products and orders, one row per key row.

Every value is a hash of (seed, column, key), so a row comes out the same on any
executor and after any retry, and orders can name existing customers and products
without a join. Pass ``spark.range(n)`` for n rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcart.schemas import (
    CUSTOMER_SEGMENTS, ORDER_STATUSES, PAYMENT_METHODS, PRODUCT_CATEGORIES,
)

_FIRST = ["Ada", "Ben", "Chen", "Dana", "Elif", "Femi", "Gita", "Hugo"]
_LAST = ["Adler", "Brown", "Costa", "Dubois", "Evans", "Fischer", "Garcia", "Haas"]
_PLACES = [("Berlin", "Germany"), ("Lyon", "France"), ("Pune", "India"), ("Osaka", "Japan"),
           ("Leeds", "United Kingdom"), ("Austin", "United States"), ("Perth", "Australia")]
_WORDS = ["Solid", "Bright", "Quiet", "Rapid", "Plain", "Royal", "Tiny", "Urban"]
_THINGS = ["Lamp", "Chair", "Phone", "Jacket", "Ball", "Puzzle", "Kettle", "Watch"]


def _digest(seed: int, tag: str, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:{tag}:"), key.cast("string")))


def _draw(seed: int, tag: str, key: Column, choices) -> Column:
    """A whole number in [0, choices)."""
    word = F.conv(F.substring(_digest(seed, tag, key), 1, 12), 16, 10).cast("bigint")
    return F.pmod(word, F.lit(choices).cast("bigint"))


def _uuid(seed: int, tag: str, key: Column) -> Column:
    return F.regexp_replace(_digest(seed, tag, key), "^(.{8})(.{4})(.{4})(.{4})(.{12})$",
                            "$1-$2-$3-$4-$5")


def _pick(seed: int, tag: str, key: Column, values: list[str]) -> Column:
    position = _draw(seed, tag, key, len(values)).cast("int") + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), position)


def _cents(seed: int, tag: str, key: Column, low: int, high: int) -> Column:
    """An amount between ``low`` and ``high`` units, to the cent."""
    cents = _draw(seed, tag, key, (high - low) * 100 + 1) + low * 100
    return (cents.cast("decimal(12,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(10,2)")


def _day(seed: int, tag: str, key: Column, first, last) -> Column:
    days = F.datediff(last, first) + 1
    word = F.conv(F.substring(_digest(seed, tag, key), 1, 12), 16, 10).cast("bigint")
    return F.date_add(first, F.pmod(word, days.cast("bigint")).cast("int"))


def generate_customers(keys: DataFrame, seed: int = 0, as_of: str | None = None) -> DataFrame:
    key = F.col("id")
    today = F.to_date(F.lit(as_of)) if as_of else F.current_date()
    decade = F.make_date((F.floor(F.year(today) / 10) * 10).cast("int"), F.lit(1), F.lit(1))
    first, last = _pick(seed, "first", key, _FIRST), _pick(seed, "last", key, _LAST)
    place = _draw(seed, "place", key, len(_PLACES)).cast("int") + 1
    return keys.select(
        _uuid(seed, "customer", key).alias("customer_id"),
        F.concat_ws(" ", first, last).alias("name"),
        F.concat(F.lower(first), F.lit("."), F.lower(last), key.cast("string"),
                 F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+1-555-"), F.lpad(_draw(seed, "phone", key, 10_000_000).cast("string"),
                                          7, "0")).alias("phone"),
        F.element_at(F.array(*[F.lit(c) for c, _ in _PLACES]), place).alias("city"),
        F.element_at(F.array(*[F.lit(c) for _, c in _PLACES]), place).alias("country"),
        _day(seed, "signup", key, decade, today).alias("signup_date"),
        _pick(seed, "segment", key, CUSTOMER_SEGMENTS).alias("segment"),
    )


def generate_products(keys: DataFrame, seed: int = 0) -> DataFrame:
    key = F.col("id")
    return keys.select(
        _uuid(seed, "product", key).alias("product_id"),
        F.concat_ws(" ", _pick(seed, "word", key, _WORDS),
                    _pick(seed, "thing", key, _THINGS)).alias("name"),
        _pick(seed, "category", key, PRODUCT_CATEGORIES).alias("category"),
        _pick(seed, "subcategory", key, _THINGS).alias("subcategory"),
        _cents(seed, "price", key, 10, 1000).alias("price"),
        _cents(seed, "cost", key, 5, 500).alias("cost"),
        F.concat(_pick(seed, "supplier", key, _LAST), F.lit(" Ltd")).alias("supplier"),
    )


def generate_orders(keys: DataFrame, n_customers: int, n_products: int, seed: int = 0,
                    as_of: str | None = None) -> DataFrame:
    """Orders of the current year whose foreign keys point at generated rows 0..n-1."""
    key = F.col("id")
    today = F.to_date(F.lit(as_of)) if as_of else F.current_date()
    new_year = F.make_date(F.year(today), F.lit(1), F.lit(1))
    return keys.select(
        _uuid(seed, "order", key).alias("order_id"),
        _uuid(seed, "customer", _draw(seed, "buyer", key, n_customers)).alias("customer_id"),
        _uuid(seed, "product", _draw(seed, "item", key, n_products)).alias("product_id"),
        (_draw(seed, "quantity", key, 10) + 1).cast("int").alias("quantity"),
        _cents(seed, "price", key, 10, 500).alias("price"),
        _cents(seed, "discount", key, 0, 50).alias("discount"),
        _day(seed, "order_date", key, new_year, today).alias("order_date"),
        _pick(seed, "status", key, ORDER_STATUSES).alias("status"),
        _pick(seed, "payment", key, PAYMENT_METHODS).alias("payment_method"),
        F.concat(_draw(seed, "house", key, 999).cast("string"), F.lit(" "),
                 _pick(seed, "street", key, _LAST), F.lit(" Street")).alias("shipping_address"),
    )

"""Table schemas and the fixed value lists of the domain."""

from __future__ import annotations

from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("country", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("amount", T.DecimalType(18, 4)),
    T.StructField("currency", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("referrer", T.StringType()),
    T.StructField("metadata", T.StringType()),
    T.StructField("_null_flags", T.ArrayType(T.StringType())),
    T.StructField("_has_nulls", T.BooleanType()),
    T.StructField("_kafka_offset", T.LongType()),
    T.StructField("_kafka_partition", T.IntegerType()),
    T.StructField("ingested_at", T.TimestampType()),
])

RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("started_at", T.TimestampType(), False),
    T.StructField("completed_at", T.TimestampType()),
    T.StructField("records_ingested", T.LongType()),
    T.StructField("records_rejected", T.LongType()),
    T.StructField("records_flagged", T.LongType()),
    T.StructField("duplicates_dropped", T.LongType()),
    T.StructField("anomalies_detected", T.LongType()),
    T.StructField("status", T.StringType(), False),
    T.StructField("error_message", T.StringType()),
])

DIM_CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("signup_date", T.DateType()),
    T.StructField("segment", T.StringType()),
])

DIM_PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("subcategory", T.StringType()),
    T.StructField("price", T.DecimalType(10, 2)),
    T.StructField("cost", T.DecimalType(10, 2)),
    T.StructField("supplier", T.StringType()),
    T.StructField("profit_margin", T.DecimalType(10, 4)),
])

DIM_DATE = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("quarter", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
])

FACT_ORDERS = T.StructType([
    T.StructField("order_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("price", T.DecimalType(10, 2)),
    T.StructField("discount", T.DecimalType(10, 2)),
    T.StructField("order_date", T.DateType()),
    T.StructField("status", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("shipping_address", T.StringType()),
    T.StructField("revenue", T.DecimalType(10, 2)),
])

KAFKA_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

# --- Fixed values: they must equal the source system's for results to agree. ---

# canonical field -> the other names producers use for it
FIELD_ALIASES = {
    "user_id": ["userId", "user", "uid"],
    "event_type": ["eventType", "event"],
    "timestamp": ["ts", "time"],
    "session_id": ["sessionId", "sid"],
    "amount": ["amt", "price"],
    "currency": ["curr", "ccy"],
    "event_id": ["evt_id", "id"],
}

REQUIRED_FIELDS = {
    "event": ["event_id", "event_type", "timestamp", "user_id"],
    "transaction": ["transaction_id", "amount", "currency", "user_id", "timestamp"],
    "pageview": ["session_id", "path", "timestamp"],
}

EVENT_TYPES = [
    "CLICK", "PAGEVIEW", "PURCHASE", "LOGIN", "LOGOUT",
    "SIGNUP", "ERROR", "API_CALL", "SEARCH", "DOWNLOAD",
]

CURRENCIES = ["USD", "EUR", "GBP", "INR", "JPY", "AUD", "CAD", "SGD"]

AUDITED_FIELDS = ["user_id", "session_id", "device_type", "country", "referrer"]

ORDER_STATUSES = ["Completed", "Pending", "Cancelled"]
PAYMENT_METHODS = ["Credit Card", "PayPal", "Bank Transfer"]
CUSTOMER_SEGMENTS = ["Premium", "Standard", "Basic"]
PRODUCT_CATEGORIES = ["Electronics", "Clothing", "Home", "Toys", "Sports"]

# --- End of fixed values. ---

# Fields a raw event may carry that some operator reads.
EVENT_FIELDS = [
    "event_id", "event_type", "user_id", "session_id", "timestamp", "country",
    "device_type", "amount", "currency", "path", "referrer", "record_type",
    "transaction_id",
]

# Of these nothing but the text matters: absent and null are the same to every operator.
TEXT_FIELDS = ["path", "record_type", "transaction_id"]

# Every name under which a raw event may carry such a field.
RAW_NAMES = [name for field in EVENT_FIELDS for name in [field, *FIELD_ALIASES.get(field, [])]]

"""The given test tables in the shapes the operators read.

Every adapter uses its whole input table. Where a remainder of an id appears it picks
how a row is written (which alias, which time format), never whether it is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcart.schemas import CURRENCIES
from loomcart.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` with the columns of the canonical events table the marts read."""
    e = table(spark, sf_dir, "events")
    codes = F.array(*[F.lit(c) for c in CURRENCIES])
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.col("user_id").cast("string").alias("user_id"),
        F.concat_ws("-", F.lit("s"), "user_id", F.to_date("ts")).alias("session_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").cast("decimal(18,4)").alias("amount"),
        # One user in nine has no currency.
        F.try_element_at(codes, (F.col("user_id") % 9 + 1).cast("int")).alias("currency"),
        (F.col("user_id") % 7 == 0).alias("_has_nulls"),
        F.timestamp_add("MINUTE", F.lit(5), "ts").alias("ingested_at"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as an extract would hand them over, repeated ids included."""
    li, o = spread(table(spark, sf_dir, "lineitem")), table(spark, sf_dir, "orders")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
        (F.col("l_discount").cast("decimal(10,2)") * 100).cast("decimal(10,2)").alias("discount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("payment_method"),
        F.concat_ws(" ", "l_suppkey", "l_returnflag", "l_linestatus",
                    F.date_format("l_shipdate", "yyyy-MM-dd"),
                    F.col("l_tax").cast("decimal(10,2)")).alias("shipping_address"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two extracts of all customers, of which the first must win; it is not the smaller."""
    c = table(spark, sf_dir, "customer")
    extracts = c.withColumn("extract_no", F.explode(F.array(F.lit(1), F.lit(2))))
    return extracts.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.lit(None).cast("string").alias("city"),
        F.col("c_nationkey").cast("string").alias("country"),
        F.date_format(F.date_add(F.lit("2020-01-01").cast("date"),
                                 (F.col("c_custkey") % 1000 + 2 - F.col("extract_no")).cast("int")),
                      "yyyy-MM-dd").alias("signup_date"),
        F.col("c_mktsegment").alias("segment"),
        F.col("extract_no").alias("_arrival"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two extracts; prices are lower in the second, which must not win."""
    p = table(spark, sf_dir, "part").withColumn("extract_no", F.explode(F.array(F.lit(1), F.lit(2))))
    listed = F.col("p_retailprice").cast("decimal(10,2)")
    price = (listed - F.col("extract_no") + 1).cast("decimal(10,2)")
    return p.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        price.alias("price"),
        (price * F.col("p_size").cast("decimal(4,0)") * F.lit("0.01").cast("decimal(2,2)"))
        .cast("decimal(10,2)").alias("cost"),
        F.lit(None).cast("string").alias("supplier"),
        F.col("extract_no").alias("_arrival"),
    )


def _case(*pairs) -> Column:
    """CASE over ((condition, value), ..., default)."""
    *whens, default = pairs
    result = None
    for condition, value in whens:
        result = F.when(condition, value) if result is None else result.when(condition, value)
    return result.otherwise(default)


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON message per event, in Kafka's columns.

    Key names, time formats, padding, missing, null and bad values change with the ids;
    some messages are cut off or are no objects. ``oracle.RAW_EVENTS`` states the
    expected reading of the same rows.
    """
    e = table(spark, sf_dir, "events")
    e = spread(e, e.count())  # counted from the footers
    i, u = F.col("event_id"), F.col("user_id")
    ts = F.col("ts").cast("timestamp")

    def text(col):
        return F.concat(F.lit('"'), col.cast("string"), F.lit('"'))

    def pick(col, *names):
        return F.element_at(F.array(*[F.lit(n) for n in names]), (col % len(names) + 1).cast("int"))

    def member(name: Column, value: Column) -> Column:
        return F.concat(F.lit('"'), name, F.lit('": '), value)

    null = F.lit("null")
    event_id = _case((i % 47 == 0, None), (i % 53 == 0, member(F.lit("event_id"), null)),
                     member(pick(i, "event_id", "id", "evt_id"),
                            text(F.when(i % 5 == 0, F.concat(F.lit("  e"), i, F.lit(" ")))
                                 .otherwise(F.concat(F.lit("e"), i)))))
    user_name = pick(i, "user_id", "userId", "user", "uid")
    user = _case(
        (i % 19 == 0, None), (i % 17 == 0, member(user_name, null)),
        # Two names for one field: the later one counts.
        (i % 23 == 0, F.concat(F.lit('"uid": "nobody", '), member(F.lit("userId"), text(u)))),
        (i % 3 == 0, member(user_name, u.cast("string"))),
        member(user_name, text(F.concat(F.lit(" "), u))))
    kind = _case((i % 59 == 0, None), (i % 61 == 0, member(F.lit("event"), null)), member(
        pick(i, "event_type", "eventType", "event"),
        text(F.when(i % 2 == 0, F.upper("event_type"))
             .otherwise(F.concat(F.lit(" "), F.col("event_type"), F.lit("  "))))))
    # Backslash-t is the escape sequence inside the JSON text.
    time_value = _case(
        (i % 41 == 0, null),
        (i % 43 == 0, text(F.concat(F.lit("t"), i))),
        (i % 37 == 0, text(F.unix_seconds(ts))),
        (i % 6 == 0, F.unix_seconds(ts).cast("string")),
        (i % 6 == 1, F.unix_millis(ts).cast("string")),
        (i % 6 == 2, text(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))),
        (i % 6 == 3, text(F.date_format(ts + F.expr("INTERVAL '05:30' HOUR TO MINUTE"),
                                        "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+05:30'"))),
        (i % 6 == 4, text(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))),
        text(F.date_format(ts, "yyyy-MM-dd")))
    time_part = _case((i % 67 == 0, None), (i % 79 == 0, F.lit('"timestamp": {"at": 1}')), member(pick(i, "timestamp", "ts", "time"), time_value))
    session = _case((i % 11 == 0, None), (i % 7 == 0, member(F.lit("sid"), null)),
                    member(pick(i, "session_id", "sessionId", "sid"),
                           text(F.concat(F.lit("s"), u, F.lit("\\t")))))
    dollars = F.col("value").cast("decimal(18,2)").cast("string")
    amount = _case((i % 13 == 0, None), (i % 31 == 0, member(F.lit("amt"), null)),
                   (i % 29 == 0, member(F.lit("amount"), text(F.lit("n/a")))),
                   (i % 3 == 0, member(F.lit("amount"), dollars)),
                   (i % 3 == 1, member(F.lit("amt"), text(dollars))),
                   member(F.lit("price"), text(F.concat(F.lit(" "), dollars, F.lit(" ")))))
    code = pick(u, *CURRENCIES, "XXX")
    currency = _case((i % 10 == 0, None), (i % 71 == 0, member(F.lit("ccy"), null)),
                     member(pick(i, "currency", "curr", "ccy"),
                            text(F.when(i % 2 == 0, F.lower(code)).otherwise(code))))
    country = _case((u % 5 == 4, member(F.lit("country"), null)),
                    member(F.lit("country"), text(F.concat(F.lit(" "),
                                                           pick(u, "us", "de", "in", "gb")))))
    device = _case((i % 9 == 0, None), member(F.lit("device_type"),
                                              text(pick(i, "mobile", "desktop"))))
    referrer = _case((i % 4 == 0, None), (i % 4 == 1, member(F.lit("referrer"), null)),
                     member(F.lit("referrer"), text(F.lit("https://example.com/"))))
    path = _case((i % 8 == 0, None), member(F.lit("path"), text(F.concat(F.lit("/p/"), u))))
    record_type = _case(
        (i % 14 == 3, F.concat(F.lit('"record_type": "transaction"'),
                               F.when(i % 28 == 3, F.lit(', "transaction_id": "x1"')).otherwise(""))),
        (i % 14 == 5, F.lit('"record_type": "pageview"')),
        (i % 14 == 7, F.lit('"record_type": "survey"')),
        (i % 14 == 9, F.lit('"record_type": "event"')),
        None)
    body = F.concat(F.lit("{"), F.concat_ws(", ", event_id, user, kind, time_part, session, amount,
                                            currency, country, device, referrer, path, record_type),
                    F.lit(', "props": '), F.col("props"), F.lit("}"))
    value = _case((i % 97 == 5, F.substring_index(body, ",", 2)),
                  (i % 89 == 7, F.lit("[1, 2]")), body)
    return e.select(
        i.cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        (u % 4).cast("int").alias("partition"),
        i.alias("offset"),
        ts.alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def delivered_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message four times, as retries 20 to 60 seconds apart."""
    m = raw_messages(spark, sf_dir)
    gap = (F.col("offset") % 5 * 10 + 20).cast("int")
    copies = m.withColumn("copy", F.explode(F.array(*[F.lit(n) for n in range(4)])))
    return copies.withColumns({
        "timestamp": F.timestamp_add("SECOND", F.col("copy") * gap, "timestamp"),
        "offset": F.col("offset") * 4 + F.col("copy"),
    }).drop("copy")

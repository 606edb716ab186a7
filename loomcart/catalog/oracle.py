"""SQL readings of the adapted test tables, as CTE lists to put before a query."""

from __future__ import annotations

CURRENCY_LIST = "['USD','EUR','GBP','INR','JPY','AUD','CAD','SGD']"

# The canonical events table of adapters.events.
EVT = f"""evt AS (
  SELECT event_id::VARCHAR AS event_id, event_type, user_id::VARCHAR AS user_id,
         's-' || user_id || '-' || ts::DATE AS session_id, ts AS "timestamp",
         value::DECIMAL(18,4) AS amount, {CURRENCY_LIST}[user_id % 9 + 1] AS currency,
         user_id % 7 = 0 AS _has_nulls, ts + INTERVAL 5 MINUTE AS ingested_at
  FROM events)"""

# adapters.raw_orders, then one row per order id with its revenue.
RAW_ORDERS = """raw_orders AS (
  SELECT l_orderkey || '-' || l_linenumber AS order_id, o_custkey::VARCHAR AS customer_id,
         l_partkey::VARCHAR AS product_id, l_quantity::INTEGER AS quantity,
         l_extendedprice::DECIMAL(10,2) AS price,
         (l_discount::DECIMAL(10,2) * 100)::DECIMAL(10,2) AS discount,
         strftime(o_orderdate, '%Y-%m-%d') AS order_date, o_orderstatus AS status,
         o_orderpriority AS payment_method,
         concat_ws(' ', l_suppkey, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d'),
                   l_tax::DECIMAL(10,2)) AS shipping_address
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

FACT = RAW_ORDERS + """,
fact AS (
  SELECT order_id, customer_id, product_id, quantity, price, discount,
         order_date::DATE AS order_date, status, payment_method, shipping_address,
         (quantity::DECIMAL(10,0) * price * (100 - discount) * 0.01)::DECIMAL(10,2) AS revenue
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY customer_id, product_id,
               quantity, price, discount, order_date, status, payment_method,
               shipping_address) AS rn FROM raw_orders) WHERE rn = 1)"""

# What adapters.raw_messages means, one row per decodable message. p_x: the record holds
# the field; r_x: its value as sent under its own name; plain names: after normalising.
EV = f"""src AS (
  SELECT event_id AS i, user_id AS u, ts, event_type AS kind, value AS v,
         i % 97 = 5 OR i % 89 = 7 AS broken FROM events),
typed AS (
  SELECT *,
    i % 47 <> 0 AS p_event_id, i % 19 <> 0 AS p_user_id, i % 59 <> 0 AS p_event_type,
    i % 67 <> 0 AS p_timestamp, i % 11 <> 0 AS p_session_id, i % 13 <> 0 AS p_amount,
    i % 10 <> 0 AS p_currency, i % 9 <> 0 AS p_device_type, i % 4 <> 0 AS p_referrer,
    i % 8 <> 0 AS p_path,
    CASE WHEN i % 67 = 0 OR i % 79 = 0 OR i % 41 = 0 OR i % 43 = 0 OR i % 37 = 0 THEN NULL
         WHEN i % 6 IN (0, 4) THEN date_trunc('second', ts)
         WHEN i % 6 = 1 THEN date_trunc('millisecond', ts)
         WHEN i % 6 IN (2, 3) THEN ts
         ELSE date_trunc('day', ts)::TIMESTAMP END AS t,
    CASE WHEN u % 9 = 8 THEN 'XXX' ELSE {CURRENCY_LIST}[u % 9 + 1] END AS code
  FROM src WHERE NOT broken),
ev AS (
  SELECT *,
    CASE WHEN p_event_id AND i % 53 <> 0 THEN 'e' || i END AS event_id,
    CASE WHEN p_user_id AND i % 17 <> 0 THEN u::VARCHAR END AS user_id,
    CASE WHEN p_event_type AND i % 61 <> 0 THEN upper(kind) END AS event_type,
    t AS "timestamp",
    CASE WHEN NOT p_timestamp THEN NULL
         WHEN i % 79 = 0 THEN '{{"at":1}}'
         WHEN i % 41 = 0 THEN NULL
         WHEN i % 43 = 0 THEN 't' || i
         WHEN i % 37 = 0 THEN (epoch_us(ts) // 1000000)::VARCHAR
         WHEN epoch_us(t) % 1000000 = 0 THEN strftime(t, '%Y-%m-%dT%H:%M:%S') || '+00:00'
         ELSE strftime(t, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS timestamp_text,
    CASE WHEN p_session_id AND i % 7 <> 0 THEN 's' || u END AS session_id,
    CASE WHEN p_amount AND i % 31 <> 0 AND i % 29 <> 0
         THEN v::DECIMAL(18,2)::DOUBLE END AS amount,
    p_amount AND i % 31 <> 0 AND i % 29 = 0 AS bad_amount,
    CASE WHEN p_currency AND i % 71 <> 0 THEN code END AS currency,
    CASE WHEN u % 5 <> 4 THEN ['US','DE','IN','GB'][u % 4 + 1] END AS country,
    CASE WHEN p_device_type THEN CASE i % 2 WHEN 0 THEN 'mobile' ELSE 'desktop' END END
      AS device_type,
    CASE WHEN i % 4 IN (2, 3) THEN 'https://example.com/' END AS referrer,
    CASE WHEN p_path THEN '/p/' || u END AS path,
    CASE i % 14 WHEN 3 THEN 'transaction' WHEN 5 THEN 'pageview' WHEN 7 THEN 'survey'
                WHEN 9 THEN 'event' END AS record_type,
    CASE WHEN i % 28 = 3 THEN 'x1' END AS transaction_id
  FROM typed),
printed AS (
  SELECT *, substr(sha256(concat(
      CASE WHEN p_event_id THEN coalesce(event_id, 'None') ELSE '' END, '|',
      CASE WHEN p_user_id THEN coalesce(user_id, 'None') ELSE '' END, '|',
      CASE WHEN p_event_type THEN coalesce(event_type, 'None') ELSE '' END, '|',
      CASE WHEN p_timestamp THEN coalesce(timestamp_text, 'None') ELSE '' END)), 1, 20)
    AS fingerprint
  FROM ev)"""


def _missing(prefix: str, groups: dict[str, list[str]]) -> str:
    return ",\n      ".join(
        f"CASE WHEN grp = '{group}' AND {prefix}{name} IS NULL "
        f"THEN 'Missing required field: ''{name}''' END"
        for group, names in groups.items() for name in names)


_REQUIRED = {
    "event": ["event_id", "event_type", "timestamp", "user_id"],
    "transaction": ["transaction_id", "amount", "currency", "user_id", "timestamp"],
    "pageview": ["session_id", "path", "timestamp"],
}
_MISSING = _missing("", _REQUIRED).replace("timestamp IS NULL", "timestamp_text IS NULL")
_KINDS = ("'CLICK','PAGEVIEW','PURCHASE','LOGIN','LOGOUT','SIGNUP','ERROR','API_CALL',"
          "'SEARCH','DOWNLOAD'")
_GROUP = """CASE WHEN record_type IN ('transaction', 'pageview') THEN record_type
              ELSE 'event' END AS grp"""


def _checked(source: str, name: str) -> str:
    """``source`` rows with flags, errors, warnings and outcome, as CTE ``name``."""
    return f"""{name}_text AS (
  SELECT *,
    concat_ws('; ',
      {_MISSING},
      CASE WHEN p_currency AND (currency IS NULL OR NOT list_contains({CURRENCY_LIST}, currency))
           THEN 'Invalid currency: ''' || coalesce(currency, 'None') || '''' END) AS errors,
    CASE WHEN p_event_type AND (event_type IS NULL OR event_type NOT IN ({_KINDS}))
         THEN 'Unrecognised event_type: ''' || coalesce(event_type, 'None') || ''''
         ELSE '' END AS warnings,
    concat_ws('; ',
      CASE WHEN p_user_id AND user_id IS NULL THEN 'user_id' END,
      CASE WHEN p_session_id AND session_id IS NULL THEN 'session_id' END,
      CASE WHEN country IS NULL THEN 'country' END,
      CASE WHEN p_referrer AND referrer IS NULL THEN 'referrer' END) AS null_flags
  FROM (SELECT *, {_GROUP} FROM {source})),
{name} AS (
  SELECT *, CASE WHEN errors <> '' THEN 'rejected' WHEN warnings <> '' THEN 'flagged'
            ELSE 'valid' END AS outcome
  FROM {name}_text)"""


CHECKED = EV + ",\n" + _checked("printed", "checked")

# Four deliveries per message, as adapters.delivered_messages makes them.
DELIVERED = CHECKED + """,
delivered AS (
  SELECT c.*, copy, ts + to_seconds(copy * (i % 5 * 10 + 20)) AS arrival,
         epoch_us(ts + to_seconds(copy * (i % 5 * 10 + 20))) // 1000 AS _kafka_timestamp,
         (u % 4)::INTEGER AS _kafka_partition, i * 4 + copy AS _kafka_offset
  FROM checked c, (SELECT unnest([0, 1, 2, 3]) AS copy))"""

# The first delivery of every fingerprint, and the accepted ones with their z-scores.
PROCESSED = DELIVERED + """,
firsts AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY fingerprint
        ORDER BY _kafka_timestamp, _kafka_partition, _kafka_offset) AS rn FROM delivered)
  WHERE rn = 1),
good AS (SELECT * FROM firsts WHERE outcome <> 'rejected'),
stats AS (
  SELECT _kafka_offset, amount, count(*) OVER w AS n, avg(amount) OVER w AS mean,
         stddev_samp(amount) OVER w AS sd
  FROM good WHERE amount IS NOT NULL
  WINDOW w AS (ORDER BY _kafka_timestamp, _kafka_partition, _kafka_offset
               ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)),
alerts AS (
  SELECT *, abs(amount - mean) / sd AS z FROM stats
  WHERE n >= 10 AND sd > 0 AND abs(amount - mean) / sd > 3.0)"""


def decimals(expr: str, places: int) -> str:
    """A number as text with fixed decimals, ties away from zero."""
    return f"round(({expr})::DECIMAL(24,9), {places})::DECIMAL(24,{places})::VARCHAR"


def alert_text(amount: str, z: str, mean: str, sd: str) -> str:
    return (f"'ANOMALY: amount=' || {decimals(amount, 2)} || ' is ' || {decimals(z, 1)} || "
            f"' std deviations from mean=' || {decimals(mean, 2)} || ' (stdev=' || "
            f"{decimals(sd, 2)} || ')'")

"""Queries over the events table and over raw event messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcart.catalog import adapters as given
from loomcart.catalog.oracle import (
    CHECKED, CURRENCY_LIST, DELIVERED, EV, EVT, PROCESSED, alert_text, decimals,
)
from loomcart.catalog.registry import query, six, six_sql, text_list
from loomcart.operators import access, anomaly, dedup, sinks
from loomcart.operators.integrity import check_references
from loomcart.operators.key_index import KeyIndex
from loomcart.operators.key_table import KeyTable, unknown_keys
from loomcart.operators.normalize import from_columns, normalize, raw_event_columns
from loomcart.operators.quality import duplicate_keys
from loomcart.operators.validate import accepted, audit_nulls, rejected, validate
from loomcart.plans import events_job, marts
from loomcart.session import cut_lineage, scratch_path
from loomcart.sources import events as source


def _messages(spark, sf_dir) -> DataFrame:
    return source.parse_kafka(given.raw_messages(spark, sf_dir))


def _deliveries(spark, sf_dir) -> DataFrame:
    return source.parse_kafka(given.delivered_messages(spark, sf_dir))


def _normal(spark, sf_dir) -> DataFrame:
    """Normalised messages; the offset of a message is its event's number."""
    return normalize(source.decoded(_messages(spark, sf_dir)))


# --- views over the events table ---

_VOLUME = """SELECT "timestamp"::DATE AS event_date, event_type, count(*) AS event_count,
       count(DISTINCT user_id) AS unique_users, sum(amount)::DOUBLE AS total_amount,
       """ + six_sql("sum(amount)::DOUBLE / count(amount)") + """ AS avg_amount
FROM evt GROUP BY 1, 2"""


def _plain_volume(volume: DataFrame) -> DataFrame:
    mean = F.col("total_amount").cast("double") / F.col("event_count")
    return volume.withColumns({"avg_amount": six(mean),
                               "total_amount": F.col("total_amount").cast("double")})


@query("daily_event_volume", f"WITH {EVT} {_VOLUME}")
def daily_event_volume(spark, sf_dir):
    return _plain_volume(marts.daily_event_volume_report(given.events(spark, sf_dir)))


_HOURLY = """SELECT date_trunc('hour', "timestamp") AS hour, currency, count(*) AS transaction_count,
       sum(amount)::DOUBLE AS total_revenue, """ + six_sql("sum(amount)::DOUBLE / count(amount)") + """
         AS avg_transaction,
       max(amount)::DOUBLE AS max_transaction, min(amount)::DOUBLE AS min_transaction
FROM evt WHERE event_type = 'purchase' AND amount IS NOT NULL AND currency IS NOT NULL
GROUP BY 1, 2"""


def plain_revenue(revenue: DataFrame) -> DataFrame:
    mean = F.col("total_revenue").cast("double") / F.col("transaction_count")
    return revenue.withColumns({"avg_transaction": six(mean), **{
        c: F.col(c).cast("double")
        for c in ("total_revenue", "max_transaction", "min_transaction")}})


HOURLY_SQL = f"WITH {EVT} {_HOURLY}"


@query("hourly_revenue", HOURLY_SQL)
def _(spark, sf_dir):
    return plain_revenue(marts.hourly_revenue_report(given.events(spark, sf_dir)))


@query("user_funnel", f"""WITH {EVT}, daily AS ({_VOLUME}), counts AS (
  SELECT event_date, sum(CASE WHEN event_type = 'signup' THEN event_count ELSE 0 END)::BIGINT AS signups,
         sum(CASE WHEN event_type = 'login' THEN event_count ELSE 0 END)::BIGINT AS logins,
         sum(CASE WHEN event_type = 'purchase' THEN event_count ELSE 0 END)::BIGINT AS purchases
  FROM daily GROUP BY 1)
SELECT *, round(100.0::DOUBLE * purchases / nullif(signups, 0), 2) AS signup_to_purchase_pct
FROM counts""")
def _(spark, sf_dir):
    return marts.user_funnel(marts.daily_event_volume(given.events(spark, sf_dir)))


@query("event_metrics", f"""WITH {EVT}
SELECT count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
       (sum(amount) FILTER (WHERE event_type = 'purchase'))::DOUBLE AS total_revenue,
       count(*) FILTER (WHERE _has_nulls) AS null_flagged_count,
       min("timestamp") AS earliest_event, max("timestamp") AS latest_event FROM evt""")
def _(spark, sf_dir):
    return marts.event_metrics(given.events(spark, sf_dir)).withColumn(
        "total_revenue", F.col("total_revenue").cast("double"))


@query("view_unique_keys", f"""WITH {EVT}, v AS ({_HOURLY})
SELECT hour, currency, 2 AS key_count FROM v WHERE hour(hour) = 7""")
def _(spark, sf_dir):
    """The stored view, to which a second refresh has added the hours from seven to eight."""
    path = scratch_path(spark, "view")
    view = marts.hourly_revenue(given.events(spark, sf_dir))
    sinks.refresh(view, path)
    view.filter(F.hour("hour") == 7).write.mode("append").parquet(path)
    return duplicate_keys(spark.read.parquet(path), ["hour", "currency"])


# --- access paths ---

@query("events_by_type_range", f"""WITH {EVT} SELECT event_id, event_type, "timestamp" FROM evt
WHERE event_type = 'purchase' AND "timestamp" >= TIMESTAMP '2024-01-03'
  AND "timestamp" < TIMESTAMP '2024-01-28'""")
def _(spark, sf_dir):
    return access.events_by_type(given.events(spark, sf_dir), "purchase", "2024-01-03",
                                 "2024-01-28").select("event_id", "event_type", "timestamp")


@query("events_by_user", f"""WITH {EVT} SELECT user_id, "timestamp", event_id FROM evt""")
def _(spark, sf_dir):
    return access.events_by_user(given.events(spark, sf_dir)).select("user_id", "timestamp", "event_id")


@query("events_by_session", f"WITH {EVT} SELECT session_id, event_id FROM evt")
def _(spark, sf_dir):
    return access.events_by_session(given.events(spark, sf_dir)).select("session_id", "event_id")


@query("events_of_one_user", f"""WITH {EVT} SELECT event_id, user_id, "timestamp" FROM evt
WHERE user_id = (SELECT min(user_id) FROM evt)""")
def _(spark, sf_dir):
    """Read from the stored layout, which lets row groups without the user be skipped."""
    events = given.events(spark, sf_dir)
    path = scratch_path(spark, "clustered")
    sinks.write_events(events, path)
    user = events.agg(F.min("user_id")).first()[0]
    return access.events_by_user(spark.read.parquet(path), user).select("event_id", "user_id", "timestamp")


@query("events_of_one_session", f"""WITH {EVT} SELECT event_id, session_id, "timestamp" FROM evt
WHERE session_id = (SELECT max(session_id) FROM evt)""")
def _(spark, sf_dir):
    events = given.events(spark, sf_dir)
    path = scratch_path(spark, "clustered")
    sinks.write_events(events, path)
    session = events.agg(F.max("session_id")).first()[0]
    return access.events_by_session(spark.read.parquet(path), session).select("event_id", "session_id", "timestamp")


@query("purchases_by_time", f"""WITH {EVT} SELECT "timestamp", amount::DOUBLE AS amount, currency
FROM evt WHERE event_type = 'purchase' AND amount IS NOT NULL""")
def _(spark, sf_dir):
    return access.purchases_by_time(given.events(spark, sf_dir)).withColumn(
        "amount", F.col("amount").cast("double"))


@query("null_flagged_events", f"""WITH {EVT} SELECT event_id, ingested_at FROM evt WHERE _has_nulls""")
def _(spark, sf_dir):
    return access.null_flagged(given.events(spark, sf_dir)).select("event_id", "ingested_at")


# --- decoding and normalising ---

@query("kafka_parse", f"""WITH {EV} SELECT 'events' AS _kafka_topic, i AS _kafka_offset, (u % 4)::INTEGER AS _kafka_partition,
       epoch_us(ts) // 1000 AS _kafka_timestamp FROM ev""")
def _(spark, sf_dir):
    return source.decoded(_messages(spark, sf_dir)).drop("fields", "raw")


@query("quarantine", f"""WITH {EV} SELECT i AS _kafka_offset, (u % 4)::INTEGER AS _kafka_partition
FROM src WHERE broken""")
def _(spark, sf_dir):
    return source.quarantined(_messages(spark, sf_dir)).select("_kafka_offset", "_kafka_partition")


@query("landing_parse", f"""WITH {EV} SELECT event_id, user_id, path FROM ev""")
def _(spark, sf_dir):
    """Messages written as lines of text files and read back."""
    path = scratch_path(spark, "landing")
    given.raw_messages(spark, sf_dir).select(F.col("value").cast("string")).write.text(path)
    parsed = source.parse_landing(source.read_landing(spark, path))
    return normalize(source.decoded(parsed)).select("event_id", "user_id", "path")


@query("normalize_aliases", f"""WITH {EV} SELECT i AS _kafka_offset, event_id, user_id, event_type,
       session_id, p_event_id, p_user_id, p_session_id FROM ev""")
def _(spark, sf_dir):
    return _normal(spark, sf_dir).select(
        "_kafka_offset", "event_id", "user_id", "event_type", "session_id",
        *[F.col("_present")[n].alias(f"p_{n}") for n in ("event_id", "user_id", "session_id")])


@query("normalize_amount", f"""WITH {EV} SELECT i AS _kafka_offset, amount,
       bad_amount AS _bad_amount FROM ev""")
def _(spark, sf_dir):
    return _normal(spark, sf_dir).select("_kafka_offset", "amount", "_bad_amount")


@query("normalize_timestamp", f"""WITH {EV} SELECT i AS _kafka_offset, "timestamp", timestamp_text,
       CASE WHEN p_timestamp AND timestamp_text IS NOT NULL THEN t IS NOT NULL END AS ts_parse_ok
FROM ev""")
def _(spark, sf_dir):
    return _normal(spark, sf_dir).select("_kafka_offset", "timestamp", "timestamp_text", "ts_parse_ok")


@query("normalize_strings", f"""WITH {EV} SELECT i AS _kafka_offset, event_type, currency, country,
       event_id, user_id, session_id, device_type, referrer, path, record_type, transaction_id
FROM ev""")
def _(spark, sf_dir):
    return _normal(spark, sf_dir).select(
        "_kafka_offset", "event_type", "currency", "country", "event_id", "user_id", "session_id",
        "device_type", "referrer", "path", "record_type", "transaction_id")


# --- duplicates ---

@query("fingerprint", f"""WITH {EV} SELECT i AS _kafka_offset, fingerprint FROM printed""")
def _(spark, sf_dir):
    return dedup.fingerprint(_normal(spark, sf_dir)).select("_kafka_offset", "fingerprint")


@query("dedup_batch", f"""WITH {DELIVERED}
SELECT fingerprint, count(*) AS copies, min(_kafka_timestamp) AS _kafka_timestamp,
       arg_min(_kafka_offset, (_kafka_timestamp, _kafka_partition, _kafka_offset)) AS _kafka_offset
FROM delivered GROUP BY 1""")
def _(spark, sf_dir):
    rows = events_job.clean(_deliveries(spark, sf_dir)).select("fingerprint", *source.KAFKA_ORDER)
    return dedup.dedup_batch(rows, source.KAFKA_ORDER, copies="copies").drop("_kafka_partition", "_kafka_topic")


@query("dedup_window", f"""WITH RECURSIVE {DELIVERED},
numbered AS (
  SELECT fingerprint, _kafka_timestamp AS t, _kafka_offset, row_number() OVER (
    PARTITION BY fingerprint ORDER BY _kafka_timestamp, _kafka_partition, _kafka_offset) AS rn
  FROM delivered),
walk AS (
  SELECT fingerprint, rn, _kafka_offset, t AS last_kept, TRUE AS kept FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.fingerprint, n.rn, n._kafka_offset,
         CASE WHEN n.t - w.last_kept > 60000 THEN n.t ELSE w.last_kept END,
         n.t - w.last_kept > 60000
  FROM walk w JOIN numbered n ON n.fingerprint = w.fingerprint AND n.rn = w.rn + 1)
SELECT fingerprint, _kafka_offset FROM walk WHERE kept""")
def _(spark, sf_dir):
    rows = cut_lineage(events_job.clean(_deliveries(spark, sf_dir)).select(
        "fingerprint", *source.KAFKA_ORDER))
    return dedup.dedup_window(rows, "_kafka_timestamp", source.KAFKA_ORDER).select(
        "fingerprint", "_kafka_offset")


@query("dedup_stats", f"""WITH {DELIVERED}, n AS (
  SELECT count(*) AS seen, count(DISTINCT fingerprint) AS live FROM delivered)
SELECT seen AS total_processed, seen - live AS duplicates_dropped,
       round(100.0::DOUBLE * (seen - live) / seen, 2) AS dedup_rate_pct, live AS window_size,
       60 AS window_seconds FROM n""")
def _(spark, sf_dir):
    return dedup.dedup_stats(events_job.clean(_deliveries(spark, sf_dir)))


# --- audit, validation, references ---

@query("null_audit", f"""WITH {CHECKED} SELECT i AS _kafka_offset, null_flags AS _null_flags,
       null_flags <> '' AS _has_nulls FROM checked""")
def _(spark, sf_dir):
    return audit_nulls(_normal(spark, sf_dir)).select(
        "_kafka_offset", text_list("_null_flags"), "_has_nulls")


@query("validate_errors", f"""WITH {CHECKED} SELECT i AS _kafka_offset, errors, warnings FROM checked""")
def _(spark, sf_dir):
    return validate(_normal(spark, sf_dir)).select(
        "_kafka_offset", text_list("errors"), text_list("warnings"))


@query("validate_outcome", f"""WITH {CHECKED} SELECT outcome, count(*) AS records,
       count_if(outcome = 'rejected')::BIGINT AS dropped FROM checked GROUP BY 1""")
def _(spark, sf_dir):
    checked = validate(_normal(spark, sf_dir))
    return (accepted(checked).select("outcome", F.lit(0).alias("drop"))
            .unionByName(rejected(checked).select("outcome", F.lit(1).alias("drop")))
            .groupBy("outcome").agg(F.count(F.lit(1)).alias("records"), F.sum("drop").alias("dropped")))


@query("validate_as_sent", f"""WITH {EV}, sent AS (
  SELECT *, CASE WHEN record_type IN ('transaction', 'pageview') THEN record_type ELSE 'event' END AS grp,
    p_event_id AND (i % 53 = 0 OR i % 3 = 0) AS h_event_id,
    p_event_id AND i % 53 <> 0 AND i % 3 = 0 AS n_event_id,
    p_user_id AND i % 4 = 0 AND i % 17 <> 0 AND i % 23 <> 0 AS n_user_id,
    p_event_type AND i % 61 <> 0 AND i % 3 = 0 AS n_event_type,
    p_timestamp AND (i % 79 = 0 OR (i % 3 = 0 AND i % 41 <> 0)) AS n_timestamp,
    p_session_id AND i % 7 <> 0 AND i % 3 = 0 AS n_session_id,
    p_amount AND i % 31 <> 0 AND (i % 29 = 0 OR i % 3 = 0) AS n_amount,
    p_amount AND i % 31 <> 0 AND i % 29 = 0 AS bad,
    p_currency AND i % 71 <> 0 AND i % 3 = 0 AS n_currency,
    CASE WHEN i % 2 = 0 THEN lower(code) ELSE code END AS sent_code,
    CASE WHEN i % 2 = 0 THEN upper(kind) ELSE ' ' || kind || '  ' END AS sent_kind
  FROM ev)
SELECT i AS _kafka_offset,
  concat_ws('; ',
    CASE WHEN grp = 'event' AND NOT n_event_id THEN 'Missing required field: ''event_id''' END,
    CASE WHEN grp = 'event' AND NOT n_event_type THEN 'Missing required field: ''event_type''' END,
    CASE WHEN grp = 'event' AND NOT n_timestamp THEN 'Missing required field: ''timestamp''' END,
    CASE WHEN grp = 'event' AND NOT n_user_id THEN 'Missing required field: ''user_id''' END,
    CASE WHEN grp = 'transaction' AND transaction_id IS NULL
         THEN 'Missing required field: ''transaction_id''' END,
    CASE WHEN grp = 'transaction' AND NOT n_amount THEN 'Missing required field: ''amount''' END,
    CASE WHEN grp = 'transaction' AND NOT n_currency THEN 'Missing required field: ''currency''' END,
    CASE WHEN grp = 'transaction' AND NOT n_user_id THEN 'Missing required field: ''user_id''' END,
    CASE WHEN grp = 'transaction' AND NOT n_timestamp THEN 'Missing required field: ''timestamp''' END,
    CASE WHEN grp = 'pageview' AND NOT n_session_id THEN 'Missing required field: ''session_id''' END,
    CASE WHEN grp = 'pageview' AND NOT p_path THEN 'Missing required field: ''path''' END,
    CASE WHEN grp = 'pageview' AND NOT n_timestamp THEN 'Missing required field: ''timestamp''' END,
    CASE WHEN bad THEN 'Field ''amount'' must be numeric, got: str' END,
    CASE WHEN p_timestamp AND i % 79 = 0
         THEN 'Field ''timestamp'' must be int/float (epoch) or ISO string' END,
    CASE WHEN n_currency AND NOT list_contains({CURRENCY_LIST}, sent_code)
         THEN 'Invalid currency: ''' || sent_code || '''' END) AS errors,
  CASE WHEN n_event_type AND sent_kind NOT IN ('CLICK','PURCHASE','SIGNUP','ERROR')
       THEN 'Unrecognised event_type: ''' || sent_kind || '''' ELSE '' END AS warnings
FROM sent""")
def _(spark, sf_dir):
    """Records validated as they came, with no aliases resolved and nothing cleaned."""
    sent = raw_event_columns(source.decoded(_messages(spark, sf_dir)))
    return validate(sent).select("_kafka_offset", text_list("errors"), text_list("warnings"))


@query("ri_users", f"""WITH {EVT}
SELECT event_id, CASE WHEN user_id IN (SELECT c_custkey::VARCHAR FROM customer WHERE c_acctbal > 0)
       THEN '' ELSE 'Unknown user_id: ''' || user_id || '''' END AS violations FROM evt""")
def _(spark, sf_dir):
    known = given.table(spark, sf_dir, "customer").filter("c_acctbal > 0").select("c_custkey")
    checked = check_references(from_columns(given.events(spark, sf_dir)), users=known,
                               spread_by=["event_id"])
    return checked.select("event_id", text_list("violations"))


@query("ri_sessions", f"""WITH {EVT}, known AS (
  SELECT DISTINCT session_id FROM evt WHERE event_type = 'signup')
SELECT event_id, CASE WHEN session_id IN (SELECT session_id FROM known) THEN ''
       ELSE 'Unknown session_id: ''' || session_id || '''' END AS violations FROM evt""")
def _(spark, sf_dir):
    """Sessions are known when they hold a signup. Joined by salted keys, as a key table
    too large to broadcast would be."""
    events = from_columns(given.events(spark, sf_dir))
    known = events.filter(access.is_type("signup")).select("session_id")
    checked = check_references(events, sessions=known, spread_by=["event_id"], limit=0)
    return checked.select("event_id", text_list("violations"))


@query("ri_registered", f"""WITH {EVT}, batches AS (SELECT 0 AS batch UNION ALL SELECT 1)
SELECT event_id, batch, concat_ws('; ',
  CASE WHEN user_id NOT IN (SELECT c_custkey::VARCHAR FROM customer WHERE c_acctbal > 0)
        AND (batch = 0 OR user_id NOT IN (SELECT c_custkey::VARCHAR FROM customer))
       THEN 'Unknown user_id: ''' || user_id || '''' END,
  CASE WHEN session_id NOT IN (SELECT session_id FROM evt WHERE event_type = 'signup')
        AND (batch = 0 OR session_id NOT IN (SELECT session_id FROM evt WHERE event_type = 'login'))
       THEN 'Unknown session_id: ''' || session_id || '''' END) AS violations
FROM evt, batches""")
def _(spark, sf_dir):
    """Customers in credit and sessions with a signup are registered first; the others,
    and sessions with a login, between the two checks."""
    events = cut_lineage(from_columns(given.events(spark, sf_dir)))
    customers = given.table(spark, sf_dir, "customer")
    users, sessions = (KeyTable(spark, scratch_path(spark, name)) for name in ("users", "sessions"))
    tables = {"user_id": users, "session_id": sessions}
    users.register(customers.filter("c_acctbal > 0").select("c_custkey"))
    sessions.register(events.filter(access.is_type("signup")).select("session_id"))
    first = cut_lineage(unknown_keys(events, tables, ["event_id"]))
    users.register(customers.select("c_custkey"))
    sessions.register(events.filter(access.is_type("login")).select("session_id"))
    second = unknown_keys(events, tables, ["event_id"])
    return first.withColumn("batch", F.lit(0)).unionByName(second.withColumn("batch", F.lit(1))).select(
        "event_id", "batch", text_list("violations"))


# --- anomalies ---

_Z = """abs(amount - mean) / sd"""
_SCORED = """scored AS (
  SELECT event_id, event_type, amount::DOUBLE AS amount, count(*) OVER w AS n,
         avg(amount::DOUBLE) OVER w AS mean, stddev_samp(amount::DOUBLE) OVER w AS sd
  FROM evt WHERE amount IS NOT NULL
  WINDOW w AS ({part} ORDER BY "timestamp", event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)),
zed AS (SELECT *, CASE WHEN n >= 10 AND sd > 0 THEN abs(amount - mean) / sd END AS z FROM scored)"""
_ORDER = ["timestamp", "event_id"]
_SCORE_COLUMNS = f"""n AS window_count, {six_sql('mean')} AS window_mean,
       {six_sql('sd')} AS window_stdev, {six_sql('z')} AS z_score,
       coalesce(z > 3.0, FALSE) AS is_alert"""


def scores(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns, "window_count", *[six(c).alias(c) for c in (
        "window_mean", "window_stdev", "z_score")], "is_alert")


@query("anomaly_amount", f"""WITH {EVT}, {_SCORED.format(part='')}
SELECT event_id, {_SCORE_COLUMNS} FROM zed""")
def _(spark, sf_dir):
    return scores(anomaly.check_amounts(given.events(spark, sf_dir), _ORDER), "event_id")


_BY_TYPE = f"WITH {EVT}, {_SCORED.format(part='PARTITION BY event_type')}"
BY_TYPE_SQL = f"{_BY_TYPE} SELECT event_id, event_type, {_SCORE_COLUMNS} FROM zed"
BY_TYPE_ALERTS_SQL = (f"{_BY_TYPE} SELECT event_id, event_type, {alert_text('amount', 'z', 'mean', 'sd')} "
                      "AS _anomaly_alert FROM zed WHERE z > 3.0")


@query("anomaly_by_type", BY_TYPE_SQL)
def _(spark, sf_dir):
    """One sequence per event type."""
    return scores(anomaly.check_amounts(given.events(spark, sf_dir), _ORDER, keys=["event_type"]),
                   "event_id", "event_type")


@query("anomaly_alert_text", f"""WITH {EVT}, {_SCORED.format(part='')}
SELECT event_id, {alert_text('amount', 'z', 'mean', 'sd')} AS _anomaly_alert FROM zed WHERE z > 3.0""")
def _(spark, sf_dir):
    scored = anomaly.check_amounts(given.events(spark, sf_dir), _ORDER)
    return scored.filter("is_alert").select("event_id", "_anomaly_alert")


@query("anomaly_batch_size", f"""WITH {EVT}, sizes AS (
  SELECT date_trunc('hour', "timestamp") AS batch_id, count(*) AS batch_size FROM evt GROUP BY 1),
stats AS (
  SELECT *, count(*) OVER w AS n, avg(batch_size) OVER w AS mean, stddev_samp(batch_size) OVER w AS sd
  FROM sizes WINDOW w AS (ORDER BY batch_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)),
zed AS (SELECT *, CASE WHEN n >= 5 AND sd > 0 THEN abs(batch_size - mean) / sd END AS z FROM stats)
SELECT batch_id, batch_size, {_SCORE_COLUMNS},
       CASE WHEN z > 3.0 THEN 'ANOMALY: batch_size=' || batch_size || ' is ' || {decimals('z', 1)} ||
         ' std deviations from mean=' || {decimals('mean', 1)} END AS _anomaly_alert
FROM zed""")
def _(spark, sf_dir):
    hour = F.date_trunc("hour", F.col("timestamp").cast("timestamp"))
    scored = anomaly.check_batch_sizes(anomaly.batch_sizes(given.events(spark, sf_dir), hour))
    return scores(scored, "batch_id", "batch_size", "_anomaly_alert")


# --- the whole event job ---

_RUNS: dict[tuple[str, str], events_job.Processed] = {}


def processed(spark: SparkSession, sf_dir: str) -> events_job.Processed:
    """The event job over all deliveries, run once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        _RUNS[key] = events_job.process(_deliveries(spark, sf_dir))
    return _RUNS[key]


@query("process_events", f"""WITH {PROCESSED}
SELECT g._kafka_offset, g.event_id, g.event_type, g.user_id, g.session_id, g."timestamp", g.country,
       g.device_type, g.amount, g.currency, g.path, g.referrer, g.null_flags AS _null_flags, g.outcome,
       a._kafka_offset IS NOT NULL AS is_alert
FROM good g LEFT JOIN alerts a ON g._kafka_offset = a._kafka_offset""")
def _(spark, sf_dir):
    return processed(spark, sf_dir).accepted.select(
        "_kafka_offset", "event_id", "event_type", "user_id", "session_id", "timestamp", "country",
        "device_type", "amount", "currency", "path", "referrer", text_list("_null_flags"), "outcome",
        F.col("_anomaly_alert").isNotNull().alias("is_alert"))


@query("process_rejected", f"""WITH {PROCESSED}
SELECT _kafka_offset, errors, fingerprint FROM firsts WHERE outcome = 'rejected'""")
def _(spark, sf_dir):
    return processed(spark, sf_dir).rejected.select("_kafka_offset", text_list("errors"), "fingerprint")


@query("process_alerts", f"""WITH {PROCESSED}
SELECT _kafka_offset, amount, {alert_text('amount', 'z', 'mean', 'sd')} AS _anomaly_alert FROM alerts""")
def _(spark, sf_dir):
    return processed(spark, sf_dir).alerts.select("_kafka_offset", "amount", "_anomaly_alert")


@query("process_metrics", f"""WITH {PROCESSED}
SELECT (SELECT count(*) FROM delivered) AS ingested,
       (SELECT count(*) FROM firsts WHERE outcome = 'rejected') AS rejected,
       (SELECT count(*) FROM firsts WHERE outcome = 'flagged') AS flagged,
       (SELECT count(*) FROM delivered) - (SELECT count(*) FROM firsts) AS duplicates_dropped,
       (SELECT count(*) FROM alerts) AS anomalies_detected,
       (SELECT count(*) FROM good) AS inserted""")
def _(spark, sf_dir):
    return processed(spark, sf_dir).metrics


# --- sinks ---

@query("insert_ignore", f"""WITH {EVT}
SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'first load' ELSE 'second load' END AS loaded,
       amount::DOUBLE AS amount FROM evt""")
def _(spark, sf_dir):
    """Purchases are loaded first; the second load offers all events, twice each."""
    events = given.events(spark, sf_dir)
    path = scratch_path(spark, "insert")
    first = events.filter(access.is_type("purchase")).withColumn("loaded", F.lit("first load"))
    sinks.insert_ignore(first, path, order_by=["timestamp"])
    again = events.withColumn("loaded", F.explode(F.array(F.lit("second load"), F.lit("third"))))
    sinks.insert_ignore(again, path, order_by=["loaded"])
    return spark.read.parquet(path).select("event_id", "loaded", F.col("amount").cast("double"))


@query("key_index", f"""WITH {EVT}
SELECT event_id FROM evt WHERE event_type IN ('purchase', 'login')""")
def _(spark, sf_dir):
    """Purchases and logins are stored by two batches; every event id and as many strange
    ones are looked up."""
    events = given.events(spark, sf_dir)
    path = scratch_path(spark, "indexed")
    for kind in ("purchase", "login"):
        sinks.insert_ignore(events.filter(access.is_type(kind)), path, order_by=["timestamp"])
    strange = events.select(F.concat(F.lit("x"), "event_id").alias("event_id"))
    keys = events.select("event_id").union(strange)
    return KeyIndex(spark, path, "event_id").lookup(keys).keys


@query("run_log_upsert", f"""WITH {EVT}, log AS (
  SELECT "timestamp"::DATE::VARCHAR AS run_id, hour("timestamp") AS h, count(*) AS n,
         min("timestamp") AS started, max("timestamp") AS ended,
         count_if(_has_nulls) AS flagged
  FROM evt GROUP BY 1, 2)
SELECT run_id, arg_min(started, h) AS started_at, arg_max(ended, h) AS completed_at,
       arg_max(n, h) AS records_ingested, arg_min(flagged, h)::BIGINT AS records_flagged,
       arg_max('hour ' || h, h) AS status FROM log GROUP BY 1""")
def _(spark, sf_dir):
    """A run per day with a log entry per hour: later entries update three columns only."""
    ts = F.col("timestamp").cast("timestamp")
    none = F.lit(None)
    log = given.events(spark, sf_dir).groupBy(
        F.to_date("timestamp").cast("string").alias("run_id"), F.hour(ts).alias("logged_at")).agg(
        F.min(ts).alias("started_at"), F.max(ts).alias("completed_at"),
        F.count(F.lit(1)).alias("records_ingested"), F.count_if("_has_nulls").alias("records_flagged"),
    ).withColumns({"records_rejected": none.cast("bigint"), "duplicates_dropped": none.cast("bigint"),
                   "anomalies_detected": none.cast("bigint"), "error_message": none.cast("string"),
                   "status": F.concat(F.lit("hour "), "logged_at")})
    return sinks.current_runs(log, ["logged_at"]).select(
        "run_id", "started_at", "completed_at", "records_ingested", "records_flagged", "status")


@query("refresh_view", f"WITH {EVT} {_VOLUME}")
def _(spark, sf_dir):
    """A view built from purchases only, then refreshed for every day that has events."""
    events = given.events(spark, sf_dir)
    path = scratch_path(spark, "volume")
    partial = marts.daily_event_volume(events.filter(access.is_type("purchase")))
    partial.write.partitionBy("event_date").parquet(path)
    days = events.select(F.to_date("timestamp").alias("day")).distinct()
    sinks.refresh_days(events, days, marts.daily_event_volume, path)
    return _plain_volume(spark.read.parquet(path)).select(
        "event_date", "event_type", "event_count", "unique_users", "total_amount", "avg_amount")


@query("event_layout", f"""WITH {EVT} SELECT "timestamp"::DATE AS event_date, event_id, event_type,
       amount::DOUBLE AS amount FROM evt""")
def _(spark, sf_dir):
    path = scratch_path(spark, "events")
    sinks.write_events(given.events(spark, sf_dir), path)
    return spark.read.parquet(path).select("event_date", "event_id", "event_type",
                                           F.col("amount").cast("double"))

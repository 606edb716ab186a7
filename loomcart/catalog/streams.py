"""Queries that run as streams over files and are read back when the stream is drained."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcart.catalog import adapters as given
from loomcart.catalog.events import BY_TYPE_ALERTS_SQL, BY_TYPE_SQL, HOURLY_SQL, plain_revenue, scores
from loomcart.catalog.oracle import CHECKED, DELIVERED, PROCESSED, alert_text
from loomcart.catalog.registry import query, six, six_sql, text_list
from loomcart.operators.sinks import current_runs, insert_ignore
from loomcart.plans.events_job import classify, clean, still_live, unseen
from loomcart.schemas import KAFKA_SCHEMA
from loomcart.session import STATE_STORE, scratch_path, store
from loomcart.sources.events import KAFKA_ORDER, parse_kafka
from loomcart.streaming.anomaly import alerts, score_stream
from loomcart.streaming.dedup import dedup_stream, live_keys, stream_stats
from loomcart.streaming.ingest import checkpoint_id, drop_recent, load_state, output, start_ingest, write_batch
from loomcart.streaming.rollups import store_views
from loomcart.streaming.runlog import RunLog, observed
from loomcart.streaming.summaries import latest_updates, refresh_summaries, windowed_revenue

# The month is handed over in four parts, oldest first.
_PARTS = [(0, 8), (8, 16), (16, 24), (24, 32)]
# Longer than any run: every repeat falls inside the window.
_LONG_WINDOW = 24 * 3600


def _write_parts(df: DataFrame, path: str) -> int:
    """Write the table in four appends, in time order; returns the files per append."""
    files = max(8, df.rdd.getNumPartitions())
    day = F.dayofmonth("timestamp")
    for first, last in _PARTS:
        part = df.filter((day > first) & (day <= last)).repartition(files)
        part.write.mode("append").parquet(path)
    return files


def _stream(spark: SparkSession, path: str, schema, files: int) -> DataFrame:
    """The table as a stream, oldest files first, one append per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


_INGESTED: dict[tuple[str, str], tuple[str, int, str]] = {}


def ingested(spark: SparkSession, sf_dir: str) -> str:
    """Root folder of one ingest of all deliveries, in four micro-batches."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _INGESTED:
        base = scratch_path(spark, "ingest")
        files = _write_parts(given.delivered_messages(spark, sf_dir), f"{base}/topic")
        run = _ingest(spark, base, files, "first")
        _INGESTED[key] = (base, files, run)
    return f"{_INGESTED[key][0]}/tables"


def first_run(spark: SparkSession, sf_dir: str) -> str:
    """Name of that ingest's run; a replay is another run over the same tables."""
    ingested(spark, sf_dir)
    return _INGESTED[spark.sparkContext.applicationId, sf_dir][2]


def _ingest(spark: SparkSession, base: str, files: int, name: str) -> str:
    checkpoint = f"{base}/checkpoint-{name}"
    start_ingest(_stream(spark, f"{base}/topic", KAFKA_SCHEMA, files), parse_kafka, f"{base}/tables",
                 checkpoint, window_seconds=_LONG_WINDOW, interval=None).awaitTermination()
    store_views(spark, f"{base}/tables")
    return checkpoint_id(spark, checkpoint)


_STORED = f"""WITH {PROCESSED}
SELECT coalesce(event_id, substr(sha256('events|' || _kafka_partition || '|' || _kafka_offset), 1, 32)) AS event_id,
       event_type, user_id, session_id, "timestamp", amount::DOUBLE AS amount, currency,
       null_flags AS _null_flags, _kafka_offset
FROM good WHERE "timestamp" IS NOT NULL AND event_type IS NOT NULL"""


def _stored(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/events").select(
        "event_id", "event_type", "user_id", "session_id", "timestamp",
        F.col("amount").cast("double"), "currency", text_list("_null_flags"), "_kafka_offset")


@query("stream_ingest", _STORED)
def _(spark, sf_dir):
    return _stored(spark, ingested(spark, sf_dir))


_STORED_ROWS = f"""{_STORED.replace('amount::DOUBLE AS amount', 'amount::DECIMAL(18,4) AS amount')}"""
_MERGED_VOLUME = f"""WITH stored AS ({_STORED_ROWS})
SELECT "timestamp"::DATE AS event_date, event_type, count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
       sum(amount)::DOUBLE AS total_amount, {six_sql('sum(amount)::DOUBLE / count(amount)')} AS avg_amount
FROM stored GROUP BY 1, 2"""


@query("stream_merged_volume", _MERGED_VOLUME)
def _(spark, sf_dir):
    """The daily view that the ingest keeps by merging what its batches add."""
    volume = spark.read.parquet(f"{ingested(spark, sf_dir)}/views/daily_event_volume")
    return volume.withColumns({"avg_amount": six("avg_amount"), "total_amount": F.col("total_amount").cast("double")})


@query("stream_merged_revenue", f"""WITH stored AS ({_STORED_ROWS})
SELECT date_trunc('hour', "timestamp") AS hour, currency, count(*) AS transaction_count, sum(amount)::DOUBLE AS total_revenue,
       {six_sql('sum(amount)::DOUBLE / count(amount)')} AS avg_transaction, max(amount)::DOUBLE AS max_transaction,
       min(amount)::DOUBLE AS min_transaction
FROM stored WHERE event_type = 'PURCHASE' AND amount IS NOT NULL AND currency IS NOT NULL GROUP BY 1, 2""")
def _(spark, sf_dir):
    return plain_revenue(spark.read.parquet(f"{ingested(spark, sf_dir)}/views/hourly_revenue"))


@query("stream_merged_funnel", f"""WITH daily AS ({_MERGED_VOLUME}), counts AS (
  SELECT event_date, sum(CASE WHEN event_type = 'SIGNUP' THEN event_count ELSE 0 END)::BIGINT AS signups,
         sum(CASE WHEN event_type = 'LOGIN' THEN event_count ELSE 0 END)::BIGINT AS logins,
         sum(CASE WHEN event_type = 'PURCHASE' THEN event_count ELSE 0 END)::BIGINT AS purchases
  FROM daily GROUP BY 1)
SELECT *, round(100.0::DOUBLE * purchases / nullif(signups, 0), 2) AS signup_to_purchase_pct FROM counts""")
def _(spark, sf_dir):
    return spark.read.parquet(f"{ingested(spark, sf_dir)}/views/user_funnel")


@query("stream_unlisted_keys", f"""WITH {PROCESSED}
SELECT g._kafka_offset, json_extract(e.props, '$.k')::BIGINT AS k FROM good g JOIN events e ON e.event_id = g.i
WHERE g."timestamp" IS NOT NULL AND g.event_type IS NOT NULL""")
def _(spark, sf_dir):
    """Fields that have no column of their own, read back from the events table by path."""
    events = spark.read.parquet(f"{ingested(spark, sf_dir)}/events")
    return events.select("_kafka_offset", F.try_variant_get("extras", "$.props.k", "bigint").alias("k"))


@query("stream_observed_counters", f"""WITH {DELIVERED}
SELECT count(*) AS ingested, count(*) FILTER (WHERE outcome = 'rejected') AS rejected,
       count(*) FILTER (WHERE outcome = 'flagged') AS flagged FROM delivered""")
def _(spark, sf_dir):
    """All deliveries validated by a stream; its counters reach the run log through the
    query's listener."""
    base = scratch_path(spark, "observed")
    files = _write_parts(given.delivered_messages(spark, sf_dir), f"{base}/topic")
    rows = classify(clean(parse_kafka(_stream(spark, f"{base}/topic", KAFKA_SCHEMA, files))))
    with RunLog(spark, f"{base}/run_log"):
        (observed(rows).select("_kafka_offset", "outcome").writeStream.format("parquet").outputMode("append")
         .option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
         .trigger(availableNow=True).start().awaitTermination())
    log = current_runs(spark.read.parquet(f"{base}/run_log"), ["logged_at"])
    return log.agg(F.sum("records_ingested").alias("ingested"), F.sum("records_rejected").alias("rejected"),
                   F.sum("records_flagged").alias("flagged"))


@query("stream_replay_idempotent", _STORED)
def _(spark, sf_dir):
    """The whole topic is read once more into the same tables, as after a lost checkpoint."""
    tables = ingested(spark, sf_dir)
    base, files, _ = _INGESTED[spark.sparkContext.applicationId, sf_dir]
    _ingest(spark, base, files, f"again-{time.time_ns()}")
    return _stored(spark, tables)


@query("stream_anomaly", f"""WITH {PROCESSED}
SELECT _kafka_offset, amount, {alert_text('amount', 'z', 'mean', 'sd')} AS _anomaly_alert FROM alerts""")
def _(spark, sf_dir):
    """The amount history is carried from batch to batch."""
    alerts = output(spark, ingested(spark, sf_dir), "alerts")
    return alerts.select("_kafka_offset", "amount", "_anomaly_alert")


@query("stream_batch_size", f"""WITH {DELIVERED}
SELECT (CASE WHEN day(arrival) <= 8 THEN 0 WHEN day(arrival) <= 16 THEN 1
             WHEN day(arrival) <= 24 THEN 2 ELSE 3 END)::BIGINT AS batch_id,
       count(*) AS batch_size FROM delivered GROUP BY 1""")
def _(spark, sf_dir):
    """The size history the fourth batch left behind."""
    return load_state(spark, ingested(spark, sf_dir), "batch_sizes", len(_PARTS),
                      first_run(spark, sf_dir)).select(
        "batch_id", "batch_size")


@query("stream_run_log", f"""WITH {PROCESSED}
SELECT (SELECT count(*) FROM delivered) AS ingested,
       (SELECT count(*) FROM firsts WHERE outcome = 'rejected') AS rejected,
       (SELECT count(*) FROM firsts WHERE outcome = 'flagged') AS flagged,
       (SELECT count(*) FROM delivered) - (SELECT count(*) FROM firsts) AS duplicates_dropped,
       (SELECT count(*) FROM alerts) AS anomalies_detected""")
def _(spark, sf_dir):
    """The run log has one row per batch, however often a batch was run."""
    log = spark.read.parquet(f"{ingested(spark, sf_dir)}/run_log").filter(
        F.col("run_id").startswith(first_run(spark, sf_dir)))
    return current_runs(log, ["logged_at"]).agg(F.sum("records_ingested").alias("ingested"),
                   F.sum("records_rejected").alias("rejected"),
                   F.sum("records_flagged").alias("flagged"),
                   F.sum("duplicates_dropped").alias("duplicates_dropped"),
                   F.sum("anomalies_detected").alias("anomalies_detected"))


@query("stream_new_checkpoint", f"""WITH {PROCESSED}
SELECT 'quarantine' AS kind, i * 4 + copy AS message FROM raw_messages_broken, (SELECT unnest([0, 1, 2, 3]) AS copy)
UNION ALL SELECT 'rejected', _kafka_offset FROM firsts WHERE outcome = 'rejected'
UNION ALL SELECT 'alerts', _kafka_offset FROM alerts
UNION ALL SELECT 'events', _kafka_offset FROM good WHERE "timestamp" IS NOT NULL AND event_type IS NOT NULL
UNION ALL SELECT 'run log', count(*) FROM delivered""".replace(
    "raw_messages_broken", "(SELECT event_id AS i FROM events WHERE event_id % 97 = 5 OR event_id % 89 = 7)"))
def _(spark, sf_dir):
    """Three quarters of the topic are read; then a new checkpoint reads all of it, with
    new messages and in other batches. Nothing is lost and nothing comes twice."""
    base = scratch_path(spark, "renewed")
    messages = given.delivered_messages(spark, sf_dir)
    day = F.dayofmonth("timestamp")
    files = max(8, messages.rdd.getNumPartitions())
    for first, last in _PARTS[:3]:
        messages.filter((day > first) & (day <= last)).repartition(files).write.mode("append").parquet(f"{base}/topic")
    _ingest(spark, base, files, "first")
    messages.filter(day > _PARTS[3][0]).repartition(files).write.mode("append").parquet(f"{base}/topic")
    run = _ingest(spark, base, 2 * files, "second")
    tables = f"{base}/tables"
    kinds = [output(spark, tables, name).select(F.lit(name).alias("kind"), F.col("_kafka_offset").alias("message"))
             for name in ("quarantine", "rejected", "alerts")]
    events = spark.read.parquet(f"{tables}/events").select(
        F.lit("events").alias("kind"), F.col("_kafka_offset").alias("message"))
    log = current_runs(spark.read.parquet(f"{tables}/run_log"), ["logged_at"]).filter(F.col("run_id").startswith(run))
    total = log.agg(F.lit("run log").alias("kind"), F.sum("records_ingested").alias("message"))
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2]).unionByName(events).unionByName(total)


def drain(query, rows: int, timeout: float = 300.0) -> int:
    """Wait until a query without an end has read ``rows`` rows, then stop it; returns how
    many it has read. Gives up when ``timeout`` seconds bring nothing but empty batches,
    however long a batch with rows takes."""
    done, last = {}, time.time()
    try:
        while query.isActive:
            # The query remembers its last batches only.
            new = {p["batchId"]: p["numInputRows"] for p in query.recentProgress if p["batchId"] not in done}
            done.update(new)
            if sum(done.values()) >= rows:
                return sum(done.values())
            if any(new.values()):
                last = time.time()
            elif new and time.time() - last > timeout:
                raise TimeoutError(f"stream read {sum(done.values())} of {rows} rows, then none for {timeout} s")
            time.sleep(0.5)
        raise query.exception() or RuntimeError(f"stream ended after {sum(done.values())} of {rows} rows")
    finally:
        query.stop()


@query("stream_dedup", f"""WITH {DELIVERED}
SELECT fingerprint, count(*) AS kept FROM (SELECT DISTINCT fingerprint FROM delivered) GROUP BY 1""")
def _(spark, sf_dir):
    """All repeats come within the time to live, so each fingerprint is kept once."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    base = scratch_path(spark, "dedup")
    rows = clean(parse_kafka(given.delivered_messages(spark, sf_dir))).select(
        "fingerprint", *KAFKA_ORDER, F.timestamp_millis("_kafka_timestamp").alias("timestamp"))
    files = _write_parts(rows, f"{base}/in")
    stored = spark.read.parquet(f"{base}/in")
    kept = dedup_stream(_stream(spark, f"{base}/in", stored.schema, files), KAFKA_ORDER, _LONG_WINDOW)
    query = (kept.writeStream.format("parquet").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/checkpoint").outputMode("append").start())
    drain(query, stored.count())
    return spark.read.parquet(f"{base}/out").groupBy("fingerprint").agg(
        F.count(F.lit(1)).alias("kept"))


@query("stream_dedup_restart", f"""WITH {DELIVERED}, n AS (
  SELECT count(*) AS seen, count(DISTINCT fingerprint) AS live FROM delivered)
SELECT seen AS total_processed, seen - live AS duplicates_dropped,
       round(100.0::DOUBLE * (seen - live) / seen, 2) AS dedup_rate_pct, live AS window_size,
       {_LONG_WINDOW} AS window_seconds FROM n""")
def _(spark, sf_dir):
    """A batch run over the first days hands its live fingerprints to a stream, which is
    stopped and started again; the statistics are those of all three."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    base = scratch_path(spark, "restart")
    rows = clean(parse_kafka(given.delivered_messages(spark, sf_dir))).select(
        "fingerprint", *KAFKA_ORDER, F.timestamp_millis("_kafka_timestamp").alias("timestamp"))
    day = F.dayofmonth("timestamp")
    rows.write.parquet(f"{base}/all")
    stored = spark.read.parquet(f"{base}/all")
    now_ms = int(time.time() * 1000)
    early = stored.filter(day <= 12)
    unique, _ = unseen(early, KAFKA_ORDER, None, now_ms, _LONG_WINDOW)
    store(still_live(unique, None, now_ms), f"{base}/live")
    initial = spark.read.parquet(f"{base}/live")
    processed = early.count()
    for first, last in ((12, 22), (22, 32)):
        stored.filter((day > first) & (day <= last)).write.mode("append").parquet(f"{base}/in")
        kept = dedup_stream(spark.readStream.schema(stored.schema).parquet(f"{base}/in"), KAFKA_ORDER, _LONG_WINDOW,
                            initial=initial)
        query = (kept.writeStream.format("parquet").option("path", f"{base}/out")
                 .option("checkpointLocation", f"{base}/checkpoint").outputMode("append").start())
        processed += drain(query, stored.filter((day > first) & (day <= last)).count())
    total = initial.count() + spark.read.parquet(f"{base}/out").count()
    live = live_keys(spark, f"{base}/checkpoint", int(time.time() * 1000), _LONG_WINDOW)
    return stream_stats(processed, total, live, _LONG_WINDOW)


@query("stream_recent", f"""WITH {CHECKED}
SELECT fingerprint, 2 AS kept FROM (SELECT DISTINCT fingerprint FROM checked)""")
def _(spark, sf_dir):
    """The same messages in three batches, 30 and 60.001 s apart, with a window of 60 s:
    the second batch falls inside it, the third lies beyond it."""
    base = scratch_path(spark, "recent")
    rows = clean(parse_kafka(given.raw_messages(spark, sf_dir)))
    kept = []
    for batch_id, now_ms in enumerate((0, 30_000, 60_001)):
        found, _ = drop_recent(rows, base, batch_id, now_ms, 60, KAFKA_ORDER)
        kept.append(found.select("fingerprint"))
    return kept[0].union(kept[1]).union(kept[2]).groupBy("fingerprint").agg(F.count(F.lit(1)).alias("kept"))


@query("stream_hourly_revenue", HOURLY_SQL)
def _(spark, sf_dir):
    """Each batch is appended to the events table; the days it touched are recomputed."""
    base = scratch_path(spark, "summaries")
    files = _write_parts(given.events(spark, sf_dir), f"{base}/in")
    schema = spark.read.parquet(f"{base}/in").schema

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # Keyed by the event id: a retried batch adds nothing.
        insert_ignore(batch.withColumn("event_date", F.to_date("timestamp")), f"{base}/events",
                      order_by=["timestamp"], partition_by=["event_date"])
        refresh_summaries(batch, session.read.parquet(f"{base}/events"), f"{base}/views")

    (_stream(spark, f"{base}/in", schema, files).writeStream.foreachBatch(handle)
     .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
     .awaitTermination())
    revenue = spark.read.parquet(f"{base}/views/hourly_revenue").drop("event_date")
    return plain_revenue(revenue)


@query("stream_windowed_revenue", HOURLY_SQL)
def _(spark, sf_dir):
    """Running hourly totals in update mode; the last state of each hour is the answer."""
    base = scratch_path(spark, "windowed")
    files = _write_parts(given.events(spark, sf_dir), f"{base}/in")
    schema = spark.read.parquet(f"{base}/in").schema
    revenue = windowed_revenue(_stream(spark, f"{base}/in", schema, files))
    (revenue.writeStream.outputMode("update")
     .foreachBatch(lambda batch, batch_id: write_batch(batch, base, "updates", batch_id))
     .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
     .awaitTermination())
    return plain_revenue(latest_updates(spark.read.parquet(f"{base}/updates"), ["hour", "currency"]).drop("run"))


_SCORED: dict[tuple[str, str], str] = {}


def _scored_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of each event type, scored in four micro-batches with a history per type."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SCORED:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        base = scratch_path(spark, "amounts")
        rows = given.events(spark, sf_dir).select(
            "event_id", "event_type", F.col("timestamp").cast("timestamp").alias("timestamp"),
            F.col("amount").cast("double").alias("amount"))
        files = _write_parts(rows, f"{base}/in")
        scored = score_stream(_stream(spark, f"{base}/in", spark.read.parquet(f"{base}/in").schema, files),
                              ["event_type"], ["timestamp", "event_id"])
        (scored.writeStream.format("parquet").option("path", f"{base}/out").outputMode("append")
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination())
        _SCORED[key] = f"{base}/out"
    return spark.read.parquet(_SCORED[key])


@query("stream_anomaly_by_type", BY_TYPE_SQL)
def _(spark, sf_dir):
    return scores(_scored_by_type(spark, sf_dir), "event_id", "event_type")


@query("stream_alerts_by_type", BY_TYPE_ALERTS_SQL)
def _(spark, sf_dir):
    return alerts(_scored_by_type(spark, sf_dir)).select("event_id", "event_type", "_anomaly_alert")

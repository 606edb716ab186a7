"""Streaming ingest: micro-batches of raw messages into the event tables.

Every table a batch writes is keyed by the run and the batch id, or by the event id. The
run is the identity of the stream's checkpoint: a batch that is run again after a failure
replaces its own output, and a new checkpoint, whose batches count from 0 again, replaces
nothing. Messages that several runs have read are shown once by ``output``.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomcart.operators.anomaly import THRESHOLD, WINDOW_SIZE, check_batch_sizes
from loomcart.operators.dedup import first_per_key
from loomcart.operators.key_table import KeyTable, unknown_keys
from loomcart.operators.layout import compact, compact_events, data_files, recover, writer
from loomcart.operators.sinks import (
    insert_ignore, log_run, not_storable, remove_staged, staged_rows, storable, to_event_rows,
)
from loomcart.operators.validate import accepted, rejected
from loomcart.plans.events_job import broken, classify, counters, find_alerts, records, sound, still_live, unseen
from loomcart.session import cut_lineage, path_exists, remove_path, spread, store
from loomcart.sources.events import KAFKA_ORDER, MESSAGE_KEY
from loomcart.streaming.rollups import add_batch, store_views

# Batches of at most this many rows are scored in one task.
ONE_TASK_ROWS = 100_000
# As many batches as the stream itself can go back (spark.sql.streaming.minBatchesToRetain).
KEPT_STATES = 100
# Small files are merged after so many batches, in days with more than layout.MOST_FILES.
COMPACT_EVERY = 16
# Of batches that are handed over without a stream; each such batch may come once only.
NO_RUN = "direct"


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gives a stream when it first writes this checkpoint. Restarts keep it."""
    text = spark.read.text(f"{checkpoint}/metadata").first()[0]
    return json.loads(text)["id"]


def write_batch(df: DataFrame, root: str, name: str, batch_id: int, run: str = NO_RUN) -> None:
    """Replace the output of one batch of one run."""
    df.write.mode("overwrite").parquet(f"{root}/{name}/run={run}/batch_id={batch_id}")


def run_starts(spark: SparkSession, root: str) -> DataFrame | None:
    """run and when it started, from the run log; None without one."""
    if not path_exists(spark, f"{root}/run_log"):
        return None
    log = spark.read.parquet(f"{root}/run_log")
    run = F.regexp_replace("run_id", r"-[0-9]+(-failed)?$", "")
    return log.groupBy(run.alias("run")).agg(F.min("started_at").alias("_started"))


def output(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All rows of a table that batches write. A message that several runs have read comes
    once, as the first batch of the run that started first wrote it."""
    rows = spark.read.parquet(f"{root}/{name}")
    key = [c for c in MESSAGE_KEY if c in rows.columns]
    if not key:
        return rows
    rows = rows.withColumn("run", F.col("run").cast("string"))
    starts = run_starts(spark, root)
    if starts is None:
        return first_per_key(rows, key, ["run", "batch_id"])
    # One row for each run.
    dated = rows.join(F.broadcast(starts), "run", "left")
    return first_per_key(dated, key, ["_started", "run", "batch_id"]).drop("_started")


def _state_path(root: str, name: str, batch_id: int, run: str) -> str:
    return f"{root}/state/{run}/{name}/{batch_id}"


def load_state(spark: SparkSession, root: str, name: str, batch_id: int, run: str = NO_RUN) -> DataFrame | None:
    """What the batch before this one left behind; None for the first batch of a run.

    Raises if it is gone: going on without it would keep repeats and lose alerts.
    """
    if batch_id == 0:
        return None
    path = _state_path(root, name, batch_id - 1, run)
    if not path_exists(spark, path):
        raise FileNotFoundError(f"state {name} of batch {batch_id - 1} of run {run} is gone: {path}")
    return spark.read.parquet(path)


def save_state(df: DataFrame, root: str, name: str, batch_id: int, run: str = NO_RUN) -> None:
    """Leave state to the next batch; state no restart can need any more is removed."""
    df.write.mode("overwrite").parquet(_state_path(root, name, batch_id, run))
    remove_path(df.sparkSession, _state_path(root, name, batch_id - KEPT_STATES, run))


def drop_recent(rows: DataFrame, root: str, batch_id: int, now_ms: int, window_seconds: int,
                order_by: list[str], run: str = NO_RUN) -> tuple[DataFrame, int]:
    """Rows whose fingerprint was not kept within the window, and how many rows came in.
    The state is the fingerprints kept within the window."""
    seen = load_state(rows.sparkSession, root, "fingerprints", batch_id, run)
    unique, live = unseen(rows, order_by, seen, now_ms, window_seconds)
    unique = cut_lineage(unique)
    offered = unique.agg(F.coalesce(F.sum("_copies"), F.lit(0))).first()[0]
    kept = unique.filter(F.col("_seen").isNull()).drop("_seen")
    save_state(still_live(kept, live, now_ms), root, "fingerprints", batch_id, run)
    return kept, offered


def keep_amounts(good: DataFrame, history: DataFrame | None, root: str, batch_id: int,
                 order_by: list[str], run: str = NO_RUN, window_size: int = WINDOW_SIZE) -> None:
    """Store the last amounts, which the next batch's first windows reach back to."""
    amounts = good.filter(F.col("amount").isNotNull()).select(*order_by, "amount")
    if history is not None:
        amounts = amounts.unionByName(history)
    newest = amounts.orderBy(*[F.col(c).desc() for c in order_by]).limit(window_size - 1)
    save_state(newest, root, "amounts", batch_id, run)


def check_batch_volume(spark: SparkSession, root: str, batch_id: int, rows: int,
                       run: str = NO_RUN) -> DataFrame:
    """Score this batch's size against the sizes of the last batches."""
    sizes = spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch_id"),
                                  F.lit(rows).cast("bigint").alias("batch_size"))
    before = load_state(spark, root, "batch_sizes", batch_id, run)
    if before is not None:
        sizes = sizes.unionByName(before.filter(F.col("batch_id") > batch_id - WINDOW_SIZE))
    save_state(sizes, root, "batch_sizes", batch_id, run)
    # At most WINDOW_SIZE rows.
    recent = spark.read.parquet(_state_path(root, "batch_sizes", batch_id, run))
    return check_batch_sizes(recent, one_block=True).filter(F.col("batch_id") == batch_id)


def ingest_batch(parsed: DataFrame, batch_id: int, root: str, order_by: list[str] | None = None,
                 window_seconds: int = 60, now_ms: int | None = None,
                 users: DataFrame | None = None, sessions: DataFrame | None = None,
                 run: str | None = None, window_size: int = WINDOW_SIZE, threshold: float = THRESHOLD,
                 views: bool = True, key_tables: dict[str, KeyTable] | None = None) -> dict:
    """One micro-batch of parsed messages into the tables below ``root``.

    A row the events table cannot hold goes to ``not_storable`` with its reason and counts
    as failed; the rest goes on. A batch that breaks off leaves a failed entry in the run
    log, and the error is raised again. ``run`` names the caller: a batch of a run that
    comes again replaces its output. Without a run a batch id that was there before is
    refused, as it may be another caller's. ``window_size`` and ``threshold`` are those of
    the amount check; ``views`` says whether the stored views are renewed. Rows with ids
    that ``key_tables`` (by column) do not hold by now go to ``unknown_keys`` as well.
    """
    spark = parsed.sparkSession
    started = datetime.now(timezone.utc)
    if run is None:
        run = NO_RUN
        if path_exists(spark, f"{root}/quarantine/run={run}/batch_id={batch_id}"):
            raise FileExistsError(f"batch {batch_id} was ingested without a run before; name the run")
    try:
        return _ingest(parsed, batch_id, root, order_by or KAFKA_ORDER, window_seconds,
                       now_ms if now_ms is not None else int(time.time() * 1000),
                       users, sessions, run, started, window_size, threshold, views, key_tables or {})
    except Exception as error:
        log_run(spark, f"{root}/run_log", {
            "run_id": f"{run}-{batch_id}-failed", "started_at": started, "status": "failed",
            "completed_at": datetime.now(timezone.utc), "error_message": f"{type(error).__name__}: {error}"[:2000]})
        raise


def _ingest(parsed: DataFrame, batch_id: int, root: str, order_by: list[str], window_seconds: int, now_ms: int,
            users: DataFrame | None, sessions: DataFrame | None, run: str, started: datetime,
            window_size: int, threshold: float, views: bool, key_tables: dict[str, KeyTable]) -> dict:
    """The batch is parsed once and classified once, each written to a table of its own
    that all outputs read. What is counted is observed while it is written."""
    spark = parsed.sparkSession
    work = f"{root}/work/{run}/{batch_id}"
    seen = load_state(spark, root, "fingerprints", batch_id, run)
    history = load_state(spark, root, "amounts", batch_id, run)
    rows = store(records(parsed), f"{work}/records")
    write_batch(broken(rows, parsed), root, "quarantine", batch_id, run)

    marked, live = unseen(sound(rows), order_by, seen, now_ms, window_seconds)
    observed = Observation()
    classified = store(classify(marked, users, sessions, order_by).observe(observed, *counters(known=True)),
                       f"{work}/classified")
    counted = observed.get
    kept = classified.filter(F.col("_seen").isNull()).drop("_seen")
    save_state(still_live(kept, live, now_ms), root, "fingerprints", batch_id, run)
    write_batch(rejected(kept).drop("_copies", "extras"), root, "rejected", batch_id, run)

    if key_tables:
        coordinates = [c for c in (*MESSAGE_KEY, "_raw_sha") if c in kept.columns]
        checked = unknown_keys(kept.select(*coordinates, "fingerprint", *key_tables), key_tables, ["fingerprint"])
        write_batch(checked.filter(F.size("violations") > 0), root, "unknown_keys", batch_id, run)

    good = accepted(kept).drop("_copies")
    alarmed = Observation()
    alerts = find_alerts(good, order_by, history, counted["ingested"] <= ONE_TASK_ROWS, window_size, threshold)
    write_batch(alerts.observe(alarmed, F.count(F.lit(1)).alias("rows")), root, "alerts", batch_id, run)
    keep_amounts(good, history, root, batch_id, order_by, run, window_size)

    failed = Observation()
    bad = not_storable(good.drop("extras")).observe(failed, F.count(F.lit(1)).alias("rows"))
    write_batch(bad, root, "not_storable", batch_id, run)
    events = to_event_rows(storable(good))
    written = insert_ignore(events, f"{root}/events", order_by=["timestamp", "_kafka_partition", "_kafka_offset"],
                            staged=f"{work}/inserted", layout=writer)
    add_batch(staged_rows(spark, f"{work}/inserted"), root, run, batch_id)
    if views:
        store_views(spark, root)
    volume = check_batch_volume(spark, root, batch_id, counted["ingested"], run)
    write_batch(volume.filter("is_alert"), root, "volume_alerts", batch_id, run)

    done = {**counted, "anomalies_detected": alarmed.get["rows"], **written, "failed": failed.get["rows"]}
    log_run(spark, f"{root}/run_log", {
        "run_id": f"{run}-{batch_id}", "started_at": started,
        "completed_at": datetime.now(timezone.utc), "status": "completed",
        "records_ingested": done["ingested"], "records_rejected": done["rejected"],
        "records_flagged": done["flagged"], "duplicates_dropped": done["duplicates_dropped"],
        "anomalies_detected": done["anomalies_detected"],
    })
    if batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
        recover(spark, f"{root}/events")
        days = [n.split("=")[1] for n in data_files(spark, f"{root}/events") if n.startswith("event_date=")]
        compact_events(spark, f"{root}/events", days)
        compact(spark, f"{root}/run_log")
    # A batch that is run again needs what the one before it had found to be new.
    before = f"{root}/work/{run}/{batch_id - 1}"
    remove_staged(spark, f"{before}/inserted")
    for path in (f"{work}/records", f"{work}/classified", before):
        remove_path(spark, path)
    return {**done, "run_id": f"{run}-{batch_id}",
            "seconds": (datetime.now(timezone.utc) - started).total_seconds()}


def start_ingest(stream: DataFrame, parse: Callable[[DataFrame], DataFrame], root: str,
                 checkpoint: str, order_by: list[str] | None = None, window_seconds: int = 60,
                 interval: str | None = "500 milliseconds", view_seconds: float = 300.0, **options) -> StreamingQuery:
    """Run ``ingest_batch`` on every micro-batch; ``interval=None`` drains and stops.

    The stored views are renewed by the first batch and then by the first one after every
    ``view_seconds``; ``rollups.store_views`` renews them at any time. ``options`` are
    those of ``ingest_batch``.
    """
    renewed = [float("-inf")]

    def handle(batch: DataFrame, batch_id: int) -> None:
        due = time.monotonic() - renewed[0] >= view_seconds
        ingest_batch(parse(spread(batch)), batch_id, root, order_by, window_seconds,
                     run=checkpoint_id(batch.sparkSession, checkpoint), views=due, **options)
        if due:
            renewed[0] = time.monotonic()

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()

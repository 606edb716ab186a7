"""Merged summaries against summaries of the whole table, and what the ingest hands on."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_ingest import event, messages

from loomcart.operators import sinks
from loomcart.operators.quality import DataQualityError
from loomcart.plans import marts
from loomcart.plans.events_job import process
from loomcart.sources.events import parse_kafka
from loomcart.streaming import ingest, rollups
from loomcart.streaming.runlog import RunLog, observed

SCHEMA = "event_id string, event_type string, user_id string, timestamp timestamp, amount decimal(18,4), currency string"


def made(seed, n, users=6):
    r = random.Random(seed)
    return [(f"{seed}-{i}", r.choice(["PURCHASE", "LOGIN", "SIGNUP"]), r.choice([None, *map(str, range(users))]),
             datetime(2024, 1, r.randint(1, 3), r.randint(0, 23)), r.choice([None, r.randint(1, 90)]), r.choice([None, "EUR", "USD"]))
            for i in range(n)]


def frame(spark, rows):
    from decimal import Decimal

    return spark.createDataFrame([(*r[:4], None if r[4] is None else Decimal(r[4]), r[5]) for r in rows], SCHEMA)


def same(got, want):
    columns = sorted(want.columns)
    a, b = (sorted(repr([float(v) if hasattr(v, "as_tuple") else v for v in r]) for r in x.select(columns).collect()) for x in (got, want))
    assert a == b


def test_batches_merge_to_the_whole(spark, folder):
    """Batches of two runs, one of them repeated, one broken off after its users were added."""
    batches = [("a", 0, made(1, 80)), ("a", 1, made(2, 60)), ("b", 0, made(3, 50, 9)), ("a", 2, [])]
    for run, batch_id, rows in batches:
        rollups.add_batch(frame(spark, rows), folder, run, batch_id)
    rollups.add_batch(frame(spark, batches[1][2]), folder, "a", 1)
    last = frame(spark, made(4, 40, 12))
    seen = spark.read.parquet(f"{folder}/summaries/presence").select("presence_key")
    rollups.presence_rows(last).join(seen, "presence_key", "left_anti").limit(7).write.parquet(
        f"{folder}/summaries/presence/run=b/batch_id=1")
    rollups.add_batch(last, folder, "b", 1)

    every = last
    for _, _, rows in batches:
        every = every.union(frame(spark, rows))
    same(rollups.daily_event_volume(spark, folder), marts.daily_event_volume(every))
    same(rollups.hourly_revenue(spark, folder), marts.hourly_revenue(every))
    rollups.store_views(spark, folder)
    same(spark.read.parquet(f"{folder}/views/user_funnel"), marts.user_funnel(marts.daily_event_volume(every)))


def test_a_batch_reads_no_earlier_events(spark, folder):
    """Adding a batch needs the presence index and the batch, not the days' events."""
    rollups.add_batch(frame(spark, made(1, 30)), folder, "a", 0)
    before = {r[0] for r in spark.read.parquet(f"{folder}/summaries/volume").select(F.input_file_name()).collect()}
    rollups.add_batch(frame(spark, made(2, 30)), folder, "a", 1)
    after = {r[0] for r in spark.read.parquet(f"{folder}/summaries/volume").select(F.input_file_name()).collect()}
    assert before < after  # nothing was rewritten


def test_views_follow_the_ingest(spark, folder):
    for batch_id, ids in enumerate((range(0, 5), range(3, 9))):
        rows = [("t", 0, 10 * batch_id + i, event(event_id=f"e{i}", event_type="purchase", user_id=f"u{i % 3}", amount=i, currency="EUR"))
                for i in ids]
        ingest.ingest_batch(parse_kafka(messages(spark, rows)), batch_id, folder, now_ms=batch_id, run="r", window_seconds=0)
    events = spark.read.parquet(f"{folder}/events")
    assert events.count() == 9
    same(spark.read.parquet(f"{folder}/views/daily_event_volume"), marts.daily_event_volume(events))
    same(spark.read.parquet(f"{folder}/views/hourly_revenue"), marts.hourly_revenue(events))


def test_repeated_batch_changes_nothing(spark, folder, monkeypatch):
    """A batch breaks off after its events are in; its second run completes everything."""
    rows = parse_kafka(messages(spark, [("t", 0, i, event(event_id=f"e{i}", user_id=f"u{i}")) for i in range(4)]))
    with monkeypatch.context() as m:
        m.setattr(ingest, "add_batch", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.ingest_batch(rows, 0, folder, now_ms=0, run="r")
    done = ingest.ingest_batch(rows, 0, folder, now_ms=0, run="r")
    assert (done["inserted"], done["skipped"]) == (4, 0)
    volume = rollups.daily_event_volume(spark, folder).collect()
    assert [(r.event_count, r.unique_users) for r in volume] == [(4, 4)]
    assert spark.read.parquet(f"{folder}/events").count() == 4


def test_batches_without_a_run_do_not_overwrite(spark, folder):
    rows = parse_kafka(messages(spark, [("t", 0, 1, event())]))
    ingest.ingest_batch(rows, 0, folder, now_ms=0)
    with pytest.raises(FileExistsError):
        ingest.ingest_batch(rows, 0, folder, now_ms=0)


def test_output_takes_the_run_that_started_first(spark, folder):
    for run in ("z-first", "a-second"):
        ingest.ingest_batch(parse_kafka(messages(spark, [("t", 0, 0, b"x")])), 0, folder, now_ms=0, run=run)
    assert [r.run for r in ingest.output(spark, folder, "quarantine").collect()] == ["z-first"]


def test_settings_reach_the_amount_check(spark, folder):
    rows = parse_kafka(messages(spark, [("t", 0, i, event(event_id=str(i), amount=100 if i == 14 else 1 + i % 2)) for i in range(15)]))
    assert process(rows).alerts.count() == 1
    assert process(rows, threshold=5.0).alerts.count() == 0
    found = ingest.ingest_batch(rows, 0, f"{folder}/a", now_ms=0, run="r", threshold=5.0)
    assert found["anomalies_detected"] == 0
    found = ingest.ingest_batch(rows, 0, f"{folder}/b", now_ms=0, run="r", window_size=5)
    assert found["anomalies_detected"] == 0  # five values never make ten


def test_process_keeps_state_over_calls(spark):
    rows = parse_kafka(messages(spark, [("t", 0, 1, event(event_id="a")), ("t", 0, 2, event(event_id="b"))]))
    more = parse_kafka(messages(spark, [("t", 0, 3, event(event_id="a")), ("t", 0, 4, event(event_id="c"))]))
    first = process(rows, now_ms=0, run_id="one")
    second = process(more, now_ms=59_000, seen=first.live)
    assert [r.event_id for r in second.accepted.collect()] == ["c"]
    m = second.metrics.first()
    assert (m.ingested, m.duplicates_dropped, m.inserted) == (2, 1, 1)
    assert second.live.count() == 3 and first.run_id == "one" and second.seconds > 0
    third = process(more, now_ms=60_001, seen=second.live)
    assert [r.event_id for r in third.accepted.collect()] == ["a"]


def test_unlisted_fields_are_kept(spark, folder):
    rows = parse_kafka(messages(spark, [("t", 0, 1, event(event_id="a", plan={"tier": [1, "x"]})), ("t", 0, 2, event(event_id="b"))]))
    ingest.ingest_batch(rows, 0, folder, now_ms=0, run="r")
    found = spark.read.parquet(f"{folder}/events").select(
        "event_id", F.try_variant_get("extras", "$.plan.tier[1]", "string").alias("x"), F.col("extras").isNull().alias("none"))
    assert sorted(map(tuple, found.collect())) == [("a", "x", False), ("b", None, True)]


def test_views_with_repeated_keys_are_refused(spark, folder):
    one = spark.createDataFrame([(1, 2)], "k int, v int")
    sinks.refresh(one, folder, ["k"])
    with pytest.raises(DataQualityError):
        sinks.refresh(one.union(one), folder, ["k"])
    assert spark.read.parquet(folder).count() == 1


def test_batch_volume_alerts(spark, folder):
    """Eleven batches of about one size, then one of ten times as many rows."""
    found = [ingest.check_batch_volume(spark, folder, i, n, "r").first()
             for i, n in enumerate([100, 101] * 6 + [1000])]
    assert [r.is_alert for r in found] == [False] * 12 + [True]
    assert found[3].z_score is None and found[4].z_score is not None  # five batches are needed
    assert found[-1]._anomaly_alert.startswith("ANOMALY: batch_size=1000 is 3.")


def test_failed_streams_are_logged(spark, folder):
    spark.createDataFrame([("valid", 1), ("rejected", 0)], "outcome string, x int").write.parquet(f"{folder}/in")

    def run(name, column):
        stream = observed(spark.readStream.schema("outcome string, x int").parquet(f"{folder}/in"))
        (stream.select(column).writeStream.format("parquet").option("path", f"{folder}/{name}")
         .option("checkpointLocation", f"{folder}/checkpoint-{name}").trigger(availableNow=True).start().awaitTermination())

    with RunLog(spark, f"{folder}/run_log"):
        run("good", F.col("x"))
        with pytest.raises(Exception):
            run("bad", F.raise_error(F.lit("stop")))
    log = spark.read.parquet(f"{folder}/run_log").collect()
    assert sorted((r.status, r.records_ingested, r.records_rejected) for r in log if r.status == "completed") == [("completed", 2, 1)]
    assert [r for r in log if r.status == "failed" and "stop" in r.error_message]
    assert all(r.completed_at - r.started_at < timedelta(minutes=5) for r in log)


def test_users_of_a_large_batch_are_written_by_several_tasks(spark, folder):
    """One task may not write all (day, type, user) triples that a batch brings."""
    from loomcart.streaming.rollups import add_batch

    events = spark.range(20_000).select(
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"), F.lit("2024-01-01").cast("date").alias("event_date"),
        F.lit("CLICK").alias("event_type"), F.col("id").cast("string").alias("user_id"),
        F.lit(None).cast("decimal(18,4)").alias("amount"), F.lit(None).cast("string").alias("currency"))
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.set(n, "64k")
        add_batch(events, folder, "r", 0)
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    presence = spark.read.parquet(f"{folder}/summaries/presence")
    assert presence.count() == 20_000 and len(presence.inputFiles()) > 1

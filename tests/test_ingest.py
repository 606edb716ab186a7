"""What the ingest must not lose: rows without ids, bad values, missing state, failed runs."""

import json
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loomcart.operators import sinks
from loomcart.operators.anomaly import rolling_zscore
from loomcart.schemas import KAFKA_SCHEMA
from loomcart.session import STATE_STORE, path_exists
from loomcart.sources.events import landing_stream, parse_kafka, parse_landing
from loomcart.streaming import ingest
from loomcart.streaming.dedup import dedup_stream


def messages(spark, rows):
    """(topic, partition, offset, body) as Kafka rows, a second apart."""
    return spark.createDataFrame(
        [(None, json.dumps(b).encode() if isinstance(b, dict) else b, t, p, o, datetime(2024, 1, 1, 0, 0, o % 60), 0)
         for t, p, o, b in rows], KAFKA_SCHEMA)


def event(**fields):
    return {"event_type": "click", "user_id": "u", "session_id": "s", "timestamp": "2024-01-01T00:00:00Z", **fields}


def test_topics_do_not_share_ids(spark):
    from loomcart.plans.events_job import clean

    rows = messages(spark, [("a", 0, 1, event()), ("b", 0, 1, event())])
    accepted = clean(parse_kafka(rows)).withColumns({"_null_flags": F.array().cast("array<string>"), "_has_nulls": F.lit(False)})
    assert sinks.to_event_rows(accepted).select("event_id").distinct().count() == 2


def test_landing_ids_come_from_the_whole_text(spark):
    from loomcart.plans.events_job import clean

    lines = [json.dumps(event(path=p)) for p in ("/a", "/b")] + [json.dumps(event()), json.dumps(event(path=None))]
    parsed = parse_landing(spark.createDataFrame([(x,) for x in lines], "value string"))
    accepted = clean(parsed).withColumns({"_null_flags": F.array().cast("array<string>"), "_has_nulls": F.lit(False)})
    assert sinks.to_event_rows(accepted).select("event_id").distinct().count() == 4


def test_rows_without_a_key_are_kept_apart(spark, folder):
    rows = spark.createDataFrame([("a", 1), (None, 2), (None, 3), (None, None)], "event_id string, x int")
    assert sinks.insert_ignore(rows, folder) == {"inserted": 4, "skipped": 0}
    assert sinks.insert_ignore(rows, folder) == {"inserted": 0, "skipped": 4}
    assert spark.read.parquet(folder).count() == 4


def test_one_bad_amount_does_not_stop_a_batch(spark, folder):
    rows = messages(spark, [("t", 0, 1, event(event_id="big", amount=1e15)), ("t", 0, 2, event(event_id="ok", amount=5))])
    counters = ingest.ingest_batch(parse_kafka(rows), 0, folder, now_ms=0)
    assert (counters["failed"], counters["inserted"]) == (1, 1)
    assert [r._reason for r in ingest.output(spark, folder, "not_storable").collect()] == ["amount out of range"]
    assert counters["run_id"] == "direct-0" and counters["seconds"] > 0


def test_runs_do_not_overwrite_each_other(spark, folder):
    for run, broken in (("one", [b"x", b"y"]), ("two", [b"z"])):
        rows = messages(spark, [(run, 0, i, b) for i, b in enumerate(broken)])
        ingest.ingest_batch(parse_kafka(rows), 0, folder, now_ms=0, run=run)
    assert ingest.output(spark, folder, "quarantine").count() == 3
    ingest.ingest_batch(parse_kafka(messages(spark, [("one", 0, 0, b"x"), ("one", 0, 1, b"y")])), 0, folder, now_ms=0, run="three")
    assert ingest.output(spark, folder, "quarantine").count() == 3
    assert sinks.current_runs(spark.read.parquet(f"{folder}/run_log"), ["logged_at"]).count() == 3


def test_missing_state_raises_and_is_logged(spark, folder):
    rows = parse_kafka(messages(spark, [("t", 0, 1, event())]))
    with pytest.raises(FileNotFoundError):
        ingest.ingest_batch(rows, 5, folder, now_ms=0)
    entry = spark.read.parquet(f"{folder}/run_log").first()
    assert entry.status == "failed" and "FileNotFoundError" in entry.error_message


def test_huge_amounts_raise_no_alert(spark):
    rows = spark.createDataFrame([(i, 1.7e308 if i < 2 else 1.0) for i in range(20)], "n int, amount double")
    scored = rolling_zscore(rows, "amount", ["n"], one_block=True)
    assert scored.filter("is_alert").count() == 0


def _write_topic(spark, path, rows):
    messages(spark, rows).coalesce(1).write.mode("append").parquet(path)


def test_restart_on_the_same_checkpoint(spark, folder):
    """Batches go on where they stopped, with the state of the batch before."""
    def run():
        stream = spark.readStream.schema(KAFKA_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/topic")
        ingest.start_ingest(stream, parse_kafka, f"{folder}/tables", f"{folder}/checkpoint",
                            window_seconds=3600, interval=None).awaitTermination()

    _write_topic(spark, f"{folder}/topic", [("t", 0, 1, event(event_id="a"))])
    _write_topic(spark, f"{folder}/topic", [("t", 0, 2, event(event_id="b"))])
    run()
    _write_topic(spark, f"{folder}/topic", [("t", 0, 3, event(event_id="a")), ("t", 0, 4, event(event_id="c"))])
    run()
    events = spark.read.parquet(f"{folder}/tables/events")
    assert sorted(r.event_id for r in events.collect()) == ["a", "b", "c"]
    log = sinks.current_runs(spark.read.parquet(f"{folder}/tables/run_log"), ["logged_at"]).orderBy("run_id").collect()
    assert [r.duplicates_dropped for r in log] == [0, 0, 1]
    assert [r.run_id.rsplit("-", 1)[1] for r in log] == ["0", "1", "2"]


def test_landing_files_as_a_stream(spark, folder):
    lines = [json.dumps(event(event_id="a")), "no json", json.dumps(event(path="/x"))]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{folder}/in")
    batches = []
    (landing_stream(spark, f"{folder}/in").writeStream
     .foreachBatch(lambda df, i: batches.append(parse_landing(df).agg(F.count("*"), F.count("fields")).first()))
     .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    assert [tuple(b) for b in batches] == [(3, 2)]


def test_kept_keys_expire(spark, folder):
    """A repeat inside the window is dropped; one after it is kept again."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    schema = "fingerprint string, n long"
    put = lambda *rows: spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    put(("a", 2), ("a", 1), ("b", 5))
    kept = dedup_stream(spark.readStream.schema(schema).parquet(f"{folder}/in"), ["n"], window_seconds=20)
    query = (kept.writeStream.format("parquet").option("path", f"{folder}/out").outputMode("append")
             .option("checkpointLocation", f"{folder}/checkpoint").start())

    def wait(n):
        end = time.time() + 120
        while time.time() < end and not query.exception():
            rows = spark.read.schema(schema).parquet(f"{folder}/out") if path_exists(spark, f"{folder}/out/_spark_metadata") else None
            if rows is not None and rows.count() >= n:
                return sorted((r.fingerprint, r.n) for r in rows.collect())
            time.sleep(0.5)
        raise AssertionError(query.exception())

    try:
        assert wait(2) == [("a", 1), ("b", 5)]
        kept_at = time.time()
        put(("a", 7), ("c", 1))
        assert wait(3) == [("a", 1), ("b", 5), ("c", 1)]
        assert time.time() - kept_at < 20, "too slow to tell"
        time.sleep(max(0, 25 - (time.time() - kept_at)))
        put(("a", 9))
        assert wait(4) == [("a", 1), ("a", 9), ("b", 5), ("c", 1)]
    finally:
        query.stop()

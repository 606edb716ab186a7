"""Keys that are registered while batches come."""

from pyspark.sql import functions as F
from test_ingest import event, messages

from loomcart.operators.key_table import KeyTable, unknown_keys
from loomcart.schemas import KAFKA_SCHEMA
from loomcart.sources.events import parse_kafka
from loomcart.streaming import ingest


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "id string")


def test_registering(spark, folder):
    table = KeyTable(spark, folder)
    assert table.is_empty()
    assert table.register(ids(spark, "a", "b", "b", None, "")) == 2
    assert table.register(ids(spark, "b", "c")) == 1
    assert table.register(ids(spark)) == 0
    assert sorted(r.key for r in table.known(ids(spark, "a", "c", "x")).collect()) == ["a", "c"]
    assert table.register(spark.range(3)) == 3
    assert [r.key for r in table.known(ids(spark, "2", "7")).collect()] == ["2"]


def test_null_empty_and_hot_ids(spark, folder):
    users, sessions = KeyTable(spark, f"{folder}/u"), KeyTable(spark, f"{folder}/s")
    users.register(ids(spark, "known"))
    rows = spark.createDataFrame([(i, u, s) for i, (u, s) in enumerate(
        [("known", "x"), ("strange", None), (None, None), ("", "")] + [("hot", "x")] * 30)], "n long, user_id string, session_id string")
    found = unknown_keys(rows, {"user_id": users, "session_id": sessions}, ["n"]).orderBy("n").collect()
    want = [[], ["Unknown user_id: 'strange'"], [], []] + [["Unknown user_id: 'hot'"]] * 30
    assert [r.violations for r in found] == want
    sessions.register(ids(spark, "y"))
    found = unknown_keys(rows, {"user_id": users, "session_id": sessions}, ["n"]).orderBy("n").first()
    assert found.violations == ["Unknown session_id: 'x'"]


def test_a_key_becomes_known_between_two_batches(spark, folder):
    """Within one running stream: unknown in batch 0, registered, known in batch 1."""
    for n in (1, 2):
        messages(spark, [("t", 0, n, event(event_id=str(n), user_id="u1"))]).coalesce(1).write.mode("append").parquet(f"{folder}/topic")
    users = KeyTable(spark, f"{folder}/users")
    users.register(ids(spark, "somebody"))

    def parse(batch):
        if not batch.filter(F.col("offset") == 2).isEmpty():
            users.register(ids(spark, "u1"))
        return parse_kafka(batch)

    stream = spark.readStream.schema(KAFKA_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/topic")
    ingest.start_ingest(stream, parse, f"{folder}/tables", f"{folder}/checkpoint", window_seconds=0, interval=None,
                        key_tables={"user_id": users}).awaitTermination()
    found = spark.read.parquet(f"{folder}/tables/unknown_keys").collect()
    assert [(r.batch_id, r._kafka_offset, r.violations) for r in found] == [(0, 1, ["Unknown user_id: 'u1'"])]
    assert spark.read.parquet(f"{folder}/tables/events").count() == 2

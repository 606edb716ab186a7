"""The events layout: what reads skip, and merging small files without harm."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loomcart.operators import layout, sinks
from loomcart.operators.access import is_type
from loomcart.operators.key_index import KeyIndex
from loomcart.session import commit_text, folder_names


def events(spark, n=40_000):
    i = F.col("id")
    return spark.range(n).select(
        F.concat(F.lit("e"), i).alias("event_id"),
        F.element_at(F.array(*[F.lit(t) for t in ("CLICK", "LOGIN", "SEARCH", "PURCHASE")]), (F.xxhash64(i) % 4 + 4).cast("int") % 4 + 1).alias("event_type"),
        F.concat(F.lit("u"), F.pmod(F.xxhash64(i, F.lit(1)), F.lit(400))).alias("user_id"),
        F.concat(F.lit("s"), F.pmod(F.xxhash64(i, F.lit(1)), F.lit(400)), F.lit("-"), F.floor(i / 4000)).alias("session_id"),
        F.timestamp_add("SECOND", (i * 86_400 / n).cast("int"), F.lit(datetime(2024, 1, 1)).cast("timestamp")).alias("timestamp"),
        F.md5(i.cast("string")).alias("path"))


def scanned(df):
    """Rows that came out of the files."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


def test_every_access_path_skips_row_groups(spark, folder):
    table = events(spark)
    layout.writer(table, row_group_bytes=16_384, partitions=4).parquet(f"{folder}/curve")
    table.repartition(4).write.parquet(f"{folder}/plain")
    rows = spark.read.parquet(f"{folder}/curve")
    n = rows.count()
    hour = (F.col("timestamp") >= F.lit(datetime(2024, 1, 1, 6))) & (F.col("timestamp") < F.lit(datetime(2024, 1, 1, 6) + timedelta(hours=1)))
    reads = {"user": F.col("user_id") == "u17", "session": F.col("session_id") == "s17-3", "type and time": is_type("PURCHASE") & hour}
    for name, asked in reads.items():
        found = rows.filter(asked)
        assert scanned(found) < n / 4, name
        assert found.count() == spark.read.parquet(f"{folder}/plain").filter(asked).count()


def test_curve_interleaves_bits(spark):
    found = spark.createDataFrame([(5, 3), (0, 0), (255, 255)], "a long, b long").select(
        layout.curve([F.col("a"), F.col("b")], 8).alias("z")).collect()
    assert [r.z for r in found] == [0b011011, 0, 0xFFFF]


def test_many_small_batches_stay_few_files(spark, folder):
    whole = events(spark, 300).repartition(1)
    for k in range(6):
        part = whole.filter(F.pmod(F.xxhash64("event_id"), F.lit(6)) == k)
        sinks.insert_ignore(part, folder, order_by=["timestamp"], layout=lambda rows: layout.writer(rows, partitions=2))
        layout.compact_events(spark, folder, ["2024-01-01"], most_files=4)
        assert len(layout.data_files(spark, f"{folder}/event_date=2024-01-01")) <= 4
    stored = spark.read.parquet(folder).select(*whole.columns)
    assert stored.count() == 300 and stored.exceptAll(whole).isEmpty()
    # The index covers the merged files: nothing is inserted twice, nothing indexed again.
    version = KeyIndex(spark, folder, "event_id").segments()[0]
    assert sinks.insert_ignore(whole, folder, order_by=["timestamp"]) == {"inserted": 0, "skipped": 300}
    assert KeyIndex(spark, folder, "event_id").segments()[0] - version <= 1
    assert folder_names(spark, f"{folder}/{layout.JOURNAL}") == []


@pytest.mark.parametrize("stop", ["draft", "first rename", "second rename"])
def test_a_broken_off_merge_is_taken_up(spark, folder, stop, monkeypatch):
    for k in range(5):
        spark.createDataFrame([(f"{k}", k)], "event_id string, n int").coalesce(1).write.mode("append").parquet(f"{folder}/event_date=2024-01-01")
    KeyIndex(spark, folder, "event_id").catch_up()
    moves, plain = [], layout._rename

    def rename(spark_, source, target):
        moves.append(source)
        if stop == "first rename" and len(moves) == 1 or stop == "second rename" and len(moves) == 2:
            raise OSError("lost")
        plain(spark_, source, target)

    with monkeypatch.context() as m:
        m.setattr(layout, "_rename", rename)
        if stop == "draft":
            m.setattr(layout, "commit_text", lambda *a: 1 / 0)
        with pytest.raises((OSError, ZeroDivisionError)):
            layout.compact(spark, folder, "event_date=2024-01-01", "event_id", 2)
    layout.recover(spark, folder)
    assert sorted(r.n for r in spark.read.parquet(folder).collect()) == [0, 1, 2, 3, 4]
    assert len(layout.data_files(spark, f"{folder}/event_date=2024-01-01")) == (5 if stop == "draft" else 1)
    assert folder_names(spark, f"{folder}/{layout.JOURNAL}") == []
    found = KeyIndex(spark, folder, "event_id").lookup(spark.createDataFrame([("3",), ("x",)], "event_id string"))
    assert [r.event_id for r in found.keys.collect()] == ["3"]


def test_run_log_files_are_merged(spark, folder):
    for k in range(6):
        sinks.log_run(spark, folder, {"run_id": f"r{k % 2}", "started_at": datetime(2024, 1, 1), "status": "ok", "records_ingested": k})
    assert layout.compact(spark, folder, most_files=4)
    assert len(layout.data_files(spark, folder)) == 1
    log = sinks.current_runs(spark.read.parquet(folder), ["logged_at"]).orderBy("run_id").collect()
    assert [(r.run_id, r.records_ingested) for r in log] == [("r0", 4), ("r1", 5)]
    assert not layout.compact(spark, folder, most_files=4)


def test_two_writers_cannot_both_commit(spark, folder):
    spark.range(1).write.parquet(folder)
    commit_text(spark, f"{folder}/_v1", "a")
    with pytest.raises(FileExistsError):
        commit_text(spark, f"{folder}/_v1", "b")

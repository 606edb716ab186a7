"""Writing tables: load modes, idempotent inserts, upserts, refreshes and layout.

Parquet folders have no transactions: each of them must have one writer at a time. For
catalogs whose tables support MERGE use ``merge_rows``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loomcart.functions.joins import fits_broadcast
from loomcart.operators.dedup import first_per_key
from loomcart.operators.key_index import KeyIndex
from loomcart.operators.layout import writer
from loomcart.operators.quality import DataQualityError, assert_unique
from loomcart.schemas import EVENT_SCHEMA, RUN_SCHEMA
from loomcart.session import cut_lineage, path_exists, remove_path, replace_folder
from loomcart.sources.events import MESSAGE_KEY

_MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}


def load_table(df: DataFrame, path: str, if_exists: str = "append",
               keys: list[str] | None = None) -> int:
    """Write ``df`` to a Parquet folder and return the number of its rows.

    ``if_exists`` is append, replace, fail or upsert; upsert needs ``keys`` and keeps
    the new row where a key is in both.
    """
    spark = df.sparkSession
    if if_exists == "upsert":
        fresh = cut_lineage(df)
        assert_unique(fresh, keys)
        if path_exists(spark, path):
            kept = spark.read.parquet(path).join(fresh.select(*keys), keys, "left_anti")
            # The target is read and replaced, so its new content is fixed first.
            cut_lineage(kept.unionByName(fresh)).write.mode("overwrite").parquet(path)
        else:
            fresh.write.parquet(path)
        return fresh.count()
    # Counted while it is written: neither the plan nor the target is read for it.
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    counted.write.mode(_MODES[if_exists]).parquet(path)
    return written.get["rows"]


def load_jdbc(df: DataFrame, url: str, table: str, if_exists: str = "append",
              batch_rows: int = 10_000, connections: int = 16, **options) -> None:
    """Write to a database table in batches over at most ``connections`` connections."""
    (df.write.format("jdbc").option("url", url).option("dbtable", table)
     .option("batchsize", str(batch_rows)).option("numPartitions", str(connections))
     .options(**options).mode(_MODES[if_exists]).save())


def to_event_rows(accepted: DataFrame) -> DataFrame:
    """Accepted rows in the columns and types of the events table, and ``extras`` if there.

    A missing event id becomes a hash of the message coordinates, topic included, so that
    a retried message gets the same id again and another message another one. Without
    coordinates it is a hash of the message as it came, or else of all its columns, with
    null, absent and empty told apart.
    """
    coordinates = [c for c in MESSAGE_KEY if c in accepted.columns]
    if coordinates:
        joined = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in coordinates])
    elif "_raw_sha" in accepted.columns:
        joined = F.col("_raw_sha")
    else:
        joined = F.to_json(F.struct(*sorted(c for c in accepted.columns if not c.startswith("_"))),
                           {"ignoreNullFields": "false"})
    filled = {
        "event_id": F.coalesce(F.nullif(F.col("event_id"), F.lit("")),
                               F.substring(F.sha2(joined, 256), 1, 32)),
        "metadata": F.lit(None).cast("string"),
        "ingested_at": F.current_timestamp(),
        **{c: F.lit(None) for c in ("_kafka_partition", "_kafka_offset")
           if c not in accepted.columns},
    }
    rows = accepted.withColumns({k: v for k, v in filled.items()
                                 if k not in accepted.columns or k == "event_id"})
    return rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA],
                       *[c for c in ("extras",) if c in rows.columns])


def _obstacle() -> Column:
    """Why the events table cannot hold a row; null if it can."""
    held = F.col("amount").try_cast(EVENT_SCHEMA["amount"].dataType)
    return (F.when(F.col("timestamp").isNull(), "no time")
            .when(F.col("event_type").isNull(), "no type")
            .when(F.col("amount").isNotNull() & held.isNull(), "amount out of range"))


def storable(accepted: DataFrame) -> DataFrame:
    """Rows the events table can hold: it needs a time, a type and an amount that fits."""
    return accepted.filter(_obstacle().isNull())


def not_storable(accepted: DataFrame) -> DataFrame:
    """The other rows, with the reason."""
    return accepted.withColumn("_reason", _obstacle()).filter("_reason is not null")


def known_keys(fresh: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """The keys of ``fresh`` that ``target`` already holds, by a scan of its key column.

    When ``fresh`` is small enough (by count) its keys are broadcast to the target's
    scan, which is never shuffled. Where ``target`` is a table, ``KeyIndex`` reads less.
    """
    keys = fresh.select(key)
    if fits_broadcast(keys):
        keys = F.broadcast(keys)
    return target.select(key).join(keys, key, "left_semi").distinct()


def insert_ignore(batch: DataFrame, path: str, key: str = "event_id",
                  order_by: list[str] | None = None, partition_by: list[str] | None = None,
                  staged: str | None = None, layout=None) -> dict[str, int]:
    """Append the first row of every key the target does not hold yet.

    Inserted and skipped rows are counted apart. Running it again with the same batch
    changes nothing, which makes at-least-once delivery safe. Rows without a key are told
    apart by all their columns, so none takes another's place.

    What the target holds is learnt from its key index, which grows with every batch: the
    target itself is read for files only that the index does not cover yet.

    With ``staged`` the rows to insert are first written to that folder. A batch that is
    run again takes them from there, so they stay the same whatever the first run had
    inserted already; the counts are those of the first run. Keys must not be null then.
    ``layout`` makes the writer of the rows, as ``layout.writer``.
    """
    spark = batch.sparkSession
    if staged is not None:
        return _insert_staged(batch, path, key, order_by, partition_by, staged, layout)
    if not batch.filter(F.col(key).isNull()).isEmpty():
        return _insert_unkeyed(batch, path, key, order_by, partition_by)
    order_by = order_by or [c for c in batch.columns if c != key]
    first = cut_lineage(first_per_key(batch, [key], order_by, copies="_copies"))
    counts = first.agg(F.count(F.lit(1)).alias("keys"),
                       F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows")).first()
    fresh, inserted = first.drop("_copies"), counts["keys"]
    found = KeyIndex(spark, path, key).lookup(first.select(key))
    if found.buckets_read:
        known = cut_lineage(found.keys)
        fresh, inserted = fresh.join(known, key, "left_anti"), inserted - known.count()
    if inserted:
        _append(fresh.select(*batch.columns), path, key, partition_by, layout)
    return {"inserted": inserted, "skipped": counts["rows"] - inserted}


def _append(rows: DataFrame, path: str, key: str, partition_by: list[str] | None, layout=None) -> None:
    if layout:
        layout(rows).mode("append").parquet(path)
        return
    if partition_by:
        # Each task writes few folders, and a folder with most rows gets many tasks.
        rows = rows.repartitionByRange(*partition_by, key)
    rows.write.mode("append").partitionBy(*partition_by or []).parquet(path)


def _insert_staged(batch: DataFrame, path: str, key: str, order_by: list[str] | None,
                   partition_by: list[str] | None, staged: str, layout=None) -> dict[str, int]:
    spark = batch.sparkSession
    again = path_exists(spark, f"{staged}/_SUCCESS")
    if not again:
        order_by = order_by or [c for c in batch.columns if c != key]
        # Written once: the look-up, the insert and whatever follows read it.
        first_per_key(batch, [key], order_by, copies="_copies").write.mode("overwrite").parquet(f"{staged}.first")
        first = spark.read.parquet(f"{staged}.first")
        offered = Observation()
        found = KeyIndex(spark, path, key).lookup(first.select(key))
        marked = first.withColumn("_known", F.lit(False))
        if found.buckets_read:
            known = found.keys.withColumn("_held", F.lit(True))
            marked = first.join(known, key, "left").withColumn("_known", F.col("_held").isNotNull()).drop("_held")
        counted = marked.observe(offered, F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
                                 F.count_if(~F.col("_known")).alias("inserted"))
        counted.filter(~F.col("_known")).select(*batch.columns).write.mode("overwrite").parquet(f"{staged}.rows")
        counts = {"inserted": offered.get["inserted"], "skipped": offered.get["rows"] - offered.get["inserted"]}
        spark.createDataFrame([(counts["inserted"], counts["skipped"])], "inserted long, skipped long").coalesce(1).write.mode(
            "overwrite").parquet(staged)
    else:
        counts = spark.read.parquet(staged).first().asDict()
    fresh = spark.read.schema(batch.schema).parquet(f"{staged}.rows")
    if again:
        held = KeyIndex(spark, path, key).lookup(fresh.select(key)).keys
        fresh = fresh.join(cut_lineage(held), key, "left_anti")
        if fresh.isEmpty():
            return counts
    if counts["inserted"]:
        _append(fresh.select(*batch.columns), path, key, partition_by, layout)
    return counts


def staged_rows(spark: SparkSession, staged: str) -> DataFrame:
    """The rows that an insert with ``staged`` found to be new."""
    return spark.read.parquet(f"{staged}.rows")


def remove_staged(spark: SparkSession, staged: str) -> None:
    for path in (staged, f"{staged}.first", f"{staged}.rows"):
        remove_path(spark, path)


def _insert_unkeyed(batch: DataFrame, path: str, key: str, order_by: list[str] | None,
                    partition_by: list[str] | None) -> dict[str, int]:
    """Insert a batch in which keys are null: those rows on their own, by a hash of theirs."""
    spark = batch.sparkSession
    named = insert_ignore(batch.filter(F.col(key).isNotNull()), path, key, order_by, partition_by)
    content = F.sha2(F.to_json(F.struct(*sorted(batch.columns)), {"ignoreNullFields": "false"}), 256)
    unnamed = batch.filter(F.col(key).isNull()).withColumn("_content", content)
    first = cut_lineage(first_per_key(unnamed, ["_content"], order_by or batch.columns, copies="_copies"))
    offered = first.agg(F.coalesce(F.sum("_copies"), F.lit(0))).first()[0]
    fresh = first.drop("_copies")
    if path_exists(spark, path):
        held = (spark.read.schema(batch.schema).parquet(path).filter(F.col(key).isNull())
                .withColumn("_content", content))
        fresh = cut_lineage(fresh.join(known_keys(first, held, "_content"), "_content", "left_anti"))
    added = fresh.count()
    if added:
        fresh.select(*batch.columns).write.mode("append").partitionBy(*partition_by or []).parquet(path)
    return {"inserted": named["inserted"] + added, "skipped": named["skipped"] + offered - added}


def merge_rows(fresh: DataFrame, table: str, key: str, update: list[str] | None = None) -> None:
    """MERGE into a catalog table that supports it: insert new keys and, when
    ``update`` is given, set those columns of known keys."""
    source = fresh.alias("source")
    merge = source.mergeInto(table, F.expr(f"{table}.{key} = source.{key}"))
    if update:
        merge = merge.whenMatched().update({c: F.col(f"source.{c}") for c in update})
    merge.whenNotMatched().insertAll().merge()


# Columns a later entry of the same run overwrites; all others keep their first value.
RUN_UPDATES = ["completed_at", "records_ingested", "status"]


def log_run(spark: SparkSession, path: str, entry: dict) -> None:
    """Append one entry to the run log; ``current_runs`` makes one row per run of it."""
    names = [f.name for f in RUN_SCHEMA]
    row = tuple(entry.get(n) for n in names)
    one = spark.createDataFrame([row], RUN_SCHEMA).withColumn("logged_at", F.current_timestamp())
    one.coalesce(1).write.mode("append").parquet(path)


def current_runs(log: DataFrame, order_by: list[str]) -> DataFrame:
    """One row per run: the latest value of the updated columns, the first of the rest."""
    order = F.struct(*order_by)
    names = [f.name for f in RUN_SCHEMA if f.name != "run_id"]
    return log.groupBy("run_id").agg(*[
        (F.max_by(F.struct(n), order) if n in RUN_UPDATES else F.min_by(F.struct(n), order))
        .getField(n).alias(n) for n in names
    ])


def refresh(view: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """Recompute a materialised view as a whole. ``keys`` must be unique in it; else the
    stored view stays as it is."""
    if not keys:
        view.write.mode("overwrite").parquet(path)
        return
    spark, draft = view.sparkSession, f"{path}-draft-{uuid.uuid4().hex}"
    view.write.parquet(draft)
    try:
        assert_unique(spark.read.parquet(draft), keys)
    except DataQualityError:
        remove_path(spark, draft)
        raise
    replace_folder(spark, draft, path)


def refresh_days(events: DataFrame, days: DataFrame, build, path: str,
                 day_col: str = "event_date", keys: list[str] | None = None) -> None:
    """Recompute a view for the listed days only and replace just their partitions.
    ``keys`` must be unique in what is written.

    ``build`` makes the view of the events it is given; ``days`` has one column of dates
    and is small: one row per calendar day at most.
    """
    touched = F.broadcast(days.select(F.col(days.columns[0]).alias("_day")).distinct())
    if "event_date" in events.columns:
        on = F.col("event_date") == F.col("_day")
    else:
        on = F.to_date("timestamp") == F.col("_day")
    view = build(events.join(touched, on, "left_semi"))
    if day_col not in view.columns:
        view = view.withColumn(day_col, F.to_date("hour"))
    if keys:
        view = cut_lineage(view)
        assert_unique(view, keys)
    (view.repartition(day_col).write.mode("overwrite").partitionBy(day_col)
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def write_events(events: DataFrame, path: str, mode: str = "append") -> None:
    """The events table in its reading layout, see ``operators.layout``: a folder per day,
    sorted along a curve through time, type and user. The ingest writes the same layout."""
    writer(events).mode(mode).parquet(path)


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def create_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)

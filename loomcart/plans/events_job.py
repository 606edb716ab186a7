"""The event job: decode, normalise, drop repeats, audit, validate, check amounts."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcart.functions.joins import fits_broadcast
from loomcart.functions.variants import map_variant, unlisted_map
from loomcart.operators.anomaly import THRESHOLD, WINDOW_SIZE, check_amounts
from loomcart.operators.dedup import dedup_batch, fingerprint
from loomcart.operators.integrity import check_references
from loomcart.operators.normalize import normalize
from loomcart.operators.validate import FLAGGED, REJECTED, accepted, audit_nulls, rejected, validate
from loomcart.schemas import RAW_NAMES
from loomcart.session import cut_lineage, scratch_path, store
from loomcart.sources.events import KAFKA_ORDER, decoded


@dataclass
class Processed:
    """Results of one run; all of them read the same materialised rows.

    ``live`` holds the fingerprints kept within the window, for the next call's ``seen``.
    ``seconds`` is the time until the rows were classified and the alerts known.
    """

    accepted: DataFrame
    rejected: DataFrame
    quarantine: DataFrame
    alerts: DataFrame
    metrics: DataFrame
    live: DataFrame
    run_id: str
    started_at: datetime
    seconds: float


def records(parsed: DataFrame) -> DataFrame:
    """All parsed messages in one table that is to be written once: canonical columns with
    the fingerprint, ``extras`` (a variant with the fields that have no column), and
    ``_broken`` with the text in ``_raw`` for messages that are no object."""
    broken = F.col("fields").isNull()
    # The rest is a column of its own, or it would be read once for each mention.
    rest = parsed.withColumn("_rest", F.when(~broken, unlisted_map(F.col("raw"), RAW_NAMES)))
    marked = rest.withColumns({
        "_broken": broken, "_raw": F.when(broken, F.col("raw")),
        "extras": map_variant(F.col("_rest"))}).drop("_rest")
    return fingerprint(normalize(marked).drop("_normalized_at"))


def sound(rows: DataFrame) -> DataFrame:
    """The records among ``rows`` of ``records``."""
    return rows.filter(~F.col("_broken")).drop("_broken", "_raw")


def broken(rows: DataFrame, parsed: DataFrame) -> DataFrame:
    """The others, in the columns of ``parsed``."""
    rest = [c for c in parsed.columns if c not in ("fields", "raw")]
    return rows.filter("_broken").select(F.col("_raw").alias("raw"), *rest)


def clean(parsed: DataFrame) -> DataFrame:
    """Decoded records as canonical rows with their fingerprint."""
    return fingerprint(normalize(decoded(parsed)).drop("_normalized_at"))


def classify(unique: DataFrame, users: DataFrame | None = None,
             sessions: DataFrame | None = None, spread_by: list[str] | None = None) -> DataFrame:
    """Null flags, errors, warnings, outcome and, on request, reference violations. The
    key tables are read once for the rows; see ``operators.key_table`` for tables of keys
    that grow meanwhile."""
    checked = validate(audit_nulls(unique))
    if users is not None or sessions is not None:
        checked = check_references(checked, users, sessions, spread_by)
    return checked


def counters(known: bool = False) -> list[Column]:
    """Aggregates over classified rows: ingested = duplicates + rejected + inserted. With
    ``known`` rows whose ``_seen`` is true are repeats of earlier calls."""
    fresh = F.col("_seen").isNull() if known else F.lit(True)
    zero = F.lit(0).cast("bigint")
    return [
        F.coalesce(F.sum("_copies"), zero).alias("ingested"),
        F.count_if(fresh & (F.col("outcome") == REJECTED)).alias("rejected"),
        F.count_if(fresh & (F.col("outcome") == FLAGGED)).alias("flagged"),
        F.coalesce(F.sum(F.col("_copies") - fresh.cast("int")), zero).alias("duplicates_dropped"),
        F.count_if(fresh & (F.col("outcome") != REJECTED)).alias("inserted"),
    ]


def run_counters(classified: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row of counters, those of ``counters`` and the alerts."""
    zero = F.lit(0).cast("bigint")
    names = ["ingested", "rejected", "flagged", "duplicates_dropped", "anomalies_detected", "inserted"]
    rows = classified.agg(*counters("_seen" in classified.columns)).withColumn("anomalies_detected", zero)
    found = alerts.agg(F.count(F.lit(1)).alias("anomalies_detected")).select(
        *[F.col(c) if c == "anomalies_detected" else zero.alias(c) for c in names])
    both = rows.select(*names).unionByName(found)
    return both.agg(*[F.sum(c).alias(c) for c in names])


def finish(classified: DataFrame, order_by: list[str], history: DataFrame | None = None,
           one_block: bool = False, window_size: int = WINDOW_SIZE,
           threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(accepted rows with ``_anomaly_alert``, alert rows) of materialised rows."""
    good = accepted(classified)
    alerts = cut_lineage(find_alerts(good, order_by, history, one_block, window_size, threshold))
    texts = alerts.select(*order_by, "_anomaly_alert")
    if fits_broadcast(texts):
        texts = F.broadcast(texts)
    return good.join(texts, order_by, "left").drop("_copies"), alerts


def find_alerts(good: DataFrame, order_by: list[str], history: DataFrame | None = None, one_block: bool = False,
                window_size: int = WINDOW_SIZE, threshold: float = THRESHOLD) -> DataFrame:
    """The amounts of accepted rows that raise an alert. Only the order and the amount
    travel through the sort."""
    scored = check_amounts(good.select(*order_by, "amount"), order_by, history=history, one_block=one_block,
                           window_size=window_size, threshold=threshold)
    return scored.filter("is_alert").drop("is_alert")


def unseen(rows: DataFrame, order_by: list[str], seen: DataFrame | None, now_ms: int,
           window_seconds: int) -> tuple[DataFrame, DataFrame | None]:
    """First rows of their fingerprint with ``_copies`` and ``_seen`` (true where one was
    kept within the window before), and what of ``seen`` is still live.

    All rows arrive at ``now_ms``, so at most one row per fingerprint can be kept: copies
    are reduced before the shuffle and before the look-up.
    """
    unique = dedup_batch(rows, order_by, copies="_copies")
    if seen is None:
        return unique.withColumn("_seen", F.lit(None).cast("boolean")), None
    live = seen.filter(F.col("kept_ms") >= now_ms - window_seconds * 1000)
    return unique.join(live.select("fingerprint", F.lit(True).alias("_seen")), "fingerprint", "left"), live


def still_live(kept: DataFrame, live: DataFrame | None, now_ms: int) -> DataFrame:
    """fingerprint, kept_ms: what the next rows are to be held against."""
    own = kept.select("fingerprint", F.lit(now_ms).cast("bigint").alias("kept_ms"))
    return own if live is None else own.unionByName(live.select(*own.columns))


def process(parsed: DataFrame, order_by: list[str] | None = None, users: DataFrame | None = None,
            sessions: DataFrame | None = None, history: DataFrame | None = None, seen: DataFrame | None = None,
            now_ms: int | None = None, window_seconds: int = 60, window_size: int = WINDOW_SIZE,
            threshold: float = THRESHOLD, run_id: str | None = None) -> Processed:
    """Run a batch of parsed messages through all stages.

    ``order_by`` is the unique arrival order, never null. ``users`` and ``sessions``
    switch the reference checks on. ``history`` holds earlier accepted amounts, ``seen``
    the ``live`` fingerprints of the call before; ``now_ms`` is when these rows arrive.
    ``window_seconds`` belongs to the fingerprints, ``window_size`` and ``threshold`` to
    the amounts. The source is read and parsed once.
    """
    spark = parsed.sparkSession
    started, begin = datetime.now(timezone.utc), time.perf_counter()
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    order_by = order_by or KAFKA_ORDER
    rows = store(records(parsed), scratch_path(spark, "records"))
    marked, live = unseen(sound(rows), order_by, seen, now_ms, window_seconds)
    classified = store(classify(marked, users, sessions, order_by), scratch_path(spark, "classified"))
    kept = classified.filter("_seen is null").drop("_seen")
    good, alerts = finish(kept, order_by, history, window_size=window_size, threshold=threshold)
    return Processed(
        accepted=good,
        rejected=rejected(kept).drop("_copies"),
        quarantine=broken(rows, parsed),
        alerts=alerts,
        metrics=run_counters(classified, alerts),
        live=still_live(kept, live, now_ms),
        run_id=run_id or uuid.uuid4().hex,
        started_at=started,
        seconds=time.perf_counter() - begin,
    )

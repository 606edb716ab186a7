"""Common reads of the events table, one per access path it is laid out for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_type(event_type: str) -> Column:
    """Type test that reaches the Parquet scan: tables hold either upper or lower case."""
    return F.col("event_type").isin(event_type.upper(), event_type.lower())


def events_by_type(events: DataFrame, event_type: str, start: str, end: str) -> DataFrame:
    """Events of one type in [start, end), newest first."""
    ts, ts_type = F.col("timestamp"), events.schema["timestamp"].dataType
    return (events.filter(is_type(event_type)
                          & (ts >= F.lit(start).cast(ts_type))
                          & (ts < F.lit(end).cast(ts_type)))
            .orderBy(ts.desc()))


def events_by_user(events: DataFrame, user_id: str | None = None) -> DataFrame:
    """Events of one user, or of all users side by side, newest first."""
    rows = events.filter(F.col("user_id").isNotNull())
    if user_id is not None:
        rows = rows.filter(F.col("user_id") == user_id)
    return rows.orderBy("user_id", F.col("timestamp").desc())


def events_by_session(events: DataFrame, session_id: str | None = None) -> DataFrame:
    rows = events.filter(F.col("session_id").isNotNull())
    if session_id is not None:
        rows = rows.filter(F.col("session_id") == session_id)
    # The further columns let the sort cut a session that holds most rows.
    return rows.orderBy("session_id", *[c for c in ("timestamp", "event_id") if c in rows.columns])


def purchases_by_time(events: DataFrame) -> DataFrame:
    """Purchases with an amount, newest first."""
    return (events.filter(is_type("PURCHASE") & F.col("amount").isNotNull())
            .select("timestamp", "amount", "currency").orderBy(F.col("timestamp").desc()))


def null_flagged(events: DataFrame) -> DataFrame:
    """Events with audited fields sent as null, latest ingest first."""
    return events.filter(F.col("_has_nulls")).orderBy(F.col("ingested_at").desc())

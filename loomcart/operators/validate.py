"""Null audit and schema validation as added columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcart.functions.variants import is_nested
from loomcart.schemas import AUDITED_FIELDS, CURRENCIES, EVENT_TYPES, REQUIRED_FIELDS

VALID, FLAGGED, REJECTED = "valid", "flagged", "rejected"


def _is_null(df: DataFrame, name: str) -> Column:
    """Absent or null; a value that could not be read still counts as given."""
    as_text = f"{name}_text"
    return F.col(as_text if as_text in df.columns else name).isNull()


def audit_nulls(df: DataFrame) -> DataFrame:
    """Adds ``_null_flags`` and ``_has_nulls``: audited fields sent as null (not absent)."""
    flags = F.array_compact(F.array(*[
        F.when(F.col("_present")[n] & F.col(n).isNull(), F.lit(n)) for n in AUDITED_FIELDS
    ]))
    return df.withColumn("_null_flags", flags).withColumn(
        "_has_nulls", F.size("_null_flags") > 0)


def _message(prefix: str, name: str) -> Column:
    shown = F.coalesce(F.col(name), F.lit("None"))
    return F.concat(F.lit(f"{prefix}: '"), shown, F.lit("'"))


def _missing_errors(df: DataFrame) -> list[Column]:
    # One list per record type: each has its own fields in its own order.
    per_type = []
    for record_type, names in REQUIRED_FIELDS.items():
        known = F.col("record_type") == record_type
        if record_type == "event":
            others = [t for t in REQUIRED_FIELDS if t != "event"]
            known = ~F.coalesce(F.col("record_type").isin(others), F.lit(False))
        per_type += [
            F.when(known & _is_null(df, n), F.lit(f"Missing required field: '{n}'")) for n in names
        ]
    return per_type


def validate(df: DataFrame) -> DataFrame:
    """Adds ``errors``, ``warnings`` and ``outcome`` (valid, flagged or rejected)."""
    checks = _missing_errors(df)
    if "_json_type" in df.columns:
        kind = F.col("_json_type")
        not_number = (F.col("amount").isNull() & F.col("amount_text").isNotNull()
                      & ~F.lower(F.trim("amount_text")).rlike(r"^[+-]?(nan|inf|infinity)$"))
        checks.append(F.when(not_number, F.concat(
            F.lit("Field 'amount' must be numeric, got: "),
            F.when(kind["amount"].startswith("ARRAY"), "list")
            .when(kind["amount"].startswith("OBJECT"), "dict").otherwise("str"))))
        checks.append(F.when(is_nested(kind["timestamp"]), F.lit(
            "Field 'timestamp' must be int/float (epoch) or ISO string")))
    bad_currency = F.col("_present")["currency"] & ~F.coalesce(
        F.col("currency").isin(CURRENCIES), F.lit(False))
    checks.append(F.when(bad_currency, _message("Invalid currency", "currency")))
    odd_type = F.col("_present")["event_type"] & ~F.coalesce(
        F.upper("event_type").isin(EVENT_TYPES), F.lit(False))

    # A generator, not a projection: a filter on the outcome stays above it. Pushed down
    # it would repeat every check and all parsing below.
    checked = df.select("*", F.inline(F.array(F.struct(
        F.array_compact(F.array(*checks)).alias("errors"),
        F.array_compact(F.array(
            F.when(odd_type, _message("Unrecognised event_type", "event_type")))).alias("warnings"),
    ))))
    outcome = (F.when(F.size("errors") > 0, REJECTED)
               .when(F.size("warnings") > 0, FLAGGED).otherwise(VALID))
    return checked.withColumn("outcome", outcome)


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("outcome") != REJECTED)


def rejected(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("outcome") == REJECTED)

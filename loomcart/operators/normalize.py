"""Raw JSON fields to canonical event columns."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcart.functions.text import bare_number, finite, iso_text, parse_number, strip
from loomcart.functions.variants import all_fields, is_number, key_order, type_name
from loomcart.schemas import EVENT_FIELDS, FIELD_ALIASES, RAW_NAMES, TEXT_FIELDS

# ISO-8601 shapes that are read as a time; anything else stays text.
_ISO = (r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?"
        r"([+-]\d{2}:\d{2})?)?$")
# Epoch numbers above this are milliseconds.
_MILLIS_FROM = 1e12
# Seconds of 0001-01-01 and 10000-01-01, the years a time can have.
_FIRST_SECOND, _END_SECOND = -62135596800, 253402300800

_UPPER = {"event_type", "currency", "country"}
_TRIMMED = {"user_id", "session_id", "event_id"}


_TYPED = sorted({*_UPPER, *_TRIMMED, "amount", "timestamp"})
_NUMERIC = ["amount", "timestamp"]


def _clash(fields: Column) -> Column:
    """Whether a record holds more than one name of some field, which is rare."""
    found = []
    for name, aliases in FIELD_ALIASES.items():
        held = [fields[n].isNotNull().cast("int") for n in [name, *aliases]]
        found.append(reduce(operator.add, held) > 1)
    return reduce(operator.or_, found)


def _pick_field(fields: Column, name: str, aliases: bool) -> Column:
    """The value that ends up under ``name``; null when there is none (a JSON null is a
    value). When several names are present the last one in the record wins."""
    names = [name, *FIELD_ALIASES.get(name, [])] if aliases else [name]
    found = F.coalesce(*[fields[n] for n in names])
    if len(names) == 1:
        return found
    last = F.try_element_at(F.filter("_order", lambda k: k.isin(names)), F.lit(-1))
    chosen = reduce(lambda case, n: case.when(last == n, fields[n]), names[1:],
                    F.when(last == names[0], fields[names[0]]))
    return F.when(F.col("_order").isNotNull(), chosen).otherwise(found)


def _read_fields(df: DataFrame, aliases: bool) -> tuple[DataFrame, list[str]]:
    """Every canonical field as plain columns, and the names of the columns carried along.

    ``_s_x`` text, ``_t_x`` JSON type, ``_d_x`` number, ``_present``, and the parts the
    time and the amount are made from. What is used more than once gets a projection of
    its own: Catalyst then evaluates it once.
    """
    rest = [c for c in df.columns if c not in ("fields", "raw")]
    fields = F.col("fields")
    # Records with clashing names are read once more, for the order of their keys.
    order = F.when(_clash(fields), key_order(F.col("raw"))) if aliases else F.lit(None)
    picked = df.withColumn("_order", order).select(*rest, *[
        _pick_field(fields, n, aliases).alias(f"_v_{n}") for n in EVENT_FIELDS])
    present = F.struct(*[F.col(f"_v_{n}").isNotNull().alias(n) for n in EVENT_FIELDS])
    read = picked.select(
        *rest, present.alias("_present"),
        *[(F.col(f"_v_{n}") if n in TEXT_FIELDS else F.try_variant_get(f"_v_{n}", "$", "string"))
          .alias(f"_s_{n}") for n in EVENT_FIELDS],
        *[type_name(F.col(f"_v_{n}")).alias(f"_t_{n}") for n in _TYPED],
        # Of numbers only: reading text as one raises an error inside Spark for every row that is none.
        *[F.when(_counts(type_name(F.col(f"_v_{n}"))), F.try_variant_get(f"_v_{n}", "$", "double")).alias(f"_d_{n}")
          for n in _NUMERIC],
    )
    number = F.col("_d_timestamp")
    parts = read.withColumns({
        "_seconds": F.when(number > F.lit(_MILLIS_FROM), number / F.lit(1000.0)).otherwise(number),
        "_iso": F.replace(F.col("_s_timestamp"), F.lit("Z"), F.lit("+00:00")),
        "_bare_amount": bare_number(F.col("_s_amount")),
        "_epoch": _is_numeric("timestamp"),
    })
    amount = (F.when(F.col("_t_amount") == "STRING", parse_number(F.col("_bare_amount")))
              .when(_is_numeric("amount"), F.col("_d_amount")))
    return parts.withColumns({"_number": amount, "_time": _parse_time()}), rest


def _counts(kind: Column) -> Column:
    """Types of numbers, and of booleans, which count as 0 and 1."""
    return F.coalesce(is_number(kind) | (kind == "BOOLEAN"), F.lit(False))


def _is_numeric(name: str) -> Column:
    return _counts(F.col(f"_t_{name}"))


def _parse_time() -> Column:
    """Epoch seconds or milliseconds, or ISO text; null for anything else."""
    seconds, iso = F.col("_seconds"), F.col("_iso")
    in_range = (seconds >= _FIRST_SECOND) & (seconds < _END_SECOND)
    epoch = F.timestamp_micros(F.when(in_range, F.rint(seconds * F.lit(1e6))).cast("bigint"))
    # Spark reads HH:MM only without an offset.
    padded = F.regexp_replace(iso, r"^(.{10})[T ](\d{2}:\d{2})([+-]|$)", "$1T$2:00$3")
    written = F.when(iso.rlike(_ISO), padded.try_cast("timestamp"))
    return F.when(F.col("_epoch"), epoch).when(F.col("_t_timestamp") == "STRING", written)


def _time_text() -> Column:
    """The time as text: ISO when it was read, else what was sent."""
    kept = F.when(F.col("_epoch"), F.col("_s_timestamp")).otherwise(F.col("_iso"))
    return F.when(F.col("_time").isNotNull(), iso_text(F.col("_time"))).otherwise(kept)


def _clean(name: str) -> Column:
    """Text trimmed and, for some fields, upper-cased; other JSON types as they are."""
    text = strip(F.col(f"_s_{name}"))
    if name in _UPPER:
        text = F.upper(text)
    kind = F.col(f"_t_{name}")
    return (F.when(kind == "STRING", text)
            .when(kind == "BOOLEAN", F.initcap(F.col(f"_s_{name}")))
            .otherwise(F.col(f"_s_{name}")))


def _given(name: str) -> Column:
    return F.coalesce(F.col(f"_t_{name}") != "VOID", F.lit(False))


def normalize(decoded: DataFrame) -> DataFrame:
    """Canonical event columns from ``fields``; the other columns are carried along.

    Adds per row: ``_present`` (which fields the record held), ``timestamp_text`` (what
    a consumer of the text form would see), ``ts_parse_ok`` and ``_bad_amount``.
    """
    read, rest = _read_fields(decoded, aliases=True)
    columns = {n: _clean(n) if n in _UPPER | _TRIMMED else F.col(f"_s_{n}") for n in EVENT_FIELDS}
    columns["timestamp"] = F.col("_time")
    columns["amount"] = finite(F.col("_number"))
    return read.select(
        *rest, *[c.alias(n) for n, c in columns.items()], "_present",
        _time_text().alias("timestamp_text"),
        F.when(_given("timestamp"), F.col("_time").isNotNull()).alias("ts_parse_ok"),
        (_given("amount") & finite(F.col("_number")).isNull()).alias("_bad_amount"),
        F.current_timestamp().alias("_normalized_at"),
    )


def other_fields(decoded: DataFrame) -> DataFrame:
    """Adds ``extras``: the fields of a record that are no event columns, as variants."""
    return decoded.withColumn("extras", F.map_filter(
        all_fields(F.col("raw")), lambda k, v: ~k.isin(RAW_NAMES)))


def raw_event_columns(decoded: DataFrame) -> DataFrame:
    """Canonical columns without aliases or cleaning, for validating records as sent.

    ``_json_type`` holds the JSON types the type checks ask about.
    """
    read, rest = _read_fields(decoded, aliases=False)
    plain = [n for n in EVENT_FIELDS if n not in _NUMERIC]
    return read.select(
        *rest, *[F.col(f"_s_{n}").alias(n) for n in plain],
        F.col("_time").alias("timestamp"), _time_text().alias("timestamp_text"),
        finite(F.col("_number")).alias("amount"), F.col("_s_amount").alias("amount_text"),
        F.struct(*[F.col(f"_t_{n}").alias(n) for n in _NUMERIC]).alias("_json_type"),
        "_present",
    )


def from_columns(df: DataFrame) -> DataFrame:
    """Events that already are a table: adds the columns ``normalize`` would add.

    A table cannot tell absent from null; null counts as absent.
    """
    missing = {n: F.lit(None).cast("string") for n in EVENT_FIELDS if n not in df.columns}
    full = df.withColumns(missing) if missing else df
    full = full.withColumns({"timestamp": F.col("timestamp").cast("timestamp"),
                             "amount": F.col("amount").cast("double")})
    present = F.struct(*[F.col(n).isNotNull().alias(n) for n in EVENT_FIELDS])
    return full.withColumns({
        "_present": present,
        "timestamp_text": iso_text(F.col("timestamp")),
        "ts_parse_ok": F.when(F.col("timestamp").isNotNull(), F.lit(True)),
    })

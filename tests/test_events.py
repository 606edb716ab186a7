"""Decoding, normalising, duplicates, audit, validation and references on small tables."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loomcart.operators import dedup
from loomcart.operators.integrity import check_references
from loomcart.operators.normalize import _read_fields, from_columns, normalize, other_fields, raw_event_columns
from loomcart.operators.validate import audit_nulls, validate
from loomcart.plans.events_job import process, records
from loomcart.sources.events import decoded, kafka_options, parse_kafka, parse_landing, quarantined


def parsed(spark, *records):
    lines = [(n, r if isinstance(r, str) or r is None else json.dumps(r)) for n, r in enumerate(records)]
    return parse_landing(spark.createDataFrame(lines, "seq int, value string"))


def normal(spark, *records):
    return normalize(decoded(parsed(spark, *records))).orderBy("seq").collect()


def test_aliases(spark):
    row, = normal(spark, {"userId": "u123", "eventType": "click", "ts": 1700000000})
    assert (row.user_id, row.event_type) == ("u123", "CLICK")
    assert row.timestamp == datetime(2023, 11, 14, 22, 13, 20)


@pytest.mark.parametrize("record, user", [
    ({"userId": "a", "user": "b"}, "b"),
    ({"userId": "a", "user": None}, None),
    ('{"user": "a", "userId": "b", "user": "c"}', "b"),
    ({"user_id": 7}, "7"),
    ({"uid": "  x \t"}, "x"),
])
def test_last_alias_wins(spark, record, user):
    row, = normal(spark, record)
    assert row.user_id == user and row["_present"].user_id


@pytest.mark.parametrize("sent, amount", [
    ("42.50", 42.5), (" 42.5 ", 42.5), ("1e3", 1000.0), ("1_000", 1000.0), (7, 7.0), (True, 1.0),
    ("1.0d", None), ("not-a-number", None), ("", None), ("nan", None), ("inf", None), (None, None),
    ([1], None), ("0x10", None),
])
def test_amount(spark, sent, amount):
    row, = normal(spark, {"amt": sent})
    assert row.amount == amount
    assert row["_bad_amount"] == (sent is not None and amount is None)


@pytest.mark.parametrize("sent, expected", [
    (1700000000, datetime(2023, 11, 14, 22, 13, 20)),
    (1700000000000, datetime(2023, 11, 14, 22, 13, 20)),
    (1700000000.5, datetime(2023, 11, 14, 22, 13, 20, 500000)),
    ("2024-01-01T00:00:00Z", datetime(2024, 1, 1)),
    ("2024-01-01T05:30:00.123456+05:30", datetime(2024, 1, 1, 0, 0, 0, 123456)),
    ("2024-01-01 10:20", datetime(2024, 1, 1, 10, 20)),
    ("2024-01-01T10:20+01:00", datetime(2024, 1, 1, 9, 20)),
    ("2024-01-01", datetime(2024, 1, 1)),
])
def test_timestamp(spark, sent, expected):
    row, = normal(spark, {"time": sent})
    assert row.timestamp == expected and row.ts_parse_ok


@pytest.mark.parametrize("sent, text", [
    ("1700000000", "1700000000"), ("garbage", "garbage"), ("2024", "2024"), ("20240101T000000", None),
    (1e30, "1.0E30"),
])
def test_unreadable_timestamp_stays_text(spark, sent, text):
    row, = normal(spark, {"ts": sent})
    assert row.timestamp is None and row.ts_parse_ok is False
    assert row.timestamp_text == (text or sent)


def test_case_and_batch(spark):
    rows = normal(spark, {"event_type": " purchase ", "currency": "usd", "country": "de"},
                  *[{"userId": f"u{i}", "ts": 1700000000} for i in range(5)])
    assert (rows[0].event_type, rows[0].currency, rows[0].country) == ("PURCHASE", "USD", "DE")
    assert [r.user_id for r in rows[1:]] == [f"u{i}" for i in range(5)]


def test_other_fields(spark):
    row = other_fields(decoded(parsed(spark, {"id": "e", "coupon": 5}))).select(
        F.to_json("extras").alias("x")).first()
    assert json.loads(row.x) == {"coupon": 5}


@pytest.mark.parametrize("text", [
    "xx", "[1]", "5", "", None, "null", '{"a": 1', '{"a": 1} x', '{"a": 1}{"b": 2}', '[{"a": 1}]',
    "{'a': 1}", '{"id": 1}, {"id": 2}', '{"id": 1}]}',
])
def test_not_an_object(spark, text):
    df = parsed(spark, text, {"id": "ok"})
    assert [r.seq for r in quarantined(df).collect()] == [0]
    assert [r.seq for r in decoded(df).collect()] == [1]


def test_kafka_columns(spark):
    from loomcart.schemas import KAFKA_SCHEMA

    rows = [(None, bytearray(b'{"id": "e"}'), "t", 3, 9, datetime(2024, 1, 1), 0),
            (None, bytearray(b'{"id": "\xff"}'), "t", 3, 10, datetime(2024, 1, 1), 0)]
    df = parse_kafka(spark.createDataFrame(rows, KAFKA_SCHEMA))
    good, = decoded(df).collect()
    assert (good["_kafka_partition"], good["_kafka_offset"]) == (3, 9)
    assert good["_kafka_timestamp"] == 1704067200000
    assert quarantined(df).count() == 1


def test_kafka_options():
    options = kafka_options("host:9092", "orders")
    assert options["subscribe"] == "orders" and options["maxOffsetsPerTrigger"] == "500"
    assert options["startingOffsets"] == "earliest"


# --- duplicates ---

def test_batch_dedup_and_stats(spark):
    event = {"event_id": "e1", "user_id": "u1", "event_type": "click", "timestamp": "t1"}
    other = {**event, "event_id": "e2", "event_type": "purchase"}
    rows = dedup.fingerprint(normalize(decoded(parsed(spark, event, event, other, event))))
    kept = dedup.dedup_batch(rows, ["seq"], copies="n").orderBy("seq").collect()
    assert [(r.seq, r.n) for r in kept] == [(0, 3), (2, 1)]
    stats = dedup.dedup_stats(rows).first()
    assert stats.asDict() == {"total_processed": 4, "duplicates_dropped": 2, "dedup_rate_pct": 50.0,
                              "window_size": 2, "window_seconds": 60}
    again = dedup.dedup_batch(rows.join(dedup.dedup_batch(rows, ["seq"]).select("seq"), "seq"), ["seq"])
    assert again.count() == 2


def test_stats_of_nothing(spark):
    empty = spark.createDataFrame([], "fingerprint string")
    assert dedup.dedup_stats(empty).first()["dedup_rate_pct"] == 0.0


def test_fingerprint_tells_absent_from_null(spark):
    rows = dedup.fingerprint(normalize(decoded(parsed(
        spark, {"event_id": "e"}, {"event_id": "e", "user_id": None})))).collect()
    assert len({r.fingerprint for r in rows}) == 2


def test_fingerprint_value(spark):
    import hashlib

    row = dedup.fingerprint(normalize(decoded(parsed(spark, {
        "event_id": "e1", "user_id": None, "ts": "2024-01-01T00:00:00Z"})))).first()
    text = "e1|None||2024-01-01T00:00:00+00:00"
    assert row.fingerprint == hashlib.sha256(text.encode()).hexdigest()[:20]


def _window(spark, arrivals, **options):
    rows = [(k, t, n) for n, (k, t) in enumerate(arrivals)]
    df = spark.createDataFrame(rows, "fingerprint string, at bigint, seq int")
    kept = dedup.dedup_window(df, "at", ["seq"], **options).collect()
    return sorted((r.fingerprint, r.at, r.seq) for r in kept)


def _brute(arrivals, window_ms=60_000):
    kept, last = [], {}
    for seq, (key, at) in sorted(enumerate(arrivals), key=lambda x: (x[1][1], x[0])):
        if key not in last or at - last[key] > window_ms:
            last[key] = at
            kept.append((key, at, seq))
    return sorted(kept)


def test_window_edges(spark):
    seconds = [0, 30, 60, 61, 100, 122, 200]
    kept = _window(spark, [("a", s * 1000) for s in seconds])
    assert [at // 1000 for _, at, _ in kept] == [0, 61, 122, 200]


@pytest.mark.parametrize("width, fan", [(240, 32), (3, 2), (1, 3)])
def test_window_against_brute_force(spark, width, fan):
    """Once with a block for most keys, then cut into short blocks under several levels."""
    import random

    rnd = random.Random(7)
    arrivals = [("hot", rnd.randrange(0, 4_000_000)) for _ in range(3000)]
    arrivals += [("dense", 10_000_000 + i * 500) for i in range(2000)]
    arrivals += [(f"k{rnd.randrange(40)}", rnd.randrange(0, 900_000)) for _ in range(300)]
    arrivals += [("hot", arrivals[0][1])]
    rnd.shuffle(arrivals)
    got = _window(spark, arrivals, windows_per_block=width, fan=fan)
    assert got == _brute(arrivals)


def test_window_chain_over_borders(spark):
    """Kept instants depend on what is kept many blocks before, and times lie around zero."""
    arrivals = [("a", t) for t in range(-900_000, 900_000, 25_000)] + [("b", -1), ("b", 0), ("b", 60_000)]
    assert _window(spark, arrivals, windows_per_block=2, fan=2) == _brute(arrivals)
    assert _window(spark, []) == []


# --- audit and validation ---

def _validated(spark, *records):
    return validate(audit_nulls(normalize(decoded(parsed(spark, *records))))).orderBy("seq").collect()


EVENT = {"record_type": "event", "event_id": "e1", "event_type": "CLICK",
         "timestamp": "2024-01-01T00:00:00Z", "user_id": "u1"}


def test_outcomes(spark):
    untyped = {k: v for k, v in EVENT.items() if k != "record_type"}
    valid, missing, currency, unknown = _validated(
        spark, EVENT, {"event_type": "click"}, {**untyped, "event_type": "PURCHASE", "currency": "FAKE"},
        {**untyped, "event_type": "UNKNOWN_EVENT"})
    assert valid.outcome == "valid" and valid.errors == [] and valid.warnings == []
    assert missing.outcome == "rejected"
    assert missing.errors == [f"Missing required field: '{n}'" for n in ("event_id", "timestamp", "user_id")]
    assert currency.errors == ["Invalid currency: 'FAKE'"]
    assert unknown.outcome == "flagged"
    assert unknown.warnings == ["Unrecognised event_type: 'UNKNOWN_EVENT'"]


def test_currency_absent_null_and_spaces(spark):
    rows = _validated(spark, EVENT, {**EVENT, "currency": None}, {**EVENT, "currency": "USD"},
                      {**EVENT, "currency": "usd "})
    assert [r.outcome for r in rows] == ["valid", "rejected", "valid", "valid"]
    assert rows[1].errors == ["Invalid currency: 'None'"]


def test_record_types(spark):
    rows = _validated(spark, {**EVENT, "record_type": "transaction", "amount": 1, "currency": "USD"},
                      {**EVENT, "record_type": "pageview", "session_id": "s"},
                      {**EVENT, "record_type": "survey"}, {**EVENT, "record_type": None})
    assert rows[0].errors == ["Missing required field: 'transaction_id'"]
    assert rows[1].errors == ["Missing required field: 'path'"]
    assert [r.outcome for r in rows[2:]] == ["valid", "valid"]


def test_type_checks_on_records_as_sent(spark):
    rows = validate(raw_event_columns(decoded(parsed(
        spark, {**EVENT, "amount": "abc"}, {**EVENT, "amount": [1]}, {**EVENT, "amount": "nan"},
        {**EVENT, "timestamp": {"a": 1}}, {**EVENT, "amount": "12"})))).orderBy("seq").collect()
    assert rows[0].errors == ["Field 'amount' must be numeric, got: str"]
    assert rows[1].errors == ["Field 'amount' must be numeric, got: list"]
    assert rows[2].errors == [] and rows[4].errors == []
    assert rows[3].errors == ["Field 'timestamp' must be int/float (epoch) or ISO string"]


def test_null_audit(spark):
    row, clean = _validated(spark, {"user_id": None, "country": None}, {"user_id": "u"})
    assert row["_null_flags"] == ["user_id", "country"] and row["_has_nulls"]
    assert clean["_null_flags"] == [] and not clean["_has_nulls"]


@pytest.mark.parametrize("limit", [500_000, 0])
def test_references(spark, limit):
    events = from_columns(spark.createDataFrame(
        [("1", "u1", "s1"), ("2", "u9", "s9"), ("3", None, ""), ("4", "u9", None)],
        "event_id string, user_id string, session_id string"))
    users = spark.createDataFrame([("u1",), ("u1",), (None,)], "id string")
    sessions = spark.createDataFrame([("s1",)], "id string")
    got = {r.event_id: r.violations for r in check_references(
        events, users, sessions, ["event_id"], limit).collect()}
    assert got == {"1": [], "2": ["Unknown user_id: 'u9'", "Unknown session_id: 's9'"], "3": [],
                   "4": ["Unknown user_id: 'u9'"]}


def test_empty_key_table_checks_nothing(spark):
    events = from_columns(spark.createDataFrame([("1", "u1")], "event_id string, user_id string"))
    none = spark.createDataFrame([], "id string")
    assert check_references(events, users=none).first().violations == []


# --- the whole job ---

def test_counters_add_up(spark):
    records = [{**EVENT, "event_id": f"e{n % 30}", "amount": 100 + n % 30, "currency": "USD" if n % 7 else "X"}
               for n in range(50)] + ["broken"]
    users = spark.createDataFrame([("u1",)], "id string")
    result = process(parsed(spark, *records), ["seq"], users=users)
    m = result.metrics.first()
    assert m.ingested == 50 and result.quarantine.count() == 1
    assert m.ingested == m.duplicates_dropped + m.rejected + m.inserted
    assert m.inserted == result.accepted.count() and m.rejected == result.rejected.count()
    assert m.duplicates_dropped == 20


def test_history_continues_the_sequence(spark):
    records = [{**EVENT, "event_id": f"e{n}", "amount": 100} for n in range(1)]
    history = spark.createDataFrame([(n - 100, 100.0 + n % 2) for n in range(50)], "seq int, amount double")
    spike = {**EVENT, "event_id": "x", "amount": 900}
    result = process(parsed(spark, *records, spike), ["seq"], history=history)
    assert [r.seq for r in result.alerts.collect()] == [1]


def test_text_is_not_read_as_a_number(spark):
    """Each text that is no number would raise an error inside Spark; numbers are read from numbers."""
    read, _ = _read_fields(decoded(parsed(spark, {"timestamp": "1700000000", "amount": "12"}, {"ts": 1700000000.5, "amt": 12},
                                          {"time": True, "price": False})), aliases=True)
    assert [(r["_d_timestamp"], r["_d_amount"]) for r in read.orderBy("seq").collect()] == [
        (None, None), (1700000000.5, 12.0), (1.0, 0.0)]


def test_other_fields_are_read_once(spark):
    """The record's other fields are parsed for one mention, not again for each; they come out whole."""
    rows = records(parsed(spark, {"user": "a", "x": {"y": [1, 2]}, "z": None}, {"user": "b"}, "[1]", None))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("map_filter(") == 1
    found = rows.orderBy("seq").select(F.try_variant_get("extras", "$.x.y[1]", "int").alias("y"),
                                       F.col("extras").isNull().alias("none"), "_broken")
    assert [tuple(r) for r in found.collect()] == [(2, False, False), (None, True, False), (None, True, True), (None, True, True)]

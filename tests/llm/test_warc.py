import hashlib
import random

import pytest
from odd import pages

from loomcart.llm import warc as W


def brute(rows, least=1000):
    largest = {}
    for i, _, h in rows:
        key = (h or "").encode()
        if i is not None and len(key) >= least:
            largest[key] = max(largest.get(key, i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        refer = largest.get(data)
        refer = None if refer == i else refer
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if refer is None else "revisit", refer))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.drop("uri").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


def nasty(made, n):
    parts = ["WARC/1.1", "\r\n", "\r\n\r\n", "WARC/1.1\r\n", "0\r\n\r\n", "é", "\U0001f600", "text ", "\x00", "\r"]
    return "".join(made.choice(parts) for _ in range(n))


def rows():
    made = random.Random(6)
    out = [(i, f"http://h/{i}", nasty(made, made.randint(0, 4000))) for i in range(40)]
    same = "x" * 999 + "é"
    out += [(100, "u", same), (101, "u", same), (102, None, same), (103, "u", "y" * 999), (104, "u", "y" * 999),
            (105, "http://a/\r\nWARC-Type: x", None), (106, "http://a/WARC/1.1", ""), (None, "u", same),
            (102, "u", same), (None, "u", "z" * 2000), (107, "u", "w" * 100_000)]
    return out


def test_round_trip(spark, folder):
    data = rows()
    assert got(W.round_trip(pages(spark, data), folder)) == brute(data)


def test_shuffled_join(spark, folder, monkeypatch):
    monkeypatch.setattr("loomcart.llm.common.BROADCAST_ROWS", -1)
    data = rows()
    assert got(W.round_trip(pages(spark, data), folder)) == brute(data)


def test_payloads_come_back_whole(spark, folder):
    data = [(i, "u", h) for i, (_, _, h) in enumerate(rows())]
    W.write_archives(pages(spark, data), folder, least_bytes=10 ** 9, segment_bytes=300)
    records = W.read_records(spark, folder)
    assert records.where("record_type = 'continuation'").count() > 100
    back = {r.page_id: bytes(r.payload).decode() for r in W.reassemble(records).collect()}
    assert back == {i: h or "" for i, _, h in data}


def test_files_are_plain_warc(spark, folder):
    """Read by the lengths the headers state, as any reader would."""
    data = rows()
    W.write_archives(pages(spark, data), folder)
    names = [r.path for r in spark.read.format("binaryFile").load(folder).select("path").collect()]
    n = 0
    for row in spark.read.format("binaryFile").load(folder).collect():
        content, at = bytes(row.content), 0
        while at < len(content):
            end = content.index(b"\r\n\r\n", at)
            lines = content[at:end].split(b"\r\n")
            assert lines[0] == b"WARC/1.1"
            length = int([x for x in lines if x.startswith(b"Content-Length:")][0].split(b":")[1])
            at = end + 4 + length
            assert content[at:at + 4] == b"\r\n\r\n"
            at += 4
            n += any(x in (b"WARC-Type: response", b"WARC-Type: revisit") for x in lines)
    assert n == len(data) and names


def test_missing_segments_are_noticed(spark, folder):
    W.write_archives(pages(spark, [(1, "u", "a" * 5000)]), folder, segment_bytes=1000)
    records = W.read_records(spark, folder)
    for lost in ("segment <> 2", "segment < 5", "segment <> 1"):
        with pytest.raises(Exception, match="segments|bytes of"):
            W.reassemble(records.where(lost)).collect()


def test_empty_table(spark, folder):
    assert got(W.round_trip(pages(spark, []), folder)) == []



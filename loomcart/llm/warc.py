"""WARC archives: records written in segments with chunked framing, and read back.

Writing. A response record's block is an HTTP answer whose body is framed in chunks. A
block over ``segment_bytes`` is cut into segments: the first is the response record, the
others are continuation records that name its id, and the last gives the total length.
The line that opens a record must never stand inside one, since readers cut files at it;
the writer is free to choose where chunks end and ends one inside every such line of a
payload. Spark's text writer puts the records into files, so a lost task leaves nothing
half-written.

Reading. Files are cut at record openings by Spark's text reader, in parallel within a
file. Segments are grouped by origin id, ordered by number, checked against the total
length and freed of their framing. Revisits take the size of the response they refer to.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcart.llm.common import checked_broadcast, stored

VERSION = "WARC/1.1"
OPENING = VERSION + "\r\n"
LEAST_BYTES = 1000  # payloads below this are never revisits
SEGMENT_BYTES = 16384
CHUNK_BYTES = 4096
DATE = "2024-01-01T00:00:00Z"  # of capture; the pages table has none
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_OPENS = VERSION.encode()  # with the line end that framing may add, an opening
_SPLIT = len("WARC")  # a chunk ends after so many bytes of it inside a payload

_RECORDS = ("record_type string, record_id string, origin_id string, segment int, total_length long, "
            "page_id long, refers_to long, digest string, uri string, block binary")
_PAYLOADS = ("record_type string, record_id string, page_id long, refers_to long, digest string, "
             "uri string, payload binary")


def _chunks(payload: bytes):
    """Pieces of at most CHUNK_BYTES that end at characters and inside openings."""
    at = 0
    while at < len(payload):
        to = min(at + CHUNK_BYTES, len(payload))
        while to < len(payload) and payload[to] & 0xC0 == 0x80 and to > at + 1:
            to -= 1
        opens = payload.find(_OPENS, at, to + len(_OPENS))
        if opens >= 0:
            to = min(to, opens + _SPLIT)
        yield payload[at:to]
        at = to


def http_block(payload: bytes) -> bytes:
    framed = b"".join(b"%x\r\n%b\r\n" % (len(c), c) for c in _chunks(payload))
    return _HTTP + framed + b"0\r\n\r\n"


def _pieces(block: bytes, size: int):
    at = 0
    while at < len(block) or at == 0:
        to = min(at + size, len(block))
        while to < len(block) and block[to] & 0xC0 == 0x80 and to > at + 1:
            to -= 1
        yield block[at:to]
        at = to


def _uri(url: str | None) -> str | None:
    """``url`` with control characters, and an opening at its end, percent-encoded."""
    if url is None:
        return None
    safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    return safe[:-1] + "%31" if safe.endswith(VERSION) else safe


def _record(fields: list[tuple[str, object]], block: bytes) -> str:
    """A record without its last line feed, which the text writer adds."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    text = f"{OPENING}{head}Content-Length: {len(block)}\r\n\r\n".encode()
    return (text + block + b"\r\n\r").decode()


def page_records(page_id, url, payload: bytes, digest: str, refers_to, key: str, segment_bytes: int):
    """The records of one page, as text."""
    record_id = f"<urn:uuid:{uuid.UUID(hashlib.sha256(key.encode()).hexdigest()[:32])}>"
    shared = [("WARC-Target-URI", _uri(url)), ("WARC-Date", DATE), ("X-Page-ID", page_id)]
    if refers_to is not None:
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", record_id), *shared,
                       ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                       ("X-Refers-To-Page-ID", refers_to), ("WARC-Payload-Digest", f"sha1:{digest}")], b"")
        return
    block = http_block(payload)
    pieces = list(_pieces(block, segment_bytes))
    first = [("WARC-Type", "response"), ("WARC-Record-ID", record_id), *shared,
             ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if len(pieces) == 1:
        yield _record(first, block)
        return
    yield _record([*first, ("WARC-Segment-Number", 1)], pieces[0])
    for number, piece in enumerate(pieces[1:], 2):
        own = uuid.UUID(hashlib.sha256(f"{key} {number}".encode()).hexdigest()[:32])
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{own}>"), ("WARC-Date", DATE),
                       ("WARC-Segment-Origin-ID", record_id), ("WARC-Segment-Number", number),
                       ("WARC-Segment-Total-Length", len(block) if number == len(pieces) else None)], piece)


def originals(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """sha, keeper: the largest page_id of every payload of at least ``least_bytes`` that
    occurs under more than one page_id."""
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select("page_id", F.sha2(html, 256).alias("sha"), F.octet_length(html).alias("n"))
    return (keyed.where(F.col("n") >= least_bytes).groupBy("sha")
            .agg(F.max("page_id").alias("keeper"), F.min("page_id").alias("least"),
                 F.count(F.lit(1)).alias("rows"), F.count("page_id").alias("ids"))
            .where("least < keeper or (rows > ids and ids > 0)").select("sha", "keeper"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES,
                   segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) to WARC files at ``path``."""
    kept = stored(originals(pages, least_bytes), "originals")
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
                        F.when(F.octet_length(html) >= least_bytes, F.sha2(html, 256)).alias("sha"),
                        F.monotonically_increasing_id().alias("row"))
    # Few payloads repeat as a rule; where many do, the join shuffles, and AQE splits
    # payloads with many rows.
    joined = rows.join(checked_broadcast(kept, kept.count()), "sha", "left").select(
        "page_id", "url", "html", "row", F.when(~F.col("keeper").eqNullSafe(F.col("page_id")), F.col("keeper"))
        .alias("refers_to"))

    def records(batches):
        for batch in batches:
            html = batch.column(2).cast(pa.large_binary())
            ids, urls, rows, refers = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
            out, held = [], 0
            for page_id, url, payload, row, refer in zip(ids, urls, html, rows, refers):
                payload = payload.as_py()
                digest = hashlib.sha1(payload).hexdigest()
                for record in page_records(page_id, url, payload, digest, refer, f"{page_id} {row} {digest}",
                                           segment_bytes):
                    out.append(record)
                    held += len(record)
                    if held > 8_000_000:
                        yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.string())})
                        out, held = [], 0
            yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.string())})

    joined.mapInArrow(records, "value string").write.text(path)


def parse_record(data: bytes) -> dict | None:
    """Fields of a record from the bytes after its opening; None if there are none."""
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found:
        return None
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    length = int(fields["content-length"])
    if len(rest) < length:
        raise ValueError(f"record {fields.get('warc-record-id')} is cut short")

    def number(name):
        return int(fields[name]) if name in fields else None

    return {"record_type": fields["warc-type"], "record_id": fields["warc-record-id"],
            "origin_id": fields.get("warc-segment-origin-id", fields["warc-record-id"]),
            "segment": number("warc-segment-number"), "total_length": number("warc-segment-total-length"),
            "page_id": number("x-page-id"), "refers_to": number("x-refers-to-page-id"),
            "digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "uri": fields.get("warc-target-uri"), "block": rest[:length]}


def unchunk(block: bytes) -> bytes:
    """The payload of an HTTP answer; the chunked framing is checked and taken off."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("HTTP header does not end")
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        out.append(body[at:at + size])
        at += size
        if body[at:at + 2] != b"\r\n":
            raise ValueError("chunk does not end where its size says")
        at += 2


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives: header fields and block. Spark cuts the files at
    record openings, so one large file is read by many tasks."""

    def parse(batches):
        for batch in batches:
            texts = batch.column(0).cast(pa.large_binary())
            rows = [parse_record(t.as_py()) for t in texts]
            yield pa.RecordBatch.from_pylist([r for r in rows if r], schema)

    schema = pa.schema([("record_type", pa.string()), ("record_id", pa.string()), ("origin_id", pa.string()),
                        ("segment", pa.int32()), ("total_length", pa.int64()), ("page_id", pa.int64()),
                        ("refers_to", pa.int64()), ("digest", pa.string()), ("uri", pa.string()),
                        ("block", pa.binary())])
    return spark.read.option("lineSep", OPENING).text(path).mapInArrow(parse, _RECORDS)


def _payload_rows(whole: list[dict]) -> pa.RecordBatch:
    names = [c.split()[0] for c in _PAYLOADS.split(", ")]
    types = [pa.int64() if n in ("page_id", "refers_to") else pa.binary() if n == "payload" else pa.string()
             for n in names]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in whole], t) for n, t in zip(names, types)],
                                      names=names)


def reassemble(records: DataFrame) -> DataFrame:
    """Records with their payloads (null for revisits): segments grouped by origin id and
    put together in order. Missing, surplus or short segments raise an error.

    Only segmented records are shuffled. A task holds the segments of one record at a
    time, never a group of records.
    """
    def whole(batches):
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                row["payload"] = unchunk(row.pop("block")) if row["record_type"] == "response" else None
            yield _payload_rows(rows)

    def join(parts: list[dict]) -> dict:
        last = parts[-1]
        numbers = [p["segment"] for p in parts]
        if numbers != list(range(1, len(parts) + 1)) or last["total_length"] is None:
            raise ValueError(f"segments {numbers} of {last['origin_id']}")
        block = b"".join(p["block"] for p in parts)
        if len(block) != last["total_length"]:
            raise ValueError(f"{len(block)} bytes of {last['origin_id']}, not {last['total_length']}")
        return {**parts[0], "payload": unchunk(block)}

    def segments(batches):
        held: list[dict] = []
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if held and held[0]["origin_id"] != row["origin_id"]:
                    done.append(join(held))
                    held = []
                held.append(row)
            if done:
                yield _payload_rows(done)
        if held:
            yield _payload_rows([join(held)])

    single = records.where("segment is null").mapInArrow(whole, _PAYLOADS)
    cut = (records.where("segment is not null").repartition("origin_id")
           .sortWithinPartitions("origin_id", "segment").mapInArrow(segments, _PAYLOADS))
    return single.unionByName(cut)


def digests(payloads: DataFrame) -> DataFrame:
    """page_id, record_type, refers_to, digest and payload_bytes of every record, from the
    payloads themselves; a revisit has those of the response it refers to."""
    facts = stored(payloads.select(
        "page_id", "record_type", "refers_to", "uri",
        F.when(F.col("record_type") == "response", F.sha1("payload")).otherwise(F.col("digest")).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.col("digest").alias("stated")), "records")
    wrong = facts.where("payload_digest != stated").limit(1).collect()
    if wrong:
        raise ValueError(f"payload of page {wrong[0]['page_id']} does not have its digest")
    sizes = (facts.where("record_type = 'response'").groupBy("page_id", "payload_digest")
             .agg(F.max("payload_bytes").alias("full")).withColumnRenamed("page_id", "refers_to"))
    revisits = facts.where("record_type = 'revisit'").drop("payload_bytes").join(
        sizes, ["refers_to", "payload_digest"], "left").withColumnRenamed("full", "payload_bytes")
    names = ["page_id", "uri", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return facts.where("record_type = 'response'").select(names).unionByName(revisits.select(names))


def round_trip(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES,
               segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Write ``pages`` to ``path`` and read them back: page_id, uri, payload_bytes,
    payload_digest, record_type, refers_to, one row per row of ``pages``.

    A null html is an empty payload. Rows that repeat the page_id of a payload's response
    are responses too. A null page_id is smaller than any other; equal payloads that have
    no page_id at all are all responses. A null url leaves the field out. An empty table
    gives no rows; other columns are not read.
    """
    write_archives(pages, path, least_bytes, segment_bytes)
    return digests(reassemble(read_records(pages.sparkSession, path)))

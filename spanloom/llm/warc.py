"""Web archives: pages as WARC/1.1 records in gzip members, a merged capture index, and pages read back through it.

Of records with equal payloads of ``REVISIT_BYTES`` at least, the one with the greatest page_id is a response, the others are revisits without a payload. Tasks write their
pages to archive files of bounded size, each with a sorted run of index lines; ``cdx.merge_runs`` makes one ordered index of all runs. Reading takes
the index's places file by file. Payloads are equal if their SHA-1 and length are.

Defined results: null html is an empty payload, a null url an empty target, a null page_id is smaller than any number and comes back null, a null time is 1970. Rows
that repeat the greatest page_id of a payload are responses too. A payload of any length is one record. No rows give no archive. Other columns are ignored.
Archives and lines are written with Arrow's file systems (local or mounted folders, HDFS, S3, GCS); ``path`` must be one that all executors share.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from spanloom.llm import cdx

REVISIT_BYTES = 1000
FILE_BYTES, FILE_RECORDS = 256 << 20, 50_000
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:page:"


def _record(kind: str, page: int | None, url: str, time: str, digest: str, payload: bytes, refers_to: int | None) -> bytes:
    """A record as one gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + payload
    named = lambda p: f"<{_ID}{'none' if p is None else p}>"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {named(page)}", f"WARC-Date: {time}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: {named(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record; raises ValueError on damage."""
    raw = zlib.decompress(member, 31)
    head, found, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    headers = dict(text.split(": ", 1) for text in lines)
    size = int(headers["Content-Length"])
    if not found or not first.startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    payload = rest[:size].partition(b"\r\n\r\n")[2]
    if headers["WARC-Type"] == "response" and headers["WARC-Payload-Digest"] != "sha1:" + hashlib.sha1(payload).hexdigest():
        raise ValueError(f"{headers['WARC-Record-ID']} fails its digest")
    return headers, payload


class _Archive:
    """One archive file that is being written, with the index lines of its records."""

    def __init__(self, path: str) -> None:
        self.path, self.name, self.size, self.lines = path, f"{uuid.uuid4().hex}.warc.gz", 0, []
        system, base = cdx.file_system(path)
        self.out = system.open_output_stream(f"{base}/{self.name}", compression=None)

    def add(self, row: dict) -> None:
        revisit = row["refers_to"] is not None
        kind = "revisit" if revisit else "response"
        member = _record(kind, row["page_id"], row["target"], row["date"], row["digest"], b"" if revisit else row["payload"], row["refers_to"])
        self.out.write(member)
        entry = {"digest": row["digest"], "filename": self.name, "id": row["page_id"], "length": len(member), "offset": self.size, "type": kind}
        self.lines.append(cdx.line(row["key"], row["date"].translate({ord(c): None for c in "-:TZ"}), entry).encode())
        self.size += len(member)

    def close(self) -> pa.RecordBatch:
        self.out.close()
        self.lines.sort()
        return cdx.described([cdx.write_run(self.path, self.lines, int(self.name[:15], 16), 0)])


def write_archives(pages: DataFrame, path: str, captured: Column) -> DataFrame:
    """Write ``pages`` (``page_id``, ``url``, ``html``; ``captured`` is the time of each) below ``path``; returns the files of the merged index, in order of ``at``."""
    rows = pages.select(
        "page_id", F.coalesce("url", F.lit("")).alias("target"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
        F.date_format(F.coalesce(captured.cast("timestamp"), F.timestamp_seconds(F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
    ).withColumns({"digest": F.sha1("payload"), "bytes": F.octet_length("payload"), "key": cdx.url_key(F.col("target"))})
    rows = rows.withColumn("target", F.when(F.col("target").rlike(r"^[\x21-\x7E]*\z"), F.col("target")).otherwise(F.url_encode("target")))
    last = rows.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest", "bytes").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    typed = rows.join(last, ["digest", "bytes"], "left").withColumn(
        "refers_to", F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    )
    sent = typed.select("page_id", "target", "date", "digest", "key", "refers_to", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    archive = archive or _Archive(path)
                    archive.add(row)
                    if archive.size >= FILE_BYTES or len(archive.lines) >= FILE_RECORDS:
                        yield archive.close()
                        archive = None
        if archive:
            yield archive.close()

    system, base = cdx.file_system(path)
    system.create_dir(base)
    runs = cdx.stored(sent.mapInArrow(run, cdx.file_schema()), "capture-runs")
    return cdx.merge_runs(runs, path)


_CAPTURE = "url_key string, captured string, place long, page_id long, file string, offset long, length long"


def read_index(index: DataFrame) -> DataFrame:
    """Captures in the index: ``url_key``, ``captured`` (14 digits), ``place`` (ascending in the order of the index), ``page_id`` and where the record lies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.string() if kind == "string" else pa.int64()) for n, kind in (f.split() for f in _CAPTURE.split(", "))])
        for batch in batches:
            for row in batch.to_pylist():
                held = []
                for number, text in enumerate(cdx.read_lines([row["file"]])):
                    key, time, entry = text.decode().split(" ", 2)
                    entry = json.loads(entry)
                    held.append({
                        "url_key": key, "captured": time, "place": (row["at"] << 33) + number, "page_id": entry["id"], "file": entry["filename"],
                        "offset": entry["offset"], "length": entry["length"],
                    })
                    if len(held) == 4096:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return index.select("at", "file").repartition(cdx.tasks(index), "at").mapInArrow(run, _CAPTURE)


def read_archives(captures: DataFrame, path: str) -> DataFrame:
    """Records of ``captures`` from the archives below ``path``: ``page_id``, ``payload``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``.

    The payload of a revisit is null; its length is that of the response it refers to.
    """
    fields = "page_id long, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    schema = pa.schema([
        ("page_id", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ])

    def number(name: str) -> int | None:
        found = name.removeprefix(f"<{_ID}").removesuffix(">")
        return None if found == "none" else int(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = cdx.file_system(path)
        name = source = None
        for batch in batches:
            held, size = [], 0
            for place in batch.select(["file", "offset", "length"]).to_pylist():
                if place["file"] != name:
                    if source is not None:
                        source.close()
                    name = place["file"]
                    source = system.open_input_file(f"{base}/{name}")
                headers, payload = parse_record(source.read_at(place["length"], place["offset"]))
                first = headers["WARC-Type"] == "response"
                held.append({
                    "page_id": number(headers["WARC-Record-ID"]), "payload": payload if first else None, "payload_bytes": len(payload) if first else None,
                    "payload_digest": headers["WARC-Payload-Digest"].removeprefix("sha1:"), "record_type": headers["WARC-Type"],
                    "refers_to": None if first else number(headers["WARC-Refers-To"]),
                })
                size += len(payload)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, schema)

    ordered = captures.select("file", "offset", "length").repartition(cdx.tasks(captures), "file").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(run, fields)


def report(captures: DataFrame, path: str) -> DataFrame:
    """What ``read_archives`` reads, without the payloads and with the lengths of revisits from the responses they refer to."""
    records = cdx.stored(read_archives(captures, path).drop("payload"), "records")
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes")
    responses = records.where("record_type = 'response'")
    sizes = responses.groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    return responses.unionByName(revisits.join(sizes, ["refers_to", "payload_digest"], "left"))

"""WARC archives: written from pages, read back, assembled into one row per capture.

Every page becomes a transaction of three records: a request, a response (or a revisit of
an earlier equal payload) and metadata. The request and the metadata name the capture they
belong to as concurrent. Archives are gzip files of one member per record in a shared
folder. Reading gives records; captures are put together by joining on those identifiers.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from wattledger.llm.common import fresh_folder, stored

# Names of the record format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The capture time of archives that are written from a table without one.
CAPTURED = "2024-01-01T00:00:00Z"
READ_BYTES = 1 << 20


def _record_id(*parts) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(repr(parts).encode()).digest())}>"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value: object) -> str:
    """A header value: line ends would end the header."""
    return " ".join(str(value).splitlines())


def record(kind: str, record_id: str, headers: dict[str, object], block: bytes) -> bytes:
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {CAPTURED}"]
    lines += [f"{k}: {_line(v)}" for k, v in headers.items() if v is not None]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", 1, mtime=0)


def _transaction(page_id, url, html: bytes, sha1: str, first_id, first_url) -> list[bytes]:
    """The records of one page; ``first``: the page whose payload it repeats, or itself."""
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    capture = _record_id(digest, page_id, url)
    original = _record_id(digest, first_id, first_url)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    common = {
        "WARC-Target-URI": url, "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    if capture == original:
        main = record("response", capture, common, http + html)
    else:
        revisit = {
            "WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": original,
            "WARC-Refers-To-Target-URI": first_url, "WARC-Refers-To-Date": CAPTURED,
        }
        main = record("revisit", capture, common | revisit, http)
    about = {"WARC-Target-URI": url, "WARC-Concurrent-To": capture}
    request = f"GET {_line(url or '/')} HTTP/1.1\r\n\r\n".encode()
    meta = b"" if page_id is None else f"page-id: {page_id}\r\n".encode()
    return [
        main,
        record(
            "request", _record_id("request", capture),
            about | {"Content-Type": "application/http; msgtype=request"}, request,
        ),
        record("metadata", _record_id("metadata", capture), about | {"Content-Type": "application/warc-fields"}, meta),
    ]


def _writer(folder: str):
    def write(batches):
        part = TaskContext.get().partitionId()
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root)
        name = f"{root}/part-{part:05d}.warc.gz"
        attempt, n = f"{name}.{uuid.uuid4().hex}", 0
        with fs.open_output_stream(attempt) as sink:
            for batch in batches:
                for row in batch.to_pylist():
                    html = (row["html"] or "").encode()
                    for one in _transaction(
                        row["page_id"], row["url"], html, row["key"], row["first_id"], row["first_url"]
                    ):
                        sink.write(one)
                    n += 1
        # An archive appears whole or not at all; a repeated attempt replaces it.
        fs.move(attempt, name)
        if n:
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/part-{part:05d}.warc.gz"], "captures": [n]})

    return write


def write_archives(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Writes every page and returns the archives: path, captures.

    Of pages with equal payloads of at least ``least`` bytes, the one with the smallest
    id (then url; nulls last) is a response and the others revisit it. Pages equal in
    id, url and payload are copies of one capture and written alike. Null html is an
    empty payload. Extra columns are ignored; an empty table gives no archives.
    """
    spark = pages.sparkSession
    folder = folder or fresh_folder(spark, "warc")
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"))
    hexed = F.sha1(F.col("html").cast("binary"))
    keyed = rows.withColumn("key", hexed)
    order = F.struct(
        F.col("page_id").isNull().alias("no_id"), "page_id", F.col("url").isNull().alias("no_url"), "url"
    )
    firsts = stored(
        rows.select(hexed.alias("same"), order.alias("page")).groupBy("same").agg(F.min("page").alias("first")),
        "warc-firsts",
    )
    joined = keyed.join(firsts, F.col("key") == F.col("same"))
    itself = F.octet_length("html") < least
    chosen = joined.select(
        "page_id", "url", "html", "key",
        F.when(itself, F.col("page_id")).otherwise(F.col("first.page_id")).alias("first_id"),
        F.when(itself, F.col("url")).otherwise(F.col("first.url")).alias("first_url"),
    )
    return stored(chosen.mapInArrow(_writer(folder), "path string, captures long"), "warc-archives")


def _members(source):
    """(offset, length, content) of every gzip member, one at a time."""
    data, offset = b"", 0
    while data or (data := source.read(READ_BYTES)):
        member, content, used = zlib.decompressobj(31), [], 0
        while not member.eof:
            if not data and not (data := source.read(READ_BYTES)):
                raise ValueError(f"the archive ends within the record at {offset}")
            content.append(member.decompress(data))
            used += len(data) - len(member.unused_data)
            data = member.unused_data
        yield offset, used, b"".join(content)
        offset += used


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, by lower-case name, and block of one record."""
    head, _, rest = content.partition(b"\r\n\r\n")
    version, *lines = head.decode(errors="replace").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a record: {version[:40]!r}")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    headers = {k.lower(): v for k, v in headers.items()}
    length = int(headers["content-length"])
    if len(rest) < length:
        raise ValueError("a record is shorter than it says")
    return headers, rest[:length]


RECORDS = (
    "path string, offset long, length long, type string, record_id string, concurrent_to string, "
    "refers_to string, target_uri string, declared_digest string, payload_bytes long, "
    "payload_digest string, fields map<string, string>, payload binary"
)


def _reader(with_payload: bool):
    def row(path, offset, length, content):
        headers, block = parse(content)
        kind, payload, fields = headers["warc-type"], None, None
        if kind == "response":
            payload = block.partition(b"\r\n\r\n")[2]
        elif kind == "metadata":
            lines = block.decode(errors="replace").split("\r\n")
            fields = [tuple(x.split(": ", 1)) for x in lines if ": " in x]
        declared = headers.get("warc-payload-digest")
        return {
            "path": path, "offset": offset, "length": length, "type": kind,
            "record_id": headers["warc-record-id"],
            "concurrent_to": headers.get("warc-concurrent-to"),
            "refers_to": headers.get("warc-refers-to"),
            "target_uri": headers.get("warc-target-uri"),
            "declared_digest": declared and declared.partition(":")[2],
            "payload_bytes": None if payload is None else len(payload),
            "payload_digest": None if payload is None else payload_digest(payload),
            "fields": fields,
            "payload": payload if with_payload else None,
        }

    schema = pa.schema(
        [(n, pa.string()) for n in ("path",)]
        + [("offset", pa.int64()), ("length", pa.int64())]
        + [(n, pa.string()) for n in ("type", "record_id", "concurrent_to", "refers_to", "target_uri", "declared_digest")]
        + [("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
        + [("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())]
    )

    def read(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, name = pafs.FileSystem.from_uri(path)
                rows, held = [], 0
                with fs.open_input_stream(name, compression=None) as source:
                    for offset, length, content in _members(source):
                        rows.append(row(path, offset, length, content))
                        held += len(content) if with_payload else 500
                        if held > 8_000_000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return read


def read_records(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """A row per record of the archives; payloads are measured even if not returned."""
    n = max(1, archives.count())
    return archives.select("path").repartitionByRange(n, "path").mapInArrow(_reader(with_payload), RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture, request, metadata, original, copies.

    Requests and metadata are found by the capture they are concurrent to, and the
    original response of a revisit by the record it refers to; missing ones are null.
    Captures of equal ids are written ``copies`` times. Every field of a record but its
    place in the archive is kept.
    """
    kept = F.struct(
        "type", "record_id", "refers_to", "target_uri", "declared_digest", "payload_bytes",
        "payload_digest", "fields", "payload",
    )
    captures = (
        records.filter(F.col("type").isin("response", "revisit"))
        .groupBy("record_id")
        .agg(F.first(kept).alias("capture"), F.count(F.lit(1)).alias("copies"))
    )

    def concurrent(kind: str) -> DataFrame:
        mine = records.filter(F.col("type") == kind).withColumnRenamed("concurrent_to", "of")
        return mine.groupBy("of").agg(F.first(kept).alias(kind))

    whole = captures
    for kind in ("request", "metadata"):
        whole = whole.join(concurrent(kind), F.col("record_id") == F.col("of"), "left").drop("of")
    originals = whole.filter(F.col("capture.type") == "response").select(
        F.col("record_id").alias("of"), F.struct("capture", "metadata").alias("original")
    )
    # Responses have no original; as null keys of the join they would all meet in one task.
    revisits = whole.filter(F.col("capture.type") == "revisit").join(
        originals, F.col("capture.refers_to") == F.col("of"), "left"
    )
    responses = whole.filter(F.col("capture.type") == "response").withColumn(
        "original", F.lit(None).cast(originals.schema["original"].dataType)
    )
    return revisits.drop("of").unionByName(responses).drop("record_id")

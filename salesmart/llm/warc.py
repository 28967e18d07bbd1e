"""Legacy archives: ARC files to WARC records, WARC files, and back.

An ARC file opens with a ``filedesc`` record that names its version; the version says which
fields a record's header line has. A line's last field is the declared length of what
follows. The converter reads header lines by version and bodies by declared length and makes
the WARC fields that ARC lacks: identifiers (of file and offset), ISO dates, record types,
block and payload digests. Captures of equal payloads become one response and revisits of it.

Spark reads and writes the files. Bodies are read as binary; records are written by Spark's
text writer, whose line separator is the format's record separator and which writes a
string's bytes as they are. Files are gzipped whole. A file is parsed as a stream; what a
task holds is one compressed file and one record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import shared

# Fixed values of the formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DATE = "20240101000000"
PAGE_ID = "X-Page-Id"  # the HTTP field by which a capture's row is found again
CHUNK = 1 << 20
_NAMES = uuid.UUID("6b8f6b3e-51a5-4b0c-9a55-0d7c1f0c8a11")

RECORD = (
    "record_id string, type string, uri string, date string, content_type string, ip string, "
    "payload_digest string, payload_bytes long, page_id long, head binary, payload binary, file string"
)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(field: str | None, instead: str) -> str:
    """A header field without white space or control characters, which would end it."""
    text = re.sub(
        r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", field or ""
    )
    return text or instead


class Stream:
    """Bytes of a plain or gzipped file, taken piecewise."""

    def __init__(self, content: bytes):
        self.content, self.at = memoryview(content), 0
        self.unzip = zlib.decompressobj(31) if content[:2] == b"\x1f\x8b" else None
        self.held, self.offset = bytearray(), 0

    def _more(self) -> bool:
        if self.unzip and self.unzip.eof:  # the next member, if any
            rest = self.unzip.unused_data
            self.at -= len(rest)
            if bytes(self.content[self.at : self.at + 2]) != b"\x1f\x8b":
                return False
            self.unzip = zlib.decompressobj(31)
        if self.unzip and self.unzip.unconsumed_tail:
            got = self.unzip.decompress(self.unzip.unconsumed_tail, CHUNK)
        else:
            raw = self.content[self.at : self.at + CHUNK]
            if not raw:
                return False
            self.at += len(raw)
            got = self.unzip.decompress(raw, CHUNK) if self.unzip else raw
        self.held += got
        return True

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the file."""
        start = 0
        while (end := self.held.find(b"\n", start)) < 0:
            start = len(self.held)
            if not self._more():
                return self.take(len(self.held)) if self.held else None
        return self.take(end + 1)[:-1].removesuffix(b"\r")

    def take(self, count: int) -> bytes:
        while len(self.held) < count:
            if not self._more():
                raise ValueError(f"a record declares {count} bytes, {len(self.held)} are left")
        with memoryview(self.held) as held:
            out = bytes(held[:count])
        del self.held[:count]
        self.offset += count
        return out


def _http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP header (with its empty line) and body; no header if the block has none."""
    if block.startswith(b"HTTP/"):
        end = block.find(b"\r\n\r\n")
        if end >= 0:
            return block[: end + 4], block[end + 4 :]
    return b"", block


@lru_cache
def _field_pattern(name: str) -> re.Pattern[bytes]:
    return re.compile(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*(.*?)[ \t]*\r?$")


def _field(head: bytes, name: str) -> str | None:
    found = _field_pattern(name).search(head)
    return found[1].decode("utf-8", "replace") if found else None


@lru_cache(4096)
def _iso(date: str) -> str:
    digits = (re.sub(r"\D", "", date) + "00000101000000"[len(date) :])[:14]
    y, rest = digits[:4], [digits[i : i + 2] for i in range(4, 14, 2)]
    return f"{y}-{rest[0]}-{rest[1]}T{rest[2]}:{rest[3]}:{rest[4]}Z"


def parse_arc(path: str, content: bytes) -> Iterator[dict]:
    """The records of an ARC file, as WARC fields; the version block gives none."""
    name = path.rpartition("/")[2]
    stream, fields = Stream(content), ARC_FIELDS[1].split()
    while True:
        offset = stream.offset
        line = stream.line()
        if line is None:
            return
        if not line:  # records end with an empty line
            continue
        values = line.decode("utf-8", "replace").split(" ")
        if len(values) > len(fields):  # spaces in an unescaped URL
            extra = len(values) - len(fields) + 1
            values = [" ".join(values[:extra]), *values[extra:]]
        block = stream.take(int(values[-1]))
        if values[0].startswith("filedesc:"):
            version, definition = [*block.decode("utf-8", "replace").split("\n"), "", ""][:2]
            fields = definition.split() or ARC_FIELDS[int(version.split()[0])].split()
            continue
        given = dict(zip(fields, values, strict=True))
        uri = given["URL"]
        head, payload = _http(block)
        page = _field(head, PAGE_ID)
        mime = given.get("Content-type", "no-type")
        yield {
            "record_id": f"urn:uuid:{uuid.uuid5(_NAMES, f'{name} {offset}')}",
            "type": "response" if head else "resource",
            "uri": uri,
            "date": _iso(given.get("Archive-date", DATE)),
            "content_type": "application/http; msgtype=response" if head else mime,
            "ip": given.get("IP-address"),
            "payload_digest": digest(payload),
            "payload_bytes": len(payload),
            "page_id": int(page) if page else None,
            "head": head,
            "payload": payload,
            "file": path,
        }


def _lines(pairs: list[tuple[str, object]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in pairs if v is not None).encode()


def warc_record(row: dict) -> bytes:
    """A record without the separator that follows it; a revisit if ``refers_to_id`` is there."""
    revisit = row.get("refers_to_id") is not None
    block = row["head"] + (b"" if revisit else row["payload"])
    fields = [
        ("WARC-Type", "revisit" if revisit else row["type"]),
        ("WARC-Record-ID", f"<{row['record_id']}>"),
        ("WARC-Date", row["date"]),
        ("WARC-Target-URI", row["uri"]),
        ("WARC-IP-Address", row["ip"]),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("WARC-Refers-To", f"<{row['refers_to_id']}>" if revisit else None),
        ("WARC-Refers-To-Target-URI", row.get("refers_to_uri")),
        ("WARC-Refers-To-Date", row.get("refers_to_date")),
        ("Content-Type", row["content_type"]),
        ("Content-Length", len(block)),
    ]
    return f"{WARC_VERSION}\r\n".encode() + _lines(fields) + b"\r\n" + block


def parse_warc(path: str, content: bytes) -> Iterator[dict]:
    """The records of a WARC file but ``warcinfo``; digests are checked."""
    name = path.rpartition("/")[2]
    stream = Stream(content)
    while True:
        line = stream.line()
        if line is None:
            return
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: no record at byte {stream.offset - len(line)}")
        given: dict[str, str] = {}
        while line := stream.line():
            key, _, value = line.decode().partition(":")
            given[key.lower()] = value.strip()
        block = stream.take(int(given["content-length"]))
        if given["warc-type"] == "warcinfo":
            continue
        if given["warc-block-digest"] != f"sha1:{digest(block)}":
            raise ValueError(f"{name}: {given['warc-record-id']} does not have its digest")
        head, payload = _http(block)
        revisit = given["warc-type"] == "revisit"
        page = _field(head, PAGE_ID)
        sha1 = given["warc-payload-digest"].removeprefix("sha1:")
        if not revisit and sha1 != digest(payload):
            raise ValueError(f"{name}: {given['warc-record-id']} does not have its payload digest")
        yield {
            "record_id": given["warc-record-id"].strip("<>"),
            "type": given["warc-type"],
            "uri": given.get("warc-target-uri"),
            "date": given["warc-date"],
            "content_type": given.get("content-type"),
            "ip": given.get("warc-ip-address"),
            "payload_digest": sha1,
            "payload_bytes": int(_field(head, "Content-Length") or 0) if revisit else len(payload),
            "page_id": int(page) if page else None,
            "head": head,
            "payload": payload,
            "file": path,
            "refers_to_id": given["warc-refers-to"].strip("<>") if revisit else None,
        }


@dataclass
class _Rows:
    """Collects rows into batches of bounded bytes."""

    schema: pa.Schema

    def batches(self, rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in rows:
            held.append(row)
            size += len(row.get("payload") or b"") + len(row.get("value") or b"") + 500
            if size >= shared.BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(held, self.schema)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, self.schema)


_RECORD_ARROW = pa.schema(
    [(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[k]) for n, k in (f.split() for f in RECORD.split(", "))]
)
_READ_ARROW = _RECORD_ARROW.append(pa.field("refers_to_id", pa.string()))
_VALUE_ARROW = pa.schema([("value", pa.binary())])


def write_arc(pages: DataFrame, path: str, *, date: str = DATE) -> None:
    """Write a capture of each ``page_id, url, html`` row; files are of versions 1 and 2 in turn.

    NULL html is an empty body. A NULL URL becomes ``urn:page``; white space in one is escaped.
    A NULL ``page_id`` is left out of the capture.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"), F.col("html").alias("html")
    )

    def captures(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        number = TaskContext.get().partitionId()
        version = 1 + number % 2
        name, at = f"part-{number:05d}.arc", 0
        body = f"{version} 0 salesmart\n{ARC_FIELDS[version]}\n".encode()

        def record(url: str, kind: str, block: bytes, status: str) -> dict:
            nonlocal at
            between = [status, "-", "-", str(at), name] if version == 2 else []
            line = " ".join([url, "0.0.0.0", date, kind, *between, str(len(block))])
            value = f"{line}\n".encode() + block
            at += len(value) + 1
            return {"value": value}

        yield record(f"filedesc://{name}", "text/plain", body, "200")
        for batch in batches:
            for page, url, html in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "html")), strict=True):
                payload = (html or "").encode()
                head = [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload)), (PAGE_ID, page)]
                block = b"HTTP/1.1 200 OK\r\n" + _lines(head) + b"\r\n" + payload
                yield record(_clean(url, "urn:page"), "text/html", block, "200")

    _write(rows, captures, path, "\n", "BEST_SPEED")


def _write(rows: DataFrame, records, path: str, separator: str, level: str = "DEFAULT_COMPRESSION") -> None:
    shared.bound_batches(rows.sparkSession)
    make = _Rows(_VALUE_ARROW)
    lines = rows.mapInArrow(lambda b: make.batches(records(b)), "value binary")
    lines.select(F.col("value").cast("string").alias("value")).write.option(
        "lineSep", separator
    ).option("compression", "gzip").option("zlib.compress.level", level).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _read(spark: SparkSession, path: str, parse, schema: str, arrow: pa.Schema, columns) -> DataFrame:
    shared.bound_batches(spark)
    wanted = list(columns) if columns else arrow.names
    kept = pa.schema([arrow.field(c) for c in wanted])
    make = _Rows(kept)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in range(len(batch)):
                for found in parse(batch["path"][row].as_py(), batch["content"][row].as_py()):
                    yield {c: found[c] for c in wanted}

    kinds = dict(f.split() for f in schema.split(", "))
    return _files(spark, path).mapInArrow(
        lambda b: make.batches(records(b)), ", ".join(f"{c} {kinds[c]}" for c in wanted)
    )


def read_arc(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The captures of the ARC files under ``path``, of either version, as WARC fields."""
    return _read(spark, path, parse_arc, RECORD, _RECORD_ARROW, columns)


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The records of the WARC files under ``path``; a digest that does not hold is an error."""
    return _read(spark, path, parse_warc, RECORD + ", refers_to_id string", _READ_ARROW, columns)


def revisits(captures: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """``record_id, refers_to_id, refers_to_uri, refers_to_date`` of captures to be revisits,
    and their ``file`` if the captures name it.

    Of captures with equal payload digest and length, of ``min_bytes`` or more, that with the
    largest ``page_id`` (NULL least, ties by record id) is the response. Per-payload maxima are
    combined before the shuffle; the join back leaves a hot payload to Spark's skew split.
    """
    same = ["payload_digest", "payload_bytes"]
    large = captures.filter(F.col("payload_bytes") >= min_bytes)
    best = large.groupBy(*same).agg(
        F.max(
            F.struct(F.coalesce("page_id", F.lit(-(2**63))).alias("page"), "record_id", "uri", "date")
        ).alias("best"),
        F.count("*").alias("n"),
    )
    repeated = best.filter("n > 1").select(*same, "best")
    return (
        large.join(repeated, same)
        .filter(F.col("record_id") != F.col("best.record_id"))
        .select(
            "record_id",
            *(["file"] if "file" in captures.columns else []),
            F.col("best.record_id").alias("refers_to_id"),
            F.col("best.uri").alias("refers_to_uri"),
            F.col("best.date").alias("refers_to_date"),
        )
    )


def convert(spark: SparkSession, arc_path: str, warc_path: str, *, min_bytes: int = 0) -> None:
    """Write the captures of ARC files as WARC files, repeated payloads as revisits.

    The captures are first read without their payloads to find the revisits. These then meet
    the files, not the captures: what is shuffled is a compressed file and the list of its
    revisits, which is no longer than the file that one task parses anyway.
    """
    thin = read_arc(
        spark, arc_path, ["record_id", "uri", "date", "payload_digest", "payload_bytes", "page_id", "file"]
    )
    lists = revisits(thin, min_bytes=min_bytes).groupBy("file").agg(
        F.collect_list(F.struct("record_id", "refers_to_id", "refers_to_uri", "refers_to_date")).alias("links")
    )
    files = _files(spark, arc_path)
    # A file is a task's work however small it is packed, so the partitions go by number, not size.
    spread = max(1, 2 * files.select("path").count())
    rows = (
        files.repartition(spread, "path")
        .join(lists.withColumnRenamed("file", "path"), "path", "left")
        .select("path", "content", "links")
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        number, begun = TaskContext.get().partitionId(), False
        text = b"software: salesmart\r\nformat: WARC File Format 1.1\r\n"
        info = [
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_NAMES, f'warcinfo {number}')}>"),
            ("WARC-Date", _iso(DATE)),
            ("Content-Type", "application/warc-fields"),
            ("Content-Length", len(text)),
        ]
        for batch in batches:
            for at in range(len(batch)):
                if not begun:
                    yield {"value": f"{WARC_VERSION}\r\n".encode() + _lines(info) + b"\r\n" + text}
                    begun = True
                links = {link["record_id"]: link for link in batch["links"][at].as_py() or ()}
                for found in parse_arc(batch["path"][at].as_py(), batch["content"][at].as_py()):
                    yield {"value": warc_record(found | links.get(found["record_id"], {}))}

    _write(rows, records, warc_path, "\r\n\r\n")


def archive_pages(pages: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """Pages to ARC files, these to WARC files, and what the WARC files say of each page.

    Returns ``page_id, payload_bytes, payload_digest, record_type, refers_to``, the last being
    the ``page_id`` of the response. Rows with NULL or repeated ``page_id`` each give a row.
    An empty table gives an empty one. Other columns are not read.
    """
    spark = pages.sparkSession
    arc, warc = shared.new_path(spark, "arc"), shared.new_path(spark, "warc")
    write_arc(pages, arc)
    convert(spark, arc, warc, min_bytes=min_bytes)
    shared.remove(spark, arc)
    found = read_warc(
        spark, warc, ["record_id", "type", "payload_digest", "payload_bytes", "page_id", "refers_to_id"]
    )
    responses = found.filter("type != 'revisit'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")
    )
    return found.join(responses, "refers_to_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to"
    )

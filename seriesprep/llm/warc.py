"""WARC archives as tables: written by Spark's text writer, read as a stream of chunks.

Writing: one record per row, the record's block being an HTTP header and the payload. The records of one file stand
in order, each ended by CRLF CRLF, which is the writer's line separator. A payload of more than ``SEGMENT_CHARS`` is
segmented as the format provides: a first record and ``continuation`` records, so that no row holds a whole large payload.
Of records with equal payloads one is a response and the others are ``revisit`` records, which carry the digest and the
HTTP header, but no payload.

Reading: an archive (gzip, so that a file is one stream) is read as pieces between separators; a parser follows the lengths
in the record headers and yields rows of record identifier and chunk number. Byte count and SHA-1 go along from
chunk to chunk and from segment to segment, so no more than one piece and one chunk is held in memory. Segments of a
record must follow each other within one file.

Defined results: a null payload is empty. Rows with equal id and payload are alike: if their id is the largest of their
group, all of them are responses. A null id is smaller than any other. Line breaks in a URL are written as blanks. An
empty table gives an archive without records. Columns other than id, URL and payload play no part.
"""

from __future__ import annotations

import hashlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesprep.workspace import fresh_path, stage

END = "\r\n\r\n"
SEGMENT_CHARS = 1 << 18
CHUNK_BYTES = 1 << 18
HTTP_LIMIT = 1 << 16
ID_PREFIX = "urn:page:"
CHUNKS = (
    "record_id STRING, record_type STRING, refers_to STRING, target_uri STRING, chunk_no INT, payload BINARY, "
    "payload_bytes LONG, payload_digest STRING, last BOOLEAN, intact BOOLEAN"
)


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32, as archives write it: 20 bits at a time through base 32 digits of another alphabet."""
    code = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(code, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def plan_records(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """Per id and payload: ``_id``, ``_sha``, ``bytes``, ``digest``, ``refers_to`` (null for responses)."""
    body = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = stage(pages.select(
        F.col(id_col).alias("_id"), F.sha2(body, 256).alias("_sha"), F.octet_length(body).cast("long").alias("bytes"),
        base32_sha1(body).alias("digest")).distinct(), "payloads")
    groups = rows.filter(F.col("bytes") >= least_bytes).groupBy("_sha").agg(
        F.max("_id").alias("_first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    joined = rows.join(groups, "_sha", "left")
    other = F.col("_first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first"))
    return joined.select("_id", "_sha", "bytes", "digest", F.when(other, F.col("_first")).alias("refers_to"))


def _lines(*lines: Column | None) -> Column:
    return F.concat_ws("\r\n", *lines)


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def _urn(value: Column) -> Column:
    return F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(value.cast("string"), F.lit("none")), F.lit(">"))


def record_texts(
    pages: DataFrame, records: DataFrame, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url",
    payload_col: str = "html", segment_chars: int = SEGMENT_CHARS,
) -> DataFrame:
    """One row ``value`` per WARC record, segments in order."""
    rows = pages.select(
        F.col(id_col).alias("_own"), F.regexp_replace(F.coalesce(F.col(url_col), F.lit("")), r"[\r\n]", " ").alias("_url"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("_body"))
    match = rows["_own"].eqNullSafe(records["_id"]) & (F.sha2(rows["_body"].cast("binary"), 256) == records["_sha"])
    joined = rows.join(records.hint("shuffle_hash"), match)
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    parts = F.when(revisit, F.array(F.lit(""))).otherwise(
        F.when(F.length("_body") <= segment_chars, F.array("_body"))
        .otherwise(F.regexp_extract_all("_body", F.lit(rf"(?s).{{1,{segment_chars}}}"), F.lit(0))))
    cut = joined.select("_own", "_url", "bytes", "digest", "refers_to", F.size(parts).alias("_n"), F.posexplode(parts).alias("_k", "_part"))
    first, several = F.col("_k") == 0, F.col("_n") > 1
    block = F.when(first, F.concat(http, F.col("_part"))).otherwise(F.col("_part"))
    kind = F.when(~first, "continuation").when(F.col("refers_to").isNotNull(), "revisit").otherwise("response")
    number = (F.col("_k") + 1).cast("string")
    own_id = F.when(first, _urn(F.col("_own"))).otherwise(
        F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(F.col("_own").cast("string"), F.lit("none")), F.lit(":"), number, F.lit(">")))
    header = _lines(
        F.lit("WARC/1.1"), _line("WARC-Type", kind), _line("WARC-Record-ID", own_id), _line("WARC-Date", F.lit(date)),
        F.when(first, _line("WARC-Target-URI", F.col("_url"))), F.when(first, _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest"))),
        F.when(first & F.col("refers_to").isNotNull(), _line("WARC-Refers-To", _urn(F.col("refers_to")))),
        F.when(several, _line("WARC-Segment-Number", number)),
        F.when(~first, _line("WARC-Segment-Origin-ID", _urn(F.col("_own")))),
        F.when(several & (F.col("_k") == F.col("_n") - 1), _line("WARC-Segment-Total-Length", (F.octet_length(http) + F.col("bytes")).cast("string"))),
        F.when(first, _line("Content-Type", F.lit("application/http; msgtype=response"))),
        _line("Content-Length", F.octet_length(block).cast("string")))
    return cut.select(F.concat(header, F.lit(END), block).alias("value"))


def write_archive(spark: SparkSession, texts: DataFrame, path: str | None = None) -> str:
    """Write records to a folder of gzipped WARC files in shared storage; returns its path."""
    path = path or fresh_path(spark, "warc")
    texts.write.option("lineSep", END).option("compression", "gzip").text(path)
    return path


class _Record:
    """A payload that is being read: what has been counted and digested so far."""

    def __init__(self, fields: dict[bytes, bytes], limit: int, with_payload: bool):
        self.fields, self.limit, self.with_payload = fields, limit, with_payload
        self.sha, self.bytes, self.chunk_no, self.held = hashlib.sha1(), 0, 0, bytearray()
        self.http: bytearray | None = bytearray()

    def feed(self, data: memoryview | bytes, rows: list) -> None:
        if self.http is not None:  # the HTTP header comes first
            self.http += data[: HTTP_LIMIT]
            at = self.http.find(b"\r\n\r\n")
            if at < 0:
                if len(self.http) >= HTTP_LIMIT:
                    raise ValueError("no end of the HTTP header")
                return
            data = data[len(data) - (len(self.http) - at - 4) - max(0, len(data) - HTTP_LIMIT) :]
            self.http, head = None, bytes(self.http[:at])
            self.head = head
        view = memoryview(data)
        while len(view):
            part = view[: self.limit - len(self.held)]
            view = view[len(part) :]
            self.sha.update(part)
            self.bytes += len(part)
            self.held += part
            if len(self.held) == self.limit:
                self.emit(rows, False)

    def emit(self, rows: list, last: bool) -> None:
        f = self.fields
        kind = f[b"warc-type"].decode()
        size, digest = self.bytes, b32encode(self.sha.digest()).decode()
        stated = f.get(b"warc-payload-digest", b"").decode().removeprefix("sha1:")
        intact = not last or not stated or digest == stated
        if kind == "revisit":
            lengths = [x.split(b":")[1] for x in self.head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            size, digest, intact = int(lengths[0]) if lengths else None, stated, True
        trim = lambda name: f[name].decode("utf-8", "replace").strip("<>") if name in f else None
        rows.append((trim(b"warc-record-id"), kind, trim(b"warc-refers-to"), trim(b"warc-target-uri"), self.chunk_no,
                     bytes(self.held) if self.with_payload else None, size, digest, last, intact))
        self.chunk_no += 1
        self.held = bytearray()


class _Parser:
    """Follows one archive; fed with pieces, it collects chunk rows."""

    def __init__(self, limit: int, with_payload: bool):
        self.limit, self.with_payload = limit, with_payload
        self.state, self.left, self.head = "header", 0, bytearray()
        self.open: dict[bytes, _Record] = {}
        self.record: _Record | None = None
        self.fields: dict[bytes, bytes] = {}

    def feed(self, data: bytes, rows: list) -> None:
        view = memoryview(data)
        while len(view):
            if self.state == "header":
                self.head += view
                self.head = self.head.lstrip(b"\r\n")  # blank lines between records
                at = self.head.find(b"\r\n\r\n")
                if at < 0:
                    return
                rest = len(self.head) - at - 4
                view = view[len(view) - rest :]
                self.begin(bytes(self.head[:at]))
                self.head = bytearray()
            elif self.state == "block":
                part = view[: self.left]
                view = view[len(part) :]
                self.left -= len(part)
                if self.record is not None:
                    self.record.feed(part, rows)
            if self.state == "block" and not self.left:
                self.finish(rows)
                self.state, self.left = "tail", 4
            elif self.state == "tail":
                take = min(self.left, len(view))
                view = view[take:]
                self.left -= take
                if not self.left:
                    self.state = "header"

    def begin(self, head: bytes) -> None:
        lines = head.split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
        pairs = (x.partition(b":") for x in lines[1:])
        self.fields = {k.strip().lower(): v.strip() for k, _, v in pairs}
        self.state, self.left = "block", int(self.fields[b"content-length"])
        kind = self.fields.get(b"warc-type")
        if kind == b"continuation":
            self.record = self.open.get(self.fields[b"warc-segment-origin-id"])
            if self.record is None:
                raise ValueError("a continuation without the record it continues")
        elif kind in (b"response", b"revisit"):
            self.record = _Record(self.fields, self.limit, self.with_payload)
            if b"warc-segment-number" in self.fields:
                self.open[self.fields[b"warc-record-id"]] = self.record
        else:
            self.record = None

    def finish(self, rows: list) -> None:
        if self.record is None:
            return
        origin = self.fields.get(b"warc-segment-origin-id") or self.fields[b"warc-record-id"]
        if origin in self.open and b"warc-segment-total-length" not in self.fields:
            return
        self.open.pop(origin, None)
        self.record.emit(rows, True)


def read_archive(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES, with_payload: bool = True) -> DataFrame:
    """Chunk rows of all responses and revisits below ``path``; see ``CHUNKS`` for the columns.

    ``payload_bytes`` and ``payload_digest`` are those of the payload up to and with the chunk, of the whole payload in the
    row that is ``last``. A revisit has one row with the figures of the payload it stands for.
    """
    arrow = pa.schema([
        ("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()),
        ("chunk_no", pa.int32()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("last", pa.bool_()), ("intact", pa.bool_())])

    def table(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, file, rows, held = None, None, [], 0
        for batch in batches:
            for name, piece in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if name != file:
                    parser, file = _Parser(chunk_bytes, with_payload), name
                before = len(rows)
                parser.feed(piece.as_py() + b"\r\n\r\n", rows)
                held += sum(len(r[5] or b"") for r in rows[before:])
                if len(rows) >= 2000 or held >= 8 << 20:
                    yield table(rows)
                    rows, held = [], 0
        if rows:
            yield table(rows)

    pieces = spark.read.option("lineSep", END).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece"))
    return pieces.mapInArrow(parse, CHUNKS)


def archive_pages(pages: DataFrame, least_bytes: int = 0, **names: str) -> DataFrame:
    """Write the pages as an archive, read it back, and return one row per record."""
    spark = pages.sparkSession
    own = {k: v for k, v in names.items() if k in ("id_col", "payload_col")}
    path = write_archive(spark, record_texts(pages, plan_records(pages, least_bytes, **own), **names))
    return read_archive(spark, path, with_payload=False).filter("last").drop("payload", "chunk_no", "last")


def id_in(urn: Column) -> Column:
    """The integer id in a record identifier of this writer."""
    return F.regexp_extract(urn, f"^{ID_PREFIX}(-?[0-9]+)", 1).try_cast("bigint")

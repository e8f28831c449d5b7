"""WARC archives: a writer, and a splittable reader.

Writer: every task writes gzip-compressed WARC/1.1 files, one member per record, below a folder of the shared
storage and reports them; only reported files belong to the archive, so a lost or repeated task leaves no record
twice. Of records with equal payloads of ``min_revisit`` bytes or more the one with the smallest page id is a
response and the others are revisits that refer to it.

Reader: archives are cut into byte ranges. A task scans its range for the gzip magic, validates a candidate by
inflating its start and decoding the WARC header, and owns the records that start inside its range, also those
that end beyond it. After a record the next candidate is sought from its end. A payload that itself holds stored
(uncompressed) gzip WARC members can be mistaken for records where a range begins inside it.

Defined cases. Null html: empty payload. Null url: no target header; control characters in it are percent-
encoded. Null page ids: such a record is never referred to, and is a revisit only if an equal payload has an id.
Repeated rows with the smallest id are all responses. Empty input: no archives, no records. Very long payloads
take memory for one record at a time. Bytes of a range that belong to no valid record are passed over.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm.common import pick, shared_path, stored

MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"
FILE_BYTES = 64 << 20
RANGE_BYTES = 16 << 20
READ_BYTES = 1 << 20
INFLATE_BYTES = 1 << 14
RECORDS = ("path string, offset long, length long, record_id string, record_type string, target_uri string, "
           "payload_digest string, refers_to string, payload_bytes long, payload binary")


def _open(path: str):
    """pyarrow filesystem and its path for a Hadoop-style path."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def record_bytes(record_id: str, target: str | None, digest: str, n: int, payload: bytes | None, refers_to: str | None, date: str) -> bytes:
    """One gzip member: a response, or (payload None) a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}"]
    if target is not None:
        head.append(f"WARC-Target-URI: {quote(target, safe=''.join(chr(c) for c in range(33, 127)))}")
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def write_warc(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_revisit: int = 100, date: str = "2024-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the archives; (path, length, records) of every file."""
    spark = pages.sparkSession
    folder = folder or shared_path(spark, "warc")
    pages = pick(pages, **{id_col: "long", url_col: "string", html_col: "string"}).toDF("id", "url", "html")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select("id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("n"), F.sha2(payload, 256).alias("digest"))
    # only payloads that occur more than once take part in the join, so it stays small on mostly distinct pages
    again = (pages.where(F.col("n") >= min_revisit).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("c"))
             .where("c > 1 and first is not null").select("digest", "first"))
    pages = pages.join(stored(again, "digests"), "digest", "left")
    first = F.when((F.col("n") >= min_revisit) & ~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    pages = pages.select("id", "url", "n", "digest", first.alias("refers"), F.when(first.isNull(), F.col("payload")).alias("payload"))

    def write(batches):
        def name(i) -> str:
            return ID_PREFIX + ("" if i is None else str(i))

        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        out, size, count, files = None, 0, 0, []

        def close():
            out.close()
            files.append((path, size, count))

        for batch in batches:
            for i, url, n, digest, refers, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    leaf = f"part-{uuid.uuid4().hex}.warc.gz"
                    path, size, count = f"{folder}/{leaf}", 0, 0
                    out = fs.open_output_stream(f"{base}/{leaf}", compression=None)
                data = record_bytes(name(i), url, digest, n, payload, None if refers is None else name(refers), date)
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= file_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([f[j] for f in files], t) for j, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["path", "length", "records"])

    return stored(pages.mapInArrow(write, "path string, length long, records long"), "archives")


def list_archives(spark: SparkSession, folder: str, glob: str = "*.warc.gz") -> DataFrame:
    """(path, length) of the archives below a folder."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder).select("path", "length")


class _Source:
    """Bytes of an open file from a place on, read ahead in pieces."""

    def __init__(self, file, at: int):
        self.file, self.base, self.data, self.at = file, at, b"", at

    def fill(self) -> bool:
        self.file.seek(self.base + len(self.data))
        more = self.file.read(READ_BYTES)
        self.data += more
        return bool(more)

    def move(self, at: int) -> None:
        self.at = at
        if at - self.base >= READ_BYTES:  # else the bytes passed stay for now: moving on costs no copy
            self.data = self.data[at - self.base :]
            self.base = at

    def piece(self, used: int) -> bytes:
        """Some bytes from ``used`` bytes after the place on; none at the file's end."""
        begin = self.at - self.base + used
        if begin >= len(self.data) and not self.fill():
            return b""
        return self.data[begin : begin + INFLATE_BYTES]

    def find(self, what: bytes, limit: int) -> int | None:
        """Place of the next ``what`` that starts before ``limit``."""
        while True:
            at = self.data.find(what, self.at - self.base)
            if at >= 0:
                return self.base + at if self.base + at < limit else None
            self.move(max(self.at, self.base + len(self.data) - len(what) + 1))
            if self.at >= limit or not self.fill():
                return None


def _member(source: _Source) -> tuple[bytes, int] | None:
    """The record whose gzip member starts at the source's place, and the member's size; None if there is none."""
    inflate, out, used, size = zlib.decompressobj(31), [], 0, 0
    try:
        while not inflate.eof:
            piece = source.piece(used)
            if not piece:
                return None
            out.append(inflate.decompress(piece))
            used += len(piece) - len(inflate.unused_data)
            if size < 5 and not b"WARC/".startswith(b"".join(out)[:5]):
                return None
            size += len(out[-1])
    except zlib.error:
        return None
    return (b"".join(out), used) if size >= 5 else None


def parse_record(data: bytes) -> dict | None:
    """Fields of one record; None if the header or the length does not hold."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, c, v in (x.partition(":") for x in lines[1:]) if c}
    size = fields.get("content-length", "")
    if not gap or not size.isdigit() or len(rest) < int(size):
        return None
    block = rest[: int(size)]
    http, gap, payload = block.partition(b"\r\n\r\n") if "application/http" in fields.get("content-type", "") else (b"", b"", block)
    revisit = fields.get("warc-type") == "revisit"
    stated = [x.split(b":")[1].strip() for x in http.split(b"\r\n")[1:] if x.lower().startswith(b"content-length:")]
    digest = fields.get("warc-payload-digest")
    return {"record_id": fields.get("warc-record-id", "").strip("<>"), "record_type": fields.get("warc-type"), "target_uri": fields.get("warc-target-uri"),
            "payload_digest": digest.rpartition(":")[2] if revisit and digest else hashlib.sha256(payload).hexdigest(),
            "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
            "payload_bytes": int(stated[0]) if revisit and stated and stated[0].isdigit() else len(payload), "payload": None if revisit else payload}


def records_in(file, start: int, end: int):
    """(offset, member size, fields) of the records that start in [start, end)."""
    source = _Source(file, start)
    while (at := source.find(MAGIC, end)) is not None:
        source.move(at)
        member = _member(source)
        fields = parse_record(member[0]) if member else None
        if fields is None:
            source.move(at + 1)
            continue
        yield at, member[1], fields
        source.move(at + member[1])


def read_warc(archives: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """``archives`` (path, length) -> one row per record. The digest of a response is that of the payload read, the
    digest and size of a revisit are those its headers state."""
    spark = archives.sparkSession
    total = archives.agg(F.sum(F.ceil(F.col("length") / range_bytes))).first()[0] or 0
    # an explicit number: by their few bytes the ranges would all be put into one task
    tasks = max(1, min(int(total), 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    ranges = archives.where("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    ranges = ranges.select("path", "start", F.least("length", F.col("start") + range_bytes).alias("end")).repartition(tasks, "path", "start")
    names = [x.split()[0] for x in RECORDS.split(", ")]
    types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary())

    def read(batches):
        for batch in batches:
            for path, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                fs, at = _open(path)
                with fs.open_input_file(at) as file:
                    rows, held = [], 0
                    for offset, size, x in records_in(file, start, end):
                        rows.append((path, offset, size, x["record_id"], x["record_type"], x["target_uri"], x["payload_digest"], x["refers_to"],
                                     x["payload_bytes"], x["payload"] if payloads else None))
                        held += len(rows[-1][-1] or b"") + 500
                        if held > READ_BYTES * 4:
                            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(types)], names=names)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(types)], names=names)

    return ranges.mapInArrow(read, RECORDS)


def page_of(record_id):
    """Page id of a record id column that this module's writer made."""
    number = F.regexp_extract(record_id, f"^{ID_PREFIX}(-?[0-9]+)$", 1)
    return F.when(number != "", number.cast("long"))

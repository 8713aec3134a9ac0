"""WARC archives: one gzip member per record, read again record by record.

Writers and readers run in tasks and reach the archives through Arrow's file systems, so the folder
may lie on any store Arrow knows; it must be one that all executors share. A task writes archives of
its own under names no other attempt uses; only the names that finished tasks report are read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import stored
from sluice.session import scratch_dir

#: Payloads below this size are always written in full.
SMALL = 100
#: A task starts a new archive beyond this size.
ARCHIVE_BYTES = 256 << 20
CHUNK = 1 << 20
#: Rows carry no time of retrieval.
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


class Damaged(ValueError):
    """An archive that does not hold what it says."""


def _sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _name(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id} {digest}')}>"


def _clean(url: str | None) -> str:
    """An address without control characters or spaces, which would end the header."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "") or "about:blank"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One uncompressed record; a revisit, for which refers_to is given, leaves the payload out."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + END
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _name(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _clean(url)),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{_sha256(block)}"),
        ("Content-Length", len(block)),
    ]
    if page_id is not None:
        fields.append(("X-Page-Id", page_id))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _name(refers_to, digest)), ("X-Refers-To-Page-Id", refers_to)]
    head = "".join(f"\r\n{name}: {value}" for name, value in fields).encode()
    return VERSION + head + END + block + END


def member(data: bytes) -> bytes:
    gzip = zlib.compressobj(4, zlib.DEFLATED, 31)
    return gzip.compress(data) + gzip.flush()


def members(stream) -> Iterator[bytes]:
    """The decompressed gzip members of a stream, one after another, read in chunks."""
    data = stream.read(CHUNK)
    while data:
        gzip, parts = zlib.decompressobj(31), []
        while not gzip.eof:
            if not data and not (data := stream.read(CHUNK)):
                raise Damaged("the archive ends within a record")
            parts.append(gzip.decompress(data, CHUNK))
            data = gzip.unconsumed_tail or (gzip.unused_data if gzip.eof else b"")
        yield b"".join(parts)
        data = data or stream.read(CHUNK)


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields, by lower-case name, and the block, framed by Content-Length, of one record."""
    head, end, rest = data.partition(END)
    version, *lines = head.split(b"\r\n")
    if not end or not version.startswith(b"WARC/"):
        raise Damaged("no record header")
    fields = {k.strip().decode().lower(): v.strip().decode() for k, _, v in (line.partition(b":") for line in lines)}
    length = int(fields["content-length"])
    if rest[length:] != END or len(rest) != length + len(END):
        raise Damaged("the record is longer or shorter than its Content-Length")
    return fields, rest[:length]


def contents(data: bytes) -> tuple:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload) of a record, digests verified."""
    fields, block = parsed(data)
    if fields["warc-block-digest"] != f"sha256:{_sha256(block)}":
        raise Damaged("block digest")
    http, _, payload = block.partition(END)
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    size = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    kind = fields["warc-type"]
    if kind == "response" and (size != len(payload) or digest != _sha256(payload)):
        raise Damaged("payload digest")
    whole = lambda name: int(fields[name]) if name in fields else None
    return (whole("x-page-id"), fields["warc-target-uri"], kind, whole("x-refers-to-page-id"), size, digest, payload if kind == "response" else None)


def _with_targets(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): refers_to where the payload repeats that of a smaller id."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.filter(F.octet_length("payload") >= SMALL).groupBy("digest")
    first = large.agg(F.min("page_id").alias("first"), F.count("*").alias("k")).filter("k > 1").select("digest", "first")
    later = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(first, "digest", "left").select("page_id", "url", "payload", "digest", later.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record per row of (page_id, url, html) below a shared folder; (path, records) of each archive.

    Of rows with equal payloads of :data:`SMALL` bytes or more, those with the smallest page_id are
    responses and the others revisits of it; rows that repeat that id with the payload are
    responses too. A null html is an empty payload, a null url is ``about:blank``; a null page_id
    counts as larger than all others and is left out of the record. A payload is held whole while
    its record is written; other columns are not looked at; no rows give no archive.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        out, path, size, count, done = None, "", 0, 0, []
        for batch in batches:
            for values in zip(*batch.columns):
                if out is None:
                    store.create_dir(root, recursive=True)
                    path = f"{root}/pages-{uuid.uuid4().hex}.warc.gz"
                    out, size, count = store.open_output_stream(path, compression=None), 0, 0
                page = member(record(*(v.as_py() for v in values)))
                out.write(page)
                size, count = size + len(page), count + 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((path.rpartition("/")[2], count))
                    out = None
        if out is not None:
            out.close()
            done.append((path.rpartition("/")[2], count))
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{p}" for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["path", "records"])

    rows = _with_targets(pages)
    return stored(rows.mapInArrow(write, "path string, records long"), "archives")


RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives at ``path``, a task reading each from front to end.

    A revisit has no payload of its own; its size and digest are those of the full payload. An
    archive that is cut off, mis-framed, or fails a checksum or digest raises :class:`Damaged`;
    so does one with other than ``records`` records, if that column is there. No archives, no rows.
    """
    schema = RECORD if payloads else RECORD.removesuffix(", payload binary")
    width = len(schema.split(", "))
    names = [field.split(" ")[0] for field in schema.split(", ")]
    expected = F.col("records") if "records" in archives.columns else F.lit(None).cast("long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, count in zip(*batch.columns):
                store, at = fs.FileSystem.from_uri(path.as_py())
                found, held, total = [], 0, 0
                with store.open_input_stream(at, compression=None) as stream:
                    for data in members(stream):
                        found.append(contents(data)[:width])
                        held, total = held + len(data), total + 1
                        if held > 16 * CHUNK or len(found) == 2000:
                            yield packed(found)
                            found, held = [], 0
                if count.is_valid and count.as_py() != total:
                    raise Damaged(f"{total} records of {count}")
                if found:
                    yield packed(found)

    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [types[field.split(" ")[1]] for field in schema.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return archives.select("path", expected.alias("records")).mapInArrow(read, schema)


def archive_folder(spark: SparkSession) -> str:
    """A fresh folder for archives in the shared folder."""
    folder = scratch_dir(spark, "warc")
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"

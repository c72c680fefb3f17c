"""WARC archives: written from pages by each task, read back as a table of payload chunks.

Payloads pass in chunks in both directions, so no task holds more of a record than one chunk besides the row that
Spark itself holds. Archives lie in a folder that all executors share, and are reached through Arrow file systems.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelframe.llm.common import map_arrow, pick
from parcelframe.session import stored, work_folder

CHUNK = 256 << 10
DATE = "2000-01-01T00:00:00Z"
#: The profile of records that repeat an earlier payload, and line ends of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEXT = b"\r\n"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _clean(value: str | None) -> str:
    """A header value without control characters or blanks, which would break the header's lines."""
    return quote(value or "", safe="/:?#[]@!$&'()*+,;=%-._~") or "about:blank"


def _head(row: dict) -> bytes:
    """The record's and the answer's header lines, up to the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n".encode()
    kind = "revisit" if row["revisit"] else "response"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, row['record'])}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_clean(row['url'])}",
        f"WARC-Payload-Digest: sha1:{base32(bytes.fromhex(row['sha1']))}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (0 if row['revisit'] else row['size'])}",
    ]
    if row["page_id"] is not None:
        lines.append(f"X-Page-Id: {row['page_id']}")
    if row["revisit"]:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{row['owner']}>"]
    return "\r\n".join(lines).encode() + NEXT * 2 + http


def chunked(pages: DataFrame, least: int = 0, chunk: int = CHUNK) -> DataFrame:
    """Rows (page_id, url, size, sha1, owner, revisit, record, number, last, data): the payload's chunks in order.

    Of records with equal payloads of ``least`` bytes or more, that with the largest page_id is written in full; the
    others have revisit set, one chunk without data and that page as ``owner``. Equal means equal SHA-1 and size.
    Rows with the same page_id and the same payload are the same record, written as often as they occur; a null
    page_id is written as a response unless its payload has an owner, and a null html is an empty payload.
    """
    rows = pick(pages, page_id="page_id", url="url", html="html")
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = rows.select("page_id", "url", body.alias("body"), F.sha1(body).alias("sha1"), F.octet_length(body).cast("long").alias("size"))
    # Digests alone are grouped; the payloads then meet short rows keyed by page, which has no hot key.
    keys = rows.select("page_id", "sha1", "size").filter(F.col("size") >= least)
    owners = keys.groupBy("sha1", "size").agg(F.max("page_id").alias("owner"), F.count("*").alias("n")).filter("n > 1").drop("n")
    again = keys.join(owners, ["sha1", "size"]).filter("not (page_id <=> owner)").select(F.col("page_id").alias("own"), F.col("sha1").alias("own_sha1"), "owner").distinct()
    rows = rows.join(again, F.col("page_id").eqNullSafe(F.col("own")) & (F.col("sha1") == F.col("own_sha1")), "left")
    revisit = F.col("owner").isNotNull()
    last = F.when(revisit, 0).otherwise(F.greatest(F.lit(0), F.ceil(F.col("size") / chunk) - 1)).cast("int")
    record = F.concat_ws(" ", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), "sha1")
    rows = rows.select("*", revisit.alias("revisit"), record.alias("record"), last.alias("last"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("number"))
    data = F.when(F.col("revisit"), F.lit(b"")).otherwise(F.substring(F.col("body"), F.col("number") * chunk + 1, F.lit(chunk)))
    return rows.select("page_id", "url", "size", "sha1", "owner", "revisit", "record", "number", "last", data.alias("data"))


def write_archives(chunks: DataFrame, folder: str, largest: int = 256 << 20, level: int = 6) -> DataFrame:
    """Writes archives into ``folder`` and returns their stored list (path, records, bytes).

    Each record is a gzip member of its own, as readers of such archives expect, packed chunk by chunk. A task starts a new archive once one has ``largest`` bytes. Names are unique for each attempt and the list holds
    those of finished tasks only, so archives of lost or repeated attempts are never read.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        name, out, records, size, done, packer = "", None, 0, 0, [], None
        for batch in batches:
            for row in _rows(batch):
                if not row["number"]:
                    if out and size >= largest:
                        out.close()
                        done.append((name, records, size))
                        out = None
                    if not out:
                        name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = system.open_output_stream(f"{root}/{name}", compression=None)
                    packer = zlib.compressobj(level, wbits=31)
                    size += out.write(packer.compress(_head(row)))
                    records += 1
                size += out.write(packer.compress(row["data"]))
                if row["number"] == row["last"]:
                    size += out.write(packer.compress(NEXT * 2) + packer.flush())
        if out:
            out.close()
            done.append((name, records, size))
        yield pa.RecordBatch.from_pylist(
            [{"path": f"{folder}/{n}", "records": r, "bytes": b} for n, r, b in done],
            pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
        )

    return stored(map_arrow(chunks, write, "path string, records long, bytes long"), "archives")


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows one after another, few of them in Python at a time."""
    for k in range(0, batch.num_rows, 64):
        yield from batch.slice(k, 64).to_pylist()


class _Stream:
    """Reads lines and bounded pieces from a file of any size."""

    def __init__(self, file, step: int = 1 << 20):
        self.file, self.step, self.data, self.at = file, step, b"", 0

    def _more(self) -> bool:
        new = self.file.read(self.step)
        self.data, self.at = self.data[self.at :] + new, 0
        return bool(new)

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the file."""
        while (end := self.data.find(NEXT, self.at)) < 0:
            if not self._more():
                if self.at < len(self.data):
                    raise ValueError("the archive ends within a line")
                return None
        found, self.at = self.data[self.at : end], end + 2
        return found

    def pieces(self, size: int, chunk: int) -> Iterator[bytes]:
        """``size`` bytes as pieces of ``chunk`` bytes, the last one shorter; nothing for size 0."""
        while size:
            want = min(size, chunk)
            while len(self.data) - self.at < want:
                if not self._more():
                    raise ValueError("the archive ends within a record")
            yield self.data[self.at : self.at + want]
            self.at += want
            size -= want


def _fields(stream: _Stream) -> tuple[dict[str, str], int]:
    """Header fields up to the empty line, by lower-case name, and the bytes they take."""
    found, size = {}, 0
    while line := stream.line():
        size += len(line) + 2
        name, _, value = line.decode().partition(":")
        found[name.strip().lower()] = value.strip()
    return found, size + 2


CHUNKS = pa.schema(
    [
        ("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("url", pa.string()), ("number", pa.int32()), ("offset", pa.int64()), ("data", pa.binary()), ("digest", pa.string()),
        ("stated_digest", pa.string()), ("stated_bytes", pa.int64()),
    ]
)


def read_archives(archives: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The record table of listed archives (path): one row for each payload chunk, in order within a record.

    ``number`` counts a record's chunks from 0, ``offset`` is the chunk's place in the payload and ``digest`` the
    base32 SHA-1 of the payload up to and with this chunk. An empty payload, as of each revisit, is one chunk without
    data. ``stated_digest`` and ``stated_bytes`` are what the record's own headers say of the full payload.
    """

    def records(path: str, system, place: str) -> Iterator[dict]:
        with system.open_input_stream(place, compression=None) as packed, gzip.GzipFile(fileobj=packed) as file:
            stream = _Stream(file)
            while (first := stream.line()) is not None:
                if not first.startswith(b"WARC/"):
                    raise ValueError(f"no record begins where one should in {path}")
                fields, _ = _fields(stream)
                status = stream.line()
                http, size = _fields(stream)
                left = int(fields["content-length"]) - size - len(status) - 2
                refers = fields.get("warc-refers-to", "").removeprefix("<urn:page:").removesuffix(">")
                row = {
                    "record_id": fields["warc-record-id"].strip("<>"), "page_id": int(fields["x-page-id"]) if "x-page-id" in fields else None,
                    "record_type": fields["warc-type"], "refers_to": int(refers) if refers else None, "url": fields["warc-target-uri"],
                    "stated_digest": fields["warc-payload-digest"].removeprefix("sha1:"), "stated_bytes": int(http["content-length"]),
                }
                sha, offset, number = hashlib.sha1(), 0, 0
                for data in stream.pieces(left, chunk):
                    sha.update(data)
                    yield row | {"number": number, "offset": offset, "data": data, "digest": base32(sha.digest())}
                    number, offset = number + 1, offset + len(data)
                if not number:
                    yield row | {"number": 0, "offset": 0, "data": b"", "digest": base32(sha.digest())}
                if stream.line() != b"" or stream.line() != b"":
                    raise ValueError(f"a record does not end where it should in {path}")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                held, size = [], 0
                for row in records(path, *fs.FileSystem.from_uri(path)):
                    held.append(row)
                    size += len(row["data"]) + 500
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, CHUNKS)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, CHUNKS)

    kinds = {pa.string(): "string", pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}
    # As many tasks as archives; a list without archives still has one.
    dealt = archives.select("path").repartition(max(1, archives.count()), "path")
    return map_arrow(dealt, read, ", ".join(f"{f.name} {kinds[f.type]}" for f in CHUNKS))


def archived_records(chunks: DataFrame) -> DataFrame:
    """One row per record from its chunks: page_id, payload_bytes, payload_digest, record_type and refers_to.

    A response's size and digest are those of the bytes read, and must be what its headers state; a revisit has the
    stated ones of the payload it repeats. Repeated records are counted by their first chunks.
    """
    full = F.col("record_type") == "response"
    keys = ["record_id", "page_id", "record_type", "refers_to", "stated_digest", "stated_bytes"]
    found = chunks.groupBy(*keys).agg(
        F.max_by("digest", "number").alias("digest"),
        F.max(F.col("offset") + F.length("data")).cast("long").alias("bytes"),
        F.sum((F.col("number") == 0).cast("int")).alias("times"),
    )
    same = ~full | ((F.col("digest") == F.col("stated_digest")) & (F.col("bytes") == F.col("stated_bytes")))
    checked = F.when(same, F.col("stated_digest")).otherwise(F.raise_error(F.lit("a payload differs from its record's headers")))
    found = found.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times"))))
    size = F.when(full, F.col("bytes")).otherwise(F.col("stated_bytes"))
    return found.select("page_id", size.alias("payload_bytes"), checked.alias("payload_digest"), "record_type", "refers_to")


def archive_pages(pages: DataFrame, folder: str | None = None, *, least: int = 0, chunk: int = CHUNK) -> DataFrame:
    """The chunk table read back from archives of all pages, written to ``folder`` or to the shared work folder."""
    folder = folder or work_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(chunked(pages, least, chunk), folder), chunk)

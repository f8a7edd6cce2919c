"""WARC archives with one gzip member a record, and a reader that splits them.

Writing: each task writes its records to one file in the shared folder and reports it; only reported files are read, so what a
lost task leaves behind is never seen. A record whose payload another record holds already (equal SHA-256, at least
``least_bytes``) is written as a revisit of the record with the smallest id.

Reading: a task gets a byte range of a file. It looks for the gzip magic from the start of its range, takes a candidate for a
member only if its header's reserved bits are clear and it decodes to a WARC version line, headers and a whole block, and owns
the members that start inside its range, reading the last one beyond its end. After a good member the next is where it ends.

Defined cases: a null payload is empty; a null id is written as an empty one; rows of one id that share a payload with it are
all responses if the id is the smallest, since none comes before the other; control characters in a URL are percent-encoded;
a very large payload is one member, held whole by the task that writes or reads it; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.joins import joined
from rillflow.llm.store import at_exit, new_path, small_batches, table

MAGIC = b"\x1f\x8b\x08"
CHUNK = 1 << 20
ID, DATE = "urn:rillflow:page:", "1970-01-01T00:00:00Z"
RECORD = "page_id long, record_type string, refers_to long, uri string, declared_bytes long, declared_digest string, payload binary"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A WARC record, a revisit if it refers to another."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    safe = "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in url or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {safe}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{ID}{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def member(raw: bytes, level: int = 4) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def parse(raw: bytes) -> dict | None:
    """The fields of a record, or None if these aren't the bytes of one."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not mark or not lines[0].startswith("WARC/"):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    size = fields.get("content-length", "")
    if not size.isdigit() or len(rest) < int(size):
        return None
    block = rest[: int(size)]
    http, mark, payload = block.partition(b"\r\n\r\n")
    declared = next((x[15:].strip() for x in http.split(b"\r\n") if x[:15].lower() == b"content-length:"), b"") if mark else b""
    page = lambda name: int(x) if (x := fields.get(name, "").strip("<>").removeprefix(ID)).lstrip("-").isdigit() else None
    return {
        "page_id": page("warc-record-id"),
        "record_type": fields.get("warc-type"),
        "refers_to": page("warc-refers-to"),
        "uri": fields.get("warc-target-uri"),
        "declared_bytes": int(declared) if declared.isdigit() else None,
        "declared_digest": fields.get("warc-payload-digest", "").removeprefix("sha256:") or None,
        "payload": payload if mark else block,
    }


class Range:
    """The bytes of a file from a place on, read as they are asked for."""

    def __init__(self, file: pa.NativeFile, at: int, size: int):
        self.file, self.size, self.first, self.held = file, size, at, bytearray()

    def upto(self, place: int) -> None:
        while self.first + len(self.held) < min(place, self.size):
            self.file.seek(self.first + len(self.held))
            self.held += self.file.read(max(CHUNK, place - self.first - len(self.held)))

    def get(self, at: int, n: int) -> bytes:
        self.upto(at + n)
        return bytes(memoryview(self.held)[at - self.first : at - self.first + n])

    def forget(self, before: int) -> None:
        if before - self.first > CHUNK:
            del self.held[: before - self.first]
            self.first = before

    def find(self, at: int, end: int) -> int:
        """The next magic that starts in [at, end), or -1."""
        while at < end:
            part = self.get(at, min(CHUNK, end - at) + len(MAGIC) - 1)
            hit = part.find(MAGIC)
            if hit >= 0 and at + hit < end:
                return at + hit
            at += CHUNK
            self.forget(at)
        return -1

    def decode(self, at: int) -> tuple[bytes, int] | None:
        """The content of the gzip member that starts here and the place after it; None if it isn't a WARC record's."""
        if len(head := self.get(at, 4)) < 4 or head[3] & 0xE0:
            return None
        z, out, place, first = zlib.decompressobj(31), [], at, True
        try:
            while not z.eof:
                part = self.get(place, CHUNK // 16)
                if not part:
                    return None
                out.append(z.decompress(part))
                place += len(part)
                if first and (start := b"".join(out))[:5]:
                    if not b"WARC/".startswith(start[:5]) and not start.startswith(b"WARC/"):
                        return None
                    first = len(start) < 5
        except zlib.error:
            return None
        return b"".join(out), place - len(z.unused_data)


def records(file: pa.NativeFile, start: int, end: int, size: int) -> Iterator[dict]:
    """The records that start in [start, end)."""
    source, at = Range(file, start, size), start
    while (at := source.find(at, end)) >= 0:
        got = source.decode(at)
        found = parse(got[0]) if got else None
        if found:
            yield found
        at = got[1] if found else at + 1
        source.forget(at)


def plan(pages: DataFrame, least_bytes: int = 100, broadcast_rows: int = 200_000) -> DataFrame:
    """page_id, url, payload, digest, refers_to. Payloads that occur more than once are few as a rule; they are broadcast up to
    ``broadcast_rows``. Beyond, only those in very many records are, and others are joined by a shuffle."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    small_batches(pages.sparkSession)
    equal = rows.where(F.length("payload") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("c")).where("c > 1")
    equal = table(equal, "equal")
    first = equal.select("digest", "first")
    few = equal.count() <= broadcast_rows
    found = rows.join(F.broadcast(first), "digest", "left") if few else joined(rows, first, "digest", equal.select("digest", "c"))
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return found.select("page_id", "url", "payload", "digest", F.when(again, F.col("first")).alias("refers_to"))


def write(planned: DataFrame, folder: str) -> DataFrame:
    """Writes archives below a folder that all executors see; returns path and bytes of each."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        name, size, out = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", 0, None
        for b in batches:
            payloads = b.column(2)
            for i, (page_id, url, digest, refers_to) in enumerate(zip(*(b.column(c).to_pylist() for c in (0, 1, 3, 4)), strict=True)):
                out = out or fs.open_output_stream(f"{base}/{name}", compression=None)
                raw = member(record(page_id, url, payloads[i].as_py(), digest, refers_to))
                out.write(raw)
                size += len(raw)
        if out:
            out.close()
            yield pa.record_batch({"path": pa.array([f"{folder}/{name}"]), "bytes": pa.array([size], pa.int64())})

    out = table(planned.mapInArrow(task, "path string, bytes long"), "archives")
    at_exit(planned.sparkSession, folder)
    return out


def read(archives: DataFrame, split_bytes: int = 16 << 20) -> DataFrame:
    """The records of archives (path, bytes), a task for each byte range."""
    ranges = archives.select("path", "bytes", F.explode(F.expr(f"sequence(0L, bytes - 1, {split_bytes}L)")).alias("start"))
    spread = archives.sparkSession.sparkContext.defaultParallelism * 4
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = dict(zip(names, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()), strict=True))

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.record_batch({n: pa.array([r[n] for r in rows], kinds[n]) for n in names})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, size, start in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                fs, place = pafs.FileSystem.from_uri(path)
                held, held_bytes = [], 0
                with fs.open_input_file(place) as file:
                    for found in records(file, start, min(size, start + split_bytes), size):
                        held.append(found)
                        held_bytes += len(found["payload"])
                        if held_bytes > 4 << 20:
                            yield batch(held)
                            held, held_bytes = [], 0
                if held:
                    yield batch(held)

    return ranges.repartition(spread, "path", "start").mapInArrow(task, RECORD)


def round_trip(pages: DataFrame, split_bytes: int = 16 << 20) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to, as the archives written from the pages tell. A revisit's
    payload is what its headers declare."""
    folder = new_path(pages.sparkSession, "warc")
    got = read(write(plan(pages), folder), split_bytes)
    own = F.col("record_type") == "response"
    return got.select(
        "page_id", F.when(own, F.length("payload")).otherwise(F.col("declared_bytes")).cast("long").alias("payload_bytes"),
        F.when(own, F.sha2("payload", 256)).otherwise(F.col("declared_digest")).alias("payload_digest"), "record_type", "refers_to",
    )


def digest(payload: bytes) -> str:
    return hashlib.sha256(payload).hexdigest()

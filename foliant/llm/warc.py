"""WARC archives as seekable Zstandard bundles.

Every page becomes one WARC record. Of records with equal payloads the one with the smallest id is a response, the others
are revisits that name it and carry no payload. A task groups its records into independent frames of about FRAME_BYTES,
appends metadata that maps record ids to frame and offset, ends the file with the seek table, and starts another file when
one holds ARCHIVE_BYTES.

Payload digests are computed and compared inside the JVM. Digests that occur more than once are listed; up to SHORT of them
are broadcast and pages are written where they are read, beyond that pages and list meet in a join on the digest, which
adaptive execution splits when one payload makes up much of the table.

Defined results: a null payload is an empty one, and empty payloads equal each other; rows that repeat the smallest id of
a payload are all responses; a row without id is written without one and never named by others, unless no row of its
payload has an id: then all of these are responses. An empty table writes no archive. Other columns are not read. A payload
is a record of one frame, whatever its length up to 4 GB, which is the format's limit for a frame and over that of a Spark
string. The list of archives is a table, too, as it grows with the input.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm.common import removed, shared_dir, written
from foliant.llm.seekable import Reader, Writer, filesystem, write_whole

FRAME_BYTES = 1 << 18
#: Records of one archive, in bytes before compression; a task with more starts another.
ARCHIVE_BYTES = 1 << 28
#: Repeated payloads (28 bytes each) whose list is broadcast.
SHORT = 200_000
_EPOCH = "1970-01-01T00:00:00Z"  # no time is known for a page; results must not depend on the clock


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; payload is empty for a revisit, size and digest are always the full payload's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {_EPOCH}"]
    if url:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() else "%" + c.encode().hex().upper() for c in url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(payload)}", "", ""]
    return "\r\n".join(head).encode() + http + payload + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], dict[str, str], bytes, int]:
    """The record that starts at `at`: its fields, its HTTP fields, its payload, and where the next record starts."""

    def fields(begin: int, end: int) -> dict[str, str]:
        lines = data[begin:end].decode().split("\r\n")
        return {"": lines[0]} | {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}

    end = data.index(b"\r\n\r\n", at)
    head = fields(at, end)
    body, size = end + 4, int(head["content-length"])
    http_end = data.index(b"\r\n\r\n", body, body + size)
    http = fields(body, http_end)
    if data[body + size : body + size + 4] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    return head, http, data[http_end + 4 : body + size], body + size + 4


def _base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _write(root: str, frame_bytes: int, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        columns = ("page_id", "url", "html", "sha1", "n", "refers_to")
        rows = (r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in columns), strict=True))
        row, made = next(rows, None), 0

        def fill(out, entries: list[tuple[int | None, int, int]]) -> None:
            """Writes rows until the archive has its size."""
            nonlocal row
            writer, parts, size, total = Writer(out), [], 0, 0
            while row is not None and total < archive_bytes:
                page_id, url, html, digest, n, refers_to = row
                own = record(page_id, url, (html or b"") if refers_to is None else b"", n, _base32(digest), refers_to)
                entries.append((page_id, len(writer.entries), size))
                parts.append(own)
                size += len(own)
                total += len(own)
                if size >= frame_bytes:
                    writer.frame(b"".join(parts))
                    parts, size = [], 0
                row = next(rows, None)
            if parts:
                writer.frame(b"".join(parts))
            table = np.array([e for e in entries if e[0] is not None], "<i8").reshape(-1, 3).T
            writer.metadata(json.dumps({"records": table.shape[1]}).encode() + b"\n" + np.ascontiguousarray(table[:, np.argsort(table[0], kind="stable")]).tobytes())
            writer.close()

        while row is not None:
            name, entries = f"pages-{context.partitionId():07d}-{made:05d}.warc.zst", []
            write_whole(root, name, str(context.taskAttemptId()), lambda out, entries=entries: fill(out, entries))
            yield pa.RecordBatch.from_pylist([{"archive": name, "records": len(entries)}])
            made += 1

    return run


def write_archives(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, root: str | None = None, frame_bytes: int = FRAME_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> tuple[str, DataFrame]:
    """Writes all archives; their folder and the table (archive, records) of them. Payloads under min_bytes are all
    responses."""
    spark = pages.sparkSession
    root = root or shared_dir(spark, "warc")
    html = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html")).withColumns({"sha1": F.sha1("html"), "n": F.octet_length("html").cast("long")})
    first = rows.groupBy(F.unhex("sha1").alias("digest")).agg(F.min("page_id").alias("first"), F.count("*").alias("times")).where("times > 1").select("digest", "first")
    first = written(first, "payloads")
    # A short list goes to where the pages are, and no payload travels; a longer one meets them in a shuffle.
    kept = rows.join(F.broadcast(first) if first.count() <= SHORT else first, F.unhex(rows.sha1) == first.digest, "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.col("n") >= min_bytes)
    kept = kept.withColumn("refers_to", F.when(revisit, F.col("first")))
    kept = kept.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"), "sha1", "n", "refers_to")
    done = written(kept.mapInArrow(_write(root, frame_bytes, archive_bytes), "archive string, records long"), "archives")
    removed(first)
    return root, done


def open_archive(root: str, name: str) -> tuple[Reader, np.ndarray]:
    """The reader, and rows of (page ids in order, frames, offsets)."""
    fs, folder = filesystem(root)
    reader = Reader(fs.open_input_file(f"{folder}/{name}"))
    head, _, table = reader.metadata().partition(b"\n")
    return reader, np.frombuffer(table, "<i8").reshape(3, json.loads(head)["records"])


def read_record(root: str, name: str, page_id: int) -> tuple[dict[str, str], dict[str, str], bytes] | None:
    """One record of an archive, from its frame alone; None if the archive doesn't have it."""
    reader, (ids, frames, offsets) = open_archive(root, name)
    with reader:
        at = int(np.searchsorted(ids, page_id))
        if at == len(ids) or ids[at] != page_id:
            return None
        return parse(reader.frame(int(frames[at])), int(offsets[at]))[:3]


def _page(urn: str) -> int | None:
    digits = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def _read(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                reader, _ = open_archive(root, name)
                for k in range(len(reader)):
                    data, at, rows = reader.frame(k), 0, []
                    while at < len(data):
                        head, http, payload, at = parse(data, at)
                        digest, n = head["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"])
                        if head["warc-type"] == "response" and (len(payload) != n or _base32(hashlib.sha1(payload).hexdigest()) != digest):
                            raise ValueError(f"{name}: a payload does not match its digest")
                        rows.append((_page(head["warc-record-id"]), n, digest, head["warc-type"], _page(head["warc-refers-to"]) if "warc-refers-to" in head else None))
                    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
                reader.close()

    return run


def read_archives(spark: SparkSession, root: str, archives: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record, from the files. archives: as
    write_archives() gives them."""
    listed = archives.select("archive").repartition(max(1, archives.count()))
    return listed.mapInArrow(_read(root), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")

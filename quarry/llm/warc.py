"""WARC archives as a chunked record table.

Writing: payloads become rows of record and chunk number, which stream into
gzip-compressed archives, a member a record; one archive a task.  Reading:
an archive streams into rows of record identifier and chunk number, each with
the digest of the payload up to and with that chunk.  Neither side holds more
of a record than a chunk in Python; digests are carried from chunk to chunk.

Payloads that were stored before are written as revisit records, which refer
to the response record and have no payload.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, materialise, scratch_path, ship_code, shuffle_partitions

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"
#: The longest header line that is read.
MAX_HEADER = 1 << 16
MANIFEST = "archive string, n_records long, n_bytes long"
CHUNKS = ("record_id string, page_id string, url string, record_type string, refers_to string, payload_bytes long, "
          "chunk_no long, is_last boolean, digest string, data binary")


def _open(folder: str):
    """Arrow file system and path of a folder on storage that all nodes share."""
    from pyarrow import fs
    if folder.startswith("file:") and not folder.startswith("file://"):
        folder = "file://" + folder[len("file:"):]
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


# -- records -----------------------------------------------------------------

def mark_revisits(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int) -> DataFrame:
    """``page_id, url, body, n_bytes, digest, record_type, first_id``.

    Of equal payloads of at least ``min_bytes``, those with the smallest id
    are responses.  First ids are combined map-side; AQE can split the join
    where many pages share a payload, and revisits leave it without payload."""
    body = F.coalesce(col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(col(id_col).alias("page_id"), col(url_col).alias("url"), body.alias("body"),
                        F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body, 256).alias("digest"))
    order = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("id"))
    shared = (rows.where(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
              .where("n > 1").select(F.col("digest").alias("shared"), F.col("first.id").alias("first_id")))
    joined = rows.join(shared, F.col("digest") == F.col("shared"), "left")
    again = F.col("shared").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select("page_id", "url", F.when(~again, F.col("body")).alias("body"), "n_bytes", "digest",
                         F.when(again, "revisit").otherwise("response").alias("record_type"),
                         F.when(again, F.col("first_id")).alias("first_id"))


def chunk_rows(records: DataFrame, chunk_bytes: int) -> DataFrame:
    """One row per chunk of a record's payload, in order; at least one a record."""
    n = F.ceil(F.coalesce(F.octet_length("body"), F.lit(0)) / chunk_bytes).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.substring(
        F.coalesce(F.col("body"), F.lit("").cast("binary")), i * chunk_bytes + 1, F.lit(chunk_bytes)))
    return records.select(F.col("page_id").cast("string").alias("page_id"), "url", "n_bytes", "digest", "record_type",
                          F.col("first_id").cast("string").alias("first_id"), F.posexplode(parts).alias("chunk_no", "data"))


# -- writing -----------------------------------------------------------------

def record_id(page_id: str | None, digest: str) -> str:
    return f"{URN}{'' if page_id is None else 'i' + quote(page_id, safe='')}:{digest[:32]}"


def page_of(identifier: str | None) -> str | None:
    name = (identifier or "").strip("<>").removeprefix(URN).partition(":")[0]
    return unquote(name[1:]) if name else None


def uri_text(url: str) -> str:
    """A URL as it stands in a header: as it is, escapes included; only what
    a header cannot hold (blanks, controls, non-ASCII) is escaped."""
    return "".join(c if "!" <= c <= "~" else quote(c, safe="", errors="replace") for c in url)


def _head(page_id, url, n_bytes, digest, record_type, first_id, date: str) -> bytes:
    revisit = record_type == "revisit"
    lines = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: <{record_id(page_id, digest)}>", f"WARC-Date: {date}",
             "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}",
             f"WARC-Payload-Length: {n_bytes}", f"Content-Length: {len(HTTP) + (0 if revisit else n_bytes)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + uri_text(url))
    if revisit:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <{record_id(first_id, digest)}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def _writer(folder: str, date: str, level: int):
    """Streams chunk rows into one archive a task attempt; yields its manifest row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        files, base = _open(folder)
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        raw, member, records, total, left, sha = None, None, 0, 0, 0, None

        def finish() -> None:
            if left or sha.hexdigest() != wanted:
                raise ValueError("a payload does not fit its length or digest")
            member.write(b"\r\n\r\n")
            member.close()

        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk_no"] == 0:
                    if raw is None:
                        raw = files.open_output_stream(f"{base}/{name}", compression=None)
                    if member is not None:
                        finish()
                    member = gzip.GzipFile(fileobj=raw, mode="wb", compresslevel=level, mtime=0)
                    member.write(_head(*(row[c] for c in ("page_id", "url", "n_bytes", "digest", "record_type", "first_id")), date))
                    member.write(HTTP)
                    stored = row["record_type"] == "response"
                    records, sha = records + 1, hashlib.sha256()
                    left, wanted = (row["n_bytes"], row["digest"]) if stored else (0, sha.hexdigest())
                member.write(row["data"])
                sha.update(row["data"])
                left -= len(row["data"])
                total += len(row["data"])
        if raw is not None:
            finish()
            raw.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64()), pa.array([total], pa.int64())],
                                             ["archive", "n_records", "n_bytes"])
    return run


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_bytes: int = 100, chunk_bytes: int = 1 << 18, date: str = "2024-01-01T00:00:00Z", level: int = 1) -> DataFrame:
    """Write a record per row; returns the manifest ``archive, n_records, n_bytes``.

    Archives that the manifest lacks are what lost task attempts left; they
    are not read."""
    ship_code()
    files, base = _open(folder)
    files.create_dir(base, recursive=True)
    rows = chunk_rows(mark_revisits(pages, id_col, url_col, payload_col, min_bytes), chunk_bytes)
    return materialise(rows.mapInArrow(_writer(folder, date, level), MANIFEST), "warc-manifest")


# -- reading -----------------------------------------------------------------

def _line(stream) -> bytes:
    """A header line; one without an end is no header, and is not read on."""
    line = stream.readline(MAX_HEADER)
    if len(line) == MAX_HEADER and not line.endswith(b"\n"):
        raise ValueError("no WARC record: a header line has no end")
    return line


def _headers(stream) -> tuple[str, dict[str, str]]:
    first = _line(stream)
    while first in (b"\r\n", b"\n"):
        first = _line(stream)
    out: dict[str, str] = {}
    while (line := _line(stream)) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return first.decode("utf-8", "replace").strip(), out


def read_records(stream, chunk_bytes: int, data: bool = True) -> Iterator[dict]:
    """Chunk rows of an uncompressed WARC stream."""
    while True:
        version, head = _headers(stream)
        if not version:
            return
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record: {version[:40]!r}")
        left, digest, kind = int(head["content-length"]), hashlib.sha256(), head.get("warc-type")
        if "http" in head.get("content-type", ""):  # the payload is what follows the HTTP head
            while left and (line := stream.readline(min(left, MAX_HEADER))):
                left -= len(line)
                if line in (b"\r\n", b"\n"):
                    break
        size, number, revisit = left, 0, kind == "revisit"
        while True:
            part = stream.read(min(chunk_bytes, left))
            if not part and left:
                raise ValueError("a record ends early")
            left -= len(part)
            digest.update(part)
            stored = head.get("warc-payload-digest", "").removeprefix("sha256:")
            yield {"record_id": head.get("warc-record-id"), "page_id": page_of(head.get("warc-record-id")),
                   "url": head.get("warc-target-uri"), "record_type": kind, "refers_to": page_of(head.get("warc-refers-to")),
                   "payload_bytes": int(head.get("warc-payload-length", 0)) if revisit else size, "chunk_no": number,
                   "is_last": left == 0, "digest": stored if revisit else digest.hexdigest(), "data": part if data else None}
            number += 1
            if not left:
                break


def _reader(folder: str, chunk_bytes: int, data: bool, batch_bytes: int = 1 << 24):
    schema = [(c.split()[0], {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}[c.split()[1]])
              for c in CHUNKS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open(folder)
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                rows, size = [], 0
                with files.open_input_stream(f"{base}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for row in read_records(stream, chunk_bytes, data):
                        rows.append(row)
                        size += 200 + len(row["data"] or b"")
                        if size >= batch_bytes:
                            yield pa.RecordBatch.from_pylist(rows, pa.schema(schema))
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, pa.schema(schema))
    return run


def read_warc(manifest: DataFrame, folder: str, chunk_bytes: int = 1 << 18, data: bool = True) -> DataFrame:
    """Chunk rows of the manifest's archives; ``data=False`` leaves the bytes out.

    ``digest`` is the SHA-256 of the payload up to and with the chunk; in a
    revisit it is the stored digest of the payload it refers to."""
    ship_code()
    names = manifest.select("archive").repartition(shuffle_partitions(manifest.sparkSession), "archive")
    return names.mapInArrow(_reader(folder, chunk_bytes, data), CHUNKS)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               folder: str | None = None, **options) -> DataFrame:
    """Write archives, read them back: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to`` of every record.

    Null payloads count as empty.  A null id counts as greater than all
    others.  Rows that share both the smallest id and the payload are all
    responses.  Empty tables give no archive and no rows.  Other columns are
    not looked at.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    manifest = write_warc(pages, folder, id_col, url_col, payload_col, **options)
    kind = pages.schema[id_col].dataType
    last = read_warc(manifest, folder, data=False).where("is_last")
    return last.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
                       "record_type", F.col("refers_to").cast(kind).alias("refers_to"))

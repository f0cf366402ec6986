"""Monolithic gzip archives made random-access.

``write_monolithic`` writes records into archives that are one gzip stream each,
as some crawlers leave them. ``normalise`` inflates every archive once, as a
stream, writes each record as a gzip member of its own and a sidecar file with
offset, length, type and id of every member. ``read_members`` reads records
back through the sidecar, by offset.

Archives are files below a folder all executors share (any store that
``pyarrow.fs`` opens). A task gives its files fresh names and the table of
archive paths is stored, so that a repeated task never touches a file in use.
Memory: records are copied in chunks while normalising, one record is held
while writing and reading.

Defined results: a NULL payload is empty; records of equal payload are one
group, that with the largest id is the response (a NULL id is the smallest;
several records of that same id are all responses), the others revisit it.
A truncated or malformed archive is an error that names the file.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synthcurate.session import scratch_path

from .common import stored

CHUNK = 1 << 20
ARCHIVE_BYTES = 32 << 20
LEVEL = 3
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVES = "path string, records bigint"
RECORD = "record_id bigint, uri string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, payload binary"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The store and the place in it; ``file:/x`` and plain paths are local files."""
    if "://" not in uri:
        uri = f"file://{uri.removeprefix('file:')}"
    return fs.FileSystem.from_uri(uri)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def encode_record(record_id: int | None, uri: str | None, kind: str, refers_to: int | None, payload: bytes) -> bytes:
    """One WARC record. The block of a revisit is the HTTP head alone, which
    still tells the length of the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if record_id is None else record_id}>"]
    if uri is not None:
        head.append(f"WARC-Target-URI: {json.dumps(uri)}")
    head += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_head(stream, path: str) -> tuple[bytes, dict[str, str]] | None:
    """The head of the next record and its fields; None at the end."""
    raw = stream.readline()
    if not raw:
        return None
    if not raw.startswith(b"WARC/"):
        raise ValueError(f"{path}: no WARC record where one should start")
    lines = [raw]
    while (line := stream.readline()) not in (b"\r\n", b""):
        lines.append(line)
    if not line:
        raise ValueError(f"{path}: ends within the head of a record")
    fields = dict(x.decode().rstrip("\r\n").split(": ", 1) for x in lines[1:])
    return b"".join(lines) + b"\r\n", fields


def _copy(stream, size: int, path: str) -> Iterator[bytes]:
    while size:
        if not (chunk := stream.read(min(size, CHUNK))):
            raise ValueError(f"{path}: ends within a record")
        size -= len(chunk)
        yield chunk


def normalise_archive(source: str, target: str) -> int:
    """Rewrite one archive; returns the number of records."""
    store, path = opened(source)
    out_store, out_path = opened(target)
    count = 0
    with store.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream, \
            out_store.open_output_stream(out_path, compression=None) as out, out_store.open_output_stream(f"{out_path}.idx") as index:
        while (head := read_head(stream, source)) is not None:
            packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            start = out.tell()
            out.write(packer.compress(head[0]))
            for chunk in _copy(stream, int(head[1]["Content-Length"]) + 4, source):
                out.write(packer.compress(chunk))
            out.write(packer.flush())
            entry = {"offset": start, "length": out.tell() - start, "type": head[1]["WARC-Type"], "id": head[1]["WARC-Record-ID"]}
            index.write(json.dumps(entry).encode() + b"\n")
            count += 1
    return count


def _number(field: str | None) -> int | None:
    text = (field or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def read_archive(path: str) -> Iterator[tuple]:
    """Records of a normalised archive, each found through the sidecar. The
    SHA-1 and length of every response payload are computed from the bytes read
    and must equal its head; a revisit has no payload and keeps its head's,
    which its response's check covers."""
    store, place = opened(path)
    with store.open_input_file(place) as data, store.open_input_stream(f"{place}.idx") as raw:
        for line in gzip.io.BufferedReader(raw):
            entry = json.loads(line)
            data.seek(entry["offset"])
            member = zlib.decompress(data.read(entry["length"]), 31)
            head, _, rest = member.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            block = rest[: int(fields["Content-Length"])]
            http, _, payload = block.partition(b"\r\n\r\n")
            size = next(int(x.split(b": ")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length"))
            uri = fields.get("WARC-Target-URI")
            digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
            if fields["WARC-Type"] == "response" and (len(payload) != size or payload_digest(payload) != digest):
                # the bytes read decide; a damaged payload is an error, not a record
                raise ValueError(f"{path}: record {fields['WARC-Record-ID']} at offset {entry['offset']} differs from its length or digest")
            yield (
                _number(fields["WARC-Record-ID"]), None if uri is None else json.loads(uri), fields["WARC-Type"],
                _number(fields.get("WARC-Refers-To")), digest, size, payload,
            )


def revisits(pages: DataFrame, record_id: str, uri: str, payload: str) -> DataFrame:
    """Records with type and the id they refer to. Only ids are gathered for
    each payload digest; they are stored before the join, so that both of its
    sides are plain shuffles and a hot payload is split at run time."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(record_id).cast("bigint").alias("record_id"), F.col(uri).cast("string").alias("uri"), body.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    groups = rows.groupBy("digest").agg(F.max("record_id").alias("first_id"), F.count("*").alias("n"))
    shared = stored(groups.filter("n > 1").select(F.col("digest").alias("of"), "first_id"), "payload-groups")
    joined = rows.join(shared, F.col("digest") == F.col("of"), "left")
    is_revisit = F.col("of").isNotNull() & ~F.col("record_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "record_id", "uri", "payload", F.when(is_revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(is_revisit, F.col("first_id")).alias("refers_to"),
    )


def write_monolithic(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write records (see ``revisits``) into archives of about ``archive_bytes``
    before compression, each one gzip stream. Returns the paths."""

    def write(batches):
        store, root = opened(folder)
        store.create_dir(root, recursive=True)
        out = packer = name = None
        done: list[tuple[str, int]] = []
        size = count = 0

        def close():
            out.write(packer.flush())
            out.close()
            done.append((f"{folder}/{name}", count))

        for batch in batches:
            for at in range(batch.num_rows):
                row = {k: batch.column(i)[at].as_py() for i, k in enumerate(batch.schema.names)}
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, packer = store.open_output_stream(f"{root}/{name}", compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    size = count = 0
                data = encode_record(row["record_id"], row["uri"], row["record_type"], row["refers_to"], row["payload"])
                out.write(packer.compress(data))
                size, count = size + len(data), count + 1
                if size >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.record_batch({"path": pa.array([p for p, _ in done], pa.string()), "records": pa.array([n for _, n in done], pa.int64())})

    return stored(records.mapInArrow(write, ARCHIVES), "archives")


def _spread(archives: DataFrame) -> DataFrame:
    """One task for each archive."""
    return archives.repartition(max(1, archives.count()))


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives below ``folder``; returns the new paths."""

    def work(batches):
        store, root = opened(folder)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                target = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                count = normalise_archive(path, target)
                yield pa.record_batch({"path": pa.array([target], pa.string()), "records": pa.array([count], pa.int64())})

    return stored(_spread(archives.select("path")).mapInArrow(work, ARCHIVES), "normalised")


def read_members(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of normalised archives; ``payloads=False`` leaves the
    payload column NULL."""
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in RECORD.split(", ")]

    def work(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                for row in read_archive(path):
                    held += len(row[-1]) if payloads else 0
                    rows.append(row if payloads else (*row[:-1], None))
                    if len(rows) >= 2000 or held >= 16 * CHUNK:
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return _spread(archives.select("path")).mapInArrow(work, RECORD)


def round_trip(pages: DataFrame, record_id: str = "page_id", uri: str = "url", payload: str = "html") -> DataFrame:
    """Write, normalise and index: the table of normalised archives."""
    folder = scratch_path(pages.sparkSession, "warc")
    return normalise(write_monolithic(revisits(pages, record_id, uri, payload), f"{folder}/whole"), f"{folder}/members")

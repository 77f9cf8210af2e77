"""WARC archives: a writer that refers copies to one response, and a sequential reader.

Every record is a gzip member of its own. The reader decompresses member after member in
small pieces, takes the block by its Content-Length and verifies the payload digest.

Files are written and read by the Python workers through ``pyarrow.fs``, as they are (left to
itself, it would compress a ``.gz`` file once more), so the folder is a
URI (or absolute path) that every executor reaches. A task names its files at random and only
the files of tasks that Spark commits are listed in the manifest: what a lost executor left
behind is never read.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, functions as F

from starledger.llm.common import as_bytes, base32, batch, stored
from starledger.shared import new_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules["starledger.llm.common"])

#: Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"

#: A record's id is this prefix and the row's key.
ID_PREFIX = "urn:record:"

RECORDS = (
    "path string, offset long, record_id string, record_type string, target_uri string, "
    "refers_to string, payload_bytes long, payload_digest string, verified boolean, payload binary"
)
_ARROW_RECORDS = pa.schema(
    [
        ("path", pa.string()),
        ("offset", pa.int64()),
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("target_uri", pa.string()),
        ("refers_to", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("verified", pa.bool_()),
        ("payload", pa.binary()),
    ]
)
_MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])


def write_warc(
    pages: DataFrame,
    folder: str | None = None,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_revisit_bytes: int = 0,
    max_file_bytes: int = 256 << 20,
    date: str = "2000-01-01T00:00:00Z",
    level: int = 6,
) -> DataFrame:
    """Write a record per row; returns the manifest: path, records and bytes of each file.

    Of rows with equal payloads of at least ``least_revisit_bytes`` bytes, the one with the
    largest key is a response record and the others are revisit records that refer to it. A
    null payload is an empty one. Rows repeated with the largest key are all responses; a null
    key is the smallest, and rows whose keys are all null are all responses. A null url leaves
    the target out. An empty table writes no file. Other columns are not read.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    body = F.coalesce(as_bytes(payload), F.lit(b""))
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).cast("string").alias("url"), body.alias("body")
    ).withColumns({"digest": F.sha1("body"), "size": F.octet_length("body")})
    # Only digests that occur twice are joined back; equal digests combine before the shuffle.
    copies = (
        rows.where(F.col("size") >= least_revisit_bytes)
        .groupBy("digest")
        .agg(F.max("key").alias("kept"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "kept")
    )
    refers = F.when(~F.col("key").eqNullSafe(F.col("kept")), F.col("kept"))
    records = rows.join(copies, "digest", "left").select(
        F.col("key").cast("string").alias("key"),
        "url",
        F.unhex("digest").alias("digest"),
        F.col("size").cast("long").alias("size"),
        refers.cast("string").alias("refers"),
        F.when(refers.isNull(), F.col("body")).alias("body"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        partition = TaskContext.get().partitionId()
        out, done = None, []
        for rows in batches:
            for row in zip(*(column.to_pylist() for column in rows.columns)):
                if out is None:
                    name = f"{partition:05d}-{uuid.uuid4().hex}.warc.gz"
                    out, count, size = store.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                member = _member(*row, date, level)
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= max_file_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", count, size))
        if done:
            yield batch(_MANIFEST, zip(*done))

    return stored(records.mapInArrow(write, "path string, records long, bytes long"), "warc-list")


def _member(key, url, digest, size, refers, body, date, level) -> bytes:
    """One record as a gzip member."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {size}\r\n\r\n"
    ).encode()
    block = http + (body or b"")
    fields = [
        f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: <{ID_PREFIX}{'' if key is None else key}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base32(digest)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        # Characters that would end the line are escaped, others stay as they are.
        fields.append("WARC-Target-URI: " + "".join(quote(c) if c < "!" else c for c in url))
    if refers is not None:
        fields.append(f"WARC-Profile: {IDENTICAL_PAYLOAD}")
        fields.append(f"WARC-Refers-To: <{ID_PREFIX}{refers}>")
    head = "\r\n".join([VERSION, *fields]).encode() + END
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(head) + packer.compress(block + END) + packer.flush()


def read_warc(files: DataFrame, payloads: bool = True, piece_bytes: int = 1 << 16) -> DataFrame:
    """The records of the archives that column ``path`` names, in ``RECORDS``.

    Each file is read from its start by one task, a record at a time; memory follows the
    largest record. ``verified`` says whether the payload has the digest in its header (null
    for a revisit, which has no payload, or without a digest); digest and size of a revisit
    are those that it states of the full payload. A file that ends inside a record, or a block
    that is not as long as its header says, raises. No files, or empty ones, give no rows.
    """
    paths = files.select("path").where("path is not null")
    tasks = min(max(paths.count(), 1), 4 * paths.sparkSession.sparkContext.defaultParallelism)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names in batches:
            for path in names.column(0).to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with store.open_input_stream(name, compression=None) as stream:
                    for offset, data in _members(stream, piece_bytes):
                        row = _record(path, offset, data)
                        rows.append(row if payloads else (*row[:-1], None))
                        held += len(row[-1]) if payloads and row[-1] else 200
                        if held > 4 << 20:
                            yield batch(_ARROW_RECORDS, zip(*rows))
                            rows, held = [], 0
                if rows:
                    yield batch(_ARROW_RECORDS, zip(*rows))

    return paths.repartition(tasks).mapInArrow(read, RECORDS)


def _members(stream, piece_bytes: int) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each gzip member, decompressed piece by piece."""
    piece, at = stream.read(piece_bytes), 0
    while piece:
        start, unpacker, content = at, zlib.decompressobj(31), []
        while not unpacker.eof:
            if not piece:
                piece = stream.read(piece_bytes)
                if not piece:
                    raise ValueError(f"the archive ends inside the record at {start}")
            content.append(unpacker.decompress(piece))
            at += len(piece) - len(unpacker.unused_data)
            piece = unpacker.unused_data
        yield start, b"".join(content)
        piece = piece or stream.read(piece_bytes)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _record(path: str, offset: int, data: bytes) -> tuple:
    head, found, rest = data.partition(END)
    fields = _fields(head)
    length = int(fields.get("content-length", -1))
    if not found or not head.startswith(b"WARC/") or rest[length:] != END:
        raise ValueError(f"{path}: no whole record at {offset}")
    payload = rest[:length]
    size = None
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = payload.partition(END)
        size = _fields(http).get("content-length")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    revisit = fields.get("warc-type") == "revisit"
    verified = None
    if not revisit:
        size = len(payload)
        if digest:
            verified = base32(hashlib.sha1(payload).digest()) == digest
    refers = fields.get("warc-refers-to")
    return (
        path,
        offset,
        fields.get("warc-record-id", "").strip("<>"),
        fields.get("warc-type"),
        fields.get("warc-target-uri"),
        refers and refers.strip("<>"),
        None if size is None else int(size),
        digest,
        verified,
        None if revisit else payload,
    )

"""Web archives as seekable Zstandard bundles.

Each task writes its records to bundle files of the shared folder. Records are gathered into frames of about
``FRAME_BYTES``, each compressed alone; after the last frame comes a skippable frame with the table of all frames'
sizes (the seekable Zstandard format), so a reader finds any frame from the file's end. The index maps each record to
its bundle, frame, and place inside the uncompressed frame.

Files carry the task attempt in their names, and only the attempt that Spark commits is in the index: what a lost or
repeated attempt leaves behind is never read. File access goes through pyarrow's file systems (local, HDFS, S3).

Among records with equal payloads of at least ``REVISIT_BYTES`` the one with the largest page id is the response and
the others are revisits that point to it; smaller ones are all responses.

Defined results: a null html is an empty payload and a null url an empty target; rows that share the largest id of
equal payloads are all responses; a null id is never the largest unless all are null, and a null id is written as an
absent page id; repeated rows are records of their own. An empty table makes an empty index and no file. Other columns
are not written.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

REVISIT_BYTES = 1000
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 64 << 20
#: Hot payloads are joined to their response in this many parts.
SALTS = 16
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Fixed values of the seekable format
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<II")

INDEX_SCHEMA = "page_id bigint, record_id string, bundle string, frame int, offset long, length long"


@cache
def _file_system(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder)


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> tuple[str, bytes]:
    """Id and bytes of one record. A revisit keeps the HTTP header, with the payload's length, and no payload."""
    name = _record_id(page_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join(c for c in url or "" if c not in "\r\n")
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name}",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    return name, "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


class Bundle:
    """One file being written: frames as they fill up, the seek table at the end."""

    def __init__(self, stream):
        self.stream, self.sizes, self.written = stream, [], 0
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.open, self.size = [], 0

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame number and offset in the frame at which the record stands."""
        place = len(self.sizes), self.size
        self.open.append(data)
        self.size += len(data)
        if self.size >= FRAME_BYTES:
            self.flush()
        return place

    def flush(self) -> None:
        if not self.open:
            return
        frame = self.compressor.compress(b"".join(self.open))
        self.stream.write(frame)
        self.sizes.append((len(frame), self.size))
        self.written += len(frame)
        self.open, self.size = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(ENTRY.pack(*x) for x in self.sizes) + FOOTER.pack(len(self.sizes), 0, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.stream.close()


def seek_table(stream, size: int) -> list[tuple[int, int, int]]:
    """Begin, compressed and plain size of every frame, from the end of the file."""
    stream.seek(size - FOOTER.size)
    n, descriptor, magic = FOOTER.unpack(stream.read(FOOTER.size))
    if magic != SEEKABLE_MAGIC or descriptor & 0x80:
        raise ValueError("no seek table without checksums at the end of the bundle")
    stream.seek(size - FOOTER.size - n * ENTRY.size)
    begin, frames = 0, []
    for packed, plain in ENTRY.iter_unpack(stream.read(n * ENTRY.size)):
        frames.append((begin, packed, plain))
        begin += packed
    return frames


def with_revisits(pages: DataFrame) -> DataFrame:
    """Payload, digest and, for repeated payloads, the page the record refers to. Payloads cross one shuffle."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    large = rows.filter(F.col("size") >= REVISIT_BYTES).groupBy("digest", "size").agg(
        F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")
    )
    # copies of one payload may be most of the table: they are dealt to SALTS parts, the response is in each
    repeated = large.filter("n > 1").select(
        "digest", "size", "response", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    joined = dealt.join(repeated, ["digest", "size", "salt"], "left")
    revisit = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return joined.select(
        "page_id", "url", "payload", "digest", F.when(revisit, F.col("response")).alias("refers_to"), revisit.alias("revisit")
    )


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write bundles below ``folder`` and return the index, itself written there."""
    spark = pages.sparkSession
    common.ship_package(spark)
    rows = with_revisits(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(folder)
        task = TaskContext.get()
        bundle, name, made = None, "", 0
        for batch in batches:
            out: list[tuple] = []
            for page_id, url, payload, digest, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bundle is None:
                    name = f"bundle-{task.partitionId():06d}-{task.taskAttemptId()}-{made}.warc.zst"
                    fs.create_dir(base, recursive=True)
                    bundle, made = Bundle(fs.open_output_stream(f"{base}/{name}", compression=None)), made + 1
                record_id, data = record(page_id, url, payload, digest, refers_to, revisit)
                out.append((page_id, record_id, name, *bundle.add(data), len(data)))
                if bundle.written >= BUNDLE_BYTES:
                    bundle.close()
                    bundle = None
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x), t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 6, _INDEX_TYPES, strict=True)],
                names=_INDEX_NAMES,
            )
        if bundle is not None:
            bundle.close()

    index = f"{folder}/index"
    rows.mapInArrow(run, INDEX_SCHEMA).write.parquet(index)
    return spark.read.schema(INDEX_SCHEMA).parquet(index)


_INDEX_TYPES = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
_INDEX_NAMES = ["page_id", "record_id", "bundle", "frame", "offset", "length"]


def parsed(data: bytes) -> dict:
    """Headers and payload of a record; a response's payload is checked against its digest."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, payload = block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
    page, other = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
    return {
        "page_id": int(page) if page else None, "url": fields["WARC-Target-URI"], "record_type": kind, "payload_bytes": size,
        "payload_digest": digest, "refers_to": int(other) if other else None, "payload": payload if kind == "response" else None,
    }


READ_SCHEMA = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"
_READ_TYPES = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
_READ_NAMES = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]


def read(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Read the records of ``index`` (all or any part of it): each frame is sought, read and expanded once."""
    common.ship_package(index.sparkSession)
    frames = index.groupBy("bundle", "frame").agg(F.collect_list(F.struct("offset", "length")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(folder)
        expand = zstandard.ZstdDecompressor()
        tables: dict[str, list] = {}
        for batch in batches:
            for name, frame, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with fs.open_input_file(f"{base}/{name}") as stream:
                    if name not in tables:
                        tables = {name: seek_table(stream, stream.size())}
                    begin, packed, plain = tables[name][frame]
                    stream.seek(begin)
                    data = expand.decompress(stream.read(packed), max_output_size=plain)
                found = [parsed(data[p["offset"] : p["offset"] + p["length"]]) for p in places]
                if not payloads:
                    found = [x | {"payload": None} for x in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[n] for x in found], t) for n, t in zip(_READ_NAMES, _READ_TYPES, strict=True)], names=_READ_NAMES
                )

    return frames.mapInArrow(run, READ_SCHEMA)


def query(spark, sf_dir):
    folder = common.new_path(spark, "warc")
    index = write(common.table(spark, sf_dir, "pages"), folder)
    return read(index, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest FROM p
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS response FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id IS DISTINCT FROM response THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id IS DISTINCT FROM response THEN response END AS refers_to
FROM g
"""

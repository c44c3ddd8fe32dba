"""WARC archives: gzip members written by tasks, read back by a splittable reader.

**Writing.** Rows are (record_id, target_uri, payload). Of records with equal payloads
of ``REVISIT_FROM`` bytes or more, the one with the largest id is a ``response``; the
others become ``revisit`` records that refer to it (rows that share the largest id are
all responses, as are rows without an id). Payload digests are grouped first; payloads
that hold more than a thousandth of all rows (a thousand at most, so broadcast) are
looked up apart, all others joined, so no payload's rows meet in one task. Every task
writes its records, a gzip member each, into files of its own name; the table of files
written is itself a committed Parquet table, so files of lost attempts are never read.

**Reading.** Files are cut into byte ranges, dealt to tasks. A task scans its range for
the gzip magic, validates each candidate by decoding its head (gzip header, then a WARC
version line and the named fields it needs), and owns the records that start inside its
range, following the last one across the border. Within a record's extent nothing is
scanned. Payload digests of responses are computed anew and must equal the header's.
Only a range that begins inside a payload which itself holds an archive, stored without
compression, can take a wrong first record; ``broken`` finds that (records must tile a
file).

A null payload is empty. Null URIs are left out of the record; line breaks in one are
percent-encoded. Repeated rows are repeated records. An empty table gives one file or
none, and no records. Files are reached through ``pyarrow.fs`` (local or mounted, HDFS,
S3, GCS).
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.llm.common import fresh, lean, materialize, scratch_path

#: Payloads of this many bytes or more may be revisited.
REVISIT_FROM = 1000
#: A task begins a new file beyond this many bytes.
FILE_BYTES = 256 << 20
#: One range of the reader.
SPLIT_BYTES = 64 << 20
#: Bytes read at a time, and gathered in one batch of rows.
BLOCK = 1 << 20
_MAGIC = b"\x1f\x8b\x08"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A candidate is judged by its first decoded bytes; members are decoded piece by piece.
_HEAD, _PIECE = 4096, 1 << 14


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or plain path, with Hadoop's spellings of local files and S3."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    for scheme in ("s3a://", "s3n://"):
        if uri.startswith(scheme):
            uri = "s3://" + uri[len(scheme) :]
    return fs.FileSystem.from_uri(uri)


# ---------------------------------------------------------------------------
# writing


def with_types(rows: DataFrame, least: int = REVISIT_FROM) -> DataFrame:
    """``rows`` (record_id, target_uri, payload binary) with payload_bytes, digest (SHA-1) and refers_to (null: response)."""
    rows = rows.withColumn("payload", F.coalesce("payload", F.expr("X''"))).select(
        "record_id", "target_uri", "payload", F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha1("payload").alias("digest"))
    # equal payloads: by a digest that has no known collisions
    same = F.when(F.col("payload_bytes") >= least, F.sha2("payload", 256))
    groups = rows.select(same.alias("same"), "record_id").where("same is not null").groupBy("same").agg(
        F.count(F.lit(1)).alias("n"), F.max("record_id").alias("newest")).where("n > 1 and newest is not null")
    groups = materialize(groups, "warc-payloads")
    total = rows.count()
    hot = groups.where(F.col("n") * 1000 > total).select(F.col("same").alias("hot"), F.col("newest").alias("hot_newest"))
    rest = groups.where(F.col("n") * 1000 <= total).select(F.col("same").alias("cold"), F.col("newest").alias("cold_newest"))
    rows = rows.withColumn("same", same).join(F.broadcast(hot), F.col("same") == F.col("hot"), "left")  # under a thousand rows
    # rows that need no look-up are spread by their own digest and never gather on a null
    asks = F.when(F.col("hot").isNull() & F.col("same").isNotNull(), F.col("same")).otherwise(F.concat(F.lit("-"), F.coalesce(F.col("record_id").cast("string"), F.col("digest"))))
    rows = rows.withColumn("asks", asks).join(rest, F.col("asks") == F.col("cold"), "left")
    newest = F.coalesce("hot_newest", "cold_newest")
    return rows.select("record_id", "target_uri", "payload", "payload_bytes", "digest", F.when(F.col("record_id") < newest, newest).alias("refers_to"))


def _urn(record_id: int | None) -> str:
    return f"<urn:x-record:{record_id}>" if record_id is not None else f"<{uuid.uuid4().urn}>"


def _member(record_id: int | None, uri: str | None, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    kind = "response" if refers_to is None else "revisit"
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if refers_to is None:
        block += payload
    fields = [("WARC-Type", kind), ("WARC-Record-ID", _urn(record_id)), ("WARC-Date", "1970-01-01T00:00:00Z"),
              ("WARC-Target-URI", None if uri is None else uri.replace("\r", "%0D").replace("\n", "%0A")),
              ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
              ("WARC-Refers-To", None if refers_to is None else _urn(refers_to)), ("WARC-Profile", None if refers_to is None else _PROFILE),
              ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def write(rows: DataFrame, root: str | None = None, least: int = REVISIT_FROM, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write (record_id bigint, target_uri, payload binary) rows as archives under ``root``; the table of files (path, size, records)."""
    spark = rows.sparkSession
    root = root or scratch_path(spark, "warc")
    system, folder = _open(root)
    system.create_dir(folder, recursive=True)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _open(root)
        out, done = None, []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if out is None:
                    path = f"records-{uuid.uuid4().hex}.warc.gz"  # an attempt's own name
                    out, size, count = system.open_output_stream(f"{folder}/{path}", compression=None), 0, 0
                member = _member(*row)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    out.close()
                    done.append((f"{root}/{path}", size, count))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{root}/{path}", size, count))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["path", "size", "records"])

    typed = with_types(rows.select(F.col("record_id").cast("bigint").alias("record_id"), F.col("target_uri").cast("string").alias("target_uri"),
                                   F.col("payload").cast("binary").alias("payload")), least)
    return materialize(typed.mapInArrow(lean(pack), "path string, size bigint, records bigint"), "warc-files")


def files(spark: SparkSession, root: str) -> DataFrame:
    """(path, size) of the archives under a folder, from a listing by Spark (no file is read)."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", "true").load(root)
    return found.select("path", F.col("length").alias("size"))


# ---------------------------------------------------------------------------
# reading


def _fields(head: bytes) -> dict[str, str]:
    lines = head.split(b"\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.decode("utf-8", "replace").partition(":") for x in lines[1:])}


def _is_record(head: bytes) -> bool:
    """A version line and, as far as the head reaches, the fields every record has."""
    if not head.startswith(b"WARC/1."):
        return False
    end = head.find(b"\r\n\r\n")
    return end < 0 or {"warc-type", "warc-record-id", "content-length"} <= set(_fields(head[:end]))


class _Bytes:
    """A file's bytes from any offset on, read in blocks and forgotten behind the reader."""

    def __init__(self, uri: str, size: int) -> None:
        system, path = _open(uri)
        self.file, self.size, self.at, self.held = system.open_input_file(path), size, 0, memoryview(b"")

    def take(self, start: int, least: int) -> memoryview:
        """What is held from ``start`` on, ``least`` bytes or more unless the file ends."""
        if not (self.at <= start and min(start + least, self.size) <= self.at + len(self.held)):
            self.at = start
            self.held = memoryview(self.file.read_at(min(BLOCK, self.size - start), start) if start < self.size else b"")
        return self.held[start - self.at :]

    def member(self, start: int, most: int = 0) -> tuple[bytes, int] | None:
        """The member at ``start`` decoded (``most``: only so many bytes), and where it ends; None if it isn't one."""
        unpack, parts, at = zlib.decompressobj(31), [], start
        try:
            while not unpack.eof:
                piece = self.take(at, 1)[:_PIECE]
                if not piece:
                    return None  # cut off
                parts.append(unpack.decompress(piece, most))
                at += len(piece)
                if most and parts[-1]:
                    break
        except zlib.error:
            return None
        return b"".join(parts), at - len(unpack.unused_data)

    def next_record(self, start: int, stop: int) -> int | None:
        """First validated member start in ``[start, stop)``."""
        at = start
        while at < stop:
            piece = bytes(self.take(at, len(_MAGIC)))
            k = piece.find(_MAGIC)
            while k >= 0 and at + k < stop:
                head = self.member(at + k, _HEAD)
                if head is not None and _is_record(head[0]):
                    return at + k
                k = piece.find(_MAGIC, k + 1)
            at += max(1, len(piece) - len(_MAGIC) + 1)
        return None


RESULT = ("path string, split bigint, start bigint, stop bigint, record_type string, record_id string, target_uri string, date string, "
          "refers_to string, content_type string, payload_digest string, payload_bytes bigint, payload binary")
_TYPES = [pa.string(), *[pa.int64()] * 3, *[pa.string()] * 7, pa.int64(), pa.binary()]


def _record(raw: bytes) -> tuple:
    """Columns from record_type on, of a decoded member."""
    end = raw.index(b"\r\n\r\n")
    fields = _fields(raw[:end])
    block = raw[end + 4 : end + 4 + int(fields["content-length"])]
    payload, size = block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        size = int(_fields(head).get("content-length", len(payload)))
    digest, kind = fields.get("warc-payload-digest"), fields["warc-type"]
    if digest and digest.startswith("sha1:"):
        digest = base64.b32decode(digest[5:]).hex()
        if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"the payload of {fields['warc-record-id']} does not have its digest")
    name = lambda x: x[1:-1] if x and x.startswith("<") else x
    return (kind, name(fields["warc-record-id"]), fields.get("warc-target-uri"), fields.get("warc-date"), name(fields.get("warc-refers-to")),
            fields.get("content-type"), digest, size, None if kind == "revisit" else payload)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, size, split, split_end) to the records that start in ``[split, split_end)``."""
    out, held = [], 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(_TYPES)], [c.split()[0] for c in RESULT.split(", ")])

    for batch in batches:
        for path, size, split, split_end in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            source = _Bytes(path, size)
            at = source.next_record(split, split_end)
            while at is not None and at < split_end:
                found = source.member(at)
                if found is None or not _is_record(found[0]):
                    raise ValueError(f"{path}: no whole record at {at}")
                raw, stop = found
                out.append((path, split, at, stop, *_record(raw)))
                held += len(raw)
                if held >= 8 * BLOCK:
                    yield flush()
                    out, held = [], 0
                at = stop
            source.file.close()
    yield flush()


def ranges(archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, size, split, split_end) rows, dealt to the reader's tasks."""
    cut = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split_bytes).cast("bigint")))
    rows = archives.where("size > 0").select("path", "size", cut.alias("split"))
    rows = rows.withColumn("split_end", F.least(F.col("split") + split_bytes, F.col("size")))
    count, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("split_end") - F.col("split")), F.lit(0))).first()
    tasks = max(math.ceil(size / split_bytes), 2 * archives.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(max(1, min(count, tasks)))


def read(archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of the archives (path, size), with their extents; see :data:`RESULT`."""
    return ranges(archives, split_bytes).mapInArrow(lean(_scan), RESULT)


def broken(records: DataFrame, archives: DataFrame) -> DataFrame:
    """Files whose records don't tile them: (path, covered, size), none when every byte is in exactly one record."""
    path = fresh(archives, "file")
    covered = records.groupBy(F.col("path").alias(path)).agg(F.sum(F.col("stop") - F.col("start")).alias("covered"), F.max("stop").alias("reach"))
    both = archives.join(covered, F.col("path") == F.col(path), "left")
    return both.where("size > 0 and (covered is null or covered <> size or reach <> size)").select("path", "covered", "size")

"""Document fingerprints: quartile bucket digests of hashed byte triplets.

Every position of a text's UTF-8 bytes gives a triplet of the bytes 0, 5 and 11
places on; triplets are counted in ``BUCKETS`` hash buckets. The digest has two bits
per bucket, the quartile of the bucket's count within the text, after a length code.
Two digests differ by the sum of their buckets' differences (opposite quartiles cost
double) and a bounded length difference; ``likeness`` scales that to 0..1.

``neighbours`` pairs every document with the one after it in ascending id without a
global sort in one task: ids are cut into ranges by approximate quantiles, each range
is sorted in its task, and the first document of each range is also sent to the range
before it. Null ids come first; rows with the same id are ordered by text (null
first), and the first document follows the last. A null text counts as empty; an empty
text's digest has only zero codes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.llm import textvec as tv
from pagetrail.llm.common import lean

BUCKETS = 1024
REACH = (0, 5, 11)
_COST = np.array([[0, 1, 2, 6], [1, 0, 1, 2], [2, 1, 0, 1], [6, 2, 1, 0]])


def codes(raw: bytes) -> np.ndarray:
    """Length code and the buckets' quartiles (0 to 3)."""
    out = np.zeros(BUCKETS + 1, np.uint8)
    if not raw:
        return out
    a = np.frombuffer(raw + bytes(REACH[2]), np.uint8).astype(np.uint64)
    n = len(raw)
    triplets = a[:n] | a[REACH[1] : REACH[1] + n] << np.uint64(8) | a[REACH[2] : REACH[2] + n] << np.uint64(16)
    counts = np.bincount((tv.mix(triplets + np.uint64(1 << 32)) >> np.uint64(40)).astype(np.int64) % BUCKETS, minlength=BUCKETS)
    cut = np.partition(counts, [BUCKETS // 4, BUCKETS // 2, 3 * BUCKETS // 4])[[BUCKETS // 4, BUCKETS // 2, 3 * BUCKETS // 4]]
    out[0] = min(255, int(8 * np.log2(n + 1)))
    out[1:] = (counts > cut[0]).astype(np.uint8) + (counts > cut[1]) + (counts > cut[2])
    return out


def to_text(code: np.ndarray) -> str:
    """The digest as hex: length code, then four buckets a byte."""
    four = code[1:].reshape(-1, 4)
    return (bytes([code[0]]) + (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).astype(np.uint8).tobytes()).hex()


def from_text(digest: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(digest), np.uint8)
    return np.r_[raw[:1], np.stack([raw[1:] >> s & 3 for s in (0, 2, 4, 6)], 1).ravel()]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 for equal digests, 0 from the difference of unrelated ones: two a bucket, or all that sparse digests hold."""
    apart = int(_COST[a[1:], b[1:]].sum()) + min(8, abs(int(a[0]) - int(b[0])))
    most = min(2 * BUCKETS, int(np.maximum(_COST[0][a[1:]], _COST[0][b[1:]]).sum())) + 8
    return max(0.0, 1 - apart / most)


_RESULT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by range, id and text; the last row of a range is the next range's first (``guest``)."""
    held = None  # the row whose successor is awaited: id, text, code
    for batch in batches:
        out = []
        for part, guest, doc, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            text = text or ""
            code = codes(text.encode())
            if held is not None and held[0] == part:
                _, doc_before, before, own = held
                n = len(before)
                edited = (before[: n - n // 2] + text[: n // 2]).encode()
                new = codes(edited)
                out.append((doc_before, n, hashlib.sha256(edited).hexdigest(), to_text(own), to_text(new), likeness(own, new), likeness(own, code)))
            held = None if guest else (part, doc, text, code)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds[i]) for i in range(7)], [c.split()[0] for c in _RESULT.split(", ")])


def neighbours(docs: DataFrame) -> DataFrame:
    """Digest of every text and of its edit by the next document's beginning, and their likeness.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one row per row of ``docs``.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = -(1 << 63)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("key", F.coalesce("doc_id", F.lit(least)))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    bounds = sorted(set(docs.select("key").agg(F.percentile_approx("key", shares, 10000)).first()[0] or []))
    # a row's range is the number of bounds below its id
    part = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>"), lambda x: x < F.col("key"))) if bounds else F.lit(0)
    docs = docs.withColumn("part", part)
    heads = docs.groupBy("part").agg(F.min("key").alias("key")).orderBy("part").collect()  # one small row per range
    if not heads:
        return spark.createDataFrame([], _RESULT)
    before = {h["part"]: heads[i - 1]["part"] for i, h in enumerate(heads)}
    first = spark.createDataFrame([(h["key"], before[h["part"]]) for h in heads], "key bigint, part int")
    guests = docs.drop("part").join(F.broadcast(first), "key").groupBy("key", "part").agg(F.first("doc_id").alias("doc_id"), F.min(F.struct(F.col("text").isNotNull().alias("has"), "text")).alias("t"))
    guests = guests.select("part", F.lit(True).alias("guest"), "doc_id", F.col("t.text").alias("text"))
    rows = docs.select("part", F.lit(False).alias("guest"), "doc_id", "text").unionByName(guests)
    rows = rows.repartition(parts, "part").sortWithinPartitions("part", "guest", F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
    return rows.mapInArrow(lean(_compare), _RESULT)

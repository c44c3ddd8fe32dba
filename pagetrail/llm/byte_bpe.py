"""Byte-level BPE encoding and decoding by a global distinct-word shuffle.

Encoding splits every whole text into pre-tokens and keeps their positions. Tasks
work on chunks of documents and shuffle not the pre-tokens but each chunk's distinct
ones, in buckets by hash; so every word meets its copies from all chunks in one
bucket, where it is encoded once. The ids go back to the chunks that asked, are
joined to the positions and reassembled in order.

What is shuffled per chunk and bucket is one compressed row, and per chunk one row
of positions, so the exchange is smaller than the texts. A chunk is bounded by
``CHUNK_BYTES`` of text (one longer document is a chunk of its own).

Decoding joins the token-byte table (as large as the vocabulary, hence broadcast)
to the ids of each document.

A null text counts as empty and has no ids; null and repeated document ids are kept
as they are. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.llm.common import lean, materialize

CHUNK_BYTES = 20 << 20
#: Words a bucket's task remembers at most before it forgets and encodes anew.
REMEMBERED = 1_000_000


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file (one base64 token and its rank a line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


#: Numbers below ``_SHORT`` take one byte, those below ``_MIDDLE`` two, others four.
_SHORT, _LEADS = 200, 55
_MIDDLE = _SHORT + 256 * _LEADS


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned integers, mostly small, as one compressed blob: lead bytes, then the second and further ones."""
    parts = [np.array([len(arrays), *(len(a) for a in arrays)], np.uint32).tobytes()]
    for a in arrays:
        a = a.astype(np.uint32)
        lead = np.where(a < _SHORT, a, _SHORT + (a - _SHORT) // 256)
        parts.append(np.where(a < _MIDDLE, lead, 255).astype(np.uint8).tobytes())
        parts.append(((a[(a >= _SHORT) & (a < _MIDDLE)] - _SHORT) & 255).astype(np.uint8).tobytes())
        rest = a[a >= _MIDDLE] - _MIDDLE
        parts += [(rest >> s & 255).astype(np.uint8).tobytes() for s in (0, 8, 16, 24)]
    return zstandard.ZstdCompressor(level=7).compress(b"".join(parts))


def _unpack(blob: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    count = int(raw[:4].view(np.uint32)[0])
    sizes = raw[4 : 4 * (count + 1)].view(np.uint32)
    at, out = 4 * (count + 1), []
    for n in sizes.tolist():
        lead = raw[at : at + n]
        at += n
        a = lead.astype(np.uint32)
        middle, far = np.flatnonzero((lead >= _SHORT) & (lead < 255)), np.flatnonzero(lead == 255)
        a[middle] = _SHORT + (a[middle] - _SHORT) * 256 + raw[at : at + len(middle)]
        at += len(middle)
        a[far] = _MIDDLE
        for s in (0, 8, 16, 24):
            a[far] += raw[at : at + len(far)].astype(np.uint32) << np.uint32(s)
            at += len(far)
        out.append(a)
    return out


def _chunks(pattern: str, buckets: int):
    """Rows (chunk, bucket, blob, doc_ids): bucket -1 holds positions, the others the chunk's words of that bucket."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        number, part = 0, TaskContext.get().partitionId()

        def closed() -> pa.RecordBatch:
            words = sorted(index)
            first = np.fromiter((index[w] for w in words), np.int64, len(words))
            flat = np.concatenate([np.zeros(0, np.uint32), *positions])
            positions.clear()
            # the most frequent words get the smallest numbers, equally frequent ones in order: both pack best
            order = np.argsort(-np.bincount(flat, minlength=len(words))[first], kind="stable")
            rank = np.empty(len(words), np.uint32)
            rank[first[order]] = np.arange(len(words), dtype=np.uint32)
            encoded = [words[i].encode() for i in order]
            bucket = np.array([zlib.crc32(w) % buckets for w in encoded], np.uint32)
            chunk = part << 24 | number
            rows = [(chunk, -1, _pack(np.array(counts, np.uint32), rank[flat], bucket), ids)]
            by = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[by], np.arange(buckets + 1))
            for b in range(buckets):
                if cut[b] < cut[b + 1]:
                    own = [encoded[i] for i in by[cut[b] : cut[b + 1]]]
                    sizes = np.array([len(w) for w in own], np.uint32)
                    rows.append((chunk, b, zstandard.ZstdCompressor(level=7).compress(np.uint32(len(own)).tobytes() + sizes.tobytes() + b"".join(own)), None))
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(4)], ["chunk", "bucket", "blob", "doc_ids"])

        index: dict[str, int] = {}
        positions, counts, ids, size = [], [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                doc, text = doc.as_py(), text.as_py() or ""
                if ids and size + len(text) > CHUNK_BYTES:
                    yield closed()
                    number += 1
                    index, positions, counts, ids, size = {}, [], [], [], 0
                found = [index.setdefault(w, len(index)) for w in find(text)]
                positions.append(np.array(found, np.uint32))
                counts.append(len(found))
                ids.append(doc)
                size += len(text)
        if ids:
            yield closed()

    return chunks


def _encoded(pattern: str, shared):
    """Each bucket's words as token ids, one row per chunk that asked."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        one = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})._encode_single_piece
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            blobs = []
            for blob in batch.column(2).to_pylist():
                raw = zstandard.ZstdDecompressor().decompress(blob)
                n = int(np.frombuffer(raw, np.uint32, 1)[0])
                stops = 4 * (n + 1) + np.cumsum(np.frombuffer(raw, np.uint32, n, 4)).astype(np.int64)
                sizes, flat, at = [], [], 4 * (n + 1)
                for stop in stops.tolist():
                    word = raw[at:stop]
                    at = stop
                    ids = known.get(word)
                    if ids is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        ids = known[word] = one(word)
                    sizes.append(len(ids))
                    flat += ids
                blobs.append(_pack(np.array(sizes, np.uint32), np.array(flat, np.uint32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blobs, pa.binary())], ["chunk", "bucket", "ids"])

    return encoded


#: Ids of one output batch, about.
_BATCH_IDS = 1 << 20


def _reassembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, ids) of each chunk: the words' ids placed by position."""
    for batch in batches:
        for row in range(batch.num_rows):
            ids = batch.column(0)[row].as_py()
            counts, flat, bucket = _unpack(batch.column(1)[row].as_py())
            sizes, starts, tokens, base = np.zeros(len(bucket), np.int64), np.zeros(len(bucket), np.int64), [], 0
            for entry in batch.column(2)[row].as_py():
                n, own = _unpack(entry["ids"])
                at = np.flatnonzero(bucket == entry["bucket"])
                sizes[at] = n
                starts[at] = base + np.cumsum(n) - n
                tokens.append(own)
                base += len(own)
            tokens = np.concatenate([np.zeros(0, np.uint32), *tokens]).view(np.int32)
            ends = np.cumsum(counts).astype(np.int64)
            begins = ends - counts
            a = 0
            while a < len(ids):
                b = max(a + 1, int(np.searchsorted(ends, begins[a] + _BATCH_IDS // 4, "right")))
                words = flat[begins[a] : ends[b - 1]]
                stop = np.cumsum(sizes[words])
                n = sizes[words]
                place = np.repeat(starts[words] - (stop - n), n) + np.arange(n.sum())
                bounds = np.r_[0, stop][np.r_[begins[a], ends[a:b]] - begins[a]]
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(tokens[place]))
                yield pa.RecordBatch.from_arrays([pa.array(ids[a:b], pa.int64()), lists], ["doc_id", "ids"])
                a = b


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text): token ids by the ranks in the file ``path``.

    ``pattern`` splits the text; its matches are encoded separately, without special tokens.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranks = spark.sparkContext.broadcast(read_ranks(spark, path))
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    chunks = materialize(docs.mapInArrow(lean(_chunks(pattern, buckets)), "chunk bigint, bucket int, blob binary, doc_ids array<bigint>"), "chunks")
    words = chunks.where("bucket >= 0").select("chunk", "bucket", "blob").repartition(buckets, "bucket")
    ids = words.mapInArrow(lean(_encoded(pattern, ranks)), "chunk bigint, bucket int, ids binary")
    ids = ids.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "ids")).alias("words"))
    whole = chunks.where("bucket = -1").join(ids, "chunk", "left").select("doc_ids", "blob", F.coalesce("words", F.array()).alias("words"))
    return whole.mapInArrow(lean(_reassembled), "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, bytes): ``encoded`` with the bytes its ids stand for. Null ids give null bytes; an unknown id raises."""
    spark = encoded.sparkSession
    ranks = read_ranks(spark, path)
    sizes = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    data = np.frombuffer(b"".join(sorted(ranks, key=ranks.__getitem__)), np.uint8)
    table = spark.sparkContext.broadcast((sizes, np.cumsum(sizes) - sizes, data))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, starts, data = table.value
        for batch in batches:
            lists = batch.column(1)
            at = lists.offsets.to_numpy().astype(np.int64)
            tokens = lists.values.to_numpy()[at[0] : at[-1]]
            at -= at[0]
            bounds, pieces, done = np.zeros(len(at), np.int32), [], 0
            for u in range(0, len(tokens), _BATCH_IDS // 4):
                some = tokens[u : u + _BATCH_IDS // 4]
                n = sizes[some]
                if (n == 0).any():
                    raise ValueError(f"no token has the id {int(some[n == 0][0])}")
                stop = np.cumsum(n)
                pieces.append(data[np.repeat(starts[some] - (stop - n), n) + np.arange(stop[-1])].tobytes())
                i, j = np.searchsorted(at, u, "right"), np.searchsorted(at, u + len(some), "right")
                bounds[i:j] = done + stop[at[i:j] - u - 1]  # documents that end within this stretch of ids
                done += int(stop[-1])
            raw = b"".join(pieces)
            out = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(bounds), pa.py_buffer(raw)])
            if lists.null_count:
                out = pa.array([None if null else x for null, x in zip(lists.is_null().to_pylist(), out.to_pylist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, out], ["doc_id", "ids", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(lean(decoded), "doc_id bigint, ids array<int>, bytes binary")


def digests() -> list[Column]:
    """Columns on ``decode``'s rows: number of ids, digests of the ids (decimal, joined by commas) and of the decoded bytes."""
    return [
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    ]

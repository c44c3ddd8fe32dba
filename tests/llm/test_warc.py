"""Archives written and read back, with ranges that cut records anywhere."""

import gzip
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from pagetrail.llm import warc

PAGE = "<html>" + "page text " * 150


def rows_of(n=60):
    rng = random.Random(6)
    rows = [(i, f"http://x/{i}", bytes(rng.randrange(256) for _ in range(rng.randint(0, 3000)))) for i in range(n)]
    rows += [(100 + i, "http://copy", PAGE.encode()) for i in range(40)]  # the hot payload
    rows += [(200, None, b"short"), (201, "u", b"short"), (202, "a\r\nWARC-Type: evil", b"x" * 999), (203, "", b"x" * 999), (204, "v", b"y" * 1000), (205, "v", b"y" * 1000)]
    rows += [(300, "n", None), (None, "null id", PAGE.encode()), (None, None, None), (301, "twice", b"z" * 2000), (301, "twice", b"z" * 2000), (-5, "neg", b"z" * 2000)]
    return rows


def expected(rows):
    last = {}
    for i, _, payload in rows:
        if i is not None and payload is not None and len(payload) >= 1000:
            last[payload] = max(i, last.get(payload, i))
    out = []
    for i, _, payload in rows:
        to = last.get(payload) if i is not None and payload is not None and i < last.get(payload, i) else None
        payload = payload or b""
        out.append((str(i), len(payload), hashlib.sha1(payload).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "record_id bigint, target_uri string, payload binary").withColumn("digest", F.lit("extra")).repartition(3)


@pytest.mark.parametrize("split,file_bytes", [(1999, 5000), (1 << 20, 1 << 30), (4096, 20_000)])
def test_round_trip(spark, tmp_path, split, file_bytes):
    rows = rows_of()
    archives = warc.write(frame(spark, rows), str(tmp_path / "w"), file_bytes=file_bytes)
    records = warc.read(archives, split).cache()
    number = lambda x: x.rsplit(":", 1)[1] if x and x.startswith("urn:x-record:") else None
    got = sorted(((number(r.record_id) or "None"), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to) and int(number(r.refers_to)))
                 for r in records.collect())
    assert sorted(got, key=str) == expected(rows)
    assert {bytes(r.payload) for r in records.where("record_type = 'response'").collect()} == {p or b"" for _, _, p in rows}
    assert {r.target_uri for r in records.collect()} >= {None, "", "a%0D%0AWARC-Type: evil"}
    assert warc.broken(records, archives).count() == 0
    listed = warc.files(spark, str(tmp_path / "w"))
    assert sorted(r["size"] for r in listed.collect()) == sorted(r["size"] for r in archives.collect())
    raw = b"".join(gzip.open(r.path.removeprefix("file:"), "rb").read() for r in archives.collect())  # any gzip reader takes the members
    assert raw.count(b"WARC/1.1\r\n") == len(rows)
    records.unpersist()


def test_false_candidates_are_no_records(spark, tmp_path):
    """Gzip magic and whole gzip files within stored payloads, other members between the records."""
    inner = gzip.compress(b"not an archive")
    noise = b"\x1f\x8b\x08" * 400 + inner * 3 + random.Random(1).randbytes(5000)
    rows = [(i, "u", noise + bytes([i])) for i in range(8)]
    archives = warc.write(frame(spark, rows), str(tmp_path / "w"))
    assert sorted(r.payload_bytes for r in warc.read(archives, 700).collect()) == [len(noise) + 1] * 8


def test_damaged_archives_fail(spark, tmp_path):
    archives = warc.write(frame(spark, rows_of(5)).coalesce(1), str(tmp_path / "w"))
    path = archives.first().path.removeprefix("file:")
    size = os.path.getsize(path)
    os.truncate(path, size - 10)
    with pytest.raises(Exception, match="no whole record"):
        warc.read(warc.files(spark, str(tmp_path / "w"))).collect()


def test_empty_table(spark, tmp_path):
    archives = warc.write(frame(spark, rows_of(0)[:0]), str(tmp_path / "w"))
    assert warc.read(archives).count() == 0

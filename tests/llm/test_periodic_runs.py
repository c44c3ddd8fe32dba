"""Lyndon arrays, runs and collapsed texts against brute force."""

import hashlib
import random
import re
import zlib

import pytest

from pagetrail.llm import periodic_runs, queries


def brute_lyndon(word):
    out = []
    for i in range(len(word)):
        j = i + 1
        while j < len(word) and word[j:] > word[i:]:
            j += 1
        out.append(j - i)
    return out


def brute_runs(word):
    n, found = len(word), []
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and word[j] == word[j + p]:
                j += 1
            length = j - i + p
            if j > i and length >= max(6, 4 * p):
                own = word[i : i + length]
                if not any(own[q:] == own[:-q] for q in range(1, p)):
                    found.append((i, length, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def words(rng, n, letters):
    out = []
    while len(out) < n:
        out += [rng.randrange(letters) for _ in range(rng.randint(1, 6))] * rng.randint(1, 7)
    return out[:n]


def test_lyndon_arrays_and_runs():
    rng = random.Random(4)
    for _ in range(1500):
        word = words(rng, rng.randint(1, 60), rng.randint(1, 4))
        assert periodic_runs.lyndon_lengths(word) == brute_lyndon(word)
        assert periodic_runs.runs_of(word) == brute_runs(word)


def expected(text):
    own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = brute_runs(own)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return len(own), runs, " ".join(w for i, w in enumerate(own) if i not in gone)


TEXTS = [None, "", " \t\r\n", "a a a a a a", "a a a a a", "x é é é é é é é\x0b y\x0cy y y y y y z", "ab ab ba ab ba ab ba ab ba ab ba z", "A a " * 9,
         "one line\n" * 30 + "the end", "             ", ("p q r s t u v " * 40 + "w ") * 5]


def test_documents_match_brute_force(spark):
    rng = random.Random(8)
    texts = TEXTS + [" ".join("wort%d" % x for x in words(rng, rng.randint(0, 300), rng.choice([2, 5, 300]))) for _ in range(120)]
    texts.append(" ".join(["tic tac"] * 30_000 + [str(i) for i in range(30_000)]))  # very long
    rows = [(None if i == 1 else i % 100, t, i) for i, t in enumerate(texts)]  # repeated and null ids
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs int").repartition(3)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.collapse(docs).collect())
    want = sorted((d is None, d or 0, *expected(t)) for d, t, _ in rows[:-1])
    long = [r for r in got if r[2] == 90_000]
    assert [r for r in got if r[2] != 90_000] == want
    assert long[0][3] == [(0, 60_000, 2)] and long[0][4] == " ".join(["tic tac"] + [str(i) for i in range(30_000)])


def test_empty_table(spark):
    assert periodic_runs.collapse(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


@pytest.fixture()
def few(spark, tmp_path):
    rng = random.Random(2)
    texts = TEXTS + [" ".join(str(rng.randrange(9)) for _ in range(rng.randint(0, 90))) for _ in range(150)]
    rows = [(7 * i if i else None, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    return tmp_path, rows


def test_query_matches_the_rule(spark, few):
    path, rows = few
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, str(path)).collect()}
    changed = 0
    for doc, text in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        if doc is not None:
            h = zlib.crc32(str(doc).encode())
            if h % 10 == 0 and own:
                g, n = h // 10, len(own)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                own = [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]
                changed += 1
        _, runs, collapsed = expected(" ".join(own))
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        r = got[doc]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (None if best[0] is None else 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed.encode()).hexdigest()
    assert changed > 5

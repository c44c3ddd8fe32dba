"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Texts are word sequences. The CGK random walk reads a window from a start word: at
step t it emits the word under the pointer, and a random bit of (t, word) says
whether the pointer moves on. Edits desynchronise two walks only until they meet
again, so a small edit distance becomes a small Hamming distance of the emitted
sequences. A hash table samples ``SYMBOLS`` of the ``STEPS`` emitted words (its
bit sample); ``REPEATS`` tables with their own walks and samples are used, and a
candidate needs ``HITS`` agreeing samples.

Every word of every document starts a window and so does every word of an item;
a match at item word o puts the item-sized document window o words before it. The
samples are compared word by word, so most windows leave a walk after its first
words. Every candidate window is verified by the exact word edit distance of the
whole item against its best part of the window: at most ``1 - similarity`` of the
item's words.

An item whose walk ends before the last sample (a short one) is compared on the
samples it has, from each of its first words that the allowed edits can leave as the
first unedited one, and one hit makes it a candidate.

Items are broadcast in blocks of ``ITEM_BYTES`` at most; a larger benchmark means
more passes over the documents, not a larger broadcast. Words are runs of letters,
digits and non-ASCII characters, A-Z lower-cased. Null or empty texts and items
match nothing; rows with a null id can be matched and keep the null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.llm import textvec as tv
from pagetrail.llm.common import Shared, lean

REPEATS = 6
STEPS = 20
SYMBOLS = 4
HITS = 2
ITEM_BYTES = 16 << 20
_BITS = 22


def _samples() -> list[tuple[list[int], list[int]]]:
    """Per table: the sampled steps (one at random in each stretch after the first), and the hash bit that moves the walk at each step."""
    rng = np.random.default_rng(5)
    edges = np.linspace(2, STEPS, SYMBOLS).astype(int)
    return [
        ([0, *(int(rng.integers(u, v)) for u, v in zip(edges, edges[1:], strict=False))], rng.permutation(64)[:STEPS].tolist())
        for _ in range(REPEATS)
    ]


def _padded(words: tv.Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with a 0, on which walks stay, after each document; where each document begins."""
    counts = np.diff(words.first)
    begin = np.r_[0, np.cumsum(counts + 1)]
    out = np.zeros(begin[-1], np.uint64)
    hashes = words.hashes()
    hashes[hashes == 0] = 1
    out[np.arange(len(hashes)) + np.repeat(np.arange(n), counts)] = hashes
    return out, begin


def _absorb(key: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return tv.mix(key * np.uint64(0x9E3779B97F4A7C15) + symbol)


class Index:
    """The items' sampled keys: per table and level a bitmap of keys that go on, and the finished keys."""

    def __init__(self, item_ids: list, texts: list[str], similarity: float):
        column = pa.array(texts, pa.string())
        data, offsets = tv.text_bytes(column)
        words = tv.Words(data, offsets, 0, len(texts), tv.NON_WORD)
        flat, begin = _padded(words, len(texts))
        self.item_ids = np.array(item_ids)
        self.words = [flat[begin[i] : begin[i + 1] - 1] for i in range(len(texts))]
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.allowed = np.floor((1 - similarity) * self.size + 1e-9).astype(np.int64)
        self.samples = _samples()
        at = np.flatnonzero(flat)
        item = np.searchsorted(begin, at, "right") - 1
        offset = at - begin[item]
        self.tables = []
        for steps, bits in self.samples:
            keys, done = [], []
            cur, key, live = at.copy(), np.zeros(len(at), np.uint64), np.arange(len(at))
            level = 0
            for t in range(STEPS):
                if t in steps:
                    symbol = flat[cur]
                    ended = symbol == 0
                    # a walk that ends early counts from the words that the allowed edits may leave first
                    early = ended & (offset[live] <= self.allowed[item[live]])
                    done.append((key[early], live[early]))
                    live, cur, key, symbol = live[~ended], cur[~ended], key[~ended], symbol[~ended]
                    key = _absorb(key, symbol)
                    bitmap = np.zeros(1 << _BITS, bool)
                    bitmap[(key >> np.uint64(64 - _BITS)).astype(np.int64)] = True
                    keys.append(bitmap)
                    level += 1
                cur = cur + ((flat[cur] >> np.uint64(bits[t])) & np.uint64(1)).astype(np.int64)
            done.append((key, live))
            finished = []
            for k, who in done:
                order = np.argsort(k, kind="stable")
                finished.append((k[order], item[who][order], offset[who][order]))
            self.tables.append((keys, finished))

    def hits(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, item, item offset) of every sampled match of a window of ``flat``; weights of finished short items are doubled."""
        starts = np.flatnonzero(flat)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        first = _absorb(np.zeros(len(starts), np.uint64), flat[starts])
        for (steps, bits), (keys, finished) in zip(self.samples, self.tables, strict=True):
            on = keys[0][(first >> np.uint64(64 - _BITS)).astype(np.int64)]
            live, key = starts[on], first[on]
            cur, level = live.copy(), 1
            for t in range(STEPS):
                if t and t in steps:
                    self._finish(found, finished[level], key, live, 2)
                    key = _absorb(key, flat[cur])
                    on = keys[level][(key >> np.uint64(64 - _BITS)).astype(np.int64)]
                    live, cur, key = live[on], cur[on], key[on]
                    level += 1
                if level == SYMBOLS:
                    break
                cur += ((flat[cur] >> np.uint64(bits[t])) & np.uint64(1)).astype(np.int64)
            self._finish(found, finished[SYMBOLS], key, live, 1)
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _finish(self, found: list, entries: tuple, key: np.ndarray, at: np.ndarray, times: int) -> None:
        keys, item, offset = entries
        lo, hi = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
        n = hi - lo
        if n.sum():
            pick = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            found.extend([(np.repeat(at, n), item[pick], offset[pick])] * times)

    def verify(self, item: int, text: np.ndarray) -> tuple[int, int]:
        """(least edits, end) of the whole item against any part of ``text``, bit-parallel."""
        pattern = self.words[item]
        where: dict[int, int] = {}
        for i, w in enumerate(pattern.tolist()):
            where[w] = where.get(w, 0) | 1 << i
        m = len(pattern)
        full, last = (1 << m) - 1, 1 << (m - 1)
        up, down, d = full, 0, m
        best = (m, 0)
        for j, w in enumerate(text.tolist()):
            eq = where.get(w, 0)
            cross = (((eq & up) + up) ^ up) | eq
            plus, minus = down | (full & ~(cross | up)), up & cross
            d += bool(plus & last) - bool(minus & last)
            if d < best[0]:
                best = (d, j + 1)
            plus, minus = plus << 1 & full, minus << 1 & full
            eq |= down
            up, down = minus | (full & ~(eq | plus)), plus & eq
        return best


_LEAK = ["doc_id", "item_id", "end_word", "edits", "item_words"]


def _leaks(docs: DataFrame, items: list, similarity: float) -> DataFrame:
    index = Index([r["item_id"] for r in items], [r["text"] for r in items], similarity)
    shared = Shared(docs.sparkSession, index)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets = tv.text_bytes(batch.column(1))
            rows = []
            for a, b in tv.blocks(offsets):
                flat, begin = _padded(tv.Words(data, offsets, a, b, tv.NON_WORD), b - a)
                at, item, offset = index.hits(flat)
                if not len(at):
                    continue
                doc = np.searchsorted(begin, at, "right") - 1
                window = at - offset - begin[doc]  # where the item would begin in its document
                order = np.lexsort((window, item, doc))
                doc, item, window = doc[order], item[order], window[order]
                slack = index.allowed[item]
                # hits of one document and item whose windows are within the allowed shift make one candidate
                new = np.r_[True, (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(window) > slack[1:])]
                start = np.flatnonzero(new)
                stop = np.r_[start[1:], len(doc)]
                for s, e in zip(start.tolist(), stop.tolist(), strict=True):
                    if e - s < HITS:
                        continue
                    d, i, extra = int(doc[s]), int(item[s]), int(slack[s])
                    lo = max(0, int(window[s]) - extra)
                    hi = min(int(begin[d + 1] - begin[d] - 1), int(window[e - 1]) + int(index.size[i]) + extra)
                    edits, end = index.verify(i, flat[begin[d] + lo : begin[d] + hi])
                    if edits <= extra:
                        rows.append((ids[a + d], index.item_ids[i], lo + end, edits, int(index.size[i])))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(5)], _LEAK)

    return docs.mapInArrow(lean(scan), ", ".join(f"{c} bigint" for c in _LEAK))


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """(doc_id, item_id, end_word, edits, item_words): parts of documents within the allowed edits of an item.

    ``end_word`` is the document word after the part, ``edits`` its word edit distance to
    the item. One row per separate place; repeated rows of ``docs`` repeat theirs.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    benchmark = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text is not null and item_id is not null")
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // ITEM_BYTES)
    if not parts:
        return docs.sparkSession.createDataFrame([], ", ".join(f"{c} bigint" for c in _LEAK))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(2 * parts if parts > 1 else 1))
    found = []
    for i in range(2 * parts if parts > 1 else 1):
        items = benchmark.where(block == i).distinct().orderBy("item_id", "text").collect()  # a block of bounded size
        found.append(_leaks(docs, items, similarity))
    return reduce(DataFrame.unionByName, found)

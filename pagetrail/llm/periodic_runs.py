"""Periodic runs of words, by Lyndon roots from Baier's grouping.

A run is a stretch of words with smallest period ``q``, of ``max(6, 4 q)`` words or
more, that no neighbouring word extends. Per document:

1. **Stretches.** Of a run with at least ``max(6, 4 q)`` words every five consecutive
   words recur ``q`` words away, within the run. Words that no such recurrence covers are
   in no run; what remains are stretches, narrowed again while a recurrence is further
   away than a quarter of its stretch. This loses no run (most prose has no stretch).
2. **Grouping.** The first phase of Baier's suffix sorter, run to its end on a stretch,
   leaves every suffix in the group of its longest Lyndon prefix, so the group's length is
   the Lyndon array. It is run under the order of the words and under its reverse.
3. **Runs.** A run holds, under one of the two orders, its Lyndon root at least three
   times in a row, each the longest Lyndon word at its place. Such a root is extended to
   both sides by longest common extensions, which gives the run's exact ends.

``collapse`` drops every word that some run holds after its first ``q`` words. A null text
and a text without words have no runs and an empty collapsed text; repeated rows and ids
each give their own row; columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.llm import textvec as tv
from pagetrail.llm.common import lean

#: A run has this many words and this many periods at least; five-word recurrences rest on both.
LEAST, PERIODS, WINDOW = 6, 4, 5


def lyndon_lengths(word: list[int]) -> list[int]:
    """Length of the longest Lyndon word at every position (Baier's grouping; smaller numbers come first)."""
    n = len(word)
    order = sorted(range(n), key=word.__getitem__)  # suffixes, by group
    group, size, length, place = [0] * n, [0] * n, [1] * n, [0] * n
    start = 0
    for k, i in enumerate(order):
        if word[i] != word[order[start]]:
            start = k
        group[i], place[i] = start, k
        size[start] += 1
    before, out = [-1] * n, [0] * n
    end = n
    while end:  # from the highest group down
        g = group[order[end - 1]]
        own = length[g]
        if end - g == 1:
            i = order[g]
            p = i - 1
            while p >= 0 and group[p] >= g:
                p = before[p]
            before[i], out[i] = p, own
            end = g
            if p < 0:
                continue
            times = ((1, (p,)),)
        else:
            members = sorted(order[g:end])
            counts: dict[int, int] = {}
            for i in members:
                p = i - 1
                while p >= 0 and group[p] >= g:  # suffixes of higher groups, or of this one further left
                    p = before[p]
                before[i], out[i] = p, own
                if p >= 0:
                    counts[p] = counts.get(p, 0) + 1
            end = g
            if not counts:
                continue
            by_count: dict[int, list[int]] = {}
            for p, c in counts.items():
                by_count.setdefault(c, []).append(p)
            times = sorted(by_count.items(), reverse=True)
        for c, holders in times:  # more copies of this group's word behind them: a higher group
            moved: dict[int, int] = {}
            for p in holders:
                h = group[p]
                size[h] -= 1
                last, at = h + size[h], place[p]
                other = order[last]
                order[at], place[other] = other, at
                order[last], place[p] = p, last
                moved[h] = moved.get(h, 0) + 1
            for h, k in moved.items():
                new, grown = h + size[h], length[h] + c * own
                for at in range(new, new + k):
                    group[order[at]] = new
                size[new], length[new] = k, grown
    return out


def _common(a: np.ndarray, i: int, j: int) -> int:
    """Length of the longest common extension of the positions ``i < j``."""
    k, step, n = 0, 32, len(a)
    while j + k < n:
        m = min(step, n - j - k)
        same = a[i + k : i + k + m] == a[j + k : j + k + m]
        if not same.all():
            return k + int(same.argmin())
        k, step = k + m, 4 * step
    return k


def runs_of(word: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    a = np.array(word, np.int64)
    back, n, found = a[::-1], len(a), set()
    for order in (word, [-x for x in word]):
        period = np.array(lyndon_lengths(order), np.int64)
        i = np.flatnonzero(np.arange(n) + 2 * period < n)
        p = period[i]
        i = i[(period[i + p] == p) & (period[i + 2 * p] == p)]
        reached: dict[int, int] = {}
        for at, p in zip(i.tolist(), period[i].tolist(), strict=True):
            if at + p <= reached.get(p, 0):
                continue  # within the run that the root before belongs to
            end = at + p + _common(a, at, at + p)
            begin = at - _common(back, n - at - p, n - at)
            reached[p] = max(end, reached.get(p, 0))
            if end - begin >= max(LEAST, PERIODS * p):
                found.add((begin, end - begin, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (in words) of what recurrences of five words cover, document by document."""
    n = len(hashes)
    if n < LEAST:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    counts = np.diff(first)
    document = np.repeat(np.arange(len(counts)), counts)
    whole = np.flatnonzero(document[: n - WINDOW + 1] == document[WINDOW - 1 :])
    key = tv.mix(tv.grams(hashes, WINDOW)[whole] + document[whole].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    by_key = np.argsort(key, kind="stable")
    same = key[by_key[1:]] == key[by_key[:-1]]
    apart = whole[by_key[1:]] - whole[by_key[:-1]]
    far = np.iinfo(np.int64).max // 8
    near = np.full(len(whole), far)
    np.minimum.at(near, by_key[1:][same], apart[same])
    np.minimum.at(near, by_key[:-1][same], apart[same])
    useful = near * PERIODS <= counts[document[whole]]
    whole, near = whole[useful], near[useful]
    while True:
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, whole, 1)
        np.add.at(edge, whole + WINDOW, -1)
        covered = np.cumsum(edge[:n]) > 0
        begins = covered.copy()
        begins[1:] &= ~covered[:-1] | (document[1:] != document[:-1])
        starts = np.flatnonzero(begins)
        own = np.cumsum(begins) - 1
        lengths = np.bincount(own[covered], minlength=len(starts))
        useful = near * PERIODS <= lengths[own[whole]]
        if useful.all():
            enough = lengths >= LEAST
            return starts[enough], (starts + lengths)[enough]
        whole, near = whole[useful], near[useful]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = tv.text_bytes(batch.column(1))
        for a, b in tv.blocks(offsets):
            words = tv.Words(data, offsets, a, b, fold=False)
            kept = np.ones(len(words.starts), bool)
            runs: list[list[dict[str, int]]] = [[] for _ in range(b - a)]
            starts, ends = stretches(words.hashes(), words.first)
            raw = words.data.tobytes() if len(starts) else b""
            owner = np.searchsorted(words.first, starts, "right") - 1
            for doc, s, e in zip(owner.tolist(), starts.tolist(), ends.tolist(), strict=True):
                known: dict[bytes, int] = {}
                ids = [known.setdefault(raw[x:y], len(known)) for x, y in zip(words.starts[s:e].tolist(), words.stops[s:e].tolist(), strict=True)]
                for start, length, period in runs_of(ids):
                    kept[s + start + period : s + start + length] = False
                    runs[doc].append({"start": s + start - int(words.first[doc]), "length": length, "period": period})
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(a, b - a), pa.array(np.diff(words.first), pa.int64()), pa.array(runs, pa.list_(_RUN)), _joined(words, kept)],
                ["doc_id", "n_words", "runs", "collapsed"])


def _joined(words: tv.Words, kept: np.ndarray) -> pa.Array:
    """Each document's kept words, joined by one space."""
    sizes = np.where(kept, words.stops - words.starts, 0)
    document = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    last = np.full(len(words.first) - 1, -1)
    last[document[kept]] = np.flatnonzero(kept)  # the last kept word of a document has no space behind it
    spaced = kept.copy()
    spaced[last[last >= 0]] = False
    n = len(words.data)
    edge = np.zeros(n + 2, np.int64)
    edge[words.starts[kept]] += 1
    np.add.at(edge, (words.stops + spaced)[kept], -1)
    data = words.data.copy()
    data[words.stops[spaced]] = 32
    data = data[np.cumsum(edge[:n]) > 0]
    ends = np.r_[0, np.cumsum(sizes + spaced)][words.first]
    return pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


RESULT = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def collapse(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs by start and period, collapsed text), one row per row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(lean(_collapse), RESULT)


def strongest(runs: str = "runs"):
    """The run with the greatest exact length / period; of equal ones the first by start, then period (null: no run)."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda best, x: F.when(best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best))

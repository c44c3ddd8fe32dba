"""Toxicity scores by a factorization machine over hashed terms.

Terms are a text's words and the words' first 4, 5 and 6 bytes (stems), A-Z
lower-cased and hashed to ``2**HASH_BITS`` slots. A model of

    w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j,   x_i = log(1 + count of term i)

learns weights per term and, through the factors v, weights of term pairs, such as
a harmless word that is harmful beside another one.

Fitting: labels are taken from at most ``SAMPLE`` labelled ids (the smallest hashes
of the ids, so the choice does not depend on the data's order), one text each. Kept are
the terms that tell the classes apart alone (chi-squared beyond chance) and the words
that do so only together: words of a pair whose texts are toxic more often than those of
either word, beyond chance for as many pairs as are compared. Words that are neutral
alone therefore reach the model. The driver holds only these rows' kept terms, at most
``SAMPLE`` sparse rows. Scoring covers all rows and whole texts, with the fitted weights
as a broadcast of fixed size.

Null or empty texts score as a text without terms. Labels that are null or without a
text are left out; of several labels of an id the toxic one holds, of several texts the
first in order. With one class or none to learn from, every text gets the base rate.
Repeated rows of ``docs`` repeat theirs; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.llm import textvec as tv
from pagetrail.llm.common import Shared, fresh, lean, materialize

#: Labelled ids to learn from, at most.
SAMPLE = 16_000
#: Chi-squared below which a term's difference between the classes counts as chance (one in a hundred).
CHANCE = 6.63
#: Pairs of words, of all that are compared, that may count as joint by chance.
JOINT_CHANCE = 0.01
#: Words whose pairs are counted at once.
PAIR_BLOCK = 512
HASH_BITS = 20
STEMS = (4, 5, 6)
FACTORS = 8
EPOCHS = 12
THRESHOLD = 0.3


class Model(NamedTuple):
    slots: np.ndarray  # hash slot of each kept term, ascending
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """Probabilities of n documents given as (document, kept term, value)."""
        return 1 / (1 + np.exp(-_raw(self.bias, self.weights, self.factors, doc, term, value, n)[0]))


def _raw(bias, weights, factors, doc, term, value, n):
    z = bias + np.bincount(doc, weights[term] * value, n)
    sums = np.empty((n, factors.shape[1]))
    for f in range(factors.shape[1]):
        x = factors[term, f] * value
        sums[:, f] = np.bincount(doc, x, n)
        z += 0.5 * (sums[:, f] ** 2 - np.bincount(doc, x * x, n))
    return np.clip(z, -35, 35), sums


def terms(data: np.ndarray, offsets: np.ndarray, a: int, b: int, slots: np.ndarray | None = None, stems: tuple[int, ...] = STEMS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, slot or kept term, count) of documents a to b; ``slots`` maps a slot to its kept term or -1."""
    words = tv.Words(data, offsets, a, b, tv.NON_WORD)
    doc = np.repeat(np.arange(b - a), np.diff(words.first))
    size = words.stops - words.starts
    docs, found = [], []
    for stem in (0, *stems):
        pick = slice(None) if not stem else np.flatnonzero(size > stem)
        starts = words.starts[pick]
        h = words.hash(starts, starts + stem if stem else words.stops)
        slot = (tv.mix(h + np.uint64(stem)) >> np.uint64(64 - HASH_BITS)).astype(np.int64)
        d = doc[pick]
        if slots is not None:
            slot = slots[slot]
            d, slot = d[slot >= 0], slot[slot >= 0]
        docs.append(d)
        found.append(slot)
    key, count = np.unique(np.concatenate(docs) << HASH_BITS | np.concatenate(found), return_counts=True)
    return key >> HASH_BITS, key & ((1 << HASH_BITS) - 1), count


def _lookup(slots: np.ndarray) -> np.ndarray:
    out = np.full(1 << HASH_BITS, -1, np.int64)
    out[slots] = np.arange(len(slots))
    return out


def fit(docs: DataFrame, labels: DataFrame, allowed: Column) -> Model:
    """Fit on the labelled rows of ``docs`` whose doc_id satisfies ``allowed``."""
    labels = labels.where("toxic is not null and doc_id is not null").where(allowed).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    # at most SAMPLE short rows are broadcast; an id that is repeated gives one text
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(sample), "doc_id")
    rows = materialize(rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")).select("toxic", "text"), "labelled")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 2 << HASH_BITS), np.int64)  # of all terms, then of whole words
        rows = np.zeros(2, np.int64)
        for batch in batches:
            label = batch.column(0).to_numpy().astype(np.int64) > 0
            rows += np.bincount(label, minlength=2)
            data, offsets = tv.text_bytes(batch.column(1))
            for a, b in tv.blocks(offsets):
                for at, stems in ((0, STEMS), (1 << HASH_BITS, ())):
                    doc, slot, _ = terms(data, offsets, a, b, stems=stems)
                    hit = label[a:b][doc]
                    for y in (0, 1):
                        total[y] += np.bincount(slot[hit == y] + at, minlength=2 << HASH_BITS)
        slot = np.flatnonzero(total.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, slot]), pa.array(np.r_[rows[1], total[1][slot]]), pa.array(np.r_[rows[0], total[0][slot]])], ["slot", "pos", "neg"])

    counted = rows.mapInArrow(lean(counts), "slot bigint, pos bigint, neg bigint").groupBy("slot").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    counted = materialize(counted.where("slot < 0 or pos + neg > 2"), "terms")
    base = counted.where("slot < 0").first()
    pos, neg = (base["pos"], base["neg"]) if base else (0, 0)
    if not pos or not neg:
        rate = np.log((pos + 0.5) / (neg + 0.5)) if pos + neg else -10.0
        return Model(np.zeros(0, np.int64), float(rate), np.zeros(0), np.zeros((0, FACTORS)))
    mean = (F.col("pos") + F.col("neg")) / (pos + neg)
    strength = F.pow(F.col("pos") / pos - F.col("neg") / neg, F.lit(2)) / (mean * (1 - mean) + 1e-9)
    chi_squared = strength * (pos * neg / (pos + neg))
    whole = 1 << HASH_BITS
    alone = [r["slot"] for r in counted.where(F.col("slot").between(0, whole - 1)).where(chi_squared >= CHANCE).select("slot").collect()]  # 2**HASH_BITS at most
    words = counted.where((F.col("slot") >= whole) & (F.col("pos") >= _least(pos / (pos + neg)))).select((F.col("slot") - whole).alias("slot")).collect()
    words = np.sort(np.array([r["slot"] for r in words], np.int64))
    label, term, _ = _sparse(rows, words, ())
    slots = np.union1d(np.array(alone, np.int64), words[joint(label, term, len(words))])
    return _train(slots, *_sparse(rows, slots, STEMS))


def _sparse(rows: DataFrame, slots: np.ndarray, stems: tuple[int, ...]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Labels, kept terms and counts of the labelled rows, SAMPLE at most, in an order of their own."""
    kept = rows.sparkSession.sparkContext.broadcast(_lookup(slots))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(0).to_pylist()
            data, offsets = tv.text_bytes(batch.column(1))
            out = []
            for a, b in tv.blocks(offsets):
                doc, term, count = terms(data, offsets, a, b, kept.value, stems)
                cut = np.searchsorted(doc, np.arange(b - a + 1))
                out += [(label[a + i], term[u:v].astype(np.int32).tobytes(), count[u:v].astype(np.int32).tobytes()) for i, (u, v) in enumerate(zip(cut, cut[1:], strict=False))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), *(pa.array([r[i] for r in out], pa.binary()) for i in (1, 2))], ["toxic", "terms", "counts"])

    found = sorted(rows.mapInArrow(lean(sparse), "toxic int, terms binary, counts binary").collect())
    return np.array([r["toxic"] > 0 for r in found]), [np.frombuffer(r["terms"], np.int32) for r in found], [np.frombuffer(r["counts"], np.int32) for r in found]


def _least(rate: float) -> int:
    """Toxic texts that a word needs before a pair of it can be beyond chance, however few pairs are compared."""
    return max(1, int(np.ceil(-np.log(JOINT_CHANCE) / -np.log(rate))))


def joint(label: np.ndarray, term: list[np.ndarray], n: int) -> np.ndarray:
    """Which of n words belong to a pair that is toxic more often than either of its words, beyond chance.

    For a pair in k texts, x of them toxic, the bound k * KL(x / k || the higher rate of
    its words) on the binomial tail must exceed what the best of all pairs reaches by
    chance. Pairs are counted block by block, as products of 0-1 matrices over the rows.
    """
    out = np.zeros(n, bool)
    toxic = np.flatnonzero(label)
    size = np.array([len(t) for t in term], np.int64)
    row, word = np.repeat(np.arange(len(term)), size), (np.concatenate(term) if len(term) else np.zeros(0)).astype(np.int64)
    times, bad = np.bincount(word, minlength=n), np.bincount(word[label[row]], minlength=n)
    rate = (bad + 1) / (times + 2)
    # a pair in x toxic texts has a bound of x * -log(rate) at best
    able = np.flatnonzero(bad * -np.log(rate) >= -np.log(JOINT_CHANCE))
    need = np.log(max(1, len(able) * (len(able) - 1) / 2) / JOINT_CHANCE)
    able = able[bad[able] * -np.log(rate[able]) >= need]
    number = np.full(n, -1)
    number[able] = np.arange(len(able))
    row, word = row[number[word] >= 0], number[word[number[word] >= 0]]
    order = np.argsort(word, kind="stable")
    row, first = row[order], np.searchsorted(word[order], np.arange(len(able) + 1))

    def block(a: int) -> np.ndarray:
        b = min(a + PAIR_BLOCK, len(able))
        x = np.zeros((len(term), b - a), np.float32)
        x[row[first[a] : first[b]], np.repeat(np.arange(b - a), np.diff(first[a : b + 1]))] = 1
        return x

    for a in range(0, len(able), PAIR_BLOCK):
        left = block(a)
        for c in range(a, len(able), PAIR_BLOCK):
            right = block(c) if c > a else left
            x = (left[toxic].T @ right[toxic]).astype(np.float64)
            expected = np.maximum(rate[able[a : a + PAIR_BLOCK]][:, None], rate[able[c : c + PAIR_BLOCK]][None])
            i, j = np.nonzero(x * -np.log(expected) >= need)
            if not len(i):
                continue
            x, k, r = x[i, j], (left.T @ right)[i, j].astype(np.float64), expected[i, j]
            p = x / k
            rest = np.where(p < 1, (1 - p) * np.log(np.maximum(1 - p, 1e-12) / (1 - r)), 0)
            hit = (p > r) & (k * (p * np.log(p / r) + rest) >= need) & (able[a + i] != able[c + j])
            out[able[a + i[hit]]] = out[able[c + j[hit]]] = True
    return out


def _train(slots: np.ndarray, label: np.ndarray, term: list, count: list, seed: int = 7) -> Model:
    """AdaGrad on the logistic loss, in small batches, with decaying weights."""
    rng = np.random.default_rng(seed)
    size = np.array([len(t) for t in term])
    start = np.cumsum(size) - size
    flat, value = np.concatenate(term).astype(np.int64), np.log1p(np.concatenate(count))
    w, v = np.zeros(len(slots)), rng.normal(0, 0.02, (len(slots), FACTORS))
    bias = float(np.log(label.mean() / (1 - label.mean())))
    gw, gv = np.full(len(slots), 1e-2), np.full(v.shape, 1e-2)
    rate, decay, batch = 0.05, 2e-4, 64
    for _ in range(EPOCHS):
        order = rng.permutation(len(label))
        for s in range(0, len(order), batch):
            rows = order[s : s + batch]
            n = size[rows]
            at = np.repeat(start[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            doc, t, x = np.repeat(np.arange(len(rows)), n), flat[at], value[at]
            z, sums = _raw(bias, w, v, doc, t, x, len(rows))
            error = 1 / (1 + np.exp(-z)) - label[rows]
            bias -= 0.02 * error.mean()
            ids, inverse = np.unique(t, return_inverse=True)
            e = error[doc] * x
            g = np.bincount(inverse, e, len(ids)) / len(rows) + decay * w[ids]
            gw[ids] += g * g
            w[ids] -= rate * g / np.sqrt(gw[ids])
            for f in range(FACTORS):
                g = np.bincount(inverse, e * (sums[doc, f] - v[t, f] * x), len(ids)) / len(rows) + decay * v[ids, f]
                gv[ids, f] += g * g
                v[ids, f] -= 0.5 * rate * g / np.sqrt(gv[ids, f])
    return Model(slots, bias, w, v)


def score(docs: DataFrame, model: Model, keep: list[str], name: str = "score") -> DataFrame:
    """The columns ``keep`` of every row of ``docs`` and, as ``name``, the probability of the toxic label."""
    shared = Shared(docs.sparkSession, (model, _lookup(model.slots)))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, lookup = shared.value
        for batch in batches:
            data, offsets = tv.text_bytes(batch.column(batch.num_columns - 1))
            out = [np.zeros(0)]
            for a, b in tv.blocks(offsets):
                doc, term, count = terms(data, offsets, a, b, lookup)
                out.append(model.score(doc, term, np.log1p(count), b - a))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate(out))], [*batch.schema.names[:-1], name])

    rows = docs.select(*keep, F.col("text").cast("string").alias(fresh(docs, "text_")))
    return rows.mapInArrow(lean(scored), T.StructType([*rows.schema.fields[:-1], T.StructField(name, T.DoubleType())]))


def held_out() -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text, mod 4, is 2 (false for a null id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``; held-out labels are not learnt from."""
    scored = score(docs, fit(docs, labels, ~held_out()), ["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

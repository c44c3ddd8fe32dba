"""N-gram Jaccard join: T-occurrence search over inverted lists (DivideSkip).

A document's set is its distinct k-word shingles. Two sets are linked when their
Jaccard similarity reaches ``percent`` / 100, which needs T common shingles. Per
document the T - 1 most frequent lists are *long*: they are never merged, only
probed by binary search; the other lists are *short*, and every partner must
occur in one of them. So:

1. equal sets collapse to one class (smallest id), so copies cost one row each;
2. shingles frequent over the whole corpus go to the end of every document's list
   order, so its short lists are its rare ones;
3. the short lists meet by shingle. Each document heap-merges the short lists it
   is in (each of bounded length) and keeps partners whose size and position
   bounds still allow T common shingles;
4. a short list over ``LIST`` entries is not expanded into pairs. Its members are
   checked against a hub; members that stay in different components are compared
   block by block on a bit signature whose distance bounds the sets' difference
   from below. Both steps are exact: no partner is lost;
5. every remaining pair is verified by binary probes of the sorted shingles, from
   the whole texts;
6. links become components;
7. links within long lists that step 4 need not look for are counted once the
   components are known: the classes of a component that has a long list are compared
   block against block, and each block pair gives one count per class, never its pairs.

Rows with equal sets are in one component, except empty sets, which are linked
with nothing. A null text counts as empty. Rows with a null id are kept, with the
component null. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.llm import textvec as tv
from pagetrail.llm.common import lean, materialize
from pagetrail.llm.components import components

#: Lists longer than this are not expanded into pairs.
LIST = 64
#: Rows of a block when a long list is compared block by block.
BLOCK = 2048
#: The most frequent shingles that are moved to the end of the list order; a bound on what is
#: broadcast. Any set gives right results, since every document uses the same order.
FREQUENT = 65536
SIGNATURE_BITS = 1024
#: Classes of a block when the links within a component are counted.
COUNT_BLOCK = 256


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every row of a batch with a text column."""
    data, offsets = tv.text_bytes(batch.column(batch.schema.get_field_index("text")))
    for a, b in tv.blocks(offsets):
        words = tv.Words(data, offsets, a, b)
        hashes = words.hashes()
        runs = tv.grams(hashes, k)
        for i in range(b - a):
            lo, hi = int(words.first[i]), int(words.first[i + 1])
            if hi - lo >= k:
                yield a + i, np.unique(runs[lo : hi - k + 1])
            elif hi > lo:
                yield a + i, np.array([tv.whole(hashes[lo:hi])], np.uint64)
            else:
                yield a + i, np.zeros(0, np.uint64)


def _short(n: int, percent: int) -> int:
    """How many short lists a set of n has: all but T - 1, T being the least overlap with any partner."""
    return n - -(-percent * n // 100) + 1 if n else 0


def _frequent(docs: DataFrame, k: int, percent: int) -> np.ndarray:
    """The (bounded) most frequent shingles among the first ones of all documents by hash order."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies within a task count once
        for batch in batches:
            out = []
            for _, s in _sets(batch, k):
                if len(s) and (key := int(tv.mix(s).sum())) not in seen:
                    seen.add(key)
                    out.append(s[: (p := _short(len(s), percent)) + p // 2 + 4])
            if out:
                yield pa.RecordBatch.from_arrays([tv.signed(np.concatenate(out))], ["h"])

    counts = docs.select("text").mapInArrow(lean(first), "h bigint").groupBy("h").count().where(F.col("count") > LIST)
    top = counts.orderBy(F.desc("count"), "h").limit(FREQUENT).select("h", "count").collect()
    return np.array([(r["h"], r["count"]) for r in top], np.int64).reshape(-1, 2)


def _profiles(docs: DataFrame, k: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """Per document: size and key of its set, bit signature, its short lists in list order."""
    spark = docs.sparkSession
    order = np.argsort(frequent[:, 0].astype(np.uint64))
    shared = spark.sparkContext.broadcast((frequent[order, 0].astype(np.uint64), frequent[order, 1]))

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, count = shared.value
        for batch in batches:
            n, key, sig, short = [], [], [], []
            for _, s in _sets(batch, k):
                p = _short(len(s), percent)
                n.append(len(s))
                key.append(np.uint64(tv.mix(s).sum() if len(s) else 0))
                bits = np.bincount((s >> np.uint64(11)).astype(np.int64) % SIGNATURE_BITS, minlength=SIGNATURE_BITS) & 1
                sig.append(np.packbits(bits.astype(bool)).tobytes())
                if len(hot) and len(s):
                    at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
                    is_hot = hot[at] == s
                    rare = s[~is_hot]
                    if len(rare) < p:
                        rest = s[is_hot]
                        rare = np.concatenate([rare, rest[np.argsort(count[at[is_hot]], kind="stable")]])
                    short.append(rare[:p].view(np.int64))
                else:
                    short.append(s[:p].view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, short)]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *short])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array(n, pa.int64()), tv.signed(np.array(key, np.uint64)), pa.array(sig, pa.binary()), lists],
                ["doc_id", "n", "key", "sig", "short"],
            )

    return docs.select("doc_id", "text").mapInArrow(lean(profile), "doc_id bigint, n bigint, key bigint, sig binary, short array<bigint>")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Heap-merge each document's short lists (sorted partner ids); partners once each."""
    for batch in batches:
        a, b = [], []
        for doc, lists in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            last = None
            for partner in heapq.merge(*lists):
                if partner != last:
                    a.append(doc)
                    b.append(partner)
                    last = partner
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of class ids whose sets reach the threshold."""
    side = lambda x: classes.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SIGNATURE_BITS // 8) for i in (4, 5)]
            n, m = (batch.column(i).to_numpy() for i in (2, 3))
            apart = np.bitwise_count(sigs[0] ^ sigs[1]).sum(1, dtype=np.int64)
            keep = _may_link(n, m, apart, percent)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep)) for i in (0, 1)], ["a", "b"])

    left = pairs.select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "sig_a", "sig_b")
    left = materialize(left.mapInArrow(lean(near), "a bigint, b bigint"), "near")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = ([s for _, s in _sets(pa.RecordBatch.from_arrays([batch.column(i)], ["text"]), k)] for i in (2, 3))
            keep = []
            for r, s in zip(one, two, strict=True):
                if len(r) > len(s):
                    r, s = s, r
                at = np.minimum(np.searchsorted(s, r), len(s) - 1)
                both = int((s[at] == r).sum())
                keep.append(100 * both >= percent * (len(r) + len(s) - both))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], ["a", "b"])

    text = docs.select("doc_id", "text")
    both = left.join(text.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(text.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return materialize(both.select("a", "b", "text_a", "text_b").mapInArrow(lean(probe), "a bigint, b bigint"), "verified")


def _may_link(n: np.ndarray, m: np.ndarray, apart: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and signature distance allow the threshold: the sets differ by at least ``apart``."""
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (apart * (100 + percent) <= (100 - percent) * (n + m))


def _blocks(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs in different components of the same long list that size and signature allow, block against block."""

    def compare(key: tuple, pdf):
        import pandas as pd

        pdf = pdf.sort_values("doc_id", ignore_index=True)
        sig = np.frombuffer(b"".join(pdf["sig"]), np.uint8).reshape(-1, SIGNATURE_BITS // 8).view(np.uint64)
        n, comp, doc, block, lists = (pdf[c].to_numpy() for c in ("n", "component", "doc_id", "block", "lists"))
        known = [np.asarray(x, np.int64) for x in lists]
        known = [x[x < key[0]] for x in known]
        ids = np.unique(np.concatenate([np.zeros(1, np.int64), *known]))
        member = np.zeros((len(pdf), len(ids)), bool)
        for i, x in enumerate(known):
            member[i, np.searchsorted(ids, x)] = True
        earlier = np.packbits(member, axis=1)
        a, b = [], []
        for i in np.flatnonzero(block == key[1]):
            other = np.flatnonzero((block == key[2]) & (comp != comp[i]) & ((doc > doc[i]) | (key[1] != key[2])))
            apart = np.bitwise_count(sig[other] ^ sig[i]).sum(1, dtype=np.int64)
            hit = other[_may_link(n[i], n[other], apart, percent)]
            # a pair that shares several of these lists is handled in the first one
            hit = hit[~(earlier[hit] & earlier[i]).any(1)]
            a.append(np.full(len(hit), doc[i]))
            b.append(doc[hit])
        empty = np.zeros(0, np.int64)
        a, b = np.concatenate([empty, *a]), np.concatenate([empty, *b])
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    cut = rows.withColumn("of", F.ceil(F.col("c") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("of")).cast("int"))
    pairs = F.expr("transform(sequence(0, of - 1), x -> struct(least(x, block) as i, greatest(x, block) as j))")
    cut = cut.withColumn("ij", F.explode(pairs)).select("h", "ij.i", "ij.j", "block", "doc_id", "n", "component", "sig", "lists")
    return cut.groupBy("h", "i", "j").applyInPandas(compare, "a bigint, b bigint")


def _counts(k: int, percent: int):
    """Links of each class within one pair of blocks of a component, from the whole sets."""

    def count(key: tuple, pdf):
        import pandas as pd

        block, doc = pdf["block"].to_numpy(), pdf["doc_id"].to_numpy()
        sets = [s for _, s in _sets(pa.RecordBatch.from_arrays([pa.array(pdf["text"], pa.string())], ["text"]), k)]
        n = np.array([len(s) for s in sets], np.int64)
        sig = np.frombuffer(b"".join(pdf["sig"]), np.uint8).reshape(-1, SIGNATURE_BITS // 8).view(np.uint64)
        links = np.zeros(len(doc), np.int64)
        # shingles of one class only are in no overlap; the others become one bit row per class
        _, at, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        column = np.cumsum(held > 1) - 1
        rows, bounds = np.zeros((len(doc), -(-int((held > 1).sum()) // 64) * 8), np.uint8), np.r_[0, np.cumsum(n)]
        for i in range(len(doc)):
            mine = at[bounds[i] : bounds[i + 1]]
            mine = column[mine[held[mine] > 1]]
            np.bitwise_or.at(rows[i], mine >> 3, (1 << (mine & 7)).astype(np.uint8))
        rows = rows.view(np.uint64)
        first, second = np.flatnonzero(block == key[1]), np.flatnonzero(block == key[2])
        for i in first:
            other = second if key[1] != key[2] else second[doc[second] > doc[i]]
            apart = np.bitwise_count(sig[other] ^ sig[i]).sum(1, dtype=np.int64)
            other = other[_may_link(n[i], n[other], apart, percent)]
            both = np.bitwise_count(rows[other] & rows[i]).sum(1, dtype=np.int64)
            hit = other[(both > 0) & (100 * both >= percent * (n[i] + n[other] - both))]
            links[i] += len(hit)
            links[hit] += 1
        return pd.DataFrame({"doc_id": doc, "n_links": links})[links > 0]

    return count


def _exact_links(named: DataFrame, found: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, n_links) of every class in a component with a long list, over all pairs of the component."""
    members = found.withColumnRenamed("node", "doc_id").join(named.select("component").distinct(), "component", "left_semi")
    cut = members.join(members.groupBy("component").agg(F.ceil(F.count("*") / COUNT_BLOCK).cast("int").alias("of")), "component")
    cut = cut.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("of")).cast("int"))
    text = docs.select("doc_id", "text").join(cut.select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    cut = cut.join(classes.select("doc_id", "sig"), "doc_id").join(text, "doc_id")
    pairs = F.expr("transform(sequence(0, of - 1), x -> struct(least(x, block) as i, greatest(x, block) as j))")
    cut = cut.withColumn("ij", F.explode(pairs)).select("component", "ij.i", "ij.j", "block", "doc_id", "sig", "text")
    counts = cut.groupBy("component", "i", "j").applyInPandas(_counts(k, percent), "doc_id bigint, n_links bigint")
    return counts.groupBy("doc_id").agg(F.sum("n_links").alias("n_links"))


def jaccard_classes(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest id reachable by links. ``n_links`` counts all links of
    the row's class.
    Repeated ids give repeated rows.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    profiles = materialize(_profiles(docs, k, percent, _frequent(docs, k, percent)), "profiles")
    classes = profiles.where("n > 0 and doc_id is not null").groupBy("key", "n").agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig"), F.first("short").alias("short"))
    classes = materialize(classes, "classes")

    postings = classes.select("doc_id", "n", F.posexplode("short").alias("i", "h"))
    shared = postings.groupBy("h").agg(F.count("*").alias("c")).where("c > 1")
    shared = materialize(postings.join(shared, "h"), "shared")

    lists = shared.where(F.col("c") <= LIST).groupBy("h").agg(F.sort_array(F.collect_list(F.struct("n", "doc_id", "i"))).alias("members"))
    # a partner is no larger; with it, T of both sizes must still fit behind the two positions
    partner = (
        f"transform(filter(members, x -> struct(x.n, x.doc_id) < struct(q.n, q.doc_id) and 100 * x.n >= {percent} * q.n"
        f" and {100 + percent} * least(x.n - x.i, q.n - q.i) >= {percent} * (x.n + q.n)), x -> x.doc_id)"
    )
    merged = lists.select("members", F.explode("members").alias("q")).select(F.col("q.doc_id").alias("a"), F.array_sort(F.expr(partner)).alias("partners")).where("size(partners) > 0")
    merged = merged.groupBy("a").agg(F.collect_list("partners").alias("lists")).mapInArrow(lean(_merge), "a bigint, b bigint")

    long = shared.where(F.col("c") > LIST)
    hubs = long.groupBy("h").agg(F.min(F.struct(F.xxhash64("doc_id", "h").alias("r"), F.col("doc_id").alias("hub"), F.col("n").alias("n_hub"))).alias("s")).select("h", "s.hub", "s.n_hub")
    spokes = long.join(hubs, "h").where(f"doc_id <> hub and 100 * least(n, n_hub) >= {percent} * greatest(n, n_hub)")
    spokes = spokes.select(F.least("doc_id", "hub").alias("a"), F.greatest("doc_id", "hub").alias("b"))
    links = _verified(merged.unionByName(spokes), classes, docs, k, percent)
    found = components(links)

    # long lists whose members are not yet in one component
    named = long.join(found, F.col("doc_id") == F.col("node"), "left").select("h", "c", "doc_id", "n", F.coalesce("component", "doc_id").alias("component"))
    open_lists = named.groupBy("h").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("h")
    rest = materialize(named.join(open_lists, "h", "left_semi").join(classes.select("doc_id", "sig"), "doc_id"), "rest")
    rest = rest.join(rest.groupBy("doc_id").agg(F.collect_set("h").alias("lists")), "doc_id")
    if rest.take(1):
        more = _verified(_blocks(rest, percent), classes, docs, k, percent)
        links = links.unionByName(more)
        found = components(links)

    named = long.select("doc_id").distinct().join(found, F.col("doc_id") == F.col("node")).select("component")
    exact = materialize(_exact_links(named, found, classes, docs, k, percent), "links")
    degree = links.select(F.explode(F.array("a", "b")).alias("doc_id")).groupBy("doc_id").agg(F.count("*").alias("n_links"))
    degree = degree.unionByName(exact).groupBy("doc_id").agg(F.max("n_links").alias("n_links"))  # the search found no more than there are
    final = classes.select("key", "n", "doc_id").join(found, F.col("doc_id") == F.col("node"), "left").join(degree, "doc_id", "left")
    final = materialize(final.select("key", "n", F.coalesce("component", "doc_id").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "final")
    out = profiles.select("doc_id", "n", "key").join(final.select("key", "n", "component", "n_links"), ["key", "n"], "left")
    # an empty set has no class row, a null id no place in one
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))

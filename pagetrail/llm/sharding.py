"""Sharding by minimax contiguous partition of atomic groups.

Documents with equal texts form one atomic group. Groups are ordered by text digest;
a shard is a contiguous run of groups, and the largest shard is as small as any such
cut allows. Its capacity is found by search: a greedy pass that fills each shard up
to a capacity tells whether the shards suffice, and the smallest capacity that does is
the minimax. The driver searches over a bounded summary of the groups' running totals
(least, greatest and count per stretch), and has Spark detail only the stretches in
which a cut may still fall; a few such jobs make the capacity and the cuts exact.

Running totals come from totals per digest prefix, so no task sorts more than a
prefix's groups. Slots within a group come from sub-groups of about the square root of
the group's size, so a group that holds a third of all rows is spread over many tasks.
DataFrame functions only.

A null text has no bytes and forms its own group, the last one; rows with null or
repeated ids are placed like any other. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetrail.llm.common import materialize

#: Groups per digest prefix, about.
PREFIX_GROUPS = 4096
#: Stretches of running totals that the driver learns per job, about; a fixed bound.
STRETCHES = 20_000


def _groups(rows: DataFrame) -> DataFrame:
    """Atomic groups with their running totals of bytes (``total``) and rows (``rows_before``) in digest order."""
    groups = materialize(rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "groups")
    digits = 1
    while 16**digits * PREFIX_GROUPS < groups.count() and digits < 12:
        digits += 1
    groups = groups.withColumn("prefix", F.substring("digest", 1, digits))
    sums = groups.groupBy("prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    before = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)  # one row per prefix
    sums = sums.select("prefix", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_0"))
    within = Window.partitionBy("prefix").orderBy("digest").rowsBetween(Window.unboundedPreceding, 0)
    groups = groups.withColumn("bytes_in", F.sum("bytes").over(within)).withColumn("n_in", F.sum("n").over(within))
    out = groups.join(sums, "prefix").select("digest", "bytes", "n", (F.col("bytes_0") + F.col("bytes_in")).alias("total"), (F.col("n_0") + F.col("n_in") - F.col("n")).alias("rows_before"))
    return materialize(out, "totals")


class _Totals:
    """What the driver knows of the groups' running totals: stretches of them as (least, most, count), a bounded number."""

    def __init__(self, groups: DataFrame, total: int) -> None:
        self.groups = groups
        self.least, self.most, self.count = [], [], []
        self.learn([(0, total, 1)])

    def learn(self, ranges: list[tuple[int, int, int]]) -> None:
        """Replace what is known of the ranges (low, high] by finer stretches: one aggregation job.

        Each range comes with the number of its stretches, of which there are at least twice as many afterwards.
        """
        number = []
        for i, (low, high, now) in enumerate(ranges):
            width = max(1, -(-(high - low) // max(2 * now, STRETCHES // len(ranges))))
            place = F.struct(F.lit(i).alias("range"), F.floor((F.col("total") - low - 1) / width).alias("stretch"))
            number.append(F.when((F.col("total") > low) & (F.col("total") <= high), place))
        stretch = F.coalesce(*number)
        inside = " or ".join(f"(total > {low} and total <= {high})" for low, high, _ in ranges)
        found = self.groups.where(inside).groupBy(stretch.alias("at")).agg(F.min("total").alias("least"), F.max("total").alias("most"), F.count("*").alias("n")).collect()
        kept = [x for x in zip(self.least, self.most, self.count, strict=True) if not any(low < x[1] <= high for low, high, _ in ranges)]
        kept = sorted(kept + [(r["least"], r["most"], r["n"]) for r in found])
        self.least, self.most, self.count = ([x[i] for x in kept] for i in range(3))

    def reach(self, x: int) -> tuple[int, int, tuple[int, int] | None]:
        """Bounds of the greatest total that is at most x, and the range to learn if they differ."""
        i = bisect_right(self.least, x) - 1
        if i < 0:
            return 0, 0, None
        if self.most[i] <= x:
            return self.most[i], self.most[i], None
        if self.count[i] <= 2:
            return self.least[i], self.least[i], None
        return self.least[i], min(x, self.most[i] - 1), (self.least[i] - 1, self.most[i])

    def between(self, high: int, low: int) -> bool:
        """Whether a known stretch begins after ``high`` and up to ``low``."""
        i = bisect_right(self.least, high)
        return i < len(self.least) and self.least[i] <= low

    def fill(self, capacity: int, shards: int, high: bool) -> list[int]:
        """Where greedy shards of the capacity end, by the lower or the upper bounds."""
        ends = [0]
        for _ in range(shards):
            ends.append(max(ends[-1], self.reach(ends[-1] + capacity)[high]))
        return ends


def minimax_cuts(groups: DataFrame, shards: int) -> list[int]:
    """Running totals at which the shards of the smallest feasible capacity end.

    Greedy passes over the known stretches bound the capacity from both sides; the
    stretches in which cuts of a capacity between the bounds may fall are learnt in more
    detail, until the bounds and the cuts are exact.
    """
    total, largest = groups.agg(F.max("total"), F.max("bytes")).first()
    known = _Totals(groups, total)

    def smallest(high: bool) -> int:
        low, top = max(-(-total // shards), largest), -(-total // shards) + largest  # the upper one always suffices
        while low < top:
            middle = (low + top) // 2
            if known.fill(middle, shards, high)[-1] >= total:
                top = middle
            else:
                low = middle + 1
        return low

    while True:
        low, high = smallest(True), smallest(False)
        first, last = known.fill(low, shards, False), known.fill(high, shards, True)
        vague = set()
        for a, b in zip(first, last, strict=True):
            i, j = bisect_right(known.least, a + low) - 1, bisect_right(known.least, b + high) - 1
            vague |= {(known.least[k] - 1, known.most[k]) for k in range(max(i, 0), j + 1) if known.count[k] > 2}
        if not vague:
            return known.fill(high, shards, False)[1:]
        ranges: list[tuple[int, int, int]] = []
        for u, v in sorted(vague):  # neighbouring stretches become one range
            if ranges and not known.between(ranges[-1][1], u):
                ranges[-1] = (ranges[-1][0], v, ranges[-1][2] + 1)
            else:
                ranges.append((u, v, 1))
        known.learn(ranges)


def shard(docs: DataFrame, shards: int = 16) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs`` (doc_id, text)."""
    text = F.col("text").cast("string")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.sha2(text, 256), F.lit("g")).alias("digest"),  # after every hexadecimal digest
    )
    rows = materialize(rows, "rows")
    groups = _groups(rows)
    if groups.isEmpty():
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))
    cuts = minimax_cuts(groups, shards)
    of = sum((F.col("total") > F.lit(c)).cast("int") for c in cuts[:-1]) if len(cuts) > 1 else F.lit(0)
    groups = groups.withColumn("shard", of)
    first = {r["shard"]: r["first"] for r in groups.groupBy("shard").agg(F.min("rows_before").alias("first")).collect()}  # a row per shard
    start = F.coalesce(*[F.when(F.col("shard") == s, F.lit(n)) for s, n in sorted(first.items())])
    groups = groups.select("digest", "n", "shard", (F.col("rows_before") - start).alias("slot_0"))
    # sub-groups of about sqrt(n) rows give each row its place within its group
    split = F.pmod(F.xxhash64("doc_id"), F.ceil(F.sqrt("n"))).cast("int")
    placed = materialize(rows.join(groups, "digest").withColumn("split", split), "placed")
    sizes = placed.groupBy("digest", "split").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("digest").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("digest", "split", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("split_0"))
    rank = F.row_number().over(Window.partitionBy("digest", "split").orderBy("doc_id")) - 1
    placed = placed.withColumn("rank", rank).join(sizes, ["digest", "split"])
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("slot_0") + F.col("split_0") + F.col("rank")).cast("bigint").alias("slot"))

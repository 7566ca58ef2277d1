"""Shards of near equal size by minimax contiguous partition of ordered atomic groups."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import running
from lexiloom.session import cut

SHARDS = 40
FIRST_BITS, MORE_BITS = 12, 6
ROW_BYTES = 16


class Ranges:
    """Consecutive ranges of keys with the size of the groups in each; a range of one group cannot be cut inside."""

    def __init__(self, rows: list[tuple[int, int, int, int, int]]):
        self.rows = sorted(rows)  # first key, size, groups, largest group, bits of the key that the range fixes
        self.sums = [0, *accumulate(r[1] for r in self.rows)]
        self.total = self.sums[-1]

    def below(self, place: int) -> int:
        """The last range boundary that is not beyond ``place``."""
        return self.sums[bisect_right(self.sums, place) - 1]

    def loosely_below(self, place: int) -> int:
        """The same, as if ranges of several groups could be cut anywhere."""
        k = bisect_right(self.sums, place) - 1
        return self.sums[k] if k >= len(self.rows) or self.rows[k][2] == 1 else place

    def ends(self, capacity: int, shards: int, loosely: bool = False) -> list[int]:
        """Greedy check: where the shards end when each takes all that fits into ``capacity``."""
        step = self.loosely_below if loosely else self.below
        found = [0]
        for _ in range(shards):
            found.append(min(self.total, step(found[-1] + capacity)))
        return found[1:]

    def smallest(self, shards: int, loosely: bool = False) -> int:
        """Binary search for the smallest capacity with which nothing is left over."""
        low = max([-(-self.total // shards), *(r[3] for r in self.rows)])
        high = max(low, self.total)
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if self.ends(mid, shards, loosely)[-1] == self.total else (mid + 1, high)
        return low


def cuts(groups: DataFrame, shards: int) -> tuple[list[int], int]:
    """Keys at which the second and later shards begin, and the smallest capacity, for atomic ``groups`` in the order of key.

    ``groups`` is a written table (key long, size long, one row per key), keys spread evenly over all longs. The driver sees
    ranges of keys instead of groups. Taking ranges as atomic bounds the capacity from above, taking ranges of several groups
    as divisible bounds it from below, and both together bound every cut. Only the ranges that a cut may fall into are split
    into finer ones, until both bounds agree, so that the driver holds some ten thousand ranges for any number of groups.
    """
    def measured(table: DataFrame, bits: int) -> list[tuple[int, int, int, int, int]]:
        got = table.groupBy(F.shiftright("key", 64 - bits).alias("r")).agg(
            F.sum("size").alias("s"), F.count(F.lit(1)).alias("n"), F.max("size").alias("m")
        ).collect()
        return [(r["r"] << (64 - bits), r["s"], r["n"], r["m"], bits) for r in got]

    now = Ranges(measured(groups, FIRST_BITS))
    while True:
        low, high = now.smallest(shards, loosely=True), now.smallest(shards)
        if low == high:
            break
        split = set()
        for first, last in zip(now.ends(low, shards), now.ends(high, shards, loosely=True)):
            k = bisect_right(now.sums, first) - 1
            while k < len(now.rows) and now.sums[k] < last:
                if now.rows[k][2] > 1:
                    split.add(k)
                k += 1
        by_bits: dict[int, list[int]] = {}
        for k in split:
            by_bits.setdefault(now.rows[k][4], []).append(k)
        rows = [r for k, r in enumerate(now.rows) if k not in split]
        for bits, chosen in by_bits.items():
            wanted = groups.sparkSession.createDataFrame([(now.rows[k][0] >> (64 - bits),) for k in chosen], "w long")
            inside = groups.join(F.broadcast(wanted), F.shiftright("key", 64 - bits) == F.col("w"), "left_semi")  # ranges, not groups
            rows += measured(inside, min(64, bits + MORE_BITS))
        now = Ranges(rows)
    starts = dict.fromkeys(now.ends(high, shards)[:-1])
    at = {s: r[0] for s, r in zip(now.sums, now.rows)}
    return [at[s] for s in starts if s in at], high


def above_share(groups: DataFrame, shards: int) -> list[tuple[int, int]]:
    """(size, key) of the groups, largest first, that exceed an equal share of what the larger ones leave; fewer than ``shards``."""
    left = groups.agg(F.sum("size").alias("s")).first()["s"] or 0
    found: list[tuple[int, int]] = []
    while True:
        big = groups.where((F.col("size") * (shards - len(found)) > left) & ~F.col("key").isin([k for _, k in found]))
        more = [(r["size"], r["key"]) for r in big.collect()]
        if not more:
            return sorted(found, reverse=True)
        found += more
        left -= sum(s for s, _ in more)


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Deal ``docs`` (doc_id, text) to ``shards`` shards of near equal size: doc_id, size, text_crc32, shard, slot.

    Size is the bytes of the text and ROW_BYTES; equal texts form an atomic group; the order is that of a hash of the text.
    The largest shard is at most as large as in the best partition that is contiguous in it. A group above an equal share of
    the bytes gets one of the last shards for itself, and the others are contiguous among the rest, so that these are near
    equal too; only where that would make the largest shard larger, the group stays in its place. A null text counts as empty and goes with the empty ones; repeated rows are rows of
    their own; other columns are ignored; an empty table stays empty, and fewer groups than shards leave the last ones empty.
    ``slot`` numbers a shard's rows without gaps, in an order mixed by hash.
    """
    table = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).select(
        "doc_id", (F.octet_length("text") + ROW_BYTES).cast("long").alias("size"), F.crc32("text").alias("text_crc32"), F.xxhash64("text").alias("key")
    ))
    groups = cut(table.groupBy("key").agg(F.sum("size").alias("size")))
    starts, most = cuts(groups, shards)
    apart = above_share(groups, shards)
    while apart:
        rest, largest = cuts(groups.where(~F.col("key").isin([k for _, k in apart])), shards - len(apart))
        if largest <= most:
            starts = rest
            break
        apart.pop()
    number = F.lit(0)
    for k in starts:  # shards - 1 at most
        number = number + (F.col("key") >= k).cast("int")
    for i, (_, k) in enumerate(apart):
        number = F.when(F.col("key") == k, shards - len(apart) + i).otherwise(number)
    dealt = table.withColumn("shard", number)
    order = F.struct(F.xxhash64("key", "doc_id").alias("h"), "key", "doc_id")
    return running(dealt, ["shard"], order, F.lit(1), "slot", table.count()).select("doc_id", "size", "text_crc32", "shard", "slot")

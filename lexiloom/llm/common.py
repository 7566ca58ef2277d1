"""Helpers shared by the operators: numbering inside groups, connected components, bounded slices of batches."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence
from math import ceil
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexiloom.session import cut, discard

BUCKET_ROWS = 2_000  # rows that one task numbers together
BROADCAST_BYTES = 64 << 20


BATCH_CONF, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"


def small_batches() -> None:
    """Bound the batches in which texts go to Python workers by 8 MB, unless the session has a bound of its own: several
    workers share an executor's memory, and documents may be very long."""
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.conf.get(BATCH_CONF) == BATCH_DEFAULT:
        spark.conf.set(BATCH_CONF, BATCH_BYTES)


T = TypeVar("T")


def tidy(batches: Iterator[T]) -> Iterator[T]:
    """The batches; what is freed after each goes back to the system. Python workers live on between tasks and share their
    executor's memory with its JVM, so what their allocators hold back counts."""
    import pyarrow

    trim = getattr(ctypes.CDLL(None), "malloc_trim", lambda _: None)
    for batch in batches:
        yield batch
        del batch
        pyarrow.default_memory_pool().release_unused()
        trim(0)


def size_checked(df: DataFrame, rows: int, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast of ``df`` when its counted ``rows`` of at most ``row_bytes`` fit ``limit``; else leave it to the planner."""
    return F.broadcast(df) if rows * row_bytes <= limit else df


def prefix_starts(counts: DataFrame, group: Sequence[str], bucket: str, n: str, name: str) -> DataFrame:
    """``counts`` (one row per group and bucket) with ``name``: the sum of ``n`` over the earlier buckets of the group."""
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum(n).over(before), F.lit(0)).cast("long"))


def running(table: DataFrame, group: Sequence[str], order: Column, amount: Column, name: str, rows: int) -> DataFrame:
    """Add ``name``: the sum of ``amount`` over the rows of the same group that come earlier by ``order``.

    ``table`` is a written table (it is read twice) with non-null group columns, and ``order`` a struct that starts with an
    evenly spread 64-bit hash. Rows are dealt to ranges of that hash, so the rows of one group, however many, meet in many
    tasks; only one sum per group and range is added up over the group. With ``amount`` 1 this is a gapless number from 0.
    """
    ranges = max(1, ceil(rows / BUCKET_ROWS))
    spread = F.shiftright(order.getField("h"), 33) + (1 << 30)  # 31 bits, in the order of h
    keyed = table.withColumn("_order", order).withColumn("_amount", amount.cast("long"))
    keyed = keyed.withColumn("_range", F.floor(spread * ranges / F.lit(float(1 << 31))).cast("int"))
    counts = keyed.groupBy(*group, "_range").agg(F.sum("_amount").alias("_sum"))
    starts = prefix_starts(counts, group, "_range", "_sum", "_start").drop("_sum")
    within = Window.partitionBy(*group, "_range").orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    return (
        keyed.join(starts, [*group, "_range"])
        .withColumn(name, F.col("_start") + F.coalesce(F.sum("_amount").over(within), F.lit(0)))
        .drop("_order", "_amount", "_range", "_start")
    )


def components(links: DataFrame, keep: Sequence[DataFrame] = ()) -> DataFrame:
    """Connected components of ``links`` (a, b): one row (node, component) per linked node, component its smallest node.

    Alternating large and small stars: every node passes its smallest neighbour on until each links only to its
    component's smallest node. A round moves one row per link, ends in a written table, and the round before is dropped.
    The smallest neighbour is a sum-like aggregate, and links return to it by an equi-join that the planner may split, so
    a node with very many links holds up no task.
    """
    now = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            now.select(F.col("v").alias("x"), F.col("u").alias("y"))  # y > x: y is linked to the least neighbour of x
            .join(least.select(F.col("u").alias("x"), F.least("m", "u").alias("m")), "x")
            .select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        )
        step = cut(large)
        low = step.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            step.join(low, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct()
        )
        after = cut(small)
        seen = after.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h")).first()
        discard(now, step)
        now = after
        if (seen["n"], seen["h"]) == state:
            break
        state = (seen["n"], seen["h"])
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))


def slices(values: Sequence[str | None], most_chars: int) -> Iterator[tuple[int, int]]:
    """Index ranges of ``values`` of about ``most_chars`` characters each; a longer value is a range of its own."""
    start = chars = 0
    for i, v in enumerate(values):
        n = len(v) if v else 0
        if i > start and chars + n > most_chars:
            yield start, i
            start, chars = i, 0
        chars += n
    if start < len(values):
        yield start, len(values)

"""Shared building blocks: global order, size-checked lookup joins, block products."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil, isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexiloom.session import cut, small_batches

BROADCAST_BYTES = 32 << 20  # a broadcast passes through the driver, and a query may need a dozen
BLOCK_ROWS = 4096
TILE_ROWS = 512  # rows of a block that one matrix product takes, so that a worker holds some 16 MB of products at a time
MATRIX_TASKS = 256  # tasks that add up the rows of a small matrix, at most
PACKED = "blk int, v binary"  # a block of doubles, row by row


def table_bytes(df: DataFrame, *text_cols: str, overhead: int = 64) -> int:
    """Measured upper size of ``df`` when its string columns are ``text_cols`` (one aggregate job)."""
    size = F.lit(overhead)
    for c in text_cols:
        size = size + F.coalesce(F.octet_length(c), F.lit(0))
    return df.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]


def lookup(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner", small_bytes: int | None = None,
           limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join ``big`` to ``small``, which has one row per key.

    ``small`` is broadcast only when its known size is below ``limit``. Otherwise both sides are shuffled once, uncopied;
    adaptive execution splits the partitions of ``big`` that it measures as hot.
    """
    on = list(on)
    if small_bytes is not None and small_bytes <= limit:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)


def ordinal(df: DataFrame, order: Sequence[Column], name: str = "idx") -> DataFrame:
    """Add a dense global index (from 0) in ascending ``order`` without a single-task window.

    Rows are range-partitioned and sorted, each range is numbered on its own, and the ranges' start offsets
    (one row per partition) are added. ``order`` should make keys nearly unique so that ranges stay balanced.
    """
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    ranged = cut(
        df.withColumn("_ord", key).repartitionByRange("_ord").withColumn("_part", F.spark_partition_id())
    )
    starts = (
        ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_start"))
    )
    within = F.row_number().over(Window.partitionBy("_part").orderBy("_ord"))
    return (
        ranged.withColumn("_row", within)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_row") - 1)
        .drop("_part", "_ord", "_row", "_start")
    )


def lowest(df: DataFrame, n: int, key: Column, ties: Sequence[Column] = ()) -> DataFrame:
    """The ``n`` rows of lowest ``key``, a number from 0 below 2^60 spread evenly, ties by ``ties``; all rows if there are fewer.

    A histogram of 4096 slots finds the slot with the cut. Rows of lower slots are in, rows of higher ones out, and only the rows of
    this slot are put in order, by range, so neither a table nor ``n`` rows are sorted or pass through one task. Rows that agree in
    everything are spread by their place, as it does not matter which of them are taken.
    """
    slot = F.shiftright(F.col("_key"), 48)
    keyed = df.withColumn("_key", key)
    counts = {r["slot"]: r["n"] for r in keyed.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect()}
    left = n
    for at in sorted(counts):
        if counts[at] > left:
            below = keyed.filter(slot < at)
            place = ordinal(keyed.filter(slot == at), [F.col("_key"), *ties, F.xxhash64(F.monotonically_increasing_id())], "_place")
            return below.unionByName(place.filter(F.col("_place") < left).drop("_place")).drop("_key")
        left -= counts[at]
    return df


def vector_shape(df: DataFrame, vec: str = "vec") -> tuple[int, int]:
    """(rows, dimension) of a vector table; differing dimensions are an error."""
    got = df.agg(F.count(F.lit(1)).alias("n"), F.min(F.size(vec)).alias("lo"), F.max(F.size(vec)).alias("hi")).first()
    if got["lo"] != got["hi"]:
        raise ValueError(f"vectors of different dimensions: {got['lo']} and {got['hi']}")
    return got["n"], got["hi"] or 0


def blocks(df: DataFrame, keys: Sequence[str], columns: Sequence[str], vec: str, rows: int,
           blk: str = "blk") -> tuple[DataFrame, int]:
    """Pack a vector table into hash blocks of about 4096 rows at most, ordered by ``keys`` inside.

    ``keys`` together are unique. Each block is one row: an array per scalar column and the vectors as one flat
    row-major array. Returns the packed frame, spread over one task per block, and the number of blocks.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    n = max(1, ceil(rows / BLOCK_ROWS), min(cores, ceil(rows / 64)))
    scalars = [*keys, *columns]
    grouped = (
        df.withColumn(blk, F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int"))
        .repartition(n, blk)
        .groupBy(blk)
        .agg(F.sort_array(F.collect_list(F.struct(*scalars, vec))).alias("_rows"))
    )
    packed = grouped.select(
        blk,
        *[F.col("_rows")[c].alias(c) for c in scalars],
        F.flatten(F.col("_rows")[vec]).alias(vec),
    )
    return packed, n


def tiles(rows: int) -> Iterator[slice]:
    """Slices of at most ``TILE_ROWS`` rows."""
    return (slice(a, min(a + TILE_ROWS, rows)) for a in range(0, rows, TILE_ROWS))


def outer_sum(rows: DataFrame, x: str, y: str) -> np.ndarray:
    """Sum over rows of the outer product x y^T, as one small matrix on the driver.

    Each task adds up its rows; the partial matrices are added by matrix row on the executors, so the driver
    receives dim(x) rows whatever the size of ``rows``.
    """
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                part = np.stack(batch["x"]).T @ np.stack(batch["y"])
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"blk": np.arange(len(total)), "v": [row.tobytes() for row in total]})

    parts = rows.select(F.col(x).alias("x"), F.col(y).alias("y")).mapInPandas(partial, PACKED)
    got = add_blocks(parts, MATRIX_TASKS).toPandas()
    if got.empty:
        raise ValueError("no rows to multiply")
    return np.stack([np.frombuffer(v) for v in got.sort_values("blk")["v"]])


def add_blocks(parts: DataFrame, n: int) -> DataFrame:
    """Element-wise sum of packed doubles (blk, v) per block number, streamed block by block within each task."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, total = None, None
        for batch in batches:
            for b, v in zip(batch["blk"], batch["v"]):
                if b == current:
                    total = total + np.frombuffer(v)
                    continue
                if current is not None:
                    yield pd.DataFrame({"blk": [current], "v": [total.tobytes()]})
                current, total = b, np.frombuffer(v)
        if current is not None:
            yield pd.DataFrame({"blk": [current], "v": [total.tobytes()]})

    tasks = min(n, 4 * parts.sparkSession.sparkContext.defaultParallelism)
    return parts.repartition(tasks, "blk").sortWithinPartitions("blk").mapInPandas(add, PACKED)


def meet(left: DataFrame, right: DataFrame, n_right: int, right_bytes: int, limit: int = BROADCAST_BYTES, left_blk: str | None = None) -> DataFrame:
    """Bring every left block together with every right block.

    The right side is broadcast below ``limit`` bytes. Beyond it both sides are dealt to the cells of a grid, left blocks to its
    rows and right blocks to its columns: a block goes to each cell of its row or column, so either side is copied about the
    square root of the tasks, and no task sees a whole side. ``left_blk`` is the left block number (``lblk`` or ``blk``).
    """
    small_batches(left.sparkSession)
    if right_bytes <= limit:
        addressed = left.withColumn("rblk", F.explode(F.sequence(F.lit(0), F.lit(n_right - 1))))
        return addressed.join(F.broadcast(right), "rblk")
    tasks = max(2 * left.sparkSession.sparkContext.defaultParallelism, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    columns = min(n_right, isqrt(tasks))
    rows = -(-tasks // columns)
    number = F.col(left_blk or ("lblk" if "lblk" in left.columns else "blk"))
    across, down = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (columns, rows))
    by_row = left.withColumn("_row", F.pmod(number, F.lit(rows))).withColumn("_column", across)
    by_column = right.withColumn("_column", F.pmod(F.col("rblk"), F.lit(columns))).withColumn("_row", down)
    return by_row.join(by_column, ["_row", "_column"]).drop("_row", "_column")

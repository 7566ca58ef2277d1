"""Pairs of words that stand close together, counted with numpy inside tasks and dealt by Spark as sorted blocks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import count
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.operators.common import BROADCAST_BYTES
from lexiloom.session import small_batches

CODE_BYTES = 12  # of a word in the broadcast vocabulary: its hash and its index
BUFFER_PAIRS = 1 << 22  # pairs that a task holds before it sums them
PART_PAIRS = 1 << 20  # pairs of a block number, of which a task adds up one after the other: some 50 MB at a time
TASK_PARTS = 4  # block numbers of a task, about, so that tasks are even
OUT_ROWS = 1 << 17
BLOCKS = "part int, keys binary, counts binary"  # differences of ascending 64-bit keys (lo, hi, gap) and 32-bit counts, byte by byte


def planes(values: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones and so on: those that are 0 nearly everywhere shrink to nothing in a shuffle."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def from_planes(packed: bytes, kind: type) -> np.ndarray:
    flat = np.frombuffer(packed, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(flat.T).view(kind).ravel()


def salt_of(words: DataFrame) -> int:
    """A salt with which no two of all distinct ``words`` share their hash, so that hashes stand for words exactly."""
    for salt in count():
        if words.groupBy(_hash(F.col("word"), salt).alias("h")).count().filter("count > 1").isEmpty():
            return salt


def _hash(word: Column, salt: int) -> Column:
    return F.xxhash64(F.lit(salt), word)


def hashes(toks: Column, salt: int) -> Column:
    return F.transform(toks, lambda t: _hash(t, salt))


def codes(vocab: DataFrame, vocab_size: int, salt: int, limit: int = BROADCAST_BYTES) -> Broadcast | None:
    """Hashes of all known words in ascending order and their indices, for every task; None above ``limit`` bytes."""
    if vocab_size * CODE_BYTES > limit:
        return None
    got = vocab.select(_hash(F.col("word"), salt).alias("h"), F.col("idx").cast("int").alias("idx")).toArrow()
    h, idx = (got[c].to_numpy() for c in ("h", "idx"))
    order = np.argsort(h)
    return vocab.sparkSession.sparkContext.broadcast((h[order], idx[order]))


def _find(h: np.ndarray, known: np.ndarray, idx: np.ndarray, first: np.ndarray, bits: int) -> np.ndarray:
    """Indices of ``h``, -1 where not known. ``first`` is the place of the first known hash by its ``bits`` upper bits."""
    at = first[(h >> (64 - bits)) + (1 << bits - 1)]
    late = np.flatnonzero(known[at] < h)
    while len(late):
        at[late] += 1
        late = late[known[at[late]] < h[late]]
    return np.where(known[at] == h, idx[at], np.int32(-1))


def fits(vocab_size: int, reach: int) -> bool:
    """Whether two indices and a gap fit a key of 63 bits."""
    return 2 * _bits(vocab_size) + _bits(reach) <= 63


def _bits(n: int) -> int:
    return max(1, (n - 1).bit_length())


def parts_of(tokens: int, reach: int, cores: int) -> int:
    """Block numbers, as many as keep each at some million pairs."""
    return max(4 * TASK_PARTS * cores, ceil(tokens * reach / PART_PAIRS))


def blocks(lists: DataFrame, reach: int, vocab_size: int, parts: int, known: Broadcast | None = None) -> DataFrame:
    """Counts of unordered pairs as blocks (part, keys, counts) from rows (ids, own): words and how many of them are own.

    A word meets the ``reach`` known words behind it in its row, if it is own. ``ids`` are indices, or hashes if ``known`` is given, and
    then words that are not known do not count. A task sums its pairs every four million, so a frequent pair is a few
    entries of a task, and sends them by pair: an entry for each different pair and gap.
    """
    small_batches(lists.sparkSession)
    wide, low = _bits(vocab_size), _bits(reach)

    def summed(keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        flat = np.sort(np.concatenate(keys))
        starts = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
        counts = np.diff(starts, append=len(flat)).astype(np.int32)
        flat = flat[starts]
        mixed = (flat >> low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        part = ((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.uint16 if parts < 1 << 16 else np.int32)
        order = np.argsort(part, kind="stable")
        flat, counts, part = flat[order], counts[order], part[order]
        cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        ends = np.append(cuts[1:], len(part))
        yield pa.RecordBatch.from_arrays([
            pa.array(part[cuts].astype(np.int32)),
            pa.array([planes(np.diff(flat[a:b], prepend=0)) for a, b in zip(cuts, ends)], pa.binary()),
            pa.array([planes(counts[a:b]) for a, b in zip(cuts, ends)], pa.binary()),
        ], ["part", "keys", "counts"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if known is not None:
            table, idx = known.value
            bits = _bits(len(table))
            edges = np.arange(-(1 << bits - 1), 1 << bits - 1, dtype=np.int64) << (64 - bits)
            first = np.searchsorted(table, edges).astype(np.int32)
            table, idx = np.append(table, np.iinfo(np.int64).max), np.append(idx, -1)
        held, n = [], 0
        for batch in batches:
            ids, own = batch.column(0), batch.column(1).to_numpy()
            size = np.diff(ids.offsets.to_numpy())
            at = np.repeat(np.arange(len(size), dtype=np.int32), size)
            mine = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size) < np.repeat(own, size)
            word = ids.flatten().to_numpy()
            if known is not None:
                word = _find(word, table, idx, first, bits)
                hit = word >= 0
                at, mine, word = at[hit], mine[hit], word[hit]
            word = word.astype(np.int64)
            for gap in range(1, reach + 1):
                near = (at[gap:] == at[:-gap]) & mine[:-gap]
                a, b = word[:-gap][near], word[gap:][near]
                held.append(((np.minimum(a, b) << wide | np.maximum(a, b)) << low) | gap - 1)
                n += len(a)
            if n >= BUFFER_PAIRS:
                yield from summed(held)
                held, n = [], 0
        if n:
            yield from summed(held)

    return lists.select("ids", "own").mapInArrow(pairs, BLOCKS)


def sums(packed: DataFrame, windows: Sequence[int], distance_weighting: bool, vocab_size: int, parts: int) -> DataFrame:
    """(lo, hi, w2, w4, ..) from blocks: a row for each unordered pair, a sum for each window, null where it does not hold the pair."""
    wide, low = _bits(vocab_size), _bits(max(windows))
    unit = 1.0 / np.arange(1, max(windows) + 1) if distance_weighting else np.ones(max(windows), np.int64)
    kind = "double" if distance_weighting else "long"
    names = ["lo", "hi", *[f"w{size}" for size in windows]]

    def added(keys: list[np.ndarray], counts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        flat, many = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(flat, kind="stable")  # of sorted runs
        flat, many = flat[order], many[order].astype(np.int64)
        gap, flat = flat & (1 << low) - 1, flat >> low
        starts = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
        pair, least, value = flat[starts], np.minimum.reduceat(gap, starts), many * unit[gap]
        columns = [pa.array((pair >> wide).astype(np.int32)), pa.array((pair & (1 << wide) - 1).astype(np.int32))]
        for size in windows:
            columns.append(pa.array(np.add.reduceat(np.where(gap < size, value, 0), starts), mask=least >= size))
        out = pa.RecordBatch.from_arrays(columns, names)
        yield from (out.slice(a, OUT_ROWS) for a in range(0, len(pair), OUT_ROWS))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, counts = None, [], []
        for batch in batches:
            for part, k, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if part != now and keys:
                    yield from added(keys, counts)
                    keys, counts = [], []
                now = part
                keys.append(np.cumsum(from_planes(k, np.int64)))
                counts.append(from_planes(c, np.int32))
        if keys:
            yield from added(keys, counts)

    dealt = packed.repartition(ceil(parts / TASK_PARTS), "part").sortWithinPartitions("part")
    return dealt.mapInArrow(add, ", ".join(["lo int", "hi int", *[f"w{size} {kind}" for size in windows]]))

"""SimHash near-duplicates found through segment popcounts.

A 64-bit fingerprint is cut into segments, and the numbers of one-bits in them form a vector: the Manhattan distance of two
vectors never exceeds the Hamming distance of their fingerprints. The segments are dealt to groups such that two
fingerprints within ``BITS`` bits have, in some group, vectors at Manhattan distance 1 at most. Each group's vectors are a
grid of unit cells; a fingerprint meets those of its own cell and of the cells one step away, and every pair met is verified
on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import BROADCAST_BYTES, components, size_checked, small_batches, tidy
from lexiloom.session import cut

WORDS = 4
BITS = 4
SEGMENT = 2  # bits in a segment
CELL_ROWS = 4096  # fingerprints at home in one block of a cell
PAIRS = 2_000_000  # compared at once


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Majority of the bits of the shingles' XXH64 (seed 42); 0 for a text without words."""
    import xxhash

    got = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not got:
        return 0
    line = b" ".join(got)
    ends = list(accumulate(len(w) + 1 for w in got))
    k = min(words, len(got))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a : z - 1], 42) for a, z in zip(starts, ends[k - 1 :])], np.uint64)
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 65_536):
        ones += np.unpackbits(hashes[lo : lo + 65_536].view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(words: int = WORDS):
    """Column function: text -> fingerprint as a long."""
    small_batches()
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in tidy(batches):
            yield pd.Series(np.array([fingerprint(t, words) for t in batch], np.uint64).view(np.int64))

    return run


def groups_of(bits: int) -> list[tuple[int, int]]:
    """Bit ranges of the groups: with bits // 2 + 1 of them, ``bits`` differences leave at most one for some group."""
    n = bits // 2 + 1
    edges = [round(64 / SEGMENT * k / n) * SEGMENT for k in range(n + 1)]
    return list(zip(edges, edges[1:]))


def _cells(fp: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Cells of fingerprints in every group, as (cells, which fingerprints, whether they visit)."""
    groups, raw = groups_of(bits), fp.view(np.uint64)
    for g, (a, z) in enumerate(groups):
        axes = range(a, z, SEGMENT)
        counts = np.stack([np.bitwise_count((raw >> np.uint64(s)) & np.uint64((1 << SEGMENT) - 1)) for s in axes], axis=1).astype(np.int64)
        place = (SEGMENT + 1) ** np.arange(len(axes), dtype=np.int64)
        cell = (counts @ place) * len(groups) + g
        yield cell, np.arange(len(fp)), False
        for k in range(len(axes)):
            can = np.flatnonzero(counts[:, k] < SEGMENT)
            yield cell[can] + place[k] * len(groups), can, True


def cell_rows(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """Rows (cell, visitor, fp): each fingerprint at home in its cell of every group, and a visitor one step up each axis.

    So two fingerprints in one cell, or in cells one step apart, meet in exactly one cell of a group.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in tidy(batches):
            fp = batch["fp"].to_numpy(np.int64)
            for lo in range(0, len(fp), 20_000):
                part = fp[lo : lo + 20_000]
                for cell, which, visitor in _cells(part, bits):
                    yield pd.DataFrame({"cell": cell, "visitor": visitor, "fp": part[which]})

    return prints.select("fp").mapInPandas(run, "cell long, visitor boolean, fp long")


def crowded(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """Cells that need more than one task: cell, homes, guests, into how many parts each side is split.

    A part of each side is bounded, and every part at home meets every part of the guests. Where the home side is split, its
    rows are guests too. There are never more rows than the grid has cells, whatever the corpus.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in tidy(batches):
            fp = batch["fp"].to_numpy(np.int64)
            for lo in range(0, len(fp), 100_000):
                for cell, _, visitor in _cells(fp[lo : lo + 100_000], bits):
                    at, n = np.unique(cell, return_counts=True)
                    yield pd.DataFrame({"cell": at, "h": 0 if visitor else n, "v": n if visitor else 0})

    counts = prints.select("fp").mapInPandas(run, "cell long, h long, v long").groupBy("cell").agg(F.sum("h").alias("h"), F.sum("v").alias("v"))
    homes = F.ceil(F.col("h") / CELL_ROWS)
    guests = F.ceil((F.col("v") + F.when(homes > 1, F.col("h")).otherwise(0)) / (4 * CELL_ROWS))
    return counts.where("h > 0").select("cell", homes.alias("homes"), F.greatest(F.lit(1), guests).alias("guests")).where("homes > 1 or guests > 1")


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components of pairs as links from each node to the least of its component: as many links as nodes at most."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        np.minimum.at(new, label[u], least)
        np.minimum.at(new, label[v], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = label != np.arange(len(nodes))
    return nodes[far], nodes[label[far]]


def _compare(frame: pd.DataFrame, bits: int) -> Iterator[pd.DataFrame]:
    """Links within whole blocks; rows are sorted by cell and block, those at home first."""
    cell, block = frame["cell"].to_numpy(np.int64), frame["block"].to_numpy(np.int64)
    visitor, fp = frame["visitor"].to_numpy(bool), frame["fp"].to_numpy(np.int64)
    edge = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (block[1:] != block[:-1]), [True]]))
    home = np.add.reduceat((~visitor).astype(np.int64), edge[:-1])
    begin, size = edge[:-1], np.diff(edge)
    busy = (home > 0) & (size > 1)
    begin, size, home = begin[busy], size[busy], home[busy]
    raw = fp.view(np.uint64)
    rows = np.repeat(np.arange(len(begin)), home)  # each fingerprint at home meets all that come after it in its cell
    own = np.arange(len(rows)) - np.repeat(np.cumsum(home) - home, home)
    left = begin[rows] + own
    count = size[rows] - own - 1
    sums = np.cumsum(count)
    lo = 0
    while lo < len(left):
        hi = max(lo + 1, int(np.searchsorted(sums, (sums[lo - 1] if lo else 0) + PAIRS, "right")))
        n = count[lo:hi]
        a = np.repeat(left[lo:hi], n)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        near = np.bitwise_count(raw[a] ^ raw[b]) <= bits
        if near.any():
            u, v = _stars(fp[a[near]], fp[b[near]])
            yield pd.DataFrame({"a": u, "b": v})
        lo = hi


def links(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` of a written table, enough to connect all that differ in at most
    ``bits`` bits.

    Cells are dealt to tasks by key, the crowded ones in blocks of bounded size; a task compares whole blocks and emits no
    more links than a block has fingerprints.
    """
    cells = sum((SEGMENT + 1) ** ((z - a) // SEGMENT) for a, z in groups_of(bits))
    hot = crowded(prints, bits)
    met = cell_rows(prints, bits).join(F.broadcast(hot) if cells * 64 <= BROADCAST_BYTES else hot, "cell", "left")
    many = met.withColumn("homes", F.coalesce("homes", F.lit(1))).withColumn("guests", F.coalesce("guests", F.lit(1)))
    h, g = F.pmod(F.xxhash64("fp"), "homes"), F.pmod(F.xxhash64("fp", F.lit(1)), "guests")
    at_home = F.transform(F.sequence(F.lit(0).cast("long"), F.col("guests") - 1), lambda j: F.struct((h * F.col("guests") + j).alias("block"), F.lit(False).alias("visitor")))
    as_guest = F.transform(F.sequence(F.lit(0).cast("long"), F.col("homes") - 1), lambda i: F.struct((i * F.col("guests") + g).alias("block"), F.lit(True).alias("visitor")))
    to = F.when(F.col("visitor"), as_guest).when(F.col("homes") > 1, F.concat(at_home, as_guest)).otherwise(at_home)
    placed = many.select("cell", "fp", F.explode(to).alias("to")).select("cell", "to.block", "to.visitor", "fp")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows = 0
        for batch in tidy(batches):
            held.append(batch)
            rows += len(batch)
            if rows >= 100_000:
                frame = pd.concat(held, ignore_index=True)
                same = ((frame["cell"] == frame["cell"].iloc[-1]) & (frame["block"] == frame["block"].iloc[-1])).to_numpy()
                if not same.all():
                    yield from _compare(frame[~same], bits)
                held, rows = [frame[same]], 0
        if held and len(frame := pd.concat(held, ignore_index=True)):
            yield from _compare(frame, bits)

    return placed.repartition("cell", "block").sortWithinPartitions("cell", "block", "visitor").mapInPandas(run, "a long, b long")


def classes(table: DataFrame, bits: int = BITS) -> DataFrame:
    """``table`` (doc_id, fp, any others; a written table) with component_id: the smallest doc_id reachable by links.

    Documents link when their fingerprints differ in at most ``bits`` bits. Equal fingerprints are collapsed first, so
    copies cost one row each and are never paired. A null doc_id is never the smallest unless all are null.
    """
    prints = cut(table.groupBy("fp").agg(F.min("doc_id").alias("_first")))
    parts = cut(components(links(prints, bits)).select(F.col("node").alias("fp"), "component"))
    joined = prints.join(parts, "fp", "left").withColumn("_class", F.coalesce("component", "fp"))
    linked = joined.where("component is not null")
    least = linked.groupBy("_class").agg(F.min("_first").alias("component_id"))
    named = linked.join(least, "_class").select("fp", "component_id").union(joined.where("component is null").select("fp", F.col("_first").alias("component_id")))
    return table.join(named, "fp")


def near_duplicates(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """doc_id, fp (fingerprint as a long) and component_id of every row of ``docs`` (doc_id, text).

    Whole texts are shingled; null and wordless texts have fingerprint 0, which links like any other; fewer words than a
    shingle form one. Repeated rows are rows of their own in the same class. An empty table stays empty.
    """
    table = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprints(words)(F.col("text").cast("string")).alias("fp")))
    return classes(table, bits).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` without all but one of each class: the one with the smallest doc_id, one of them if rows repeat.

    Rows are written once with their fingerprint and a number; what goes is left out by number.
    """
    held = cut(docs.select(F.struct("*").alias("row"), fingerprints(words)(F.col("text").cast("string")).alias("fp"), F.monotonically_increasing_id().alias("at")))
    named = cut(classes(held.select(F.col("row.doc_id").cast("long").alias("doc_id"), "fp", "at"), bits))
    # a class is named by its least doc_id; classes without any id are told apart by fingerprint
    key = [F.col("component_id").isNull().alias("none"), F.coalesce("component_id", "fp").alias("name")]
    firsts = named.select(*key, F.struct(F.col("doc_id").isNull(), "doc_id", "at").alias("who")).groupBy("none", "name").agg(F.min("who").alias("who"))
    gone = cut(named.select("at").join(firsts.select("who.at"), "at", "left_anti"))
    return held.join(size_checked(gone, gone.count(), 16), "at", "left_anti").select("row.*")

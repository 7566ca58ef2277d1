"""Alignment of two tokenizers' tokens of the same text, by diagonal run skipping.

Both sides are arrays of byte offsets at which tokens end. Where they end together a group closes. Long stretches agree token
by token at a constant shift between the two indexes, so slices of doubling size are compared at the current shift and jumped
over whole; the first disagreement opens an irregular group, which is walked to the next common end and sets a new shift.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import slices, small_batches, tidy
from lexiloom.llm.packing import encoding, plain_ids
from lexiloom.session import cut

FREQUENT = 1 << 20  # id pairs whose counts are broadcast, 16 bytes each; the rest are joined
WIDE = 4_096  # links of a group up to which they are written out one by one before they are counted
DIGITS = 7  # room for a decimal id and the mark after it
PROBE = 4  # tokens that are compared first in a run
SHIFT = 32  # an id pair is one number: A's id above these bits, B's below

_SIDES: dict[str, Side] = {}
_PIECES: dict[str, object] = {}


class Side:
    """A tokenizer's ids: their bytes, the lengths of these, and their decimal digits."""

    def __init__(self, parts: list[bytes]):
        self.parts, self.lengths = parts, np.array([len(p) for p in parts], np.int64)
        names = [str(i).encode() for i in range(len(parts))]
        self.widths = np.array([len(x) for x in names], np.int64)
        self.digits = np.frombuffer(b"".join(x.ljust(DIGITS) for x in names), np.uint8).reshape(-1, DIGITS)

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.parts.__getitem__, ids))


def side_a(path: str) -> Side:
    """Ids of a byte-level BPE file; special ids have no bytes."""
    if path not in _SIDES:
        enc, special = encoding(path)
        ids = {enc._mergeable_ranks[b]: b for b in enc._mergeable_ranks}
        _SIDES[path] = Side([ids.get(i, b"") for i in range(max([*ids, *special.values()]) + 1)])
    return _SIDES[path]


def processor(path: str):
    if path not in _PIECES:
        import sentencepiece

        _PIECES[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _PIECES[path]


def side_b(path: str) -> Side:
    """Ids of a piece model: U+2581 is a blank, ``<0xHH>`` is one byte."""
    if path not in _SIDES:
        model = processor(path)
        _SIDES[path] = Side([
            bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(model.get_piece_size())
        ])
    return _SIDES[path]


def common_ends(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Numbers of tokens of each side up to each common end, given the sides' token ends (ascending, the last ones equal)."""
    cuts_a, cuts_b = group_cuts(a, b)
    return cuts_a.tolist(), cuts_b.tolist()


def group_cuts(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """``common_ends`` as arrays."""
    i = j = 0
    n = len(a)
    starts: list[int] = []
    stops: list[int] = []
    shifts: list[int] = []
    while i < n:
        x, y = a[i], b[j]
        while x != y:  # an irregular group, up to the next common end; it sets the shift
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        shift = j - i
        starts.append(i)
        shifts.append(shift)
        k = i + PROBE
        while i < n and a[i] == b[j]:  # most runs are short; a longer one is probed ahead in doubled steps
            i += 1
            j += 1
            if i == k:
                k = PROBE
                while i < n and a[i : i + k] == b[i + shift : i + shift + k]:
                    i = min(i + k, n)
                    k *= 2
                while k > 1:  # close in on the end of the run
                    k //= 2
                    if i + k <= n and a[i : i + k] == b[i + shift : i + shift + k]:
                        i += k
                j = i + shift
                break
        stops.append(i)
    first = np.array(starts, np.int64)
    size = np.array(stops, np.int64) - first
    ends = np.arange(1, int(size.sum()) + 1) + np.repeat(first - np.cumsum(size) + size, size)
    return ends, ends + np.repeat(np.array(shifts, np.int64), size)


class Aligned:
    """Ids of both sides and, for each group, how many ids of each side there are up to its end."""

    def __init__(self, a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray):
        self.a, self.b = a.astype(np.int64), b.astype(np.int64)
        self.cuts_a, self.cuts_b = np.asarray(cuts_a, np.int64), np.asarray(cuts_b, np.int64)
        self.p, self.q = np.diff(self.cuts_a, prepend=0), np.diff(self.cuts_b, prepend=0)

    def groups(self, side_a: Side, side_b: Side) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: ids of each group, empty without groups."""
        n = len(self.a) + len(self.b)
        if not n:
            return b""
        at_a = np.arange(len(self.a)) + np.repeat(self.cuts_b - self.q, self.p)  # places in the order of the result
        at_b = np.arange(len(self.b)) + np.repeat(self.cuts_a, self.q)
        cells, width, mark = np.empty((n, DIGITS), np.uint8), np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
        for side, ids, at in ((side_a, self.a, at_a), (side_b, self.b, at_b)):
            cells[at], width[at] = side.digits[ids], side.widths[ids]
        mark[at_a[self.cuts_a - 1]], mark[at_b[self.cuts_b - 1]] = ord("|"), ord(";")
        cells[np.arange(n), width] = mark
        return cells[np.arange(DIGITS) <= width[:, None]].tobytes()[:-1]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct id pairs that share a group, ascending, and how often they do."""
        p, q = self.p, self.q
        area = p * q
        single = area == 1
        small = np.flatnonzero(~single & (area <= WIDE))
        size = area[small]
        group = np.repeat(small, size)
        nth = np.arange(len(group)) - np.repeat(np.cumsum(size) - size, size)
        first_a, first_b = self.cuts_a - p, self.cuts_b - q
        keys = np.concatenate([
            self.a[first_a[single]] << SHIFT | self.b[first_b[single]],
            self.a[first_a[group] + nth // q[group]] << SHIFT | self.b[first_b[group] + nth % q[group]],
        ])
        found, times = np.unique(keys, return_counts=True)
        wide = np.flatnonzero(area > WIDE)
        if not len(wide):
            return found, times
        keys, counts = [found], [times]
        for g in wide:  # equal ids are counted first: a wide group of few different ids stays small
            xs, nx = np.unique(self.a[first_a[g] : self.cuts_a[g]], return_counts=True)
            ys, ny = np.unique(self.b[first_b[g] : self.cuts_b[g]], return_counts=True)
            keys.append((xs[:, None] << SHIFT | ys).ravel())
            counts.append((nx[:, None] * ny).ravel())
        found, at = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.zeros(len(found), np.int64)
        np.add.at(sums, at, np.concatenate(counts))
        return found, sums


NOTHING = Aligned(*[np.zeros(0, np.int64)] * 4)


def align_texts(texts: list[str | None], path_a: str, path_b: str) -> Iterator[Aligned]:
    """Alignment of each text; texts that are null or empty, or that a side does not give back byte for byte, have no tokens."""
    left, right, model = side_a(path_a), side_b(path_b), processor(path_b)
    for text in texts:
        if not text:
            yield NOTHING
            continue
        a, pieces = plain_ids(" " + text, path_a), model.encode(text)
        whole = (" " + text).encode("utf-8", "surrogatepass")
        b, ends_a = np.array(pieces, np.int64), np.cumsum(left.lengths[a])
        # byte-level merges can lose bytes but not change them, so their number is enough; pieces may stand for other bytes
        if ends_a[-1] != len(whole) or right.joined(pieces) != whole:
            yield NOTHING
            continue
        yield Aligned(a, b, *group_cuts(ends_a.tolist(), np.cumsum(right.lengths[b]).tolist()))


def _sent(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Tokens and groups of every row of ``docs`` (doc_id, text; further columns are ignored): doc_id, a_ids, b_ids, a_cuts, b_cuts.

    A is the byte-level BPE file ``path_a`` on a blank and the text, B the piece model ``path_b`` on the text, to which it adds
    the blank; strings of special tokens are plain text. Group k holds A's ids from ``a_cuts[k - 1]`` to ``a_cuts[k]``, B's
    likewise. A null or empty text, and one that a side does not give back byte for byte, has empty arrays. Repeated rows
    are aligned each; a null doc_id stays null.
    """
    small_batches()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in tidy(batches):
            for lo, hi in slices(batch["text"].tolist(), 1_000_000):
                found = list(align_texts(batch["text"].iloc[lo:hi].tolist(), path_a, path_b))
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[lo:hi].to_numpy(), "a_ids": [x.a for x in found], "b_ids": [x.b for x in found],
                    "a_cuts": [x.cuts_a for x in found], "b_cuts": [x.cuts_b for x in found],
                })

    schema = "doc_id string, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>"
    return _sent(docs).mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def summaries(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The figures of ``align`` per row: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and its distinct id pairs (keys)
    with how often each is linked (times)."""
    small_batches()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in tidy(batches):
            for lo, hi in slices(batch["text"].tolist(), 1_000_000):
                rows, sides = [], (side_a(path_a), side_b(path_b))
                for doc, x in zip(batch["doc_id"].iloc[lo:hi], align_texts(batch["text"].iloc[lo:hi].tolist(), path_a, path_b)):
                    keys, times = x.links()
                    digest = hashlib.sha256(x.groups(*sides)).hexdigest() if len(x.a) else ""
                    rows.append((doc, len(x.a), len(x.b), len(x.cuts_a), int(times.sum()), digest, keys, times))
                yield pd.DataFrame(rows, columns=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "keys", "times"])

    schema = "doc_id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, keys array<long>, times array<long>"
    return _sent(docs).mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def pair_counts(found: DataFrame) -> DataFrame:
    """Of every id pair in ``found`` (keys): key, n (rows that hold it), top (no pair of its A id is in more)."""
    counts = cut(found.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    of_a = F.shiftright("key", SHIFT).alias("a")
    most = counts.groupBy(of_a).agg(F.max("n").alias("most"))  # a row per id of A's vocabulary at most
    return counts.withColumn("a", of_a).join(F.broadcast(most), "a").select("key", "n", (F.col("n") == F.col("most")).alias("top"))


def link_counts(docs: DataFrame, path_a: str, path_b: str, frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``docs`` (see ``align``): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    An id pair's count is the number of rows of ``docs`` that hold it linked, so repeated rows count each. ``n_best`` are the
    links whose count is the highest of their A id, ties included; ``count_sum`` adds the counts of all links. Rows without
    tokens have zeros and an empty ``groups_sha256``. An empty table gives no rows.

    Texts are tokenised once. The pairs of each row, counted, are written; their counts over all rows are summed map-side.
    Counts return to the rows in two ways: of the most frequent pairs, at most ``frequent``, by broadcast, so that no hot pair
    is shuffled; of the rest, of which none is in more than one row in ``frequent`` of all, by a join on the pair.
    """
    spark = docs.sparkSession
    found = cut(summaries(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id()))
    marks = cut(pair_counts(found))
    by_size = {r["e"]: r["c"] for r in marks.groupBy(F.floor(F.log2("n")).cast("int").alias("e")).agg(F.count(F.lit(1)).alias("c")).collect()}
    taken, least = 0, 64  # counts of 2 ** least and more are broadcast
    for e in sorted(by_size, reverse=True):
        if taken + by_size[e] > frequent:
            break
        taken, least = taken + by_size[e], e
    often = F.col("n") >= F.lit(float(2**least))
    table = marks.where(often).orderBy("key").toArrow()  # ``frequent`` rows at most
    shared = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy(zero_copy_only=False) for c in ("key", "n", "top")))

    @F.pandas_udf("n_best long, count_sum long, rare array<long>, times array<long>")
    def look_up(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        known, counts, top = shared.value
        for keys, times in tidy(batches):
            size = keys.map(len).to_numpy()
            key = np.concatenate([*keys, np.zeros(0, np.int64)]).astype(np.int64)
            n = np.concatenate([*times, np.zeros(0, np.int64)]).astype(np.int64)
            owner = np.repeat(np.arange(len(size)), size)
            at = np.minimum(np.searchsorted(known, key), max(len(known) - 1, 0))
            hit = known[at] == key if len(known) else np.zeros(len(key), bool)
            sums = np.zeros((2, len(size)), np.int64)
            np.add.at(sums[0], owner[hit], n[hit] * top[at[hit]])
            np.add.at(sums[1], owner[hit], n[hit] * counts[at[hit]])
            ends = np.cumsum(np.bincount(owner[~hit], minlength=len(size)))[:-1]
            yield pd.DataFrame({
                "n_best": sums[0], "count_sum": sums[1], "rare": np.split(key[~hit], ends) if len(size) else [],
                "times": np.split(n[~hit], ends) if len(size) else [],
            })

    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    known = found.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", look_up("keys", "times").alias("l"))
    if taken == sum(by_size.values()):
        return known.select("doc_id", *[F.col(f"l.{c}").alias(c) if c in ("n_best", "count_sum") else F.col(c) for c in columns])
    known = cut(known)
    rest = known.select("row", F.explode(F.arrays_zip(F.col("l.rare").alias("key"), F.col("l.times").alias("t"))).alias("x")).select("row", "x.key", "x.t")
    more = (
        rest.join(marks.where(~often), "key").groupBy("row")
        .agg(F.sum(F.when(F.col("top"), F.col("t")).otherwise(0)).alias("b"), F.sum(F.col("t") * F.col("n")).alias("s"))
    )
    both = known.join(more, "row", "left").withColumn("n_best", F.col("l.n_best") + F.coalesce("b", F.lit(0)))
    return both.withColumn("count_sum", F.col("l.count_sum") + F.coalesce("s", F.lit(0))).select("doc_id", *columns)

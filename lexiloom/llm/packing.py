"""Best-fit packing of token pieces into fixed sequences, improved by swap-based local search.

Only the histogram of piece lengths decides how lengths combine, and it has at most ``width`` rows whatever the corpus. So
bins are kept as classes, a content (lengths) and how many bins have it, and a move changes all bins of two classes at once.
Classes are first filled best-fit in falling length. Then documents move between underfull bins: one document moves, two
documents exchange, or two exchange for one, always so that the sum of squared fill grows, until bins empty. The resulting
plan, a run of ordinals per length and class, is joined back to the pieces.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import prefix_starts, size_checked, slices, small_batches, tidy
from lexiloom.session import cut

WIDTH = 1024
END_ID = 2
#: The split of a byte-level vocabulary into words, a fixed value of that tokenizer.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

LONG_RUN = 100_000  # blanks
LONG_BLANKS = re.compile(r"(?<!\s)\s{%d}" % LONG_RUN)  # tried at the start of a run only, so the search is linear

_ENCODINGS: dict[str, object] = {}


def encoding(path: str):
    """The byte-level BPE of a ``tokenizers`` file and its special tokens, as a faster equal encoder; read once a process."""
    if path not in _ENCODINGS:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
        rest = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        _ENCODINGS[path] = tiktoken.Encoding("bpe", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special), special
    return _ENCODINGS[path]


def _library(path: str, special: bool):
    """The ``tokenizers`` object of the file; without ``special`` the strings of special tokens are plain text."""
    key = f"{path} {special}"
    if key not in _ENCODINGS:
        from tokenizers import Tokenizer

        lib = Tokenizer.from_file(path)
        lib.encode_special_tokens = not special
        _ENCODINGS[key] = lib
    return _ENCODINGS[key]


def _ids(text: str, path: str, special: bool) -> np.ndarray:
    """Ids of ``text``. The faster encoder cannot split very long runs of blanks; the library, which can, takes those texts."""
    if len(text) >= LONG_RUN and LONG_BLANKS.search(text):
        return np.array(_library(path, special).encode(text, add_special_tokens=False).ids, "<u4")
    enc, names = encoding(path)
    known = {"allowed_special": "all"} if special and any(s in text for s in names) else {"disallowed_special": ()}
    return enc.encode_to_numpy(text, **known).astype("<u4", copy=False)


def plain_ids(text: str, path: str) -> np.ndarray:
    """Ids of ``text`` in which the strings of special tokens are plain text."""
    return _ids(text, path, special=False)


def token_ids(text: str | None, path: str, end_id: int = END_ID) -> np.ndarray:
    """Ids of ``text`` as the tokenizer file gives them, then ``end_id``."""
    if not text:
        return np.array([end_id], "<u4")
    return np.append(_ids(text, path, special=True), np.array([end_id], "<u4"))


def piece_bounds(n: int, width: int) -> list[int]:
    """Cut points of ``n`` ids into pieces of ``width``; of a longer document only the first piece is shorter."""
    return list(range(n % width or width, n + 1, width)) if n > width else [n]


def pieces(docs: DataFrame, tokenizer: str, width: int = WIDTH, end_id: int = END_ID) -> DataFrame:
    """Tokenise ``docs`` (doc_id, text; further columns are ignored) into pieces of at most ``width`` ids.

    Returns doc_id, piece (from 0), start, length, ids (little-endian unsigned 32-bit integers), and part and nth: the
    pieces of one length are numbered inside each input task. A null text counts as empty, so it is one piece holding only
    ``end_id``; a null doc_id stays null; repeated rows are pieces of their own.
    """
    small_batches()
    schema = "doc_id long, piece int, start long, length long, ids binary, part int, nth long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in tidy(batches):
            for lo, hi in slices(list(batch["text"]), 4_000_000):
                out: list[tuple] = []
                for doc, text in zip(batch["doc_id"].iloc[lo:hi], batch["text"].iloc[lo:hi]):
                    ids, start = token_ids(text, tokenizer, end_id), 0
                    for k, stop in enumerate(piece_bounds(len(ids), width)):
                        n = stop - start
                        out.append((doc, k, start, n, ids[start:stop].tobytes(), part, seen[n]))
                        seen[n] += 1
                        start = stop
                frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids", "part", "nth"])
                frame["doc_id"] = frame["doc_id"].astype("Int64")
                yield frame

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(run, schema)


class Bins:
    """Bin classes: content (sorted lengths with counts) -> number of bins."""

    def __init__(self, width: int):
        self.width, self.classes = width, Counter()

    def add(self, content: dict[int, int], n: int) -> None:
        if content and n:
            self.classes[tuple(sorted(content.items()))] += n

    def take(self, key: tuple, n: int) -> None:
        self.classes[key] -= n
        if not self.classes[key]:
            del self.classes[key]

    def count(self) -> int:
        return sum(self.classes.values())


def fill(key: tuple) -> int:
    return sum(size * n for size, n in key)


def best_fit(histogram: dict[int, int], width: int) -> Bins:
    """Best-fit decreasing over classes: each length goes to the open bins with the least room that still hold it."""
    bins, room = Bins(width), {}  # room: residual -> contents with that residual

    def place(content: tuple, count: int, size: int, per: int) -> None:
        more = dict(content)
        more[size] = more.get(size, 0) + per
        key = tuple(sorted(more.items()))
        open_ = room.setdefault(width - fill(key), Counter())
        open_[key] += count

    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        for r in [r for r in sorted(room) if r >= size]:
            if not left:
                break
            for content, count in sorted(room[r].items()):
                per = r // size
                full = min(count, left // per)
                if full:
                    place(content, full, size, per)
                    left -= full * per
                extra = left if full < count and left else 0  # fewer than per: one bin takes them
                if extra:
                    place(content, 1, size, extra)
                    left = 0
                used = full + bool(extra)
                room[r][content] -= used
                if not room[r][content]:
                    del room[r][content]
                if not left:
                    break
            if not room[r]:
                del room[r]
        per = width // size
        if left // per:
            place((), left // per, size, per)
        if left % per:
            place((), 1, size, left % per)
    for contents in room.values():
        for content, count in contents.items():
            bins.classes[content] += count
    return bins


def moves(a: tuple, b: tuple, room: int) -> tuple[int, tuple, tuple] | None:
    """The best exchange that shifts most tokens, at most ``room``, from a bin ``a`` into a bin ``b``: (tokens, out, back).

    ``out`` leaves a and ``back`` leaves b: one for nothing, one for one, two for one or one for two.
    """
    def picks(content: tuple, two: bool) -> list[tuple[int, tuple]]:
        sizes = [s for s, _ in content]
        found = [(s, (s,)) for s in sizes]
        if two:
            have = dict(content)
            found += [(x + y, (x, y)) for x, y in combinations_with_replacement(sizes, 2) if x != y or have[x] > 1]
        return found

    best, empty = None, [(0, ())]
    for outs, backs in ((picks(a, False), empty + picks(b, False)), (picks(a, True), picks(b, False)), (picks(a, False), picks(b, True))):
        back_sizes = np.array([s for s, _ in backs])
        for size, out in outs:
            shift = size - back_sizes
            fits = np.where((shift > 0) & (shift <= room), shift, 0)
            k = int(fits.argmax())
            if fits[k] and (best is None or fits[k] > best[0]):
                best = (int(fits[k]), out, backs[k][1])
        if best and best[0] == room:
            break
    return best


def local_search(bins: Bins, steps: int = 4000) -> Bins:
    """Exchange documents between underfull bins while the sum of squared fill grows.

    The least filled class gives; the fullest classes are tried first as receivers. A class that nothing improves is left
    alone until a class appears that it has not met. Ends when as few bins are left as their tokens need, when no move is
    left, or after ``steps`` moves (the packing is whole at any step).
    """
    width = bins.width
    total = sum(fill(k) * n for k, n in bins.classes.items())
    least = -(-total // width)
    tried: set[tuple] = set()
    for _ in range(steps):
        if bins.count() <= least:
            break
        under = sorted((k for k in bins.classes if fill(k) < width), key=lambda k: (fill(k), k))
        step = None
        for giver in under:
            for taker in reversed(under):
                if fill(taker) < fill(giver) or (giver, taker) in tried:
                    continue
                if taker == giver and bins.classes[giver] < 2:
                    continue
                got = moves(giver, taker, width - fill(taker))
                if got:
                    step = (giver, taker, got)
                    break
                tried.add((giver, taker))
            if step:
                break
        if not step:
            break
        giver, taker, (_, out, back) = step
        n = bins.classes[giver] // 2 if giver == taker else min(bins.classes[giver], bins.classes[taker])
        bins.take(giver, n)
        bins.take(taker, n)
        a, b = Counter(dict(giver)), Counter(dict(taker))
        a.subtract(Counter(out))
        a.update(back)
        b.subtract(Counter(back))
        b.update(out)
        for side in (a, b):
            bins.add({s: c for s, c in side.items() if c}, n)
    return bins


def plan_rows(bins: Bins) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first ordinal, pieces, pieces per bin, first sequence, first offset), one per length of a class."""
    rows, used, sequence = [], Counter(), 0
    for content, n in sorted(bins.classes.items()):
        offset = 0
        for size, per in sorted(content, reverse=True):
            rows.append((size, used[size], n * per, per, sequence, offset))
            used[size] += n * per
            offset += size * per
        sequence += n
    return rows


def pack(table: DataFrame, width: int = WIDTH, steps: int = 4000) -> DataFrame:
    """Place every row of ``table`` in a sequence: all its columns but part and nth, and sequence_id, offset.

    ``table`` is a written table of ``pieces`` (length, part, nth; any other columns). Sequences are numbered from 0 without
    gaps and offsets inside one are gapless from 0. Pieces of the same length are interchangeable, so ties cost nothing. An
    empty table gives no rows. A length over ``width`` is an error.
    """
    spark = table.sparkSession
    counts = cut(table.groupBy("length", "part").agg(F.count(F.lit(1)).alias("_n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # width rows at most
    if histogram and not 0 < min(histogram) <= max(histogram) <= width:
        raise ValueError(f"lengths are 1 to {width}")
    runs = spark.createDataFrame(
        plan_rows(local_search(best_fit(histogram, width), steps)), "length long, _first long, _many long, _per long, _seq long, _off long"
    )
    starts = prefix_starts(counts, ["length"], "part", "_n", "_start").drop("_n")
    ordered = table.join(size_checked(starts, counts.count(), 24), ["length", "part"]).withColumn("_at", F.col("_start") + F.col("nth"))
    inside = F.col("_at") - F.col("_first")
    placed = ordered.join(F.broadcast(runs), "length").where((inside >= 0) & (inside < F.col("_many")))  # a run per length and class
    placed = placed.withColumn("sequence_id", F.col("_seq") + F.floor(inside / F.col("_per")).cast("long"))
    placed = placed.withColumn("offset", F.col("_off") + (inside % F.col("_per")) * F.col("length"))
    return placed.select(*[c for c in table.columns if c not in ("part", "nth")], "sequence_id", "offset")


def fewest(histogram: dict[int, int], width: int) -> int:
    """Sequences that the tokens alone need."""
    return -(-sum(s * n for s, n in histogram.items()) // width)

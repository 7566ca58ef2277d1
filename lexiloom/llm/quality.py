"""Quality of documents: an isolation forest over rule statistics, with a threshold calibrated from labelled rows.

Words, symbols, repeated lines and repeated passages of a text are counted exactly. The forest sees ratios of such counts:
random splits part unusual documents from the rest early, so a short mean path means an anomaly. How short is too short is
read from the scores of all labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import size_checked, slices, small_batches, tidy
from lexiloom.session import cut

SPAN = 8  # words of a window whose repetition counts
FEW_WORDS = 20
REPEAT_PERCENT = 30
TREES = 100
SUBSAMPLE = 256  # rows that a tree is grown from; TREES * SUBSAMPLE bounds the rows that the forest is grown from
BINS = 2_000  # of the scores, for the threshold
CLEAN_WEIGHT = 4.0  # losing all clean documents counts as so many times keeping all bad ones
#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Mean length of words, symbols a word (1 at most), words in repeated passages, distinct words by the root of all, share of
#: letters and digits in the words, share of lines with a sentence's end.
FEATURES = ("word_length", "symbols", "repeats", "distinct", "alphanumeric", "line_ends")


def letter_classes() -> np.ndarray:
    """By code point: 1 a letter or digit, 4 a symbol, 8 a word character (not blank); a code point may have several."""
    if not hasattr(letter_classes, "table"):
        table = np.full(0x110000, 8, np.uint8)
        table[[0x20, *range(0x09, 0x0E)]] = 0
        for p in range(0x30000):
            if chr(p).isalnum():
                table[p] |= 1
        table[[ord(c) for c in SYMBOLS]] |= 4
        letter_classes.table = table
    return letter_classes.table


def repeated(ids: np.ndarray, doc: np.ndarray, n_docs: int, span: int = SPAN) -> np.ndarray:
    """Words of each document in windows of ``span`` words that the document holds twice or more, the first included.

    ``ids`` numbers the words, ``doc`` (ascending) says whose they are. Windows are compared exactly: equal pairs of windows
    of half the length get equal numbers, doubling from single words on.
    """
    n = len(ids)
    if n < span:
        return np.zeros(n_docs, np.int64)
    level, length = ids.astype(np.int64), 1
    while length < span:
        left, right = level[: n - 2 * length + 1], level[length : n - length + 1]
        level = np.unique(left * (int(level.max()) + 1) + right, return_inverse=True)[1]
        length *= 2
    first, last = doc[: n - span + 1], doc[span - 1 :]
    at = np.flatnonzero(first == last)
    if not len(at):
        return np.zeros(n_docs, np.int64)
    _, group, size = np.unique(level[at] * np.int64(n_docs) + first[at], return_inverse=True, return_counts=True)
    starts = at[size[group] > 1]
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + span, -1)
    return np.bincount(doc, weights=np.cumsum(change[:n]) > 0, minlength=n_docs).astype(np.int64)


def measure(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Counts (documents x COUNTS) and features (documents x FEATURES) of ``texts``."""
    n = len(texts)
    counts, features = np.zeros((n, len(COUNTS)), np.int64), np.zeros((n, len(FEATURES)))
    number: dict[bytes, int] = {}
    words_of, ids, lines_with, ended, distinct = np.zeros(n, np.int64), [], np.ones(n), np.zeros(n), np.zeros(n)
    for i, text in enumerate(texts):
        if not text:
            continue
        words = text.encode("utf-8", "surrogatepass").split()  # bytes are split at exactly the six blanks
        own = [number.setdefault(w, len(number)) for w in words]
        ids.append(np.array(own, np.int64))
        words_of[i], distinct[i] = len(words), len(set(own))
        seen, spoken = set(), 0
        for line in text.split("\n"):
            if body := line.rstrip(" \t\n\x0b\x0c\r"):
                spoken += 1
                ended[i] += body[-1] in ".!?"
                if line in seen:
                    counts[i, 3] += 1
                seen.add(line)
        lines_with[i] = max(1, spoken)
    doc = np.repeat(np.arange(n), words_of)
    counts[:, 0] = words_of
    if ids:
        counts[:, 4] = repeated(np.concatenate(ids), doc, n)
    lengths = np.array([len(t) if t else 0 for t in texts], np.int64)
    codes = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds, owner = letter_classes()[codes], np.repeat(np.arange(n), lengths)

    def having(bit: int) -> np.ndarray:
        return np.bincount(owner[(kinds & bit) > 0], minlength=n)

    counts[:, 1], counts[:, 2] = having(8), having(4)
    n_words, chars = np.maximum(counts[:, 0], 1), np.maximum(counts[:, 1], 1)
    features[:, 0] = counts[:, 1] / n_words
    features[:, 1] = np.minimum(counts[:, 2] / n_words, 1)
    features[:, 2] = counts[:, 4] / n_words
    features[:, 3] = distinct / np.sqrt(n_words)
    features[:, 4] = having(1) / chars
    features[:, 5] = ended / lines_with
    return counts, features


def statistics(docs: DataFrame) -> DataFrame:
    """Rule statistics of every row of ``docs`` (doc_id, text; further columns are ignored): doc_id, COUNTS, features.

    A null text counts as empty and has zeros. Whole texts are read, in slices bounded by characters.
    """
    small_batches()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in tidy(batches):
            texts = batch["text"].tolist()
            for lo, hi in slices(texts, 2_000_000):
                counts, features = measure(texts[lo:hi])
                frame = pd.DataFrame(counts, columns=COUNTS)
                frame.insert(0, "doc_id", batch["doc_id"].iloc[lo:hi].to_numpy())
                frame["features"] = list(features)
                yield frame

    sent = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id string, " + ", ".join(f"{c} long" for c in COUNTS) + ", features array<double>"
    return sent.mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


@dataclass
class Forest:
    """Trees as arrays over nodes in level order: a node's children are 2k + 1 and 2k + 2; a leaf's feature is -1."""

    feature: np.ndarray  # trees x nodes
    split: np.ndarray
    length: np.ndarray  # path length to a leaf, with the expected rest of its rows
    expected: float  # mean path length in a tree of as many rows, which scores 0.5

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly of each row, between 0 and 1; without trees 0."""
        if not len(self.feature) or not len(x):
            return np.zeros(len(x))
        total = np.zeros(len(x))
        depth = (self.feature.shape[1] + 1).bit_length() - 2
        rows = np.arange(len(x))
        for feature, split, length in zip(self.feature, self.split, self.length):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                f = feature[node]
                down = 2 * node + 1 + (x[rows, np.maximum(f, 0)] >= split[node])
                node = np.where(f >= 0, down, node)
            total += length[node]
        return np.exp2(-total / len(self.feature) / self.expected)


def mean_path(n: int) -> float:
    """Expected path length of an unsuccessful search in a random binary tree of ``n`` rows."""
    if n < 2:
        return 0.0
    return 2 * float(np.sum(1 / np.arange(1, n))) - 2 * (n - 1) / n


def grow(x: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 7) -> Forest:
    """Isolation trees of ``subsample`` rows of ``x`` each (all, if fewer), to a depth of its logarithm."""
    rng = np.random.default_rng(seed)
    size = min(subsample, len(x))
    if size < 2:
        return Forest(np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 1)), 1.0)
    depth = int(np.ceil(np.log2(size)))
    nodes = 2 ** (depth + 1) - 1
    feature, split, length = np.full((trees, nodes), -1, np.int64), np.zeros((trees, nodes)), np.zeros((trees, nodes))
    for t in range(trees):
        todo = [(0, rng.choice(len(x), size, replace=False), 0)]
        while todo:
            node, rows, level = todo.pop()
            part = x[rows]
            low, high = part.min(axis=0), part.max(axis=0)
            open_ = np.flatnonzero(high > low)
            if level == depth or len(rows) < 2 or not len(open_):
                length[t, node] = level + mean_path(len(rows))
                continue
            f = int(rng.choice(open_))
            at = low[f] + (high[f] - low[f]) * (1 - rng.random())  # in (low, high]: both sides get rows
            right = part[:, f] >= at
            feature[t, node], split[t, node] = f, at
            todo += [(2 * node + 1, rows[~right], level + 1), (2 * node + 2, rows[right], level + 1)]
    return Forest(feature, split, length, mean_path(size))


def fit(stats: DataFrame, trees: int = TREES, subsample: int = SUBSAMPLE) -> Forest:
    """Grow a forest from about ``trees * subsample`` rows of ``stats``, picked by a hash of their features, equal rows once.

    The sample is bounded by that product whatever the table, and spread evenly over it; a text with very many copies is one
    row of it.
    """
    most = trees * subsample
    keyed = stats.select("features", F.xxhash64("features").alias("h"))
    total = keyed.agg(F.approx_count_distinct("h")).first()[0]
    if total > most:
        keyed = keyed.where(F.pmod(F.xxhash64(F.lit(1), "h"), F.lit(1 << 30)) < int((1 << 30) * most / total))
    rows = keyed.groupBy("h").agg(F.first("features").alias("features")).orderBy("h").collect()  # about ``most``
    return grow(np.array([r["features"] for r in rows]).reshape(len(rows), len(FEATURES)), trees, subsample)


def scored(stats: DataFrame, forest: Forest) -> DataFrame:
    """``stats`` with ``score``, the anomaly of each row."""
    shared = stats.sparkSession.sparkContext.broadcast(forest)  # trees * 4 * subsample numbers at most

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.array(batch.tolist(), np.float64).reshape(len(batch), -1)
            yield pd.Series(shared.value.scores(x))

    return stats.withColumn("score", score("features"))


def threshold(counts: dict[tuple[int, int], int], bins: int = BINS, clean_weight: float = CLEAN_WEIGHT) -> float:
    """The score from which a document is bad, from ``counts`` of (bin of the score, quality) -> documents.

    It gives the least share of bad documents kept plus ``clean_weight`` times the share of clean ones lost; equal choices take
    the highest. Without labels of both kinds nothing is bad.
    """
    good, bad = np.zeros(bins + 1), np.zeros(bins + 1)
    for (at, quality), n in counts.items():
        (good if quality else bad)[at] += n
    if not good.sum() or not bad.sum():
        return np.inf
    lost = np.append(np.cumsum(good[::-1])[::-1], 0) / good.sum()
    left = np.append(0, np.cumsum(bad)) / bad.sum()
    cost = left + clean_weight * lost
    return float(np.flatnonzero(cost <= cost.min() + 1e-12).max()) / bins


def base_failed() -> F.Column:
    """The plain rule: too few words, or too many of them in repeated passages."""
    return (F.col("n_words") < FEW_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, trees: int = TREES, subsample: int = SUBSAMPLE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, COUNTS, base_failed, score, kept.

    ``labels`` (doc_id, quality 0 or 1) calibrates the threshold: the scores of all labelled documents that pass the plain rule
    are counted by bin and quality, and the best cut is taken. Rows with null ids or quality say nothing; a document with both
    labels counts for both. A document that fails the plain rule is not kept; of the rest those are kept that score below
    the threshold. A null or empty text has no words and fails. Without labels of both kinds only the plain rule decides.

    Texts are read once; their statistics are written, and the forest, the calibration and the verdict read those.
    """
    stats = cut(statistics(docs))
    rated = scored(stats, fit(stats, trees, subsample))
    known = labels.where("doc_id is not null and quality is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") != 0).cast("int").alias("quality")
    ).distinct()
    passing = rated.where(~base_failed()).select("doc_id", F.floor(F.col("score") * BINS).cast("int").alias("bin"))
    found = passing.join(size_checked(known, known.count(), 16), "doc_id").groupBy("bin", "quality").count().collect()  # 2 * BINS rows at most
    limit = threshold({(r["bin"], r["quality"]): r["count"] for r in found})
    return rated.select(
        "doc_id", *COUNTS, base_failed().alias("base_failed"), "score",
        (~base_failed() & (F.floor(F.col("score") * BINS) / BINS < F.lit(limit))).alias("kept"),
    )

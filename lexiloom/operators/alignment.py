"""Mapping one vector space onto another: Procrustes, CCA, entropic transport, self-learning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.vectors import l2_normalize
from lexiloom.operators.common import (
    PACKED, add_blocks, blocks, lookup, lowest, meet, ordinal, outer_sum, table_bytes, tiles, vector_shape,
)
from lexiloom.operators.similarity import nearest, packed_units, vector_bytes, with_vectors
from lexiloom.session import cut, discard, small_batches

SLOW = 0.5  # a round that leaves more of the error than this hardly moves
EVEN_STEPS = 10  # steps to even potentials, at most


def training_pairs(pairs: DataFrame, src: DataFrame, tgt: DataFrame) -> DataFrame:
    """Pairs with both words known, with their vectors ``x`` and ``y``; repeated pairs are kept."""
    return with_vectors(with_vectors(pairs, src, "src", "x"), tgt, "tgt", "y")


def dim_check(src: DataFrame, tgt: DataFrame) -> int:
    """The common dimension; different ones are an error."""
    (_, a), (_, b) = vector_shape(src), vector_shape(tgt)
    if a != b:
        raise ValueError(f"embedding dimensions differ: {a} and {b}")
    return a


def required_words(pairs: DataFrame, gold: DataFrame) -> DataFrame:
    """Distinct target words of the dictionary and of the gold set."""
    return pairs.select(F.col("tgt").alias("word")).union(gold.select("tgt")).distinct()


def filter_vocab(vectors: DataFrame, required: DataFrame, max_words: int) -> DataFrame:
    """Required words first, then file order, ``max_words`` in all; vectors are (word, vec, pos).

    A repeated required word takes its last vector, any other word its first. Only words and places are put in order; the vectors
    of the words that stay are looked up afterwards.
    """
    vectors = vectors.select("word", "vec", "pos")
    marked = lookup(vectors.select("word", "pos"), required.select("word").distinct().withColumn("required", F.lit(True)), ["word"],
                    "left", small_bytes=table_bytes(required, "word"))
    needed = F.coalesce(F.bool_or("required"), F.lit(False))
    one = marked.groupBy("word").agg(needed.alias("_needed"), F.min("pos").alias("_pos"), F.max("pos").alias("_last"))
    order = [F.when(F.col("_needed"), 0).otherwise(1), F.col("_pos"), F.col("word")]
    kept = cut(ordinal(one, order, "place").filter(F.col("place") < max_words).select(
        "word", "place", F.when(F.col("_needed"), F.col("_last")).otherwise(F.col("_pos")).alias("_at")
    ))
    size = table_bytes(kept.select(F.col("word").cast("string").alias("word")), "word", overhead=256)
    found = lookup(vectors, kept, ["word"], small_bytes=size).filter(F.col("pos") == F.col("_at"))
    return found.dropDuplicates(["word"]).select("word", "vec", "place")


def procrustes(train: DataFrame) -> np.ndarray:
    """Orthogonal R minimising the distance of x R to y, from the d x d sum of x y^T."""
    u, _, vt = np.linalg.svd(outer_sum(train, "x", "y"))
    return u @ vt


def apply_map(vectors: DataFrame, r: np.ndarray, shift: np.ndarray | None = None) -> DataFrame:
    """Multiply every vector by ``r``, batch by batch, after subtracting ``shift``."""
    def turn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                m = np.stack(batch["vec"])
                yield pd.DataFrame({"word": batch["word"], "vec": list((m if shift is None else m - shift) @ r)})

    word = vectors.schema["word"].dataType.simpleString()
    return vectors.select("word", "vec").mapInPandas(turn, f"word {word}, vec array<double>")


def align_procrustes(pairs: DataFrame, src: DataFrame, tgt: DataFrame) -> tuple[DataFrame, np.ndarray]:
    dim_check(src, tgt)
    r = procrustes(training_pairs(pairs, src, tgt))
    return apply_map(src, r), r


def cca_map(train: DataFrame, n_components: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(source mean, source projection, correlations) of canonical correlation analysis.

    All moments come from one sum of outer products of the joined vector (1, x, y); only that small matrix is
    solved on the driver. Scores have unit variance.
    """
    joined = train.select(F.concat(F.array(F.lit(1.0)), "x", "y").alias("z"), F.size("x").alias("d"))
    d = joined.first()["d"]
    s = outer_sum(joined, "z", "z")
    n, mean = s[0, 0], s[0, 1:] / s[0, 0]
    cov = (s[1:, 1:] - n * np.outer(mean, mean)) / max(n - 1, 1)

    def whiten(c: np.ndarray) -> np.ndarray:
        values, vectors = np.linalg.eigh(c)
        keep = values > max(values.max(), 0) * 1e-12
        return vectors[:, keep] / np.sqrt(values[keep])

    wx, wy = whiten(cov[:d, :d]), whiten(cov[d:, d:])
    u, corr, _ = np.linalg.svd(wx.T @ cov[:d, d:] @ wy, full_matrices=False)
    k = min(n_components or min(d, len(mean) - d), u.shape[1])
    return mean[:d], wx @ u[:, :k], corr[:k]


def align_cca(pairs: DataFrame, src: DataFrame, tgt: DataFrame, n_components: int | None = None) -> tuple[DataFrame, np.ndarray]:
    """Canonical scores of every source vector, and the canonical correlations."""
    mean, projection, corr = cca_map(training_pairs(pairs, src, tgt), n_components)
    return apply_map(src, projection, mean), corr


def pair_sample(pairs: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` pairs without replacement, the same ones on every run: lowest digests of seed and words."""
    digest = F.md5(F.concat_ws("\t", F.lit(str(seed)), F.col("src").cast("string"), F.col("tgt").cast("string")))
    key = F.conv(F.substring("_h", 1, 15), 16, 10).cast("long")
    return lowest(pairs.withColumn("_h", digest), n, key, [F.col("_h"), F.col("src"), F.col("tgt")]).drop("_h")


STATE = "blk int, v array<double>"  # potentials of a block, in the block's order


def _bordered(x: np.ndarray, *columns: np.ndarray | float) -> np.ndarray:
    """``x`` with further columns, so that a matrix product adds potentials to cosines."""
    return np.column_stack([x, *(np.broadcast_to(c, len(x)) for c in columns)])


def _log_sum(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Per row of ``x``: log of the sum of exp over its products with the rows of ``y``, some hundred rows at a time."""
    out = np.empty(len(x))
    for rows in tiles(len(x)):
        m = x[rows] @ y.T
        top = m.max(axis=1)
        m -= top[:, None]
        out[rows] = top + np.log(np.exp(m, out=m).sum(axis=1))
    return out


def _summed(parts: Iterator[tuple[int, np.ndarray]], add: np.ufunc) -> Iterator[tuple[int, np.ndarray]]:
    """Neighbouring parts of one block as one."""
    current, total = None, None
    for blk, v in parts:
        if blk == current:
            total = add(total, v)
            continue
        if current is not None:
            yield current, total
        current, total = blk, v
    if current is not None:
        yield current, total


class TransportPlan:
    """Entropic transport between the two sides of ``n`` pairs: cost = -cosine, uniform marginals.

    The plan is held as log potentials, one number per pair and side: P_ij = exp(f_i + cos_ij / reg + g_j). The
    n x n matrix is never stored; its blocks are formed inside the tasks that sum over them, a tile at a time. Blocks of vectors
    are packed once, as bytes, which pass to the tasks uncopied.
    """

    def __init__(self, train: DataFrame, reg: float = 0.05, max_iter: int = 1000, tol: float = 1e-9):
        """``train`` is (pid, x, y) with unique ``pid``."""
        small_batches(train.sparkSession)
        self.reg, self.rows = reg, cut(train.select("pid", "x", "y"))
        self.n, self.d = vector_shape(self.rows, "x")
        self._pid = self.rows.schema["pid"].dataType.simpleString()
        unit_x = self.rows.select("pid", l2_normalize(F.col("x")).alias("x"))
        unit_y = self.rows.select(F.col("pid").alias("tpid"), F.concat(l2_normalize(F.col("y")), "y").alias("y"))
        self.left, self.n_left = self._packed(unit_x, "pid", "x", "lblk")
        self.right, self.n_right = self._packed(unit_y, "tpid", "y", "rblk")
        self.f, self.g, self.rounds, self.error = cut(self._start()), None, 0, None
        self._solve(max_iter, tol)

    def _packed(self, vectors: DataFrame, key: str, vec: str, blk: str) -> tuple[DataFrame, int]:
        """Blocks (blk, key, vec, raw): vectors as bytes; those given behind the unit vectors go to ``raw``."""
        d = self.d

        def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for number, ids, v in zip(batch[blk], batch[key], batch[vec]):
                    m = np.reshape(v, (len(ids), -1))
                    yield pd.DataFrame({blk: [number], key: [ids], vec: [m[:, :d].tobytes()], "raw": [m[:, d:].tobytes()]})

        packed, n = blocks(vectors, [key], [], vec, self.n, blk)
        return cut(packed.mapInPandas(pack, f"{blk} int, {key} array<{self._pid}>, {vec} binary, raw binary")), n

    def _start(self) -> DataFrame:
        level = F.lit(-float(np.log(self.n)))
        return self.left.select(F.col("lblk").alias("blk"), F.transform("pid", lambda _: level).alias("v"))

    def _potential(self, state: DataFrame, side: str) -> DataFrame:
        """The potentials of ``side`` that settle its marginal, given those of the other side."""
        d, reg, level = self.d, self.reg, -float(np.log(self.n))
        left = self.left.select("lblk", "x")
        right = self.right.select("rblk", "y")
        here, there, n_here, n_there = (left, right, self.n_left, self.n_right) if side == "lblk" else (right, left, self.n_right, self.n_left)
        here, there = here.toDF("lblk", "x"), there.toDF("rblk", "y").join(state.withColumnRenamed("blk", "rblk"), "rblk")
        met = meet(here, there, n_there, self.n * (8 * d + 72)).select(F.col("lblk").alias("blk"), "x", "y", "v")

        def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            parts = (
                (blk, _log_sum(_bordered(np.frombuffer(x).reshape(-1, d) / reg, 1.0), _bordered(np.frombuffer(y).reshape(-1, d), v)))
                for batch in batches for blk, x, y, v in zip(batch["blk"], batch["x"], batch["y"], batch["v"])
            )
            for blk, v in _summed(parts, np.logaddexp):
                yield pd.DataFrame({"blk": [blk], "v": [v]})

        def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            parts = ((blk, np.asarray(v)) for batch in batches for blk, v in zip(batch["blk"], batch["v"]))
            for blk, v in _summed(parts, np.logaddexp):
                yield pd.DataFrame({"blk": [blk], "v": [level - v]})

        tasks = min(n_here, 4 * here.sparkSession.sparkContext.defaultParallelism)
        parts = met.mapInPandas(sums, STATE).repartition(tasks, "blk").sortWithinPartitions("blk")
        return parts.mapInPandas(merge, STATE)

    def _solve(self, max_iter: int, tol: float) -> None:
        """Scale columns and rows in turn. The next column potentials tell how far the columns are off, so a check costs nothing."""
        after, before, evened = cut(self._potential(self.f, "rblk")), None, False
        while self.rounds < max_iter:
            discard(self.f, self.g)
            self.g, self.rounds = after, self.rounds + 1
            self.f = cut(self._potential(self.g, "lblk"))
            if tol <= 0 and self.rounds == max_iter:
                return
            after = cut(self._potential(self.f, "rblk"))
            if tol <= 0:
                continue
            before, self.error = self.error, self._gap(self.g, after)
            if self.error < tol:
                return discard(after)
            if not evened and self.rounds >= 3 and self.error > SLOW * before:
                after, evened = self._evened(after, tol), True
        discard(after)
        if tol > 0:
            raise ValueError(f"column sums are still off by {self.error:.3g} after {self.rounds} rounds")

    def _evened(self, after: DataFrame, tol: float) -> DataFrame:
        """Column potentials to go on from, for rounds that hardly move: ``after``, or better ones from even potentials.

        Where a plan is close to a matching, rounds shift weight between rows and columns by tiny steps. Both sides of
        such pairs are mostly alike, and the plan of like sides has like potentials, f = g: steps to the mean of both sides
        reach them at once. They are taken only if a round from there is closer to the marginals, whatever the sides are.
        """
        even, error = cut(self._mean(self.f, after)), None
        for _ in range(EVEN_STEPS):
            other = cut(self._potential(even, "rblk"))
            last, error = error, self._gap(even, other)
            following = cut(self._mean(even, other))
            discard(even, other)
            even = following
            if error < tol or last is not None and error > SLOW * SLOW * last:
                break
        g = cut(self._potential(even, "rblk"))
        f = cut(self._potential(g, "lblk"))
        trial = cut(self._potential(f, "rblk"))
        if self._gap(g, trial) < self.error:
            discard(even, f, trial, after)
            return g
        discard(even, f, trial, g)
        return after

    @staticmethod
    def _mean(one: DataFrame, other: DataFrame) -> DataFrame:
        both = one.join(other.withColumnRenamed("v", "w"), "blk")
        return both.select("blk", F.zip_with("v", "w", lambda a, b: (a + b) / 2).alias("v"))

    def _gap(self, given: DataFrame, after: DataFrame) -> float:
        """Distance of the column sums from 1/n under potentials ``given``: those that settle them tell each sum."""
        gap = F.aggregate(F.zip_with("v", "w", lambda a, b: F.pow(F.exp(a - b) - 1, F.lit(2))), F.lit(0.0), lambda s, x: s + x)
        total = given.join(after.withColumnRenamed("v", "w"), "blk").agg(F.sum(gap)).first()[0]
        return float(np.sqrt(total) / self.n)

    def potentials(self) -> DataFrame:
        """(pid, f, g) per pair."""
        def rows(blocks_: DataFrame, key: str, blk: str, state: DataFrame, out: str) -> DataFrame:
            joined = blocks_.select(F.col(blk).alias("blk"), key).join(state, "blk")
            zipped = F.explode(F.arrays_zip(F.col(key).alias("p"), F.col("v").alias("q")))
            return joined.select(zipped.alias("z")).select(F.col("z.p").alias("pid"), F.col("z.q").alias(out))

        return rows(self.left, "pid", "lblk", self.f, "f").join(rows(self.right, "tpid", "rblk", self.g, "g"), "pid")

    def barycenters(self) -> DataFrame:
        """(pid, ybar): n P y, the transported target of each source row."""
        reg, n, d, pid = self.reg, self.n, self.d, self._pid
        left = self.left.select("lblk", "x").join(self.f.select(F.col("blk").alias("lblk"), F.col("v").alias("f")), "lblk")
        right = self.right.drop("tpid").join(self.g.select(F.col("blk").alias("rblk"), F.col("v").alias("g")), "rblk")
        joined = meet(left, right, self.n_right, n * (16 * d + 72))

        def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            def product(x, y, raw, f, g) -> np.ndarray:
                x = _bordered(np.frombuffer(x).reshape(-1, d) / reg, 1.0, f)
                y, raw = _bordered(np.frombuffer(y).reshape(-1, d), g, 1.0), np.frombuffer(raw).reshape(-1, d)
                out = np.empty((len(x), d))
                for rows in tiles(len(x)):
                    m = x[rows] @ y.T
                    out[rows] = n * (np.exp(m, out=m) @ raw)
                return out

            parts = ((row[0], product(*row[1:])) for batch in batches for row in zip(*(batch[c] for c in ("lblk", "x", "y", "raw", "f", "g"))))
            for blk, v in _summed(parts, np.add):
                yield pd.DataFrame({"blk": [blk], "v": [v.tobytes()]})

        cols = joined.select("lblk", "x", "y", "raw", "f", "g")
        summed = add_blocks(cols.mapInPandas(weigh, PACKED), self.n_left).withColumnRenamed("blk", "lblk")

        def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for ids, v in zip(batch["pid"], batch["v"]):
                    yield pd.DataFrame({"pid": ids, "ybar": list(np.frombuffer(v).reshape(-1, d))})

        named = self.left.select("lblk", "pid").join(summed, "lblk").select("pid", "v")
        return named.mapInPandas(unpack, f"pid {pid}, ybar array<double>")


def align_transport(pairs: DataFrame, src: DataFrame, tgt: DataFrame, reg: float = 0.05, sample_size: int | None = None,
                    max_iter: int = 1000, tol: float = 1e-9, seed: int = 42) -> tuple[DataFrame, np.ndarray]:
    """Transport all pairs (or ``sample_size`` of them), fit Procrustes to the transported targets, map every source vector."""
    chosen = pairs if sample_size is None else pair_sample(pairs, sample_size, seed)
    train = cut(ordinal(training_pairs(chosen, src, tgt), [F.col("src"), F.col("tgt")], "pid"))
    plan = TransportPlan(train, reg, max_iter, tol)
    r = procrustes(train.select("pid", "x").join(plan.barycenters(), "pid").select("x", F.col("ybar").alias("y")))
    return apply_map(src, r), r


def self_learning(pairs: DataFrame, src: DataFrame, tgt: DataFrame, rounds: int = 5, k: int = 5,
                  dictionary_targets: bool = True) -> tuple[DataFrame, np.ndarray]:
    """Refit Procrustes on every source word and its ``k`` nearest targets, ``rounds`` times.

    Targets are the dictionary's target rows, one per pair as repeated pairs count, or the full vocabulary. Both sides are
    packed once; only the d x d map crosses from one round to the next, so no lineage grows, and is applied to the packed blocks.
    """
    train = cut(ordinal(training_pairs(pairs, src, tgt), [F.col("src"), F.col("tgt")], "pid"))
    r = procrustes(train)
    targets = train.select(F.col("pid").alias("word"), F.col("y").alias("vec")) if dictionary_targets else tgt
    shapes = (vector_shape(src), vector_shape(targets))
    x = src.select(F.col("word").alias("src"), F.col("vec").alias("x"))
    (left, _), (right, n_right) = packed_units(src, targets, shapes)
    left, right = cut(left), cut(right)
    for _ in range(rounds):
        near = nearest(left, right, n_right, vector_bytes(shapes[1]), k, r).select("src", "tgt")
        both = with_vectors(near, targets, "tgt", "y", shapes[1])
        r = procrustes(lookup(both, x, ["src"], small_bytes=vector_bytes(shapes[0])))
    discard(left, right)
    return apply_map(src, r), r

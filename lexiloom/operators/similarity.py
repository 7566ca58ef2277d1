"""Cosine look-ups, nearest neighbours, analogies, clustering and rank correlation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexiloom.functions.vectors import cosine, dot, l2_normalize
from lexiloom.operators.common import BROADCAST_BYTES, blocks, lookup, meet, ordinal, table_bytes, tiles, vector_shape
from lexiloom.session import cut

COS_DIGITS = 12


Shape = tuple[int, int]


def vector_bytes(shape: Shape) -> int:
    return shape[0] * (8 * shape[1] + 64)


def with_vectors(pairs: DataFrame, vectors: DataFrame, key: str, out: str, shape: Shape | None = None,
                 how: str = "inner", limit: int = BROADCAST_BYTES) -> DataFrame:
    """Attach the vector of ``key``; pairs without one are dropped (or kept with ``how="left"``).

    A vector table too large to broadcast is first cut down to the words that are asked for, by a semi-join with their
    distinct list when that is small enough to broadcast; only then does it meet the pairs.
    """
    named = vectors.select(F.col("word").alias(key), F.col("vec").alias(out))
    shape = shape or vector_shape(vectors)
    if vector_bytes(shape) <= limit:
        return lookup(pairs, named, [key], how, small_bytes=vector_bytes(shape), limit=limit)
    asked = cut(pairs.select(key).distinct())
    size = table_bytes(asked.select(F.col(key).cast("string").alias(key)), key)
    if size > limit:
        return lookup(pairs, named, [key], how)
    needed = named.join(F.broadcast(asked), key, "left_semi")
    return lookup(pairs, needed, [key], how, small_bytes=size + asked.count() * (8 * shape[1] + 64), limit=limit)


def cosine_cells(pairs: DataFrame, src: DataFrame, tgt: DataFrame) -> DataFrame:
    """Cosine for each requested (src, tgt) cell; cells with an unknown word are dropped."""
    both = with_vectors(with_vectors(pairs, src, "src", "_x"), tgt, "tgt", "_y")
    return both.withColumn("cos", cosine(F.col("_x"), F.col("_y"))).drop("_x", "_y")


def unit_table(vectors: DataFrame) -> DataFrame:
    return vectors.select("word", l2_normalize(F.col("vec")).alias("vec"))


def _kth(sims: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th highest value of every row; below all if there are not so many, as not-a-numbers do not count."""
    if k == 1:
        return np.fmax(np.fmax.reduce(sims, axis=1), -np.inf)
    ordered = -sims
    ordered.partition(k - 1, axis=1)
    return np.fmax(-ordered[:, k - 1], -np.inf)


def _hopeful(x: np.ndarray, y: np.ndarray, xs: np.ndarray, ys: np.ndarray, k: int, slack: float):
    """(i, j, product, low): the cells that may be among the ``k`` best of their row, and the ``k``-th best product of every row.

    Products of single precision are off by ``slack / 2`` at most, so they only screen: whatever comes that near to the best is
    multiplied again in double precision. Where too many cells do, as among equal vectors, all are.
    """
    near = xs @ ys.T
    i, j = np.nonzero(near >= (_kth(near, k) - np.float32(slack))[:, None])
    if len(i) <= (4 * k + 12) * len(x):
        sims = np.einsum("ij,ij->i", x[i], y[j])
        first = np.searchsorted(i, np.arange(len(x) + 1))
        low, full = np.full(len(x), -np.inf), np.flatnonzero(np.diff(first) >= k)
        low[full] = sims[np.lexsort((-sims, i))][first[full] + k - 1]
        return i, j, sims, low
    del near, i, j
    sims = x @ y.T
    low = _kth(sims, k)
    i, j = np.nonzero(sims >= (low - 2 * 10.0**-COS_DIGITS)[:, None])
    return i, j, sims[i, j], low


def nearest_in_block(ids, x, other, y, k: int) -> pd.DataFrame:
    """(src, tgt, cos): the ``k`` rows of ``y`` of highest product per row of ``x``, equal ones by place in ``other``.

    Products are formed for some hundred rows at a time, and only the few that may be among the best are rounded and compared.
    """
    x, y = np.reshape(x, (len(ids), -1)), np.reshape(y, (len(other), -1))
    xs, ys = x.astype(np.float32), y.astype(np.float32)
    longest = [float(np.sqrt(np.fmax.reduce((m * m).sum(axis=1)))) for m in (x, y)]
    slack = 1e-9 + (x.shape[1] + 4) * float(np.finfo(np.float32).eps) * longest[0] * longest[1]
    take, found = min(k, len(other)), []
    for rows in tiles(len(ids)):
        i, j, sims, low = _hopeful(x[rows], y, xs[rows], ys, take, slack)
        cos, floor = np.round(sims, COS_DIGITS), np.round(low, COS_DIGITS)
        above, level = cos > floor[i], cos == floor[i]
        room = take - np.bincount(i[above], minlength=len(low))
        place = np.cumsum(level)
        before = np.append(place - level, 0)[np.searchsorted(i, np.arange(len(low)))]  # the last rows may have no cells
        keep = above | (level & (place - before[i] <= room[i]))
        found.append((i[keep] + rows.start, j[keep], cos[keep]))
    i, j, cos = (np.concatenate(part) for part in zip(*found))
    return pd.DataFrame({"src": np.asarray(ids)[i], "tgt": np.asarray(other)[j], "cos": cos})


Packed = tuple[DataFrame, int]


def packed_units(src: DataFrame, tgt: DataFrame, shapes: tuple[Shape, Shape]) -> tuple[Packed, Packed]:
    """Blocks of unit vectors of both sides, (lblk.., src, vec) and (rblk, tgt, tvec), each with their number."""
    s, t = unit_table(src).withColumnRenamed("word", "src"), unit_table(tgt).toDF("tgt", "tvec")
    return blocks(s, ["src"], [], "vec", shapes[0][0]), blocks(t, ["tgt"], [], "tvec", shapes[1][0], "rblk")


def nearest(left: DataFrame, right: DataFrame, n_right: int, right_bytes: int, k: int, turn: np.ndarray | None = None) -> DataFrame:
    """``topk_neighbours`` of packed sides; sources are multiplied by ``turn``, an orthogonal map, if one is given."""
    pairs = meet(left, right, n_right, right_bytes).select("src", "vec", "tgt", "tvec")
    src, tgt = (pairs.schema[c].dataType.elementType.simpleString() for c in ("src", "tgt"))

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, x, other, y in zip(batch["src"], batch["vec"], batch["tgt"], batch["tvec"]):
                yield nearest_in_block(ids, x if turn is None else np.reshape(x, (len(ids), -1)) @ turn, other, y, k)

    found = pairs.mapInPandas(best, f"src {src}, tgt {tgt}, cos double")
    rank = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("cos"), "tgt"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def topk_neighbours(src: DataFrame, tgt: DataFrame, k: int, shapes: tuple[Shape, Shape] | None = None) -> DataFrame:
    """The ``k`` targets of highest cosine per source word: (src, tgt, cos, rank); ties go to the lower target.

    Exact: every source block meets every target block, each pair of blocks is one matrix product that keeps only
    ``k`` candidates per source row, and the candidates are merged by a window.
    """
    shapes = shapes or (vector_shape(src), vector_shape(tgt))
    (left, _), (right, n_right) = packed_units(src, tgt, shapes)
    return nearest(left, right, n_right, vector_bytes(shapes[1]), k)


def analogy_predictions(questions: DataFrame, vectors: DataFrame) -> DataFrame:
    """3CosAdd per covered question (qid, a, b, c, d): the best word for b - a + c other than a, b and c."""
    q, shape = questions, vector_shape(vectors)
    for key in "abcd":
        q = with_vectors(q, vectors, key, f"_{key}", shape)
    offset = F.transform(F.arrays_zip("_a", "_b", "_c"), lambda r: r["_b"] - r["_a"] + r["_c"])
    asked = q.withColumn("vec", offset).drop("_a", "_b", "_c", "_d")
    points = asked.select(F.col("qid").alias("word"), "vec")
    shapes = ((questions.count(), shape[1]), shape)
    near = topk_neighbours(points, vectors, 4, shapes).withColumnRenamed("src", "qid")
    keyed = near.join(asked.drop("vec"), "qid")
    allowed = keyed.filter(~F.col("tgt").isin(F.col("a"), F.col("b"), F.col("c")))
    best = F.max_by(F.struct("tgt", "cos"), -F.col("rank"))
    return (
        allowed.groupBy("qid", "a", "b", "c", "d").agg(best.alias("m"))
        .select("qid", "a", "b", "c", "d", F.col("m.tgt").alias("predicted"), F.col("m.cos").alias("cos"))
    )


def analogy_scores(questions: DataFrame, vectors: DataFrame) -> DataFrame:
    """Accuracy over fully covered questions, with total, skipped and coverage."""
    got = analogy_predictions(questions, vectors).select("qid", (F.col("predicted") == F.col("d")).alias("hit"))
    known = F.col("hit").isNotNull()
    covered = F.count_if(known)
    return questions.select("qid").join(got, "qid", "left").agg(
        F.coalesce(F.avg(F.col("hit").cast("double")), F.lit(0.0)).alias("accuracy"),
        F.coalesce(F.try_divide(covered, F.count(F.lit(1))), F.lit(0.0)).alias("coverage"),
        covered.alias("total"),
        F.count_if(~known).alias("skipped"),
    )


def kmeans(vectors: DataFrame, k: int = 10, seed: int = 42, max_iter: int = 1000) -> DataFrame:
    """Cluster number per word, iterated until the centres settle; an error if ``max_iter`` rounds are not enough."""
    feats = vectors.withColumn("features", array_to_vector("vec"))
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="cluster").fit(feats)
    if model.summary.numIter >= max_iter:
        raise ValueError(f"centres still move after {max_iter} rounds")
    return model.transform(feats).drop("features")


def silhouette_samples(points: DataFrame) -> DataFrame:
    """Exact Euclidean silhouette per word of (word, vec, cluster).

    Distances are summed per (point, cluster) inside block products, so no pair of points is ever a row.
    A point alone in its cluster scores 0.
    """
    n, d = vector_shape(points)
    sizes = points.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    left, _ = blocks(points.select("word", "vec", "cluster"), ["word"], ["cluster"], "vec", n)
    other = points.select(F.col("word").alias("oword"), F.col("vec").alias("ovec"), F.col("cluster").alias("ocluster"))
    right, n_right = blocks(other, ["oword"], ["ocluster"], "ovec", n, "rblk")
    pairs = meet(left, right, n_right, n * (8 * d + 64)).select("word", "cluster", "vec", "ocluster", "ovec")
    word_t, cl_t = (points.schema[c].dataType.simpleString() for c in ("word", "cluster"))

    def distance_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, own, x, oc, y in zip(*(batch[c] for c in ("word", "cluster", "vec", "ocluster", "ovec"))):
                a, b = np.reshape(x, (len(ids), -1)), np.reshape(y, (len(oc), -1))
                labels, where = np.unique(oc, return_inverse=True)
                order = np.argsort(where, kind="stable")
                b, first = b[order], np.searchsorted(where[order], np.arange(len(labels)))
                aa, bb, total = (a * a).sum(1), (b * b).sum(1), np.empty((len(a), len(labels)))
                for rows in tiles(len(a)):
                    far = a[rows] @ b.T
                    far *= -2
                    far += aa[rows, None]
                    far += bb
                    np.sqrt(np.maximum(far, 0, out=far), out=far)
                    total[rows] = np.add.reduceat(far, first, axis=1)
                yield pd.DataFrame({
                    "word": np.repeat(np.asarray(ids), len(labels)),
                    "cluster": np.repeat(np.asarray(own), len(labels)),
                    "other": np.tile(labels, len(ids)),
                    "dist": total.ravel(),
                })

    sums = (
        pairs.mapInPandas(distance_sums, f"word {word_t}, cluster {cl_t}, other {cl_t}, dist double")
        .groupBy("word", "cluster", "other").agg(F.sum("dist").alias("dist"))
        .join(sizes.withColumnRenamed("cluster", "other"), "other")
    )
    own = F.col("cluster") == F.col("other")
    scored = sums.groupBy("word", "cluster").agg(
        F.max(F.when(own, F.col("size"))).alias("size"),
        F.max(F.when(own, F.try_divide(F.col("dist"), F.col("size") - 1))).alias("a"),
        F.min(F.when(~own, F.col("dist") / F.col("size"))).alias("b"),
    )
    value = F.when(F.col("size") > 1, F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b"))).otherwise(F.lit(0.0))
    return scored.select("word", "cluster", value.alias("silhouette"))


def silhouette(points: DataFrame) -> DataFrame:
    """Mean exact silhouette; null when there are fewer than two clusters."""
    return silhouette_samples(points).agg(
        F.when(F.count_distinct("cluster") > 1, F.avg("silhouette")).alias("silhouette")
    )


def silhouette_squared(points: DataFrame) -> float:
    """MLlib's squared-Euclidean silhouette: linear in the points, a different number from :func:`silhouette`."""
    feats = points.select(array_to_vector("vec").alias("features"), F.col("cluster").cast("double").alias("prediction"))
    return ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(feats)


def average_rank(rows: DataFrame, value: str, key: str, out: str) -> DataFrame:
    """Add the average rank (from 1) of ``value``; ``key`` is unique and only balances the ranges."""
    placed = ordinal(rows, [F.col(value), F.col(key)], "_pos")
    ranks = placed.groupBy(value).agg((F.avg("_pos") + 1).alias(out))
    return lookup(placed.drop("_pos"), ranks, [value])


def correlation(rows: DataFrame, x: str, y: str, key: str, method: str = "spearman") -> DataFrame:
    """One row (n, corr). Spearman uses average ranks; fewer than two rows or no variance gives null."""
    if method == "spearman":
        ranked = average_rank(average_rank(rows.select(key, x, y), x, key, "_rx"), y, key, "_ry")
        x, y = "_rx", "_ry"
    elif method == "pearson":
        ranked = rows
    else:
        raise ValueError(f"unknown correlation method: {method}")
    c = F.corr(x, y)
    return ranked.agg(F.count(F.lit(1)).alias("n"), F.when(F.isnan(c), None).otherwise(c).alias("corr"))


def gold_correlation(gold: DataFrame, src: DataFrame, tgt: DataFrame, method: str = "spearman") -> DataFrame:
    """Correlation of cosine with gold ``score`` over covered pairs (pid, src, tgt, score), with coverage."""
    scored = cosine_cells(gold, src, tgt)
    pairs = gold.agg(F.count(F.lit(1))).scalar()
    got = correlation(scored, "cos", "score", "pid", method).withColumn("pairs", pairs)
    return got.select("corr", F.col("n").alias("covered"), "pairs", F.try_divide("n", "pairs").alias("coverage"))


def group_cosine(concepts: DataFrame, src: DataFrame, tgt: DataFrame) -> DataFrame:
    """Per category and source word: number of targets, mean cosine to all targets of the category.

    The mean cosine to a set is the product with the mean unit vector of the set, so no word pairs are formed.
    """
    known = with_vectors(concepts.select("category", "src", "tgt"), unit_table(src), "src", "x")
    known = with_vectors(known, unit_table(tgt), "tgt", "y")
    centre = mean_vector(known.select("category", F.col("y").alias("vec")), ["category"])
    n_bytes = table_bytes(centre, "category", overhead=64 + 8 * vector_shape(tgt)[1])
    rows = lookup(known.select("category", "src", "tgt", "x", "y"), centre, ["category"], small_bytes=n_bytes)
    return rows.select(
        "category", "src", "tgt", dot(F.col("x"), F.col("y")).alias("own_cos"),
        F.col("n").alias("n_targets"), dot(F.col("x"), F.col("mean")).alias("mean_cos"),
    )


def mean_vector(rows: DataFrame, by: list[str], vec: str = "vec") -> DataFrame:
    """Element-wise mean of ``vec`` per group, as (by.., n, mean); whole vectors are added map-side, in the JVM."""
    mean = Summarizer.mean(array_to_vector(F.col(vec)))
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), mean.alias("_m")).select(*by, "n", vector_to_array("_m").alias("mean"))

"""How well mapped source vectors find their translations."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.vectors import dot
from lexiloom.operators.alignment import pair_sample
from lexiloom.operators.common import blocks, lookup, meet, table_bytes, tiles, vector_shape
from lexiloom.operators.similarity import (
    Shape, correlation, cosine_cells, topk_neighbours, unit_table, vector_bytes, with_vectors,
)

TIE = 1e-12


def translation_ranks(pairs: DataFrame, src: DataFrame, tgt: DataFrame) -> DataFrame:
    """(src, tgt, n, cos, rank): place of the gold target among all targets by cosine; ``n`` counts repeats.

    The rank is one plus the number of targets that are closer by more than 1e-12, so ties take the best rank. Closer
    targets are counted inside block products; nothing is sorted and no pair of words becomes a row.
    """
    shape = vector_shape(tgt)
    us, ut = unit_table(src), unit_table(tgt)
    distinct = pairs.groupBy("src", "tgt").agg(F.count(F.lit(1)).alias("n"))
    known = with_vectors(with_vectors(distinct, us, "src", "x", vector_shape(src)), ut, "tgt", "y", shape)
    gold = known.select("src", "tgt", "n", dot(F.col("x"), F.col("y")).alias("cos"), "x")
    left, _ = blocks(gold, ["src", "tgt"], ["n", "cos"], "x", pairs.count())
    other = ut.select(F.col("word").alias("oword"), F.col("vec").alias("ovec"))
    right, n_right = blocks(other, ["oword"], [], "ovec", shape[0], "rblk")
    met = meet(left, right.select("rblk", "ovec", F.size("oword").alias("m")), n_right, vector_bytes(shape))

    def closer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for s, t, n, c, x, y, m in zip(*(batch[k] for k in ("src", "tgt", "n", "cos", "x", "ovec", "m"))):
                x, y, bar = np.reshape(x, (len(s), -1)), np.reshape(y, (m, -1)), np.asarray(c)[:, None] + TIE
                above = np.concatenate([np.count_nonzero(x[rows] @ y.T > bar[rows], axis=1) for rows in tiles(len(s))])
                yield pd.DataFrame({"src": s, "tgt": t, "n": n, "cos": c, "above": above})

    ts, tt = (gold.schema[c].dataType.simpleString() for c in ("src", "tgt"))
    counts = met.select("src", "tgt", "n", "cos", "x", "ovec", "m").mapInPandas(
        closer, f"src {ts}, tgt {tt}, n long, cos double, above long"
    )
    return counts.groupBy("src", "tgt", "n", "cos").agg((F.sum("above") + 1).alias("rank"))


def precision_mrr(ranks: DataFrame, ks: Sequence[int] = (1, 5, 10)) -> DataFrame:
    """One row: total pairs, share with rank <= k for each k, mean reciprocal rank (0 when there are no pairs)."""
    total = F.coalesce(F.sum("n"), F.lit(0))

    def share(value) -> F.Column:
        return F.coalesce(F.try_divide(F.sum(value * F.col("n")), F.sum("n").cast("double")), F.lit(0.0))

    hits = [share((F.col("rank") <= k).cast("double")).alias(f"p_at_{k}") for k in ks]
    return ranks.agg(total.alias("total"), *hits, share(F.lit(1.0) / F.col("rank")).alias("mrr"))


def alignment_report(scores: DataFrame, ks: Sequence[int] = (1, 5, 10)) -> DataFrame:
    """Total pairs, precision in percent with two decimals, reciprocal rank with four."""
    return scores.select(
        "total", *[F.round(F.col(f"p_at_{k}") * 100, 2).alias(f"p_at_{k}_percent") for k in ks], F.round("mrr", 4).alias("mrr")
    )


def semantic_similarity(gold: DataFrame, src: DataFrame, tgt: DataFrame, gold_scale: float = 1.0) -> DataFrame:
    """Spearman and mean absolute error of cosine against gold (pid, src, tgt, score) times ``gold_scale``."""
    scored = cosine_cells(gold, src, tgt).withColumn("score", F.col("score") * gold_scale)
    mae = scored.agg(F.avg(F.abs(F.col("cos") - F.col("score")))).scalar()
    return correlation(scored, "cos", "score", "pid").select(
        F.col("corr").alias("spearman_correlation"), mae.alias("mean_absolute_error")
    )


def hub_counts(src: DataFrame, tgt: DataFrame, k: int = 10, shapes: tuple[Shape, Shape] | None = None) -> DataFrame:
    """(tgt, hits): how often each target is among the ``k`` nearest of a source word, zeros included."""
    hits = topk_neighbours(src, tgt, k, shapes).groupBy("tgt").agg(F.count(F.lit(1)).alias("hits"))
    every = tgt.select(F.col("word").alias("tgt"))
    return every.join(hits, "tgt", "left").select("tgt", F.coalesce("hits", F.lit(0).cast("long")).alias("hits"))


def hubness(src: DataFrame, tgt: DataFrame, k: int = 10) -> DataFrame:
    """Largest, mean, population deviation and skewness of the hub counts."""
    h = F.col("hits").cast("double")
    return hub_counts(src, tgt, k).agg(
        F.max("hits").alias("max_hub_size"), F.avg(h).alias("mean_hub_size"),
        F.stddev_pop(h).alias("std_hub_size"), F.skewness(h).alias("skewness"),
    )


def evaluate_all(methods: Mapping[str, DataFrame], pairs: DataFrame, gold: DataFrame, tgt: DataFrame,
                 ks: Sequence[int] = (1, 5, 10), k_hub: int = 10) -> DataFrame:
    """One row per alignment method: translation, similarity and hubness scores."""
    rows = None
    for name, mapped in methods.items():
        tag = F.lit(name).alias("method")
        row = precision_mrr(translation_ranks(pairs, mapped, tgt), ks).select(tag, *[f"p_at_{k}" for k in ks], "mrr")
        row = row.join(semantic_similarity(gold, mapped, tgt).withColumn("method", F.lit(name)), "method")
        row = row.join(hubness(mapped, tgt, k_hub).withColumn("method", F.lit(name)), "method")
        rows = row if rows is None else rows.unionByName(row)
    return rows


def sample_pairs(pairs: DataFrame, src: DataFrame, tgt: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """A repeatable sample of pairs known on both sides, labelled ``src/tgt``."""
    chosen = pair_sample(pairs, n, seed)
    for key, table in (("src", src), ("tgt", tgt)):
        words = table.select(F.col("word").alias(key))
        chosen = chosen.join(words, key, "left_semi")
    return chosen.select("src", "tgt", F.concat_ws("/", "src", "tgt").alias("label"))

"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order, and posted with its place in the inverted file of each of them. A query
opens the files of its own nearest pivots and adds up, for the vectors posted there, how much nearer the two orders are than
orders that share nothing (the footrule distance, counted down from its largest value); the vectors with the least distance
are ranked again by the exact measure.

Inner products are turned into distances by one more coordinate that brings all vectors to the same length; queries get 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexiloom.session import cut

PIVOTS = 256
DEPTH = 64  # files that a vector is posted in, and a query opens
SAMPLE = 4096  # vectors that pivots are drawn from
FRACTION = 0.25  # of each block's vectors are ranked again
LEAST = 256  # at least so many in a block
ROWS, QUERIES = 8192, 4096  # vectors and queries in a block


def usable(vec: str) -> F.Column:
    """Neither null, empty, zero nor with null or non-finite components."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(vec).isNotNull() & (F.size(vec) > 0) & ~bad & F.exists(vec, lambda x: x != 0), F.lit(False))


def pivots_of(vectors: DataFrame, n: int = PIVOTS, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """``n`` pivots, lengthened by the coordinate that equalises lengths, and the largest length.

    They come from about ``sample`` vectors that a hash picks, whatever the size of the table: each is drawn with a chance
    that grows with the square of its distance to those before, so copies of a pivot are never drawn.
    """
    got = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)).alias("m")).first()
    if not got["n"]:
        return np.zeros((0, 1)), 0.0
    part = vectors
    if got["n"] > sample:
        part = vectors.where(F.pmod(F.xxhash64("vec_id", F.lit(11)), F.lit(1 << 30)) < int((1 << 30) * sample / got["n"]))
    rows = part.select("vec_id", "vec").toPandas().sort_values("vec_id")
    x = lengthen(np.stack(rows["vec"]), float(got["m"]))
    rng, pick, far = np.random.default_rng(5), [], np.ones(len(x))
    while len(pick) < n and far.any():
        pick.append(int(rng.choice(len(x), p=far / far.sum())))
        gap = ((x - x[pick[-1]]) ** 2).sum(axis=1)
        gap[gap <= 1e-18 * max(1.0, float(got["m"]))] = 0
        far = gap if len(pick) == 1 else np.minimum(far, gap)
    return x[pick], float(got["m"])


def lengthen(x: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(0, longest - (x * x).sum(axis=1)))
    return np.concatenate([x, rest[:, None]], axis=1)


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """The numbers of the ``depth`` nearest pivots of each row, nearest first, ties to the earlier pivot."""
    far = (pivots * pivots).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.argsort(far, axis=1, kind="stable")[:, :depth].astype(np.int16)


def inverted_files(order: np.ndarray, n_pivots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Postings by pivot of rows with the nearest pivots ``order``: (row, place of the pivot in its order), and where a file starts."""
    by_pivot = np.argsort(order, axis=None, kind="stable")
    starts = np.searchsorted(order.ravel()[by_pivot], np.arange(n_pivots + 1))
    return by_pivot // order.shape[1], (by_pivot % order.shape[1]).astype(np.int32), starts


def search_block(ids: np.ndarray, x: np.ndarray, order: np.ndarray, qids: np.ndarray, q: np.ndarray, asked: np.ndarray, n_pivots: int,
                 k: int, fraction: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best found in one block for each query: (query ids, vector ids, inner products)."""
    row, place, starts = inverted_files(order, n_pivots)
    depth = order.shape[1]
    again = min(len(ids), max(LEAST, 2 * k, ceil(fraction * len(ids))))
    out_q, out_v, out_s = [], [], []
    for i in range(len(q)):
        shared = np.zeros(len(ids), np.int32)  # half of: largest footrule distance less the footrule distance
        for rank, pivot in enumerate(asked[i]):
            file = slice(starts[pivot], starts[pivot + 1])
            shared[row[file]] += depth - np.maximum(place[file], rank)
        near = np.flatnonzero(shared >= np.partition(shared, len(ids) - again)[len(ids) - again])
        near = near[ids[near] != qids[i]]
        score = x[near] @ q[i]
        best = np.lexsort((ids[near], -score))[:k]
        out_q.append(np.full(len(best), qids[i]))
        out_v.append(ids[near][best])
        out_s.append(score[best])
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, n_pivots: int = PIVOTS, fraction: float = FRACTION,
           rows: int = ROWS, n_queries: int = QUERIES) -> DataFrame:
    """The ``k`` vectors with the largest inner product found for each query: query_id, rank (from 1), vec_id, score.

    ``vectors`` and ``queries`` have vec_id and embedding; other columns are ignored. Products are in double precision on the
    vectors as given; ties go to the smaller vec_id; a query never finds a row of its own id. Rows whose vector is null,
    empty, zero or holds null or non-finite components take no part, on either side, and neither do rows without an id; rows
    that agree in id and vector count once. If there are fewer than ``k`` others, all are found.

    Nearest pivots are found once per vector. Vectors and queries then meet in a grid of blocks, each of bounded size and with
    inverted files of its own, so that the file of a hot pivot is spread over the blocks; a query visits only the postings of its
    own pivots, and a task returns k rows per query.
    """
    spark = vectors.sparkSession
    clean = lambda df: df.select("vec_id", F.col("embedding").cast("array<double>").alias("vec")).where(usable("vec") & F.col("vec_id").isNotNull()).distinct()
    table, asked = cut(clean(vectors)), cut(clean(queries))
    pivots, longest = pivots_of(table, n_pivots)
    n, m = table.count(), asked.count()
    schema = "query_id long, vec_id long, score double"
    down, across = max(1, ceil(n / rows)), max(1, ceil(m / n_queries))
    held = spark.sparkContext.broadcast((pivots, longest))

    def posted(df: DataFrame, query: bool) -> DataFrame:
        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            points, most = held.value
            for batch in batches:
                if len(batch):
                    x = np.stack(batch["vec"])
                    long = np.concatenate([x, np.zeros((len(x), 1))], axis=1) if query else lengthen(x, most)
                    yield batch.assign(pivots=list(nearest_pivots(long, points)))

        return df.mapInPandas(place, "vec_id long, vec array<double>, pivots array<short>")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        sides = [(side["vec_id"].to_numpy(np.int64), np.stack(side["vec"]), np.stack(side["pivots"])) for side in (left, right)]
        q, v, s = search_block(*sides[0], *sides[1], len(held.value[0]), k, fraction)
        return pd.DataFrame({"query_id": q, "vec_id": v, "score": s})

    def block(df: DataFrame, own: str, parts: int, other: str, copies: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))

    cells = block(posted(table, False), "i", down, "j", across).groupBy("i", "j").cogroup(block(posted(asked, True), "j", across, "i", down).groupBy("i", "j"))
    found = cells.applyInPandas(run, schema)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def recall(vectors: DataFrame, queries: DataFrame, found: DataFrame, k: int = 20, most: int = 512) -> float:
    """Share of the true ``k`` nearest that ``found`` has, by brute force for ``most`` queries that a hash picks."""
    asked = queries.select("vec_id", F.col("embedding").cast("array<double>").alias("vec")).where(usable("vec"))
    asked = asked.orderBy(F.xxhash64("vec_id", F.lit(3))).limit(most).toPandas()
    q, qids = np.stack(asked["vec"]), asked["vec_id"].to_numpy()

    def best(batches):
        for batch in batches:
            ids, score = batch["vec_id"].to_numpy(), np.stack(batch["vec"]) @ q.T
            for j in range(len(qids)):
                s = np.where(ids == qids[j], -np.inf, score[:, j])
                top = np.lexsort((ids, -s))[:k]
                top = top[np.isfinite(s[top])]
                yield pd.DataFrame({"query_id": qids[j], "vec_id": ids[top], "score": s[top]})

    table = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vec")).where(usable("vec"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    true = table.mapInPandas(best, "query_id long, vec_id long, score double").withColumn("r", place).where(F.col("r") <= k)
    met = true.join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    return float(met.agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0])

"""Mixing sources to target weights by temperature, laid out as budgeted block permutations."""

from __future__ import annotations

from collections.abc import Mapping
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexiloom.llm.common import running, size_checked
from lexiloom.session import cut

REPEATS = 1.5
BLOCK_TOKENS = 1 << 20


def weights(shares: Mapping[str, float], exponent: float) -> dict[str, float]:
    """Shares to the power of ``exponent``, normalised: 1 leaves them, 0 makes all sources alike."""
    raw = {s: exp(exponent * log(p)) for s, p in shares.items()}
    total = sum(raw.values())
    return {s: x / total for s, x in raw.items()}


def entropy(w: Mapping[str, float]) -> float:
    return -sum(x * log(x) for x in w.values() if x)


def epochs(shares: Mapping[str, float], w: Mapping[str, float], budget: float | None = None) -> dict[str, float]:
    """How often each source is read for weights ``w`` and a budget in corpora; None: the least read source once."""
    ratio = {s: w[s] / shares[s] for s in shares}
    budget = 1 / min(ratio.values()) if budget is None else budget
    return {s: budget * x for s, x in ratio.items()}


def exponent(shares: Mapping[str, float], target_entropy: float | None = None, repeats: float | None = None,
             budget: float | None = None, steps: int = 60) -> float:
    """Bisect for the exponent in [0, 1] whose weights have ``target_entropy`` nats, or else for the flattest weights that
    read no source more than ``repeats`` times. A target out of reach takes the nearer end."""
    if (target_entropy is None) == (repeats is None):
        raise ValueError("give either an entropy or a repetition limit")

    def flat_enough(x: float) -> bool:
        w = weights(shares, x)
        if target_entropy is not None:
            return entropy(w) >= target_entropy
        return max(epochs(shares, w, budget).values()) > repeats  # too flat

    low, high = 0.0, 1.0  # flat enough at low, if anywhere
    if not flat_enough(low):
        return low
    if flat_enough(high):
        return high
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (mid, high) if flat_enough(mid) else (low, mid)
    return low if target_entropy is not None else high


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    return docs.select(
        "*",
        F.coalesce(F.concat(F.lit("s:"), F.col("source").cast("string")), F.lit("null")).alias("_src"),
        F.greatest(F.lit(1), F.coalesce(F.regexp_count("text", F.lit(r"\S++")), F.lit(0))).cast("long").alias("_tokens"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("_key"),
    )


def _order(epoch: Column) -> Column:
    """Place of a row in the permutation of an epoch."""
    return F.xxhash64("_key", epoch.cast("int"))


def plan(table: DataFrame, target_entropy: float | None = None, repeats: float | None = REPEATS, budget: float | None = None) -> DataFrame:
    """One row per source of the written ``table`` (_src, _tokens, _key): _src, n_tokens, weight, reads, _full, _cut.

    A source is read ``_full`` times whole; of the next permutation the rows with an order up to ``_cut`` follow, those that
    start inside the rest of its budget (null: none). Sources, not documents, are gathered on the driver.
    """
    spark = table.sparkSession
    totals = {r["_src"]: r["t"] for r in table.groupBy("_src").agg(F.sum("_tokens").alias("t")).collect()}
    schema = "_src string, n_tokens long, weight double, reads double, _full int, _rest long"
    if not totals:
        return spark.createDataFrame([], schema).drop("_rest").withColumn("_cut", F.lit(None).cast("long"))
    grand = sum(totals.values())
    shares = {s: t / grand for s, t in totals.items()}
    w = weights(shares, exponent(shares, target_entropy, None if target_entropy is not None else repeats, budget))
    reads = epochs(shares, w, budget)
    rows = []
    for s, t in totals.items():
        whole = round(reads[s] * t)
        rows.append((s, t, w[s], reads[s], whole // t, whole % t))
    sources = size_checked(spark.createDataFrame(rows, schema), len(rows), 256)
    partial = table.join(sources.where("_rest > 0").select("_src", "_full", "_rest"), "_src")
    partial = cut(partial.select("_src", "_tokens", "_rest", _order(F.col("_full")).alias("_h")))
    placed = running(partial, ["_src"], F.struct(F.col("_h").alias("h")), F.col("_tokens"), "_before", partial.count())
    cuts = placed.where("_before < _rest").groupBy("_src").agg(F.max("_h").alias("_cut"))
    return sources.drop("_rest").join(cuts, "_src", "left")


def _repeat(docs: DataFrame, sources: DataFrame, n_sources: int) -> DataFrame:
    """Rows of ``docs`` once for every time that they are read, with their epoch."""
    met = docs.join(size_checked(sources, n_sources, 256), "_src")
    last = F.coalesce(_order(F.col("_full")) <= F.col("_cut"), F.lit(False))
    times = F.col("_full") + last.cast("int")
    return met.where(times > 0).withColumn("_epoch", F.explode(F.sequence(F.lit(0), times - 1)))


def mix(docs: DataFrame, target_entropy: float | None = None, repeats: float | None = REPEATS, budget: float | None = None, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, source, any others) as often as the mixture reads them; its own columns only.

    Weights are the sources' token shares (words; a text without words counts as one) to a power that meets
    ``target_entropy`` (nats) or the limit ``repeats``. ``budget`` is in corpora; without one the least repeated source is
    read once, so no document is lost. A null source is a source of its own. Rows that agree in doc_id and text stand at the
    same place of a permutation. An empty table stays empty. No text is shuffled: a row needs its source's line of the plan.
    """
    table = cut(_keyed(docs.select("doc_id", "text", "source"), seed).select("_src", "_tokens", "_key"))
    sources = cut(plan(table, target_entropy, repeats, budget))
    keyed = _keyed(docs.select("doc_id", "text", "source", F.struct("*").alias("_row")), seed).drop("doc_id", "text", "source")
    return _repeat(keyed, sources, sources.count()).select("_row.*")


def mixture(docs: DataFrame, target_entropy: float | None = None, repeats: float | None = REPEATS, budget: float | None = None,
            block_tokens: int = BLOCK_TOKENS, seed: int = 7) -> DataFrame:
    """The mixture in reading order: doc_id, source, tokens, epoch, block, position, weight.

    Each source is a stream of permutations, one per epoch, of which each block takes a budget of weight times
    ``block_tokens``; so every block has the mixture's weights but for its documents' overhang. ``position`` is the place in
    a block, permuted anew. What ``mix`` says of null, equal and empty holds here; ties in position are broken by epoch.
    """
    names = ["doc_id", "source", "_src", "_tokens", "_key"]
    table = cut(_keyed(docs.select("doc_id", "text", "source"), seed).select(*names))
    sources = cut(plan(table, target_entropy, repeats, budget))
    rows = cut(_repeat(table, sources, sources.count()).withColumn("_h", _order(F.col("_epoch"))))
    placed = running(rows, ["_src", "_epoch"], F.struct(F.col("_h").alias("h")), F.col("_tokens"), "_before", rows.count())
    stream = F.col("_epoch") * F.col("n_tokens") + F.col("_before")
    blocked = placed.withColumn("block", F.floor(stream / F.greatest(F.lit(1.0), F.col("weight") * block_tokens)).cast("long"))
    again = Window.partitionBy("block").orderBy(F.xxhash64("_h", "block"), "_epoch", "doc_id")
    return blocked.select(
        "doc_id", "source", F.col("_tokens").alias("tokens"), F.col("_epoch").alias("epoch"), "block",
        (F.row_number().over(again) - 1).cast("long").alias("position"), "weight",
    )


"""Tables of evaluation metrics: one row per configuration, merged, summarised and reshaped."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.operators.common import BROADCAST_BYTES, ordinal, table_bytes

# The metric columns that reports compare.
METRICS = ("SimLex-Correlation", "WordSim-Correlation", "Analogy-Accuracy", "Clustering-Silhouette")
BINS = 20


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def nan_to_null(name: str) -> Column:
    return F.when(F.isnan(_c(name)), None).otherwise(_c(name))


def merge_methods(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row union tagged with ``Method``; columns missing on one side are null."""
    merged = None
    for method, table in tables.items():
        tagged = table.withColumn("Method", F.lit(method))
        merged = tagged if merged is None else merged.unionByName(tagged, allowMissingColumns=True)
    return merged


def long_form(table: DataFrame, metrics: Sequence[str] = METRICS, ids: Sequence[str] = ("Method",)) -> DataFrame:
    """(ids.., metric, value) with NaN as null."""
    clean = table.select(*ids, *[nan_to_null(m).cast("double").alias(m) for m in metrics])
    return clean.unpivot([_c(i) for i in ids], [_c(m) for m in metrics], "metric", "value")


def method_summary(table: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Mean, sample deviation, minimum and maximum per method and metric; nulls are skipped."""
    return long_form(table, metrics).groupBy("Method", "metric").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )


def best_method(table: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Method of the highest mean per metric; ties go to the first name."""
    means = method_summary(table, metrics).filter("mean is not null")
    best = F.min(F.struct((-F.col("mean")).alias("neg"), "Method"))
    return means.groupBy("metric").agg(best.alias("b")).select(
        "metric", F.col("b.Method").alias("best"), (-F.col("b.neg")).alias("mean")
    )


def method_means(table: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """One row per method, one mean per metric column."""
    return table.groupBy("Method").agg(*[F.avg(nan_to_null(m)).alias(m) for m in metrics])


def metric_correlation(table: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of ``*Correlation*`` columns: (metric, one column per metric)."""
    names = list(columns or [c for c in table.columns if "Correlation" in c])

    def pair(a: str, b: str) -> Column:
        both = nan_to_null(a).isNotNull() & nan_to_null(b).isNotNull()
        return F.corr(F.when(both, _c(a)), F.when(both, _c(b)))

    wide = table.agg(*[pair(a, b).alias(f"c{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names)])
    rows = F.array(*[
        F.struct(F.lit(a).alias("metric"), *[F.col(f"c{i}_{j}").alias(b) for j, b in enumerate(names)])
        for i, a in enumerate(names)
    ])
    return wide.select(F.inline(rows))


def histograms(table: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """(metric, bin, lo, hi, n) per column: ``bins`` equal bins from minimum to maximum, the last one closed.

    Empty bins are kept; when all values of a column are equal they fall into its first bin; a column without values
    gives no rows. All columns are read together, once for their ranges and once for the counts.
    """
    values = long_form(table, columns, ids=()).filter("value is not null")
    spans = values.groupBy("metric").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    place = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    number = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(F.least(place, F.lit(bins - 1))).cast("int")
    spanned = values.join(F.broadcast(spans), "metric")  # one row per column of the table
    counts = spanned.groupBy("metric", "lo", "hi", number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    filled = F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("filled")  # at most ``bins`` entries
    every = counts.groupBy("metric", "lo", "hi").agg(filled).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    step = (F.col("hi") - F.col("lo")) / bins
    return every.select(
        "metric", "bin", (F.col("lo") + step * F.col("bin")).alias("lo"), (F.col("lo") + step * (F.col("bin") + 1)).alias("hi"),
        F.coalesce(F.try_element_at("filled", "bin"), F.lit(0).cast("long")).alias("n"),
    )


def histogram(table: DataFrame, column: str, bins: int = BINS) -> DataFrame:
    """(bin, lo, hi, n) of one column, as :func:`histograms`."""
    return histograms(table, [column], bins).drop("metric")


def box_summary(table: DataFrame, group: str, column: str) -> DataFrame:
    """Minimum, quartiles and maximum of a metric per group (linear interpolation); nulls are skipped.

    Values get their place by ranges, so no task holds a whole group; a quantile is the sum of the one or two values
    around its place, each times one minus its distance.
    """
    rows = table.select(_c(group).alias("_g"), nan_to_null(column).cast("double").alias("_v"), F.monotonically_increasing_id().alias("_k"))
    placed = ordinal(rows, [F.col("_g"), F.col("_v"), F.col("_k")], "_i")
    known = F.when(F.col("_v").isNotNull(), F.col("_i"))
    starts = placed.groupBy(F.col("_g").alias("_h")).agg(F.min(known).alias("_start"), F.count("_v").alias("_n"))
    size = table_bytes(starts.select(F.col("_h").cast("string").alias("_h")), "_h")
    joined = placed.join(F.broadcast(starts) if size <= BROADCAST_BYTES else starts, F.col("_g").eqNullSafe(F.col("_h")))

    def quantile(p: float) -> Column:
        near = 1 - F.abs(F.col("_i") - F.col("_start") - (F.col("_n") - 1) * p)
        return F.sum(F.when(near > 0, F.col("_v") * near))

    named = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    return joined.groupBy(F.col("_g").alias(group)).agg(*[quantile(p).alias(n) for n, p in named.items()])


def surface_pivot(table: DataFrame, column: str, dims: Sequence[int]) -> DataFrame:
    """Mean metric per weighting and window, one column per dimension."""
    return table.groupBy("Normalization", "Window").pivot("Dimensions", list(dims)).agg(F.avg(nan_to_null(column)))


def trend_series(table: DataFrame, x: str, y: str, hue: str) -> DataFrame:
    """Mean of ``y`` per ``hue`` and ``x``."""
    return table.groupBy(hue, x).agg(F.avg(nan_to_null(y)).alias("mean"))


def top_rows(table: DataFrame, column: str, keys: Sequence[str], n: int = 3) -> DataFrame:
    """The ``n`` best rows by a metric; ties by ``keys``."""
    return table.filter(nan_to_null(column).isNotNull()).orderBy(_c(column).desc(), *[_c(k) for k in keys]).limit(n)


def overall_range(table: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Smallest and largest value over all metrics."""
    low = [F.min(nan_to_null(m)) for m in metrics]
    high = [F.max(nan_to_null(m)) for m in metrics]
    return table.agg(F.least(*low).alias("low"), F.greatest(*high).alias("high"))


def overview_counts(table: DataFrame) -> DataFrame:
    return table.agg(F.count_distinct("Method").alias("methods"), F.count(F.lit(1)).alias("rows"))


def metrics_row(params: Mapping[str, object], analogy: DataFrame, silhouette: DataFrame,
                gold: Mapping[str, DataFrame]) -> DataFrame:
    """One row of parameters and scores from the one-row results of the evaluators.

    ``analogy`` holds accuracy, coverage and total, ``silhouette`` its mean, and ``gold`` maps a gold set's name to
    its (corr, coverage).
    """
    row = analogy.select(
        *[F.lit(v).alias(k) for k, v in params.items()],
        F.col("accuracy").alias("Analogy-Accuracy"), F.col("coverage").alias("Analogy-Coverage"),
        F.col("total").alias("Analogy-Total"),
    ).withColumn("Clustering-Silhouette", silhouette.select("silhouette").scalar())
    for name, scores in gold.items():
        row = row.withColumn(f"{name}-Correlation", scores.select("corr").scalar())
        row = row.withColumn(f"{name}-Coverage", scores.select("coverage").scalar())
    return row


def with_label(table: DataFrame, prefix: str) -> DataFrame:
    """Rows whose ``category`` starts with ``prefix``."""
    return table.filter(F.col("category").startswith(prefix))


def triples_from_tokens(tokens: DataFrame, order: Sequence[str]) -> DataFrame:
    """Cut the token array ``toks`` of every row into records of three (order.., rec, category, src, tgt).

    An incomplete tail is dropped. Rows stay where they are: there is no shuffle.
    """
    n = F.floor(F.size("toks") / 3)
    named = ("category", "src", "tgt")

    def record(r: Column) -> Column:
        cells = [F.get("toks", (r * 3 + i).cast("int")).alias(name) for i, name in enumerate(named)]
        return F.struct(r.alias("rec"), *cells)

    records = F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(n, F.lit(1)) - 1), record)
    return tokens.filter(n > 0).select(*order, F.inline(records))

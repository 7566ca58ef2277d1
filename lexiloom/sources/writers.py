"""Sinks: parquet tables partitioned by parameters, vector text, metric files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.operators.common import vector_shape
from lexiloom.session import CLEANUP, settings

OPEN_FOLDERS = "8"


def table_sink(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """Parquet; partition columns (window, norm, dim) become folders that later filters skip. A task keeps the files of several
    folders open, so rows are not sorted by folder, which would spill them all once; it sorts only if it meets more folders."""
    with settings(df.sparkSession, **{"spark.sql.maxConcurrentOutputFileWriters": OPEN_FOLDERS, CLEANUP: "true"}):
        df.write.mode(mode).option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def vector_line(word: Column, vec: Column) -> Column:
    return F.concat_ws(" ", word.cast("string"), F.array_join(vec.cast("array<string>"), " "))


def vectors_text_sink(vectors: DataFrame, path: str, mode: str = "errorifexists", header: bool = False) -> None:
    """``word v1 .. vd`` lines; with ``header`` the first file starts with a line of row count and dimension."""
    lines = vectors.select(vector_line(F.col("word"), F.col("vec")).alias("value"))
    if header:
        n, dim = vector_shape(vectors)
        lines = vectors.sparkSession.createDataFrame([(f"{n} {dim}",)], "value string").coalesce(1).union(lines)
    lines.write.mode(mode).text(path)


def metrics_sink(table: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Metric table as CSV with header or as JSON lines, by suffix."""
    if path.endswith(".csv"):
        table.write.mode(mode).option("header", True).csv(path)
    elif path.endswith(".json"):
        table.write.mode(mode).json(path)
    else:
        raise ValueError(f"unsupported file format: {path}; only .json and .csv are allowed")

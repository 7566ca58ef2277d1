"""Removal of repeated passages by overlapping windows of consecutive lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import size_checked, small_batches, tidy
from lexiloom.session import cut

WINDOW = 3


def windows(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """Every window of ``width`` consecutive lines: doc_id, text_hash, pos (its first line, from 0) and a 128-bit hash (h1, h2).

    Lines count without outer blanks. A window of blank lines only is none.
    """
    lines = docs.where("text is not null").select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.transform(F.split("text", "\n"), lambda x: F.trim(x)).alias("lines")
    ).where(F.size("lines") >= width)
    hashed = lines.select(
        "doc_id", "text_hash",
        F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), (x != "").alias("said"))).alias("hs"),
    )

    def window(i: Column) -> Column:
        parts = [F.col("hs")[i + k] for k in range(width)]
        said = F.lit(False)
        for p in parts:
            said = said | p["said"]
        return F.struct(
            i.alias("pos"), F.xxhash64(*[p["a"] for p in parts]).alias("h1"), F.xxhash64(*[p["b"] for p in parts]).alias("h2"), said.alias("said")
        )

    return (
        hashed.select("doc_id", "text_hash", F.explode(F.transform(F.sequence(F.lit(0), F.size("hs") - width), window)).alias("w"))
        .where("w.said").select("doc_id", "text_hash", "w.pos", "w.h1", "w.h2")
    )


def later_windows(found: DataFrame) -> DataFrame:
    """Occurrences (doc_id, text_hash, pos) of windows of a written table that are not the first by those three."""
    place = F.struct("doc_id", "text_hash", "pos")
    first = found.groupBy("h1", "h2").agg(F.min(place).alias("f"), F.max(place).alias("l")).where("f <> l").select("h1", "h2", "f")
    first = cut(first)
    return found.join(size_checked(first, first.count(), 64), ["h1", "h2"]).where(~place.eqNullSafe(F.col("f"))).select("doc_id", "text_hash", "pos")


def _rebuild(width: int):
    small_batches()
    @F.pandas_udf("n int, text string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, starts in tidy(batches):
            counts, out = [], []
            for text, at in zip(texts, starts):
                if text is None:
                    counts.append(0)
                    out.append(None)
                    continue
                lines = text.split("\n")
                covered = np.zeros(len(lines), bool)
                for k in range(width):
                    covered[np.asarray(at) + k] = True
                counts.append(int(covered.sum()))
                out.append("\n".join(x for x, gone in zip(lines, covered) if not gone))
            yield pd.DataFrame({"n": counts, "text": out})

    return run


def dedup_lines(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """All rows and columns of ``docs`` (doc_id, text, any others) with repeated passages gone from text, and n_removed.

    A passage is a window of ``width`` consecutive lines. Its first occurrence, in the order of doc_id, text hash and line,
    stays; the lines of all later ones go, in their own document too, overlapping ones merged. So a later copy of a whole
    document of at least ``width`` lines ends as an empty text, and a document with fewer lines is left alone. Rows that
    agree in doc_id and text are treated alike: they stand at the same place, so neither is later than the other. A null
    text stays null with nothing removed; a null doc_id comes before all others. An existing column n_removed is replaced.

    Windows are hashed where the text is read; only their hashes and places are shuffled, summed map-side, and the text
    moves only if the removals outgrow a broadcast.
    """
    found = cut(windows(docs.select("doc_id", "text"), width))
    gone = cut(later_windows(found).groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("_at")))
    size = gone.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("_at")), F.lit(0)).alias("m"), F.coalesce(F.sum(F.size("_at")), F.lit(0)).alias("s")).first()
    row_bytes = 64 + 8 * -(-size["s"] // max(1, size["n"]))
    small = size_checked(gone.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_th"), "_at"), size["n"], row_bytes)
    others = [c for c in docs.columns if c not in ("n_removed",)]
    rows = docs.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in others]).alias("_row"))  # any name, dots too
    met = rows.join(small, F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("_row.text") == F.col("_th")) & F.col("_row.text").isNotNull(), "left")
    fixed = met.withColumn("_new", _rebuild(width)(F.when(F.col("_at").isNotNull(), F.col("_row.text")), "_at"))  # only these texts go to Python
    return fixed.select(
        *[(F.when(F.col("_at").isNotNull(), F.col("_new.text")).otherwise(F.col("_row.text")) if c == "text" else F.col("_row").getField(c)).alias(c) for c in others],
        F.coalesce("_new.n", F.lit(0)).alias("n_removed"),
    )

"""Inputs of the registered queries, all read or derived from the given tables, and the queries' parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions import text as T
from lexiloom.functions.vectors import doubles
from lexiloom.operators import corpus as C
from lexiloom.operators import metrics as M
from lexiloom.session import spread

# Parameters of the registered queries; the SQL side states the same values.
STOP = ("the", "and", "for", "that", "with", "les", "des", "que", "und", "die", "der", "den", "los", "las", "una")
UNITS = ("the", "of", "de", "du", "en")
ACCENTED = "À-ÖØ-öø-ÿ"
MIN_FREQ = 5
WINDOWS = (2, 4, 6, 8, 10)
DIMS = (50, 100, 200, 300)
SETS = ("T1", "T2", "A1", "A2")
REG = 0.5  # at 0.05 these vectors are not settled after 2,000 rounds
TRANSPORT_TOL = 1e-13
MASK_TOKENS = tuple(f"t{i}" for i in range(64))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def toks() -> Column:
    """Token array of column ``sentence``: cleaned, split, filtered."""
    return T.filter_tokens(T.tokenize(T.clean_basic(F.col("sentence"))), STOP)


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return C.lines(spread(table(spark, sf, "documents").select("doc_id", "text")))


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, line, toks) of every line of every document."""
    return lines(spark, sf).select("doc_id", "line", toks().alias("toks"))


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """(word, vec) with ``vec_id`` as the word."""
    return spread(table(spark, sf, "embeddings").select(F.col("vec_id").alias("word"), doubles(F.col("embedding")).alias("vec")))


def rotated(vec: Column) -> Column:
    return F.concat(F.slice(vec, 2, F.size(vec) - 1), F.slice(vec, 1, 1))


def other_space(spark: SparkSession, sf: str) -> DataFrame:
    """The same words in a space whose axes are rotated by one place."""
    return vectors(spark, sf).select("word", rotated(F.col("vec")).alias("vec"))


def identity_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("src"), F.col("vec_id").alias("tgt"))


def next_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Every word with its successor; the last one has none and is dropped by look-ups."""
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("src"), (F.col("vec_id") + 1).alias("tgt"))


def gold(spark: SparkSession, sf: str) -> DataFrame:
    """(pid, src, tgt, score) with ties, and words that have no vector."""
    score = (F.pmod(F.col("doc_id") * 7, F.lit(11)) + F.col("quality")).cast("double")
    return table(spark, sf, "labels").select(
        F.col("doc_id").alias("pid"), F.col("doc_id").alias("src"), (F.col("doc_id") + 3).alias("tgt"), score.alias("score")
    )


def analogies(spark: SparkSession, sf: str) -> DataFrame:
    """One question per vector: (v, v+1, v+2, v+3); the last ones have unknown words."""
    v = F.col("vec_id")
    return table(spark, sf, "embeddings").select(
        v.alias("qid"), v.alias("a"), (v + 1).alias("b"), (v + 2).alias("c"), (v + 3).alias("d")
    )


def clusters(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("word"), doubles(F.col("embedding")).alias("vec"), F.col("label").alias("cluster")
    ))


def wordsets(spark: SparkSession, sf: str) -> DataFrame:
    """(set_name, word) from the labels' documents, some of which have no vector."""
    names = F.array(*[F.lit(s) for s in SETS])
    return table(spark, sf, "labels").select(
        F.get(names, F.pmod(F.col("doc_id"), F.lit(4)).cast("int")).alias("set_name"), F.col("doc_id").alias("word")
    )


def logits(spark: SparkSession, sf: str) -> DataFrame:
    """(role, token, logit): every vector is a prompt, its components are the logits of tokens t0, t1, ..."""
    cells = vectors(spark, sf).select(F.col("word").alias("role"), F.posexplode("vec").alias("p", "x"))
    return cells.select("role", F.concat(F.lit("t"), F.col("p").cast("string")).alias("token"), (F.col("x") * 10).alias("logit"))


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    """A metric table with one row per (lang, source): parameters from the source's number, scores as exact ratios."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    joined = docs.join(table(spark, sf, "labels"), "doc_id", "left")
    n = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    norms = F.array(F.lit("ppmi"), F.lit("tfidf"), F.lit("row_normalize"))
    dims = F.array(*[F.lit(d) for d in DIMS])

    def ratio(x: Column, scale: int) -> Column:
        return F.try_divide(F.sum(x).cast("double"), F.count(x) * scale)

    scores = joined.groupBy("lang", "source").agg(
        ratio(F.col("n_chars") % 97, 97).alias("SimLex-Correlation"),
        ratio(F.col("doc_id") % 89, 89).alias("WordSim-Correlation"),
        ratio(F.col("quality"), 1).alias("Analogy-Accuracy"),
        ratio(F.col("toxic") * 2 - F.col("quality"), 2).alias("Clustering-Silhouette"),
    )
    return scores.select(
        F.col("lang").alias("Method"), F.col("source").alias("Configuration"), (2 + n % 5 * 2).alias("Window"),
        F.get(norms, n % 3).alias("Normalization"), F.get(dims, n % 4).alias("Dimensions"), *M.METRICS,
    )

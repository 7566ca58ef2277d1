"""From raw documents to packed training sequences: five stages, each over all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm import langid, linededup, mixing, packing, simhash
from lexiloom.llm.queries import tokenizer_path
from lexiloom.session import cut, scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: no text, or no letters in a script that some language uses."""
    predict = langid.predictor(langid.fit(docs.where(~langid.held_out("doc_id"))))
    found = docs.select(F.struct("*").alias("row"), predict(F.col("text").cast("string")).alias("p"))
    return found.where((F.col("p.lang_pred") != "und") & (F.col("p.score") > 0)).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut later copies of three-line passages out of the texts; n_chars follows the text."""
    done = linededup.dedup_lines(docs)
    n_chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return done.withColumn("n_chars", n_chars).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near-duplicates."""
    return simhash.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Read small sources up to 1.5 times, as the tempered weights ask."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 1024 tokens."""
    return packing.pack(cut(packing.pieces(docs, tokenizer_path())))


STAGES = [("language_id", language), ("line_dedup", line_dedup), ("simhash_near_dedup", near_dedup), ("mixing", mix), ("packing", pack)]

#: Tokenising and fingerprints are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""Readers for corpora, vectors, dictionaries, gold sets, vocabularies and metric tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexiloom.operators.common import lookup, ordinal, table_bytes

HEADER = r"^\s*[+-]?\d+\s+[+-]?\d+\s*$"
BLANKS = r"\s+"


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """(pos, value): lines with a sortable position (file, byte offset of the split, place in the split)."""
    text = spark.read.text(path)
    pos = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("n"),
    )
    return text.select(pos.alias("pos"), "value")


def corpus_scan(spark: SparkSession, path: str) -> DataFrame:
    """(pos, sentence): whole non-empty lines of a corpus file."""
    return file_lines(spark, path).filter("value <> ''").withColumnRenamed("value", "sentence")


def _words(line: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(line, BLANKS, " ")), " ")


def parse_vectors(lines: DataFrame, header: bool | None = None, max_vocab: int | None = None) -> DataFrame:
    """(word, vec, pos) from lines (pos, value) of ``word v1 .. vd``.

    ``header``: True drops the first line, False keeps it, None drops it when it is two whole numbers. Lines with
    fewer than two fields are skipped; a number that cannot be read is an error. A repeated word keeps its first
    place and its last vector. With ``max_vocab`` reading ends at the line that brings the last new word.
    """
    if header is not False:
        first = lines.agg(F.min("pos")).scalar()
        is_header = (F.col("pos") == first) & (F.lit(True) if header else F.col("value").rlike(HEADER))
        lines = lines.filter(~is_header)
    parts = lines.select("pos", _words(F.col("value")).alias("p")).filter(F.size("p") >= 2)
    rows = parts.select(
        "pos", F.col("p")[0].alias("word"),
        F.slice("p", 2, F.greatest(F.size("p") - 1, F.lit(0))).cast("array<double>").alias("vec"),
    )
    if max_vocab is not None:
        seen = ordinal(rows.groupBy("word").agg(F.min("pos").alias("first")), [F.col("first")], "place")
        last = seen.filter(F.col("place") < max_vocab).agg(F.max("first")).scalar()
        rows = rows.filter(F.col("pos") <= last)
    return rows.groupBy("word").agg(F.max_by("vec", "pos").alias("vec"), F.min("pos").alias("pos"))


def vectors_scan(spark: SparkSession, path: str, header: bool | None = None, max_vocab: int | None = None) -> DataFrame:
    """Vector text file: header detected, absent (``header=False``) or present (``header=True``)."""
    return parse_vectors(file_lines(spark, path), header, max_vocab)


def repair_vectors(lines: DataFrame, dim: int) -> DataFrame:
    """(pos, word, vec): the parts before the first number, joined by ``_``; kept when ``dim`` numbers follow.

    Lines that start with a number are dropped.
    """
    floats = lines.select("pos", _words(F.col("value")).alias("p"))
    floats = floats.withColumn("v", F.transform("p", lambda x: x.try_cast("double")))
    first = F.array_position(F.transform("v", lambda x: x.isNotNull()), True)
    split = floats.withColumn("k", first).filter("k > 1")
    vec = F.slice("v", F.col("k").cast("int"), F.size("v"))
    out = split.select("pos", F.array_join(F.slice("p", 1, (F.col("k") - 1).cast("int")), "_").alias("word"), vec.alias("vec"))
    return out.filter((F.size("vec") == dim) & ~F.exists("vec", lambda x: x.isNull()))


def _readable(rows: DataFrame, good: Column, watch: Observation | None) -> DataFrame:
    """Rows that are ``good``; ``watch`` receives in the same pass how many ``lines`` there are and how many are ``skipped``."""
    if watch is not None:
        skipped = F.count_if(~F.coalesce(good, F.lit(False))).alias("skipped")
        rows = rows.observe(watch, F.count(F.lit(1)).alias("lines"), skipped)
    return rows.filter(good)


def parse_dict_ws(lines: DataFrame, watch: Observation | None = None) -> DataFrame:
    """(pos, src, tgt): first two whitespace fields; shorter lines are skipped, and counted by ``watch``."""
    parts = _readable(lines.select("pos", _words(F.col("value")).alias("p")), F.size("p") >= 2, watch)
    return parts.select("pos", F.col("p")[0].alias("src"), F.col("p")[1].alias("tgt"))


def _tabbed(lines: DataFrame, names: Sequence[str], watch: Observation | None = None, number: str | None = None) -> DataFrame:
    """Split trimmed lines on tabs into ``names``; lines with fewer fields, or an unreadable ``number``, are skipped."""
    trimmed = F.regexp_replace("value", r"^\s+|\s+$", "")
    good = F.size("p") >= len(names)
    if number is not None:
        good = good & F.get("p", F.lit(names.index(number))).try_cast("double").isNotNull()
    parts = _readable(lines.select("pos", F.split(trimmed, "\t").alias("p")), good, watch)
    return parts.select("pos", *[F.col("p")[i].alias(n) for i, n in enumerate(names)])


def known(rows: DataFrame, column: str, words: DataFrame) -> DataFrame:
    """Rows whose ``column`` is among ``words``."""
    named = words.select(F.col("word").alias(column)).distinct()
    return lookup(rows, named, [column], "left_semi", small_bytes=table_bytes(words, "word"))


def parse_dict_tab(lines: DataFrame, src_words: DataFrame, tgt_words: DataFrame, watch: Observation | None = None) -> DataFrame:
    """(pos, src, tgt) with both words known; malformed lines are skipped, and counted by ``watch``."""
    return known(known(_tabbed(lines, ["src", "tgt"], watch), "src", src_words), "tgt", tgt_words)


def malformed_count(lines: DataFrame, fields: int) -> DataFrame:
    """How many lines have fewer than ``fields`` tab-separated fields."""
    short = F.size(F.split("value", "\t")) < fields
    return lines.agg(F.count_if(short).alias("malformed"))


def parse_gold(lines: DataFrame, src_words: DataFrame, tgt_words: DataFrame, watch: Observation | None = None) -> DataFrame:
    """(pos, src, tgt, score); lines without a readable score, such as a header, are skipped, and counted by ``watch``."""
    rows = _tabbed(lines, ["src", "tgt", "score"], watch, "score").withColumn("score", F.col("score").try_cast("double"))
    return known(known(rows, "src", src_words), "tgt", tgt_words)


def parse_concepts(lines: DataFrame, src_words: DataFrame, tgt_words: DataFrame, watch: Observation | None = None) -> DataFrame:
    """(pos, category, src, tgt) with both words known; ``watch`` counts malformed lines."""
    rows = _tabbed(lines, ["category", "src", "tgt"], watch)
    return known(known(rows, "src", src_words), "tgt", tgt_words)


def parse_analogies(lines: DataFrame, watch: Observation | None = None) -> DataFrame:
    """(pos, a, b, c, d) from lines of exactly four words; ``watch`` counts the others."""
    parts = _readable(lines.select("pos", _words(F.col("value")).alias("p")), F.size("p") == 4, watch)
    return parts.select("pos", *[F.col("p")[i].alias(n) for i, n in enumerate("abcd")])


# Analogy questions used when no file is given.
ENGLISH_ANALOGIES = (
    ("king", "queen", "man", "woman"),
    ("paris", "france", "london", "england"),
    ("big", "biggest", "small", "smallest"),
)
HINDI_ANALOGIES = (
    ("राजा", "रानी", "पुरुष", "स्त्री"),
    ("पेरिस", "फ्रांस", "लंदन", "इंग्लैंड"),
    ("बड़ा", "सबसे बड़ा", "छोटा", "सबसे छोटा"),
)


def analogy_scan(spark: SparkSession, path: str | None, default: Sequence[tuple] = HINDI_ANALOGIES) -> DataFrame:
    """Questions of a file, or the ``default`` ones when the file does not exist."""
    if path is not None:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            return parse_analogies(file_lines(spark, path)).drop("pos")
    return spark.createDataFrame(list(default), "a string, b string, c string, d string")


def csv_scan(spark: SparkSession, path: str, names: Sequence[str] | None = None, sep: str = ",", header: bool = True,
             schema: str | None = None) -> DataFrame:
    """Delimited gold set; ``names`` renames the columns by place."""
    reader = spark.read.option("header", header).option("sep", sep)
    table = (reader.schema(schema) if schema else reader).csv(path)
    return table.toDF(*names) if names else table


def vocab_lines(spark: SparkSession, path: str) -> DataFrame:
    """(pos, word) of a one-word-per-line file; blank lines are dropped."""
    lines = file_lines(spark, path).select("pos", F.trim("value").alias("word"))
    return lines.filter("word <> ''")


def vocab_json(spark: SparkSession, path: str, max_bad: int = 0) -> DataFrame:
    """(word, idx) of a JSON object written one entry per line; blank lines and lone braces are no entries.

    More than ``max_bad`` lines that cannot be read are an error; up to so many are skipped.
    """
    inner = F.regexp_replace("value", r"^\s*\{?|[,\s]*\}?\s*$", "")
    lines = spark.read.text(path).select(inner.alias("inner")).filter(~F.col("inner").rlike(r"^[\s{},]*$"))
    entries = lines.select("inner", F.from_json(F.concat(F.lit("{"), "inner", F.lit("}")), "map<string,int>").alias("m"))
    unread = F.coalesce(F.size("m") < 1, F.lit(True)) | F.coalesce(F.exists(F.map_values("m"), lambda x: x.isNull()), F.lit(False))
    bad = entries.agg(F.count_if(unread)).first()[0]
    if bad > max_bad:
        raise ValueError(f"{bad} unreadable lines in {path}")
    return entries.filter(~unread).select(F.explode("m").alias("word", "idx"))


def metrics_scan(spark: SparkSession, path: str, schema: str | None = None, multi_line: bool = True) -> DataFrame:
    """Metric table from ``.csv`` or ``.json``; any other suffix is an error.

    A JSON file is one array of records (``multi_line``) or one record per line.
    """
    if path.endswith(".csv"):
        reader = spark.read.option("header", True).option("inferSchema", schema is None)
        return (reader.schema(schema) if schema else reader).csv(path)
    if path.endswith(".json"):
        reader = spark.read.option("multiLine", multi_line)
        return (reader.schema(schema) if schema else reader).json(path)
    raise ValueError(f"unsupported file format: {path}; only .json and .csv are allowed")


def metrics_dir_scan(spark: SparkSession, path: str, pattern: str = "*summary.json", schema: str | None = None,
                     multi_line: bool = True) -> DataFrame:
    """All matching JSON files below ``path``, tagged ``Configuration`` = name of the parent folder.

    Unreadable files and records are skipped.
    """
    reader = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("multiLine", multi_line)
        .option("ignoreCorruptFiles", True).option("mode", "DROPMALFORMED")
    )
    table = (reader.schema(schema) if schema else reader).json(path)
    parts = F.split(F.col("_metadata.file_path"), "/")
    return table.select("*", F.url_decode(F.element_at(parts, -2)).alias("Configuration"))

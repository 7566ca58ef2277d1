"""Registered queries: one per operator, each (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions import text as T
from lexiloom.functions import vectors as VX
from lexiloom.operators import alignment as A
from lexiloom.operators import alignment_eval as E
from lexiloom.operators import bias as B
from lexiloom.operators import cell_index
from lexiloom.operators import corpus as C
from lexiloom.operators import metrics as M
from lexiloom.operators import reduction as R
from lexiloom.operators import similarity as S
from lexiloom.operators import weighting as W
from lexiloom.operators.common import vector_shape
from lexiloom.plans import inputs as I
from lexiloom.session import cut, scratch_path, spread
from lexiloom.sources import readers, writers

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def r6(name: str):
    return F.round(F.col(name), 6).alias(name)


def w6():
    """``w`` to six places, the double that ``F.round`` gives. Only near ties, where the shortest decimal form decides, and from a million on
    is that form made, which takes longer than all other work on a weight."""
    w = F.col("w")
    scaled = w * 1e6
    clear = (F.abs(w) < 1e6) & (F.abs(scaled - F.floor(scaled) - 0.5) > 1e-3)
    return F.when(clear, F.floor(scaled + 0.5) / 1e6).otherwise(F.round(w, 6)).alias("w")


def _cells(df: DataFrame, *keys: str, vec: str = "vec") -> DataFrame:
    """Every component of every vector as a row (keys.., p, x); the key is ``word`` if none is named."""
    keys = keys or ("word",)
    return df.select(*keys, F.posexplode(vec).alias("p", "x")).select(*keys, "p", r6("x"))


# --- sources and sinks -------------------------------------------------------------------------------------------


@query
def corpus_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences written as a text corpus, read back as whole lines, counted."""
    path = scratch_path(spark, "corpus")
    I.lines(spark, sf).select("sentence").write.text(path)
    return readers.corpus_scan(spark, path).groupBy("sentence").agg(F.count(F.lit(1)).alias("n"))


@query
def vectors_text_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Vector lines whose words repeat: first place, last vector."""
    rows = I.table(spark, sf, "embeddings")
    line = writers.vector_line(F.concat(F.lit("w"), F.col("label").cast("string")), VX.doubles(F.col("embedding")))
    parsed = readers.parse_vectors(rows.select(F.col("vec_id").alias("pos"), line.alias("value")))
    return _cells(parsed.withColumnRenamed("pos", "first_pos"), "word", "first_pos")


@query
def vectors_text_capped(spark: SparkSession, sf: str) -> DataFrame:
    """The same, reading only up to the fifth new word."""
    rows = I.table(spark, sf, "embeddings")
    line = writers.vector_line(F.concat(F.lit("w"), F.col("label").cast("string")), VX.doubles(F.col("embedding")))
    parsed = readers.parse_vectors(rows.select(F.col("vec_id").alias("pos"), line.alias("value")), max_vocab=5)
    return _cells(parsed.withColumnRenamed("pos", "first_pos"), "word", "first_pos")


@query
def vectors_text_header(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors written as text below a header line, which the reader is told of."""
    path = scratch_path(spark, "vectors")
    writers.vectors_text_sink(I.vectors(spark, sf), path, header=True)
    back = readers.vectors_scan(spark, path, header=True)
    return _cells(back.withColumn("word", F.col("word").cast("long")))


@query
def vectors_text_sniff(spark: SparkSession, sf: str) -> DataFrame:
    """The same file, whose header line the reader detects."""
    path = scratch_path(spark, "vectors")
    writers.vectors_text_sink(I.vectors(spark, sf), path, header=True)
    return _cells(readers.vectors_scan(spark, path).withColumn("word", F.col("word").cast("long")))


@query
def vectors_text_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors written as text and read back without a header."""
    path = scratch_path(spark, "vectors")
    writers.vectors_text_sink(I.vectors(spark, sf), path)
    back = readers.vectors_scan(spark, path, header=False)
    return _cells(back.withColumn("word", F.col("word").cast("long")))


def _word_lines(spark: SparkSession, sf: str) -> DataFrame:
    return I.lines(spark, sf).select(F.struct("doc_id", "line").alias("pos"), F.col("sentence").alias("value"))


@query
def dict_scan_ws(spark: SparkSession, sf: str) -> DataFrame:
    pairs = readers.parse_dict_ws(_word_lines(spark, sf))
    return pairs.select("pos.doc_id", "pos.line", "src", "tgt")


@query
def dict_scan_tab_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """First two words of each line as a tab dictionary, kept when both are words of the conversations."""
    first = F.split("value", " ")
    rows = _word_lines(spark, sf).select("pos", F.array_join(F.slice(first, 1, 2), "\t").alias("value"))
    talk = I.table(spark, sf, "conversations").select(F.explode(F.split("text", r"\s+")).alias("word")).distinct()
    return readers.parse_dict_tab(rows, talk, talk).select("pos.doc_id", "pos.line", "src", "tgt")


@query
def malformed_count(spark: SparkSession, sf: str) -> DataFrame:
    """How many lines, as a tab dictionary of all their words, have no second field."""
    rows = _word_lines(spark, sf).select("pos", F.translate("value", " ", "\t").alias("value"))
    return readers.malformed_count(rows, 2)


@query
def gold_similarity_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Customer lines as a gold file; negative balances are written unreadable, customers without orders unknown."""
    bal = F.when(F.col("c_acctbal") < 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
    rows = I.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("pos"), F.concat_ws("\t", "c_name", "c_mktsegment", bal).alias("value")
    )
    buyers = I.table(spark, sf, "customer").join(
        I.table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi"
    ).select(F.col("c_name").alias("word"))
    segments = I.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("word")).distinct()
    return readers.parse_gold(rows, buyers, segments)


@query
def gold_similarity_renamed(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV whose columns are renamed by place."""
    path = scratch_path(spark, "gold")
    I.table(spark, sf, "supplier").write.option("header", True).csv(path)
    schema = "a bigint, b string, c string, d double"
    return readers.csv_scan(spark, path, ("s_no", "word1", "word2", "similarity"), schema=schema)


@query
def gold_similarity_plain(spark: SparkSession, sf: str) -> DataFrame:
    """A tab file with header."""
    path = scratch_path(spark, "gold")
    I.table(spark, sf, "part").select("p_name", "p_type", "p_retailprice").write.option("header", True).option("sep", "\t").csv(path)
    return readers.csv_scan(spark, path, sep="\t", schema="p_name string, p_type string, p_retailprice double")


@query
def analogy_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of exactly four words."""
    return readers.parse_analogies(_word_lines(spark, sf)).select("pos.doc_id", "pos.line", "a", "b", "c", "d")


@query
def analogy_file(spark: SparkSession, sf: str) -> DataFrame:
    """The same lines written to a file of questions and read back, counted."""
    path = scratch_path(spark, "analogies")
    I.lines(spark, sf).select("sentence").write.text(path)
    return readers.analogy_scan(spark, path).groupBy("a", "b", "c", "d").agg(F.count(F.lit(1)).alias("n"))


@query
def concept_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Part lines (type, name, brand) whose name is among the widgets and whose brand among those that begin with 1."""
    part = I.table(spark, sf, "part")
    rows = part.select(F.col("p_partkey").alias("pos"), F.concat_ws("\t", "p_type", "p_name", "p_brand").alias("value"))
    names = part.filter("p_name LIKE '% widget'").select(F.col("p_name").alias("word"))
    brands = part.filter("p_brand LIKE 'Brand#1%'").select(F.col("p_brand").alias("word"))
    return readers.parse_concepts(rows, names, brands)


@query
def vocab_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A vocabulary written one word per line and read back."""
    path = scratch_path(spark, "vocab")
    C.word_count(I.tokens(spark, sf)).select("word").write.text(path)
    return readers.vocab_lines(spark, path).select("word")


@query
def vocab_json(spark: SparkSession, sf: str) -> DataFrame:
    """A vocabulary written as one JSON entry per line and read back."""
    path = scratch_path(spark, "vocab")
    entry = F.to_json(F.create_map("word", F.col("freq").cast("int")))
    C.word_count(I.tokens(spark, sf)).select(F.concat(F.lit("  "), F.regexp_replace(entry, r"^\{|\}$", ""), F.lit(","))).write.text(path)
    return readers.vocab_json(spark, path).select("word", F.col("idx").alias("freq"))


METRIC_SCHEMA = (
    "Method string, Configuration string, Window int, Normalization string, Dimensions int, "
    "`SimLex-Correlation` double, `WordSim-Correlation` double, `Analogy-Accuracy` double, `Clustering-Silhouette` double"
)


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(f"`{c}`"), 6).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])


@query
def metrics_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A metric table written as CSV and read back."""
    path = scratch_path(spark, "metrics") + ".csv"
    writers.metrics_sink(I.metrics(spark, sf), path)
    return _rounded(readers.metrics_scan(spark, path, METRIC_SCHEMA))


@query
def metrics_dir_scan(spark: SparkSession, sf: str) -> DataFrame:
    """JSON files in one folder per configuration, read together and tagged with the folder."""
    path = scratch_path(spark, "metrics")
    I.metrics(spark, sf).repartition("Configuration").write.partitionBy("Configuration").json(path)
    schema = METRIC_SCHEMA.replace("Configuration string, ", "")
    return _rounded(readers.metrics_dir_scan(spark, path, "*.json", schema, multi_line=False))


@query
def table_sinks(spark: SparkSession, sf: str) -> DataFrame:
    """Weighted matrices written by window, one window read back: only its folder is scanned."""
    path = scratch_path(spark, "cooc")
    writers.table_sink(_cooc(spark, sf), path, ["window"])
    one = spark.read.parquet(path).filter("window = 4")
    return one.groupBy("window").agg(F.count(F.lit(1)).alias("nonzero"), F.sum("w").alias("total"))


# --- text ----------------------------------------------------------------------------------------------------------


@query
def clean_basic(spark: SparkSession, sf: str) -> DataFrame:
    return I.lines(spark, sf).select("doc_id", "line", T.clean_basic(F.col("sentence")).alias("clean"))


@query
def clean_minimal(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(I.table(spark, sf, "documents").select("doc_id", "text"))
    return docs.select("doc_id", T.clean_minimal(F.col("text")).alias("clean"))


@query
def clean_indic(spark: SparkSession, sf: str) -> DataFrame:
    return I.lines(spark, sf).select("doc_id", "line", T.clean_indic(F.col("sentence"), I.UNITS).alias("clean"))


@query
def preserved_phrases(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct number+unit and mixed-script phrases; the accented letters stand in for the second script."""
    s = F.col("sentence")
    found = F.concat(T.unit_phrases(s, I.UNITS), T.mixed_phrases(s, I.ACCENTED, I.UNITS))
    return I.lines(spark, sf).select(F.explode_outer(found).alias("phrase")).filter("phrase is not null").distinct()


@query
def tokenize(spark: SparkSession, sf: str) -> DataFrame:
    toks = T.tokenize(T.clean_basic(F.col("sentence")))
    return I.lines(spark, sf).select("doc_id", "line", F.size(toks).cast("long").alias("n"), F.array_join(toks, "|").alias("toks"))


@query
def filter_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return I.tokens(spark, sf).select("doc_id", "line", F.array_join("toks", "|").alias("toks"))


@query
def filter_tokens_indic(spark: SparkSession, sf: str) -> DataFrame:
    toks = T.filter_tokens_indic(T.tokenize(F.col("text")))
    return I.table(spark, sf, "conversations").select("conv_id", "turn", F.array_join(toks, "|").alias("toks"))


@query
def script_filter(spark: SparkSession, sf: str) -> DataFrame:
    toks = T.script_filter(T.tokenize(T.clean_basic(F.col("sentence"))), I.ACCENTED)
    return I.lines(spark, sf).select("doc_id", "line", F.array_join(toks, "|").alias("toks"))


@query
def triples_from_tokens(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(I.table(spark, sf, "documents").select("doc_id", "text"))
    return M.triples_from_tokens(docs.select("doc_id", T.tokenize(F.col("text")).alias("toks")), ["doc_id"])


@query
def repair_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with words of several parts, words that are numbers, and vectors that are too short."""
    vec = VX.doubles(F.col("embedding"))
    word = F.when(F.col("label") % 4 == 0, F.lit("new york")).when(F.col("label") % 4 == 1, F.lit("2007")).otherwise(F.lit("x"))
    kept = F.when(F.col("label") % 4 == 3, F.slice(vec, 1, 63)).otherwise(vec)
    rows = I.table(spark, sf, "embeddings").select(F.col("vec_id").alias("pos"), writers.vector_line(word, kept).alias("value"))
    return _cells(readers.repair_vectors(rows, 64), "pos", "word")


@query
def parse_params(spark: SparkSession, sf: str) -> DataFrame:
    """File stems built from parts, some malformed."""
    prefix = F.when(F.col("p_size") % 3 == 0, F.lit("hindi_embeddings_w")).when(F.col("p_size") % 3 == 1, F.lit("embeddings_w")).otherwise(F.lit("vectors_of_"))
    stem = F.concat(prefix, F.col("p_size").cast("string"), F.lit("_"), F.lower("p_type"), F.lit("_d"), F.col("p_partkey").cast("string"))
    p = T.parse_params(F.col("stem"))
    return I.table(spark, sf, "part").select("p_partkey", stem.alias("stem")).select(
        "p_partkey", p["window"].alias("window"), p["norm"].alias("norm"), p["dim"].alias("dim"),
        T.config_label(p["norm"], p["dim"]).alias("label"),
    )


@query
def topic_filters(spark: SparkSession, sf: str) -> DataFrame:
    part = I.table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("category"))
    return M.with_label(part, "S")


@query
def metric_filters(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(I.metrics(spark, sf).filter("Dimensions = 100 AND Normalization = 'ppmi'"))


@query
def template_fill(spark: SparkSession, sf: str) -> DataFrame:
    return B.prompts(I.table(spark, sf, "nation").select(F.col("n_name").alias("role")))


# --- vocabulary and co-occurrence ----------------------------------------------------------------------------------


@query
def corpus_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(C.corpus_stats(I.tokens(spark, sf)))


@query
def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return C.word_count(I.tokens(spark, sf))


@query
def build_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return C.build_vocab(I.tokens(spark, sf), I.MIN_FREQ)


@query
def build_vocab_unfiltered(spark: SparkSession, sf: str) -> DataFrame:
    return C.build_vocab_first_seen(I.tokens(spark, sf))


@query
def encode(spark: SparkSession, sf: str) -> DataFrame:
    vocab = cut(C.build_vocab(I.tokens(spark, sf), I.MIN_FREQ))
    placed = C.by_sentence(I.lines(spark, sf)).select(*C.SENTENCE, I.toks().alias("toks"))
    return C.compact_positions(C.encode(placed, vocab))


def _cooc(spark: SparkSession, sf: str, windows=I.WINDOWS, distance: bool = False) -> DataFrame:
    _, cooc, _ = C.build_matrices(I.lines(spark, sf), I.toks(), windows, I.MIN_FREQ, distance)
    return cooc


@query
def cooc_count(spark: SparkSession, sf: str) -> DataFrame:
    return _cooc(spark, sf, (2,))


@query
def cooc_distance(spark: SparkSession, sf: str) -> DataFrame:
    return _cooc(spark, sf, (2,), True).select("window", "row", "col", w6())


@query
def cooc_rownorm(spark: SparkSession, sf: str) -> DataFrame:
    _, cooc, n = C.build_matrices(I.lines(spark, sf), I.toks(), (2,), I.MIN_FREQ, True)
    return W.row_normalize(cooc, n, n_windows=1).select("window", "row", "col", w6())


@query
def cooc_multi_window(spark: SparkSession, sf: str) -> DataFrame:
    """All five windows from one pass, summarised per row."""
    cooc = _cooc(spark, sf)
    return cooc.groupBy("window", "row").agg(F.count(F.lit(1)).alias("nonzero"), F.sum("w").alias("total"))


@query
def matrix_info(spark: SparkSession, sf: str) -> DataFrame:
    _, cooc, n = C.build_matrices(I.lines(spark, sf), I.toks(), I.WINDOWS, I.MIN_FREQ)
    info = C.matrix_info(cooc, n, I.MIN_FREQ, False, False)
    return info.select(
        "window_size", F.col("shape")[0].alias("n_rows"), F.col("shape")[1].alias("n_cols"), "nonzero", "normalized",
        "distance_weighted", "min_frequency", "vocabulary_size",
    )


# --- weighting and reduction ---------------------------------------------------------------------------------------


def _weighted(spark: SparkSession, sf: str, method: str) -> DataFrame:
    _, cooc, n = C.build_matrices(I.lines(spark, sf), I.toks(), (2,), I.MIN_FREQ)
    return W.weight(cooc, method, n).select("window", "row", "col", w6())


@query
def ppmi(spark: SparkSession, sf: str) -> DataFrame:
    return _weighted(spark, sf, "ppmi")


@query
def tfidf(spark: SparkSession, sf: str) -> DataFrame:
    return _weighted(spark, sf, "tfidf")


@query
def row_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return _weighted(spark, sf, "row_normalize")


@query
def row_normalize_l2(spark: SparkSession, sf: str) -> DataFrame:
    _, cooc, n = C.build_matrices(I.lines(spark, sf), I.toks(), (2,), I.MIN_FREQ)
    return W.row_normalize(cooc, n, "l2", n_windows=1).select("window", "row", "col", w6())


@query
def top_ppmi_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Corpus to the twenty strongest word pairs: distance-weighted window 2, PPMI."""
    vocab, cooc, n = C.build_matrices(I.lines(spark, sf), I.toks(), (2,), I.MIN_FREQ, True)
    scored = W.ppmi(cooc, n, n_windows=1).filter("row < col").select("row", "col", w6().alias("ppmi"))
    best = scored.orderBy(F.desc("ppmi"), "row", "col").limit(20)
    a = vocab.select(F.col("idx").cast("int").alias("row"), F.col("word").alias("word_a"))
    b = vocab.select(F.col("idx").cast("int").alias("col"), F.col("word").alias("word_b"))
    return best.join(a, "row").join(b, "col").select("word_a", "word_b", "ppmi")


@query
def svd_embed(spark: SparkSession, sf: str) -> DataFrame:
    """Weighted by PPMI at window 2, fifty dimensions, U * sqrt(S)."""
    _, cooc, n = C.build_matrices(I.lines(spark, sf), I.toks(), (2,), I.MIN_FREQ)
    return R.svd_embed(W.ppmi(cooc, n), n, 50)


@query
def svd_leading(spark: SparkSession, sf: str) -> DataFrame:
    """The first column of U * S by PPMI at window 2, without its sign."""
    _, cooc, n = C.build_matrices(I.lines(spark, sf), I.toks(), (2,), I.MIN_FREQ)
    return R.svd_embed(W.ppmi(cooc, n), n, 10, power=1.0, tol=1e-6).select("idx", F.round(F.abs(F.col("vec")[0]), 3).alias("x"))


@query
def svd_embed_us(spark: SparkSession, sf: str) -> DataFrame:
    """Counts at window 5, fifty dimensions, U * S."""
    _, cooc, n = C.build_matrices(I.lines(spark, sf), I.toks(), (5,), I.MIN_FREQ)
    return R.svd_embed(cooc, n, 50, power=1.0)


def _sweep(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    vocab, cooc, n = C.build_matrices(I.lines(spark, sf), I.toks(), I.WINDOWS, I.MIN_FREQ)
    return R.sweep(cooc, vocab, n, I.WINDOWS, dims=I.DIMS), n


@query
def sweep(spark: SparkSession, sf: str) -> DataFrame:
    """Five windows, three weightings, four dimensions; one decomposition per window and weighting."""
    return _sweep(spark, sf)[0]


@query
def sweep_info(spark: SparkSession, sf: str) -> DataFrame:
    """One row per configuration of the sweep."""
    info = R.sweep_info(*_sweep(spark, sf))
    shapes = [F.col(f"{s}_shape")[i].alias(f"{s}_{k}") for s in ("original", "embedding") for i, k in enumerate(("rows", "columns"))]
    return info.select("key", "window_size", "normalization", "dimensions", *shapes)


@query
def merge_sweep_results(spark: SparkSession, sf: str) -> DataFrame:
    """Summaries by part type, then by brand size: the later table wins equal keys."""
    part = I.table(spark, sf, "part")
    first = part.groupBy(F.col("p_brand").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.max("p_size").alias("d"))
    second = part.filter("p_size > 45").groupBy(F.col("p_brand").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.min("p_size").alias("d"))
    return R.merge_by_key([first, second])


@query
def project_2d(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(R.project_2d(I.vectors(spark, sf)))


# --- similarity ----------------------------------------------------------------------------------------------------


@query
def cosine_pair(spark: SparkSession, sf: str) -> DataFrame:
    v = I.vectors(spark, sf)
    return S.cosine_cells(I.next_pairs(spark, sf), v, v).select("src", "tgt", r6("cos"))


@query
def l2_normalize(spark: SparkSession, sf: str) -> DataFrame:
    unit = S.unit_table(I.vectors(spark, sf))
    return unit.select("word", F.posexplode("vec").alias("p", "x")).select("word", "p", r6("x"))


@query
def analogy(spark: SparkSession, sf: str) -> DataFrame:
    got = S.analogy_predictions(I.analogies(spark, sf), I.vectors(spark, sf))
    return got.select("qid", "a", "b", "c", "d", "predicted", r6("cos"))


@query
def analogy_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(S.analogy_scores(I.analogies(spark, sf), I.vectors(spark, sf)))


@query
def topk_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    got = S.topk_neighbours(I.vectors(spark, sf), I.other_space(spark, sf), 5)
    return got.select("src", "tgt", r6("cos"), "rank")


@query
def approx_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    got = cell_index.approx_neighbours(I.vectors(spark, sf), I.other_space(spark, sf), 5)
    return got.select("src", "tgt", r6("cos"), "rank")


@query
def kmeans(spark: SparkSession, sf: str) -> DataFrame:
    return S.kmeans(I.vectors(spark, sf)).select("word", "cluster")


@query
def silhouette(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(S.silhouette_samples(I.clusters(spark, sf)))


@query
def silhouette_mean(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(S.silhouette(I.clusters(spark, sf)))


@query
def silhouette_squared(spark: SparkSession, sf: str) -> DataFrame:
    """The linear-time form on squared distances."""
    points = I.clusters(spark, sf)
    return points.agg(F.count(F.lit(1)).alias("n"), F.round(F.lit(S.silhouette_squared(points)), 6).alias("silhouette"))


@query
def gold_spearman(spark: SparkSession, sf: str) -> DataFrame:
    v = I.vectors(spark, sf)
    return _rounded(S.gold_correlation(I.gold(spark, sf), v, v))


@query
def gold_pearson(spark: SparkSession, sf: str) -> DataFrame:
    v = I.vectors(spark, sf)
    return _rounded(S.gold_correlation(I.gold(spark, sf), v, v, "pearson"))


@query
def group_cosine(spark: SparkSession, sf: str) -> DataFrame:
    """Every word of a category against the whole category in the other space."""
    concepts = I.table(spark, sf, "embeddings").select(
        F.concat(F.lit("c"), F.col("label").cast("string")).alias("category"), F.col("vec_id").alias("src"), F.col("vec_id").alias("tgt")
    )
    got = S.group_cosine(concepts, I.vectors(spark, sf), I.other_space(spark, sf))
    return got.select("category", "src", "tgt", r6("own_cos"), "n_targets", r6("mean_cos"))


# --- alignment -----------------------------------------------------------------------------------------------------


@query
def training_pairs(spark: SparkSession, sf: str) -> DataFrame:
    got = A.training_pairs(I.next_pairs(spark, sf), I.vectors(spark, sf), I.other_space(spark, sf))
    return _cells(got.withColumn("vec", F.concat("x", "y")), "src", "tgt")


def _required(spark: SparkSession, sf: str) -> DataFrame:
    pairs = I.table(spark, sf, "labels").filter("toxic = 1").select(F.col("doc_id").alias("src"), F.col("doc_id").alias("tgt"))
    return A.required_words(pairs, I.gold(spark, sf).filter("score > 10"))


@query
def required_words(spark: SparkSession, sf: str) -> DataFrame:
    return _required(spark, sf)


@query
def filter_vocab(spark: SparkSession, sf: str) -> DataFrame:
    """Required words first, then the others from the highest id down, 200 in all."""
    v = I.vectors(spark, sf).withColumn("pos", -F.col("word"))
    return _cells(A.filter_vocab(v, _required(spark, sf), 200), "word", "place")


@query
def procrustes(spark: SparkSession, sf: str) -> DataFrame:
    """The map from a space to its rotation, applied: the rotated vectors come back."""
    mapped, _ = A.align_procrustes(I.identity_pairs(spark, sf), I.vectors(spark, sf), I.other_space(spark, sf))
    return _cells(mapped)


@query
def dim_check(spark: SparkSession, sf: str) -> DataFrame:
    v = I.vectors(spark, sf)
    d = A.dim_check(v, I.other_space(spark, sf))
    return v.agg(F.count(F.lit(1)).alias("n"), F.lit(d).alias("dim"))


@query
def cca(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical scores against a rotated space: every score column has mean 0 and variance 1."""
    scores, _ = A.align_cca(I.identity_pairs(spark, sf), I.vectors(spark, sf), I.other_space(spark, sf))
    cells = scores.select(F.posexplode("vec").alias("p", "x"))
    return cells.groupBy("p").agg(F.count("x").alias("n"), F.abs(F.round(F.avg("x"), 6)).alias("mean"), F.round(F.var_samp("x"), 6).alias("variance"))


@query
def cca_correlations(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical correlations of every vector with its successor: how many, their sum of squares."""
    v = I.vectors(spark, sf)
    _, corr = A.align_cca(I.next_pairs(spark, sf), v, v)
    return I.next_pairs(spark, sf).agg(
        F.count(F.lit(1)).alias("pairs"), F.lit(len(corr)).cast("long").alias("n"), F.lit(round(float((corr**2).sum()), 6)).alias("squares")
    )


@query
def pair_sample(spark: SparkSession, sf: str) -> DataFrame:
    return A.pair_sample(I.next_pairs(spark, sf), 100)


def _plan(spark: SparkSession, sf: str) -> A.TransportPlan:
    train = A.training_pairs(I.next_pairs(spark, sf), I.vectors(spark, sf), I.vectors(spark, sf))
    return A.TransportPlan(train.withColumnRenamed("src", "pid"), I.REG, tol=I.TRANSPORT_TOL)


@query
def sinkhorn_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Log potentials, solved to tolerance."""
    return _plan(spark, sf).potentials().select("pid", r6("f"), r6("g"))


@query
def barycenter_targets(spark: SparkSession, sf: str) -> DataFrame:
    return _cells(_plan(spark, sf).barycenters(), "pid", vec="ybar")


@query
def barycenter_align(spark: SparkSession, sf: str) -> DataFrame:
    """Transport of a space onto itself, solved to tolerance: the plan is symmetric, so the map is the identity."""
    v = I.vectors(spark, sf)
    mapped, _ = A.align_transport(I.identity_pairs(spark, sf), v, v, sample_size=None)
    return mapped.select("word", F.posexplode("vec").alias("p", "x")).select("word", "p", F.round("x", 4).alias("x"))


@query
def barycenter_align_next(spark: SparkSession, sf: str) -> DataFrame:
    """Transport between two different sides, every word and its successor, solved to tolerance."""
    v = I.vectors(spark, sf)
    mapped, _ = A.align_transport(I.next_pairs(spark, sf), v, v, I.REG, tol=I.TRANSPORT_TOL)
    return _cells(mapped)


@query
def self_learning(spark: SparkSession, sf: str) -> DataFrame:
    """Five rounds with five neighbours."""
    mapped, _ = A.self_learning(I.identity_pairs(spark, sf), I.vectors(spark, sf), I.other_space(spark, sf))
    return _cells(mapped)


@query
def self_learning_nearest(spark: SparkSession, sf: str) -> DataFrame:
    """Five rounds with the nearest neighbour over the full vocabulary: the rotation is kept."""
    mapped, _ = A.self_learning(
        I.identity_pairs(spark, sf), I.vectors(spark, sf), I.other_space(spark, sf), k=1, dictionary_targets=False
    )
    return _cells(mapped)


# --- alignment evaluation ------------------------------------------------------------------------------------------


def _ranks(spark: SparkSession, sf: str) -> DataFrame:
    v = I.vectors(spark, sf)
    return E.translation_ranks(I.next_pairs(spark, sf), v, v)


@query
def translation_rank(spark: SparkSession, sf: str) -> DataFrame:
    return _ranks(spark, sf).select("src", "tgt", "n", r6("cos"), "rank")


@query
def precision_mrr(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(E.precision_mrr(_ranks(spark, sf)))


@query
def alignment_report(spark: SparkSession, sf: str) -> DataFrame:
    return E.alignment_report(E.precision_mrr(_ranks(spark, sf)))


@query
def semantic_similarity(spark: SparkSession, sf: str) -> DataFrame:
    v = I.vectors(spark, sf)
    return _rounded(E.semantic_similarity(I.gold(spark, sf), v, v))


@query
def hubness(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(E.hubness(I.vectors(spark, sf), I.other_space(spark, sf)))


@query
def evaluate_all(spark: SparkSession, sf: str) -> DataFrame:
    """Unmapped and Procrustes-mapped vectors against the rotated space."""
    v, other = I.vectors(spark, sf), I.other_space(spark, sf)
    mapped, _ = A.align_procrustes(I.identity_pairs(spark, sf), v, other)
    methods = {"none": v, "procrustes": mapped}
    return _rounded(E.evaluate_all(methods, I.next_pairs(spark, sf), I.gold(spark, sf), other))


@query
def sample_pairs(spark: SparkSession, sf: str) -> DataFrame:
    v = I.vectors(spark, sf)
    return E.sample_pairs(I.next_pairs(spark, sf), v, v, 200)


# --- bias ----------------------------------------------------------------------------------------------------------


def _found(spark: SparkSession, sf: str) -> DataFrame:
    return B.set_vectors(I.wordsets(spark, sf), I.vectors(spark, sf))


@query
def set_vectors(spark: SparkSession, sf: str) -> DataFrame:
    cells = _found(spark, sf).select("set_name", "word", F.posexplode_outer("vec").alias("p", "x"))
    return cells.select("set_name", "word", "p", r6("x"))


@query
def missing_words(spark: SparkSession, sf: str) -> DataFrame:
    return B.missing_words(_found(spark, sf))


@query
def mean_association(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(B.mean_association(_found(spark, sf)))


@query
def differential(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(B.differential(_found(spark, sf)))


@query
def weat_effect(spark: SparkSession, sf: str) -> DataFrame:
    got = B.weat_effect(_found(spark, sf))
    return _rounded(got.withColumn("missing", F.col("missing").cast("int")))


@query
def softmax_at_mask(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(B.softmax_at_mask(I.logits(spark, sf), I.MASK_TOKENS))


@query
def pair_bias(spark: SparkSession, sf: str) -> DataFrame:
    """Every even token against the next one."""
    probs = B.softmax_at_mask(I.logits(spark, sf), I.MASK_TOKENS)
    return _rounded(B.pair_bias(probs, list(zip(I.MASK_TOKENS[::2], I.MASK_TOKENS[1::2]))))


# --- metric tables -------------------------------------------------------------------------------------------------


@query
def metrics_row(spark: SparkSession, sf: str) -> DataFrame:
    """All scores of one embedding table."""
    v = I.vectors(spark, sf)
    params = {"Window": 10, "Normalization": "ppmi", "Dimensions": vector_shape(v)[1]}
    analogy_row = S.analogy_scores(I.analogies(spark, sf), v)
    gold = {"SimLex": S.gold_correlation(I.gold(spark, sf), v, v)}
    return _rounded(M.metrics_row(params, analogy_row, S.silhouette(I.clusters(spark, sf)), gold))


@query
def merge_methods(spark: SparkSession, sf: str) -> DataFrame:
    table = I.metrics(spark, sf).drop("Method")
    neural = table.filter("Dimensions > 100").drop("Window").withColumn("Analogy-Total", F.lit(3))
    return _rounded(M.merge_methods({"Co-occurrence": table.drop("Configuration"), "Neural": neural}))


@query
def method_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(M.method_summary(I.metrics(spark, sf)))


@query
def best_method(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(M.best_method(I.metrics(spark, sf)))


@query
def method_means_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(M.method_means(I.metrics(spark, sf)))


@query
def metric_correlation(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(M.metric_correlation(I.metrics(spark, sf)))


@query
def histograms(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(M.histograms(I.metrics(spark, sf), ("Window", "Dimensions", "SimLex-Correlation", "WordSim-Correlation")))


@query
def box_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(M.box_summary(I.metrics(spark, sf), "Normalization", "SimLex-Correlation"))


@query
def surface_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(M.surface_pivot(I.metrics(spark, sf), "SimLex-Correlation", I.DIMS))


@query
def trend_series(spark: SparkSession, sf: str) -> DataFrame:
    fixed = I.metrics(spark, sf).filter("Dimensions = 100")
    return _rounded(M.trend_series(fixed, "Window", "SimLex-Correlation", "Normalization"))


@query
def top3(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(M.top_rows(I.metrics(spark, sf), "SimLex-Correlation", ["Method", "Configuration"]))


@query
def overall_range(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(M.overall_range(I.metrics(spark, sf)))


@query
def overview_counts(spark: SparkSession, sf: str) -> DataFrame:
    return M.overview_counts(I.metrics(spark, sf))

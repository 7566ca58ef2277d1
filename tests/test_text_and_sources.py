import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lexiloom.functions import text as T
from lexiloom.operators import bias as B
from lexiloom.operators import metrics as M
from lexiloom.sources import readers, writers


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "t string").select(fn(F.col("t"))).first()[0]


def test_clean_keeps_accents_and_marks(spark):
    assert one(spark, "  Étion, dans 12 l'été!\t Ça  ", T.clean_basic) == "étion dans lété ça"
    assert one(spark, "Ab-C 12.", T.clean_minimal) == "abc 12"
    assert one(spark, "Ab, 12", lambda c: T.clean_basic(c, punctuation=False)) == "ab,"
    assert one(spark, "हिन्दी।", T.clean_basic) == "हिन्दी"


def test_clean_indic_wraps_once(spark):
    got = one(spark, "• 5 साल और 5 साल (कुछ)। ठीक?", T.clean_indic)
    assert got == "__5 साल__ और __5 साल__ ठीक"
    assert one(spark, "१० लाख 3 km", T.unit_phrases) == ["१० लाख"]
    assert one(spark, "यह IPL मैच है", T.mixed_phrases) == ["यह IPL"]
    assert one(spark, "plain text only", T.mixed_phrases) == []


def test_token_filters(spark):
    toks = F.array(*[F.lit(x) for x in ("the", "ab", "abc", "123", "१२३", "word")])
    df = spark.range(1)
    assert df.select(T.filter_tokens(toks, ["the"])).first()[0] == ["abc", "word"]
    hindi = F.array(*[F.lit(x) for x in ("का", "क", "घर", "house")])
    assert df.select(T.filter_tokens_indic(hindi)).first()[0] == ["घर", "house"]
    assert df.select(T.script_filter(hindi)).first()[0] == ["का", "क", "घर"]
    assert "the" in T.english_stop_words(spark)


def test_parse_params_and_label(spark):
    rows = spark.createDataFrame([("embeddings_w10_ppmi_d100",), ("hindi_embeddings_w2_tfidf_d50",), ("other",), ("embeddings_wx_ppmi_d1",)], "s string")
    got = [tuple(r[0]) for r in rows.select(T.parse_params(F.col("s"))).collect()]
    assert got == [(10, "ppmi", 100), (2, "tfidf", 50), (None, None, None), (None, None, None)]


def test_template_needs_a_mask(spark):
    roles = spark.createDataFrame([("doctor",)], "role string")
    assert B.prompts(roles).first()["prompt"] == "The doctor said that [MASK] is very busy."
    with pytest.raises(Exception, match="MASK"):
        B.prompts(roles, "The {role} is busy").collect()


def lines(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "pos long, value string")


def test_vector_lines(spark):
    rows = ["3 2", "a 1 2", "b 3 4", "short", "a 5 6", "c 7 8", "a 9 9"]
    got = {r["word"]: (r["pos"], r["vec"]) for r in readers.parse_vectors(lines(spark, rows)).collect()}
    assert got == {"a": (1, [9.0, 9.0]), "b": (2, [3.0, 4.0]), "c": (5, [7.0, 8.0])}
    capped = {r["word"]: r["vec"] for r in readers.parse_vectors(lines(spark, rows), max_vocab=3).collect()}
    assert capped == {"a": [5.0, 6.0], "b": [3.0, 4.0], "c": [7.0, 8.0]}
    assert "3" in {r["word"] for r in readers.parse_vectors(lines(spark, rows), header=False).collect()}


def test_repair_lines(spark):
    rows = ["new york 0.1 0.2", "2007 0.1 0.2", "x 0.1", "y 0.1 z"]
    got = [(r["word"], r["vec"]) for r in readers.repair_vectors(lines(spark, rows), 2).collect()]
    assert got == [("new_york", [0.1, 0.2])]


def test_dictionaries_and_gold(spark):
    words = spark.createDataFrame([("a",), ("b",), ("c",)], "word string")
    rows = lines(spark, ["a\tb", "a b", "a\tz", "b\tc\textra"])
    assert {(r["src"], r["tgt"]) for r in readers.parse_dict_tab(rows, words, words).collect()} == {("a", "b"), ("b", "c")}
    assert readers.malformed_count(rows, 2).first()[0] == 1
    gold = lines(spark, ["Hindi\tEnglish\tScore", "a\tb\t7.5", "a\tz\t1", "b\tc\tbad"])
    assert [(r["src"], r["tgt"], r["score"]) for r in readers.parse_gold(gold, words, words).collect()] == [("a", "b", 7.5)]
    groups = lines(spark, ["numbers\ta\tb", "colors\tz\tb", "broken\ta"])
    assert [r["category"] for r in readers.parse_concepts(groups, words, words).collect()] == ["numbers"]
    assert len(readers.parse_analogies(lines(spark, ["a b c d", "a b c", " a  b c e "])).collect()) == 2


def test_skipped_lines_are_counted_in_the_same_pass(spark):
    words = spark.createDataFrame([("a",), ("b",)], "word string")
    cases = (
        (lambda x, w: readers.parse_dict_ws(x, w), ["a b", "", "a", None, "b a c"], 2),
        (lambda x, w: readers.parse_dict_tab(x, words, words, w), ["a\tb", "a b", "a\tz"], 2),
        (lambda x, w: readers.parse_gold(x, words, words, w), ["a\tb\t1", "a\tb\tx", "a\tb", "z\tb\t2"], 2),
        (lambda x, w: readers.parse_concepts(x, words, words, w), ["c\ta\tb", "c\ta"], 1),
        (lambda x, w: readers.parse_analogies(x, w), ["a b a b", "a b a", "a b a b a"], 1),
    )
    for parse, values, good in cases:
        watch = Observation()
        parse(lines(spark, values), watch).collect()
        assert watch.get == {"lines": len(values), "skipped": len(values) - good}


def test_unreadable_vocabulary_lines_are_an_error(spark, tmp_path):
    path = tmp_path / "v.json"
    path.write_text('{\n  "a": 0,\n  "b" 1,\n  "c": x,\n\n  "d": 3\n}\n', encoding="utf-8")
    with pytest.raises(ValueError, match="2 unreadable lines"):
        readers.vocab_json(spark, str(path), max_bad=1)
    assert {tuple(r) for r in readers.vocab_json(spark, str(path), max_bad=2).collect()} == {("a", 0), ("d", 3)}


def test_files(spark, tmp_path):
    (tmp_path / "corpus.txt").write_text("first, with a comma\n\nsecond\n", encoding="utf-8")
    got = readers.corpus_scan(spark, str(tmp_path / "corpus.txt")).orderBy("pos")
    assert [r["sentence"] for r in got.collect()] == ["first, with a comma", "second"]
    (tmp_path / "v.json").write_text(json.dumps({"a,": 0, "रा\"जा": 1}, ensure_ascii=False, indent=2), encoding="utf-8")
    assert {(r["word"], r["idx"]) for r in readers.vocab_json(spark, str(tmp_path / "v.json")).collect()} == {("a,", 0), ("रा\"जा", 1)}
    for name in ("m1", "m2"):
        (tmp_path / "runs" / name).mkdir(parents=True)
        (tmp_path / "runs" / name / "neural_summary.json").write_text(json.dumps([{"Dimensions": 50, "Analogy-Accuracy": 0.5}]))
    (tmp_path / "runs" / "m2" / "other.txt").write_text("x")
    tagged = readers.metrics_dir_scan(spark, str(tmp_path / "runs"))
    assert sorted(r["Configuration"] for r in tagged.collect()) == ["m1", "m2"]
    with pytest.raises(ValueError):
        readers.metrics_scan(spark, "table.xlsx")
    assert readers.analogy_scan(spark, str(tmp_path / "none.txt")).count() == 3


def test_vector_file_round_trip(spark, tmp_path):
    v = spark.createDataFrame([("a", [1.5, -2.0]), ("b", [0.25, 1e-9])], "word string, vec array<double>")
    writers.vectors_text_sink(v, str(tmp_path / "v"))
    back = readers.vectors_scan(spark, str(tmp_path / "v"), header=False)
    assert {r["word"]: r["vec"] for r in back.collect()} == {"a": [1.5, -2.0], "b": [0.25, 1e-9]}


def test_partitioned_sink_prunes(spark, tmp_path):
    spark.range(10).selectExpr("id % 2 as window", "id").write.partitionBy("window").parquet(str(tmp_path / "t"))
    plan = spark.read.parquet(str(tmp_path / "t")).filter("window = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window" in plan


def test_triples_drop_the_tail(spark):
    toks = spark.createDataFrame([(1, "numbers ek one colors lal red tail".split()), (2, ["a", "b"]), (3, []), (4, None)], "g int, toks array<string>")
    got = M.triples_from_tokens(toks, ["g"])
    assert {(r["category"], r["src"], r["tgt"]) for r in got.collect()} == {("numbers", "ek", "one"), ("colors", "lal", "red")}


def test_clean_runs_on_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("One, two 3\n")
    stream = spark.readStream.text(str(tmp_path / "in")).select(T.tokenize(T.clean_basic(F.col("value"))).alias("toks"))
    run = stream.writeStream.format("memory").queryName("cleaned").start()
    run.processAllAvailable()
    run.stop()
    assert spark.table("cleaned").first()["toks"] == ["one", "two"]

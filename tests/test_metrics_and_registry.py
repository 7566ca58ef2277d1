import math
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lexiloom.operators import corpus as C
from lexiloom.operators import metrics as M
from lexiloom.plans import inputs as I
from lexiloom.session import cut

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark):
    nan = float("nan")
    rows = [("a", 0.1, 0.5, 1.0, nan), ("a", 0.3, 0.1, None, 0.2), ("b", 0.9, 0.2, 0.0, 0.4)]
    return spark.createDataFrame(rows, "Method string, " + ", ".join(f"`{m}` double" for m in M.METRICS))


def test_summary_skips_missing(spark, table):
    got = {(r["Method"], r["metric"]): r for r in M.method_summary(table).collect()}
    assert math.isclose(got["a", "SimLex-Correlation"]["std"], math.sqrt(0.02))
    assert got["a", "Clustering-Silhouette"]["mean"] == 0.2 and got["a", "Clustering-Silhouette"]["std"] is None
    best = {r["metric"]: r["best"] for r in M.best_method(table).collect()}
    assert best == {"SimLex-Correlation": "b", "WordSim-Correlation": "a", "Analogy-Accuracy": "a", "Clustering-Silhouette": "b"}


def test_merge_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2,)], "y int")
    got = {r["Method"]: (r["x"], r["y"]) for r in M.merge_methods({"p": a, "q": b}).collect()}
    assert got == {"p": (1, None), "q": (None, 2)}


def test_histogram_keeps_every_row_and_bin(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("x"))
    got = M.histogram(df, "x", 20).orderBy("bin").collect()
    assert len(got) == 20 and sum(r["n"] for r in got) == 101 and got[-1]["n"] == 6
    flat = M.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", 20).collect()
    assert sum(r["n"] for r in flat) == 2 and len(flat) == 20


def test_concept_scan_has_rows_and_drops_some(spark):
    n = entry.queries()["concept_scan"](spark, SF).count()
    assert 0 < n < spark.read.parquet(f"{SF}/part.parquet").count()


def test_box_summary_interpolates_and_keeps_empty_groups(spark):
    rows = [("a", float(x)) for x in (4, 1, 2, 3)] + [("b", 5.0), ("b", None), ("b", float("nan")), ("c", None), (None, 2.0), (None, 4.0)]
    got = {r["g"]: tuple(r)[1:] for r in M.box_summary(spark.createDataFrame(rows, "g string, v double"), "g", "v").collect()}
    assert got == {"a": (1, 1.75, 2.5, 3.25, 4), "b": (5,) * 5, "c": (None,) * 5, None: (2, 2.5, 3, 3.5, 4)}


def test_histograms_and_pair_bias_read_their_table_in_few_scans(spark):
    for name, table, most in (("histograms", "documents", 2), ("pair_bias", "embeddings", 1)):
        df = entry.queries()[name](spark, SF)
        assert 0 < _plan(df).count("FileScan parquet") <= 2 * most, name


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() == 20


def test_registry_and_oracles_agree():
    names = {n for n in entry.queries() if n not in entry.LLM_QUERIES}
    assert set(entry.oracle_sql()) <= names | set(entry.LLM_QUERIES)
    assert {n for n in names if n not in entry.oracle_sql()} == {
        "svd_embed", "svd_embed_us", "sweep", "kmeans", "self_learning", "approx_neighbours",
    }


@pytest.mark.parametrize("name", ["top_ppmi_pairs", "cooc_multi_window", "weat_effect", "translation_rank", "method_summary"])
def test_queries_equal_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from check import TABLES, rows

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(entry.oracle_sql()[name])
    df = entry.queries()[name](spark, SF)
    assert rows(df.columns, df.collect()) == rows([d[0] for d in cur.description], cur.fetchall())


def test_library_has_no_local_checkpoint_or_cross_join():
    for path in Path(entry.__file__).parent.glob("lexiloom/**/*.py"):
        if path.name != "oracles.py":
            assert not re.search(r"localCheckpoint\(|crossJoin\(", path.read_text(encoding="utf-8")), path


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_word_count_cleans_once_and_reads_only_the_text(spark):
    plan = _plan(entry.queries()["word_count"](spark, SF))
    assert plan.count("lower(sentence") == 1 and "ReadSchema: struct<text:string>" in plan


def test_counting_shuffles_raw_lines_once_and_pairs_once(spark):
    lines = I.lines(spark, SF)
    vocab = cut(C.build_vocab(I.tokens(spark, SF), 5))
    placed = C.by_sentence(lines).select(*C.SENTENCE, I.toks().alias("toks"))
    plan = _plan(C.cooccurrence(C.encode(placed, vocab)))
    assert plan.count("hashpartitioning(doc_id") == 1 and plan.count("lower(sentence") == 1
    assert plan.count("ENSURE_REQUIREMENTS") == 1 and "BroadcastHashJoin" in plan


def test_the_sweep_has_all_windows_and_dimensions(monkeypatch):
    from lexiloom.plans import inputs as I
    from lexiloom.plans import queries as Q

    asked = {}
    monkeypatch.setattr(Q.I, "lines", lambda *a: None)
    monkeypatch.setattr(Q.C, "build_matrices", lambda lines, toks, windows, *a: asked.update(built=windows) or (None, None, 1))
    monkeypatch.setattr(Q.I, "toks", lambda: None)
    monkeypatch.setattr(Q.R, "sweep", lambda cooc, vocab, n, windows, dims: asked.update(swept=windows, dims=dims))
    Q._sweep(None, "")
    assert asked == {"built": I.WINDOWS, "swept": I.WINDOWS, "dims": I.DIMS}
    assert I.WINDOWS == (2, 4, 6, 8, 10) and I.DIMS == (50, 100, 200, 300)

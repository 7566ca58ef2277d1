import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiloom.functions import text as T
from lexiloom.operators import corpus as C
from lexiloom.operators import pair_counts as P
from lexiloom.operators import weighting as W
from lexiloom.operators.common import lookup, ordinal
from lexiloom.plans.queries import w6
from lexiloom.session import cut
from lexiloom.sources import writers


def corpus(spark, sentences):
    rows = [(d, 0, s.split()) for d, s in enumerate(sentences)]
    return spark.createDataFrame(rows, "doc_id long, line int, toks array<string>")


def brute(sentences, vocab, window, distance):
    out = Counter()
    for s in sentences:
        ids = [vocab[t] for t in s.split() if t in vocab]
        for i, a in enumerate(ids):
            for j, b in enumerate(ids):
                if i != j and abs(i - j) <= window:
                    out[a, b] += 1 / abs(i - j) if distance else 1
    return out


SENTENCES = ["a b c", "b c", "a b a", "x", "c c c c d a b", "rare a b rare2 c"] * 2


@pytest.mark.parametrize("distance", [False, True])
def test_pairs_equal_brute_force(spark, distance):
    toks = corpus(spark, SENTENCES)
    vocab = C.build_vocab(toks, 3)
    ids = {r["word"]: r["idx"] for r in vocab.collect()}
    assert list(ids.values()) == sorted(ids.values()) or set(ids.values()) == set(range(len(ids)))
    got = C.cooccurrence(C.encode(toks, vocab), (1, 2, 4), distance).collect()
    for window in (1, 2, 4):
        mine = {(r["row"], r["col"]): r["w"] for r in got if r["window"] == window}
        want = brute(SENTENCES, ids, window, distance)
        assert mine.keys() == want.keys()
        assert all(math.isclose(mine[k], want[k]) for k in want)


def test_large_vocabulary_path_gives_the_same_codes(spark):
    toks = corpus(spark, SENTENCES)
    vocab = C.build_vocab(toks, 1).cache()
    small = C.encode(toks, vocab).collect()
    large = C.encode(toks, vocab, limit=300)
    assert Counter(small) == Counter(large.collect())
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and "toks" not in plan  # both branches read the marked words


def test_vocabulary_order(spark):
    toks = corpus(spark, ["b a", "c b", "a b"])
    assert {r["word"]: r["idx"] for r in C.build_vocab(toks, 1).collect()} == {"b": 0, "a": 1, "c": 2}
    assert {r["word"]: r["idx"] for r in C.build_vocab_first_seen(toks).collect()} == {"b": 0, "a": 1, "c": 2}
    assert C.build_vocab(toks, 2).count() == 2


def test_compact_positions_drop_short_sentences(spark):
    toks = corpus(spark, ["a x b", "a x x"])
    got = C.compact_positions(C.encode(toks, C.build_vocab(corpus(spark, ["a b"]), 1)))
    assert sorted((r["doc_id"], r["pos"], r["idx"]) for r in got.collect()) == [(0, 0, 0), (0, 1, 1)]


def test_stats_of_an_empty_corpus(spark):
    row = C.corpus_stats(corpus(spark, ["a"]).filter("doc_id < 0")).first()
    assert (row["total_sentences"], row["total_tokens"], row["avg_tokens_per_sentence"]) == (0, 0, 0.0)


def test_no_pairs_is_an_error(spark):
    with pytest.raises(ValueError):
        C.build_matrices(corpus(spark, ["a", "b"]), F.col("toks"), (2,), 1)


def test_weighting_properties(spark):
    _, cooc, n = C.build_matrices(corpus(spark, SENTENCES), F.col("toks"), (2,), 1)
    cells = {(r["row"], r["col"]): r["w"] for r in cooc.collect()}
    assert all(cells[b, a] == w for (a, b), w in cells.items())
    ppmi = W.ppmi(cooc, n)
    assert ppmi.count() == cooc.count() and ppmi.agg(F.min("w")).first()[0] >= 0
    sums = W.row_normalize(cooc, n).groupBy("row").agg(F.sum("w").alias("s")).collect()
    assert all(math.isclose(r["s"], 1) for r in sums)
    lengths = W.row_normalize(cooc, n, "l2").groupBy("row").agg(F.sum(F.col("w") * F.col("w")).alias("s")).collect()
    assert all(math.isclose(r["s"], 1) for r in lengths)
    with pytest.raises(ValueError):
        W.weight(cooc, "other", n)


def test_shuffled_lookup_equals_broadcast(spark):
    big = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k long, v string")
    for how in ("inner", "left", "left_semi"):
        a = lookup(big, small, ["k"], how, small_bytes=10).collect()
        b = lookup(big, small, ["k"], how, small_bytes=None).collect()
        assert Counter(tuple(sorted(r.asDict().items(), key=str)) for r in a) == Counter(tuple(sorted(r.asDict().items(), key=str)) for r in b)


def test_ordinal_is_dense_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x"))
    got = ordinal(df, [-F.col("x")]).orderBy("idx").collect()
    assert [r["idx"] for r in got] == list(range(5000)) and [r["x"] for r in got] == list(range(4999, -1, -1))


@pytest.mark.parametrize("distance", [False, True])
def test_chunks_with_a_halo_equal_brute_force(spark, distance):
    """Chunks without a known word, chunks with one, and windows that reach over several chunks."""
    rng = random.Random(4)
    long = [" ".join(rng.choice(["a", "b", "c", "d"] if rng.random() < share else ["u", "v"]) for _ in range(150)) for share in (0.9, 0.3, 0.05)]
    sentences = [*SENTENCES, *long, "u " * 40 + "a " + "u " * 40 + "b", "u"]
    toks = corpus(spark, sentences)
    ids = {w: i for i, w in enumerate("abcd")}
    vocab = spark.createDataFrame([(w, i, 9) for w, i in ids.items()], "word string, idx int, freq long")
    encoded = cut(C.encode(C.in_chunks(toks, size=7), vocab, sentence=C.CHUNK))
    got = C.cooccurrence(C.with_halo(encoded, 5), (1, 2, 5), distance, C.CHUNK).collect()
    for window in (1, 2, 5):
        mine = {(r["row"], r["col"]): r["w"] for r in got if r["window"] == window}
        want = brute(sentences, ids, window, distance)
        assert mine.keys() == want.keys() and all(math.isclose(mine[k], want[k]) for k in want)


def test_matrices_in_chunks_equal_matrices_in_place(spark):
    toks = corpus(spark, [*SENTENCES, " ".join(SENTENCES * 5)])
    _, placed, n = C.build_matrices(toks, F.col("toks"), (1, 4), 2)
    _, chunked, m = C.build_matrices(toks, F.col("toks"), (1, 4), 2, chunk=16)
    assert n == m and sorted(map(tuple, placed.collect())) == sorted(map(tuple, chunked.collect()))


def test_one_endless_line_is_spread_over_all_tasks(spark):
    endless = spark.range(1).select(F.col("id").alias("doc_id"), F.lit(0).alias("line"), F.expr("transform(sequence(1, 1000000), x -> concat('w', (x % 8191) * (x % 8191) % 97))").alias("toks"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a million short words are little for a task
    try:
        rows = C.in_chunks(endless).groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.size("toks")).alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(rows) >= 6 and sum(r["n"] for r in rows) == 1_000_000 and max(r["n"] for r in rows) < 400_000
    _, cooc, n = C.build_matrices(endless, F.col("toks"), (2,), 1)
    assert cooc.agg(F.sum("w")).first()[0] == 2 * (999_999 + 999_998)


def test_empty_corpus_is_an_error_and_does_not_hang(spark):
    empty = spark.createDataFrame([], "doc_id long, line int, toks array<string>")
    for df in (empty, corpus(spark, ["a b"]).filter("doc_id > 5"), corpus(spark, ["a b"]).filter("false")):
        with pytest.raises(ValueError):
            C.build_matrices(df, F.col("toks"), (2,), 1)


def test_margins_are_broadcast_by_the_windows_that_are_there(spark):
    cells = spark.range(40).select((F.col("id") % 20).cast("int").alias("window"), F.lit(0).alias("row"), F.col("id").cast("int").alias("col"), F.lit(1.0).alias("w"))
    assert W._bytes(cells, None, 10) == 20 * 10 * W.MARGIN_ROW_BYTES and W._bytes(cells, 3, 10) == 3 * 10 * W.MARGIN_ROW_BYTES


def test_tasks_that_window_grow_with_the_corpus(spark):
    """As many tasks as keep each at some two million tokens; adaptive execution does not merge them."""
    lines = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(0).alias("line"))
    placed = C.by_sentence(lines, tokens=100 * C.TASK_TOKENS)
    assert placed.rdd.getNumPartitions() == 100
    assert placed.groupBy(F.spark_partition_id().alias("p")).count().count() > 90


def test_the_table_is_written_as_one_row_per_unordered_pair(spark):
    """Five windows and both halves of the matrix are made when the table is read."""
    _, cooc, _ = C.build_matrices(corpus(spark, SENTENCES), F.col("toks"), min_freq=1)
    rows = cooc.collect()
    written = spark.read.parquet(*cooc.inputFiles())
    assert written.count() == len({frozenset((r["row"], r["col"])) for r in rows}) < len(rows) / 5
    assert {r["window"] for r in rows} == {2, 4, 6, 8, 10}


def test_pairs_are_counted_without_a_shuffle_of_sentences(spark):
    """From lists of words blocks of sums are dealt once, by block number; no token is a row."""
    lists = corpus(spark, SENTENCES).select(P.hashes(F.col("toks"), 0).alias("ids"), F.size("toks").alias("own"))
    plan = P.sums(P.blocks(lists, 2, 9, 16), (2,), False, 9, 16)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(part") == 1 and plan.count("Exchange") == 1
    assert "Window" not in plan and "Generate" not in plan and "Aggregate" not in plan


@pytest.mark.parametrize("distance", [False, True])
def test_ways_to_look_words_up_give_the_brute_force_table(spark, monkeypatch, distance):
    """Hashes, indices with a split vocabulary, chunks beside short sentences, and buffers that are full after each batch."""
    monkeypatch.setattr(P, "BUFFER_PAIRS", 1)
    monkeypatch.setattr(P, "PART_PAIRS", 4)
    sentences = [*SENTENCES, "", "z " * 30, " ".join(SENTENCES * 3)]
    toks = corpus(spark, sentences).unionByName(spark.createDataFrame([(99, 0, None)], "doc_id long, line int, toks array<string>"))
    for chunk, limit in ((1000, 1 << 20), (1000, 10), (16, 1 << 20), (16, 10)):
        vocab, cooc, n = C.build_matrices(toks, F.col("toks"), (1, 2, 4), 2, distance, chunk=chunk, limit=limit)
        ids = {r["word"]: r["idx"] for r in vocab.collect()}
        got = cooc.collect()
        for window in (1, 2, 4):
            mine = {(r["row"], r["col"]): r["w"] for r in got if r["window"] == window}
            want = brute(sentences, ids, window, distance)
            assert n == len(ids) and mine.keys() == want.keys() and all(math.isclose(mine[k], want[k]) for k in want)


def test_known_hashes_are_found_and_others_are_not():
    rng = np.random.default_rng(5)
    ends = np.iinfo(np.int64)
    table = np.unique(np.concatenate([rng.integers(ends.min, ends.max, 4000), [ends.min, ends.max, 0, -1]]))
    bits = P._bits(len(table))
    first = np.searchsorted(table, np.arange(-(1 << bits - 1), 1 << bits - 1, dtype=np.int64) << (64 - bits)).astype(np.int32)
    other = np.setdiff1d(rng.integers(ends.min, ends.max, 4000), table)
    known, idx = np.append(table, ends.max), np.append(np.arange(len(table), dtype=np.int32), -1)
    assert (P._find(table, known, idx, first, bits) == np.arange(len(table))).all() and (P._find(other, known, idx, first, bits) == -1).all()


def test_words_that_share_a_hash_get_another_salt(spark, monkeypatch):
    monkeypatch.setattr(P, "_hash", lambda word, salt: F.length(word).cast("long") if salt < 2 else F.xxhash64(F.lit(salt), word))
    assert P.salt_of(spark.createDataFrame([("aa",), ("bb",)], "word string")) == 2


def test_a_margin_above_the_limit_shuffles_rare_words_only(spark, monkeypatch):
    _, cooc, n = C.build_matrices(corpus(spark, SENTENCES), F.col("toks"), (2,), 1)
    ways = [lambda: W.row_normalize(cooc, n, "l2", n_windows=1), lambda: W.ppmi(cooc, n, n_windows=1), lambda: W.tfidf(cooc, n)]
    want = [sorted(map(tuple, way().collect())) for way in ways]
    monkeypatch.setattr(W, "BROADCAST_BYTES", 3 * W.MARGIN_ROW_BYTES)
    for way, rows in zip(ways, want):
        got = way()
        assert sorted(map(tuple, got.collect())) == rows
        assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_weights_are_rounded_as_spark_rounds_them(spark):
    rng = random.Random(6)
    near = [k / 1e6 + 5e-7 + e for k in range(0, 3000, 7) for e in (0, 1e-16, -1e-16, 1e-12, -1e-9, 2e-9)]
    values = [*near, *(-x for x in near), *(rng.uniform(-3, 3) for _ in range(5000)), *(rng.uniform(0, 3e6) for _ in range(5000)), 0.0, -0.0, -1e-9, 1e18, 1e300, math.inf, -math.inf, math.nan, None]
    df = spark.createDataFrame([(x,) for x in values], "w double")
    bits = df.select(F.round("w", 6).cast("string").alias("a"), w6().cast("string").alias("b"))
    assert bits.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0



def test_tokens_that_cannot_be_numbers_are_kept_without_a_pattern(spark):
    words = ["12", "a1", "1a", "zz", "z{", "{", "{{", "٣٤", "१२", "café", "été", "_1", "ZZ", "the", "a", "99z", "", None]
    rows = spark.createDataFrame([(words,)], "toks array<string>")
    plain = F.filter("toks", lambda t: (F.length(t) >= 2) & ~t.isin("the") & ~t.rlike(r"^\p{Nd}+$"))
    a, b = rows.select(plain, T.filter_tokens(F.col("toks"), ["the"], 2)).first()
    assert a == b and "12" not in a and "٣٤" not in a and "z{" in a


def test_margins_are_broadcast_in_blocks_below_the_limit_of_rows(spark, monkeypatch):
    """Eight bytes a word: a margin that is above the limit row by row is not split, its table is read as often as before."""
    _, cooc, n = C.build_matrices(corpus(spark, SENTENCES), F.col("toks"), (2,), 1)
    want = [sorted(map(tuple, way(cooc, n, n_windows=1).collect())) for way in (W.row_normalize, W.ppmi, W.tfidf)]
    for limit, scans in ((n * W.MARGIN_ROW_BYTES - 1, 1), (n * 8 - 1, 2)):
        monkeypatch.setattr(W, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(W, "MARGIN_BLOCK", 2)
        for way, rows in zip((W.row_normalize, W.ppmi, W.tfidf), want):
            assert sorted(map(tuple, way(cooc, n, n_windows=1).collect())) == rows
        plan = W.row_normalize(cooc, n, n_windows=1)._jdf.queryExecution().optimizedPlan().toString()
        assert (plan.count("Join") == 1) == (scans == 1)


def test_sink_by_window_is_not_sorted(spark, tmp_path):
    docs = [(d, 0, [f"w{(d * 7 + i * i) % 40}" for i in range(60)]) for d in range(30)]
    rows = spark.createDataFrame(docs, "doc_id long, line int, toks array<string>")
    _, cooc, _ = C.build_matrices(rows, F.col("toks"), (2, 4, 6), 1)
    path = str(tmp_path / "sink")
    writers.table_sink(cooc, path, ["window"])
    log = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [log.apply(i).physicalPlanDescription() for i in range(log.size())]
    assert not re.search(r"\bSort\b", next(p for p in plans if path in p and "InsertIntoHadoopFs" in p))
    want = sorted(map(tuple, cooc.select("row", "col", "w", "window").collect()))
    assert sorted(map(tuple, spark.read.parquet(path).select("row", "col", "w", "window").collect())) == want


def test_cut_removes_the_shuffle_files_of_its_plan(spark):
    def files():
        folders = spark._jsc.sc().env().blockManager().diskBlockManager().localDirs()
        return {f for d in folders for _, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_") and f.endswith(".data")}

    before = files()
    back = cut(spark.range(1000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count())
    assert not files() - before
    assert back.count() == 7


def test_pair_blocks_shrink_to_the_bytes_that_differ():
    values = np.cumsum(np.random.default_rng(4).integers(1, 1 << 24, 5000))
    packed = P.planes(np.diff(values, prepend=0))
    assert np.array_equal(np.cumsum(P.from_planes(packed, np.int64)), values)
    assert not any(packed[4 * 5000:]) and np.array_equal(P.from_planes(P.planes(np.arange(9, dtype=np.int32)), np.int32), np.arange(9))

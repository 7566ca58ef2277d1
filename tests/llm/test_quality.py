"""Quality rules: counts and base rule by brute force, isolation trees by plain recursion, held-out labels, odd tables."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiloom.llm import quality, queries

SF = "/root/testdata/sf0.01"


def counts_of(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search("[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


HARD = [
    None, "", " \n\t ", "a " * 9, "a b c d e f g h a b c d e f g h", "one\none\n \n \none two\x85three\xa0four", "x\x1cy z\x0bw", "# $% |<>&*\n# $% |<>&*",
    "é" * 50 + " " + "日本 " * 30, "w1 w2 w3 w4 w5 w6 w7 w8 " + "q " * 3 + "w1 w2 w3 w4 w5 w6 w7 w8", "same line\n" * 30,
]


def test_counts_equal_brute_force():
    rng = random.Random(3)
    texts = HARD + [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) + rng.choice(["", "\n", "\nx\nx"]) for _ in range(200)]
    got, features = quality.measure(texts)
    assert [tuple(r) for r in got.tolist()] == [counts_of(t) for t in texts]
    assert np.isfinite(features).all()


def test_windows_do_not_cross_documents():
    ids = np.array([1, 2, 3, 4, 5, 6, 7, 8] * 2)
    assert quality.repeated(ids, np.repeat([0, 1], 8), 2).tolist() == [0, 0]
    assert quality.repeated(ids, np.zeros(16, int), 1).tolist() == [16]


def test_scores_equal_plain_descent():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(size=(500, 3)), [[9, 9, 9]]])
    forest = quality.grow(x, trees=20, subsample=64)

    def path(t, row):
        node = 0
        while forest.feature[t, node] >= 0:
            node = 2 * node + 1 + int(row[forest.feature[t, node]] >= forest.split[t, node])
        return forest.length[t, node]

    want = [2 ** (-np.mean([path(t, row) for t in range(20)]) / forest.expected) for row in x]
    assert np.allclose(forest.scores(x), want)
    assert forest.scores(x).argmax() == 500
    assert quality.mean_path(2) == 1.0 and quality.mean_path(1) == 0.0
    assert quality.grow(x[:1]).scores(x[:2]).tolist() == [0, 0]


def test_threshold_equals_trying_every_cut():
    rng = random.Random(4)
    for _ in range(50):
        counts = {(rng.randrange(11), k % 2): rng.randrange(1, 9) for k in range(12)}
        good, bad = (sum(n for (_, q), n in counts.items() if q == k) for k in (1, 0))

        def cost(cut):
            lost = sum(n for (b, q), n in counts.items() if q and b >= cut)
            left = sum(n for (b, q), n in counts.items() if not q and b < cut)
            return left / bad + 4 * lost / good

        least = min(cost(c) for c in range(12))
        assert quality.threshold(counts, 10) == max(c for c in range(12) if cost(c) <= least + 1e-12) / 10
    assert quality.threshold({(3, 1): 5}) == np.inf


def test_query_counts_and_base_rule(spark):
    texts = {r["doc_id"]: r["text"] for r in queries.read(spark, "/root/testdata/sf0.001", "documents").collect()}
    rows = queries.op12_quality(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, chars, symbols, dup, repeat = counts_of(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert r["base_failed"] == (n < 20 or 100 * repeat > 30 * n) and not (r["base_failed"] and r["kept"])


def test_held_out_labels(spark):
    docs, labels = queries.read(spark, "/root/testdata/sf0.1", "documents"), queries.read(spark, "/root/testdata/sf0.1", "labels")
    learned = labels.where("crc32(cast(doc_id as string)) % 2 = 0")
    found = quality.judge(docs, learned).join(labels.where("crc32(cast(doc_id as string)) % 2 = 1"), "doc_id").where("not base_failed")
    share = {r["quality"]: r["kept"] for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.99 and share[0] < 0.05


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i % 6 if i else None, t, 0.5, "f", i) for i, t in enumerate(HARD)] + [(9007199254740993, "long word " * 100_000, 0.5, "f", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, score double, features string, n_words int")


def test_odd_tables(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, 1), (1, 1, 1)], "doc_id long, quality int, toxic int")
    rows = quality.judge(odd, labels).collect()
    want = sorted((r["doc_id"] if r["doc_id"] is not None else -1, counts_of(r["text"])) for r in odd.where("doc_id < 100 or doc_id is null").collect())
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], tuple(r[c] for c in quality.COUNTS)) for r in rows if r["doc_id"] != 9007199254740993)
    assert got == want
    long = [r for r in rows if r["doc_id"] == 9007199254740993]
    assert len(long) == 1 and long[0]["n_words"] == 200_000 and long[0]["n_repeat_words"] == 200_000 and not long[0]["kept"]
    assert quality.judge(odd.limit(0), labels).count() == 0
    assert all(r["kept"] == (not r["base_failed"]) for r in quality.judge(odd, labels.limit(0)).collect())

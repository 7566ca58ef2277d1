"""Embedding links, neighbours, SimHash classes, components, and the pipeline, against brute force."""

import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lexiloom.llm import nndescent, permindex, queries, simhash
from lexiloom.llm.common import components
from lexiloom.session import cut


def classes(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 180)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = classes(300, pairs)
    assert got == {x: want[x] for x in {y for p in pairs if p[0] != p[1] for y in p}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(8)
    x = list(rng.normal(size=(500, 24)))
    for k in range(60):
        x.append(x[k] + rng.normal(scale=0.08, size=24))
    x += [x[70] + rng.normal(scale=0.05, size=24) for _ in range(150)]  # a crowd
    x += [x[0] * 3, x[1].copy(), x[1].copy()]
    rows = [(i, v.tolist(), "l") for i, v in enumerate(x)]
    bad = [(900, None, "l"), (901, [0.0] * 24, "l"), (902, [float("nan")] + [1.0] * 23, "l"), (903, [None] + [1.0] * 23, "l"), (904, [float("inf")] * 24, "l"), (905, [], "l")]
    return spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, n_links string"), np.stack(x)


def test_embedding_links(vectors):
    table, x = vectors
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    want = classes(len(x), zip(*np.nonzero(near)))
    got = {r["vec_id"]: r for r in nndescent.near_duplicates(table).collect()}
    assert len(got) == len(x) + 6
    for i in range(len(x)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (near[i].sum(), want[i], want[i] == i)
    assert all((got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True) for i in range(900, 906))


def test_block_counts_over_several_blocks(spark, monkeypatch, vectors):
    monkeypatch.setattr(nndescent, "BLOCK", 40)
    _, x = vectors
    u = x[:150] / np.linalg.norm(x[:150], axis=1)[:, None]
    members = spark.createDataFrame([(i, 7, 150, i % 3 + 1, v.tolist()) for i, v in enumerate(u)], "node long, part long, size long, m long, vec array<double>")
    near = u @ u.T >= 0.3
    np.fill_diagonal(near, False)
    want = near @ (np.arange(150) % 3 + 1)
    assert {r["node"]: r["links"] for r in nndescent.block_counts(members, 0.3).collect()} == dict(enumerate(want.tolist()))


def test_saturated_lists_do_not_hide_links_that_leave_the_component(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(scale=0.02, size=(41, 24))
    x[:20, 0] += 1
    x[20:40, :2] += np.cos(0.48), np.sin(0.48)  # beside the first twenty, with cosines about 0.9
    x[40, 5] += 1
    u = x / np.linalg.norm(x, axis=1)[:, None]
    cosine = u @ u.T
    near = cosine >= 0.88
    np.fill_diagonal(near, False)
    across = near[:20, 20:40].sum()
    assert 0 < across < 400 and not near[40].any()
    nodes = cut(spark.createDataFrame([(i, i % 2 + 1, v.tolist()) for i, v in enumerate(u)], "node long, m long, vec array<double>"))
    own = [(i, j, float(cosine[i, j])) for i in range(40) for j in range(40) if i != j and i // 20 == j // 20]
    own = [e for i in range(40) for e in sorted((e for e in own if e[0] == i), key=lambda e: -e[2])[:8]]
    lists = spark.createDataFrame([(*e, False) for e in own], "node long, nbr long, sim float, new boolean")
    links = cut(spark.createDataFrame(sorted({(min(i, j), max(i, j)) for i, j, _ in own}), "a long, b long"))
    got = {r["node"]: (r["part"], r["links"]) for r in nndescent.counted(nodes, links, lists, 0.88, 8).collect()}
    assert got == {i: (0, near[i] @ (np.arange(41) % 2 + 1)) for i in range(40)}


def test_audit_sees_missed_pairs_beside_a_crowd(spark):
    rng = np.random.default_rng(5)
    x = [rng.normal(size=24) for _ in range(20)]
    x += [v + rng.normal(scale=0.05, size=24) for v in x]  # 20 pairs
    x += [x[0] * 0 + 1 + rng.normal(scale=0.05, size=24) for _ in range(150)]
    u = np.stack(x) / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    nodes = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(u)], "node long, m long, vec array<double>")
    rows = [(i, 40, int(near[i].sum()), i >= 40) for i in range(len(u))]
    crowd, all_ = (spark.createDataFrame(r, "node long, part long, links long, dense boolean") for r in (rows[40:], rows))
    assert nndescent.audit(nodes, len(u), crowd, 0.9) == 0 and nndescent.audit(nodes, len(u), all_, 0.9) == 1


def test_goes_on_until_the_recall_is_met(spark, monkeypatch, vectors):
    table, x = vectors
    first = nndescent.first_lists
    monkeypatch.setattr(nndescent, "first_lists", lambda nodes, *a: first(nodes.where(F.element_at("vec", 1) > 0.1), *a))  # codes that never see the others
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    want = classes(len(x), zip(*np.nonzero(near)))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in nndescent.near_duplicates(table).collect()}
    assert all(got[i] == (near[i].sum(), want[i]) for i in range(len(x)))


def test_embedding_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert nndescent.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(3, [1.0, 0.0]), (3, [1.0, 0.0]), (None, [1.0, 0.01]), (8, [0.0, 1.0])]
    got = [(r["vec_id"], r["n_links"], r["component_id"]) for r in nndescent.near_duplicates(spark.createDataFrame(rows, schema)).collect()]
    assert sorted(got, key=str) == sorted([(3, 2, 3), (3, 2, 3), (None, 2, 3), (8, 0, 8)], key=str)
    assert [r["n_links"] for r in nndescent.near_duplicates(spark.createDataFrame(rows[:1], schema)).collect()] == [0]


def test_neighbours_recall_and_scores(spark):
    sf = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    found = cut(queries.op9_neighbours(spark, sf))
    asked = table.where("vec_id % 20 = 0")
    assert permindex.recall(table, asked, found) >= 0.9
    x = {r["vec_id"]: np.array(r["embedding"], float) for r in table.collect()}
    rows = found.toPandas()
    assert len(rows) == 20 * asked.count() and (rows.groupby("query_id")["rank"].max() == 20).all()
    for q, part in rows.sort_values("rank").groupby("query_id"):
        s = part["score"].to_numpy()
        assert (np.diff(s) <= 0).all() and q not in set(part["vec_id"]) and abs(s - [x[q] @ x[v] for v in part["vec_id"]]).max() < 1e-12


def test_neighbours_of_different_lengths_and_odd_tables(vectors, spark):
    table, x = vectors
    rows = permindex.search(table, table.where("vec_id < 40"), k=5, rows=200, n_queries=25).toPandas()
    for q, part in rows.sort_values(["query_id", "rank"]).groupby("query_id"):
        s = x @ x[q]
        s[q] = -np.inf
        assert part["vec_id"].tolist() == np.lexsort((np.arange(len(x)), -s))[:5].tolist()
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 0.0]), (4, None)], "vec_id long, embedding array<double>")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in permindex.search(few, few.where("vec_id % 20 = 0")).orderBy("rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2)]
    assert permindex.search(few.limit(0), few.limit(0)).count() == 0


def brute_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark):
    texts = ["", None, "One", "one TWO three", "É a b c d e f g", "a b\tc\nd\x0be\x0cf\rg " * 30, "x " * 40_000, "ÀB cd ef gh ij kl"]
    assert [simhash.fingerprint(t) for t in texts] == [brute_print(t) for t in texts]
    one = spark.createDataFrame([("a b c d",)], "t string").select(F.xxhash64("t").alias("h")).first()["h"]
    assert simhash.fingerprint("A b c d") == one & (1 << 64) - 1


def near_prints(seed, n):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(n // 8)] + [0]
    found = list(base)
    while len(found) < n:
        f = rng.choice(found)
        for b in rng.sample(range(64), rng.randint(1, 6)):
            f ^= 1 << b
        found.append(f)
    return found


def class_ids(prints):
    a = np.array(prints, np.uint64)
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= 4
    return classes(len(a), ((i, j) for i, j in zip(*np.nonzero(near)) if i < j))


@pytest.mark.parametrize("crowd", [4096, 8])
def test_classes_equal_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CELL_ROWS", crowd)
    prints = near_prints(crowd, 1200)
    rows = [(i, int(np.uint64(f).astype(np.int64))) for i, f in enumerate(prints)]
    table = cut(spark.createDataFrame(rows, "doc_id long, fp long"))
    got = {r["doc_id"]: r["component_id"] for r in simhash.classes(table).collect()}
    assert [got[i] for i in range(len(prints))] == class_ids(prints)


def test_near_duplicates_of_odd_tables(spark):
    schema = "doc_id long, text string, fp string, at int, row int"
    rows = [(5, None, "x", 1, 1), (4, "", "x", 1, 1), (7, "a b c d e", "x", 1, 1), (7, "a b c d e", "x", 1, 1), (None, "a b c d e", "x", 1, 1), (None, "q r s t u v", "x", 1, 1)]
    table = spark.createDataFrame(rows, schema)
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(table).collect()), key=str)
    assert got == sorted([(5, 4), (4, 4), (7, 7), (7, 7), (None, 7), (None, None)], key=str)
    kept = simhash.keep_first(table)
    assert kept.columns == table.columns and sorted((str(r["doc_id"]) for r in kept.collect())) == ["4", "7", "None"]
    empty = spark.createDataFrame([], schema)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_first(empty).count() == 0


def test_pipeline_equals_its_parts(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = cut(stage(spark, now, sf))
        assert after.columns == columns, name
        if name == "simhash_near_dedup":
            old = now.toPandas()
            prints = [brute_print(t) for t in old["text"]]
            ids = class_ids(prints)
            first = pd.DataFrame({"c": ids, "d": old["doc_id"]}).groupby("c")["d"].min()
            assert sorted(r["doc_id"] for r in after.collect()) == sorted(first)
        now = after
    rows = corpus_pipeline.run(spark, sf).collect()
    want = sorted(r["doc_id"] for r in now.collect())
    assert sorted(r["doc_id"] for r in rows if r["piece"] == 0) == want
    used = {}
    for r in rows:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all(sum(n for _, n in v) <= 1024 for v in used.values())


def test_pipeline_of_an_odd_table(spark, tmp_path):
    rows = [(1, None, None, None, None, "x"), (2, "", "en", "a", 0, "x"), (3, "12 !", "en", "a", 4, "x"), (4, "hello to the world of words", "en", "a", 4, "x"), (4, "hello to the world of words", "en", "a", 4, "x")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/full/documents.parquet")
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert [r["doc_id"] for r in corpus_pipeline.run(spark, f"{tmp_path}/full").collect()] == [4]
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_footrule_by_postings_equals_footrule_by_ranks():
    rng = np.random.default_rng(8)
    order = np.stack([rng.permutation(30)[:10] for _ in range(200)]).astype(np.int16)
    row, place, starts = permindex.inverted_files(order, 30)
    asked = rng.permutation(30)[:10]
    shared = np.zeros(200, int)
    for rank, pivot in enumerate(asked):
        file = slice(starts[pivot], starts[pivot + 1])
        assert (order[row[file], place[file]] == pivot).all()
        shared[row[file]] += 10 - np.maximum(place[file], rank)
    full = np.full((201, 30), 10)
    for i, o in enumerate([*order, asked]):
        full[i, o] = np.arange(10)
    assert (np.abs(full[:-1] - full[-1]).sum(axis=1) == 2 * (55 - shared)).all()


def test_pivots_are_drawn_far_apart(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [1.0, 1.0, 1.0]) for i in range(300)] + [(300 + i, rng.normal(size=3).tolist()) for i in range(40)]
    pivots, _ = permindex.pivots_of(spark.createDataFrame(rows, "vec_id long, vec array<double>"), n=64)
    assert len(pivots) == 41 and len(np.unique(pivots.round(12), axis=0)) == 41


def test_neighbours_keep_repeated_rows_and_clashing_columns_apart(spark):
    rows = [(i % 40, [float(i % 40), 1.0], i, 0.5, i, i) for i in range(80)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, score double, query_id int, pivots int")
    got = permindex.search(table, table.where("vec_id = 20"), k=3).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(20, 1, 39), (20, 2, 38), (20, 3, 37)]

"""Packing, language, personal data, line deduplication, mixing, sharding, pages: brute force, round trips and odd tables."""

import hashlib
import html
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiloom.llm import htmltext, langid, linededup, mixing, packing, pii, queries, sharding

SF = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, lang string, source string, n_chars long, size int, shard int, n_removed int, row int"
ROWS = [
    (1, "One line\nand another\nand a third\nthen more", "en", "a", 1, 0, 0, 9, 0), (2, None, None, None, None, 0, 0, 9, 0), (3, "", "en", "", 0, 0, 0, 9, 0),
    (4, "One line\nand another\nand a third", "en", "a", 1, 0, 0, 9, 0), (4, "One line\nand another\nand a third", "en", "a", 1, 0, 0, 9, 0),
    (None, "mail x@y.org", None, "b", 1, 0, 0, 9, 0), (5, "wort " * 60_000, "de", "b", 1, 0, 0, 9, 0), (6, " \n\n\n\n ", "en", "b", 1, 0, 0, 9, 0),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], ODD)


def test_token_ids_equal_the_library():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    lib = Tokenizer.from_file(path)
    for text in ["", "Hello  world\n\n x", "éß 日本 <|endoftext|> z", "a" * 4000, " " * 4000 + "b", "don't 123 ~~"]:
        assert packing.token_ids(text, path).tolist() == lib.encode(text, add_special_tokens=False).ids + [2]


def test_very_long_runs_of_blanks_give_the_ids_of_the_library():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    lib = Tokenizer.from_file(path)
    for text in ["a" + " " * 2_000_000 + "b", "\n" * 1_200_000 + "<|endoftext|>x", "x" + " \t" * 60_000 + "y" + " " * 99_999]:
        assert packing.token_ids(text, path).tolist() == lib.encode(text, add_special_tokens=False).ids + [2]
    plain = packing.plain_ids("<|endoftext|>" + " " * 150_000, path)
    assert 50256 not in plain.tolist()


def test_pack_takes_a_text_with_a_very_long_run_of_blanks(spark):
    docs = spark.createDataFrame([(1, "a" + " " * 1_500_000 + "b"), (2, "c"), (3, None)], "doc_id long, text string")
    rows = packing.pack(packing.cut(packing.pieces(docs, queries.tokenizer_path()))).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == len(packing.token_ids(docs.first()["text"], queries.tokenizer_path()))
    check_packing(rows, packing.WIDTH)


def test_every_language_has_its_share_of_the_sample(spark):
    rows = [(f"word{i} and more", "en") for i in range(3_000)] + [("copied text", "de")] * 3_000 + [(f"rara {i}", "es") for i in range(5)] + [(None, "fr"), ("x", None)]
    got = langid.sampled(spark.createDataFrame(rows, "text string, lang string"), 60).collect()
    count = Counter(r["lang"] for r in got)
    assert count["es"] == 5 and count["de"] == 1 and 20 < count["en"] < 150 and set(count) == {"en", "de", "es"}
    assert set(r["lang"] for r in langid.sampled(spark.createDataFrame(rows, "text string, lang string"), 60, 2).collect()) == {"en", "es"}


def test_scan_time_grows_with_the_text():
    import time

    for unit in ("a-at-", "(at) x", "x at y.", "a-at-a.", "one two onex ", "a@b.co x (at) y.org "):
        spent = []
        for n in (50_000, 200_000):
            start = time.perf_counter()
            pii.scan(unit * (n // len(unit)))
            spent.append(time.perf_counter() - start)
        assert spent[1] < 10 * spent[0] + 0.5  # 16 times, were it quadratic


def test_line_dedup_takes_any_column_name(spark):
    odd_names = spark.createDataFrame([(1, "a\nb\nc", 1, 2), (2, "a\nb\nc", 3, 4)], "doc_id long, text string, `x.y` int, `z``q` int")
    rows = linededup.dedup_lines(odd_names).orderBy("doc_id").collect()
    assert [(r["text"], r["x.y"], r["z`q"], r["n_removed"]) for r in rows] == [("a\nb\nc", 1, 2, 0), ("", 3, 4, 3)]


def test_piece_bounds():
    assert packing.piece_bounds(1, 4) == [1] and packing.piece_bounds(4, 4) == [4]
    assert packing.piece_bounds(5, 4) == [1, 5] and packing.piece_bounds(8, 4) == [4, 8] and packing.piece_bounds(11, 4) == [3, 7, 11]


def check_packing(rows, width):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= width
    return len(by_sequence)


def test_packing_is_whole_and_tight(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = queries.op1_packing(spark, SF).collect()
    used = check_packing(rows, 1024)
    assert used <= -(-sum(r["length"] for r in rows) // 1024) * 1.02 + 1
    path, want = queries.tokenizer_path(), {}
    for d in docs.collect():
        ids = packing.token_ids(d["text"], path)
        start = 0
        for k, stop in enumerate(packing.piece_bounds(len(ids), 1024)):
            import zlib

            want[d["doc_id"], k] = (start, stop - start, zlib.crc32(ids[start:stop].tobytes()))
            start = stop
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want


def test_local_search_empties_bins():
    rng = random.Random(3)
    for _ in range(5):
        histogram = Counter(rng.randint(250, 520) for _ in range(3000))
        first = packing.best_fit(histogram, 1024)
        before, squares = first.count(), sum(n * packing.fill(k) ** 2 for k, n in first.classes.items())
        after = packing.local_search(first)
        assert after.count() <= before and sum(n * packing.fill(k) ** 2 for k, n in after.classes.items()) >= squares
        got = Counter()
        for content, n in after.classes.items():
            assert packing.fill(content) <= 1024
            got.update({s: c * n for s, c in content})
        assert got == histogram


def test_packing_of_odd_tables(spark, odd, none):
    from lexiloom.session import cut

    rows = packing.pack(cut(packing.pieces(odd, queries.tokenizer_path()))).collect()
    check_packing(rows, 1024)
    pieces = Counter((r["doc_id"], r["piece"]) for r in rows)
    assert pieces[4, 0] == 2 and pieces[None, 0] == 1 and sum(r["length"] for r in rows if r["doc_id"] == 2) == 1
    long = sorted((r["piece"], r["start"], np.frombuffer(r["ids"], "<u4")) for r in rows if r["doc_id"] == 5)
    assert np.concatenate([x[2] for x in long]).tolist() == packing.token_ids(ROWS[6][1], queries.tokenizer_path()).tolist()
    assert packing.pack(cut(packing.pieces(none, queries.tokenizer_path()))).count() == 0


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    lang = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = queries.op2_language(spark, sf).join(lang, "doc_id").where("held_out").collect()
    assert len(rows) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(30):
        sizes = rng.integers(1, 6, 4)
        text = np.repeat(np.arange(4), sizes)
        scores = rng.normal(size=(len(text), 3)).round(1)
        path = langid.viterbi(scores, text, 1.0)
        for t in range(4):
            s = scores[text == t]

            def value(p, s=s):
                return sum(s[i, k] for i, k in enumerate(p)) - sum(a != b for a, b in zip(p, p[1:]))

            import itertools

            assert abs(value(path[text == t]) - max(map(value, itertools.product(range(3), repeat=len(s))))) < 1e-9


def test_language_spans_and_odd_tables(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    by = {r["lang"]: r["text"] for r in docs.where("length(text) between 400 and 900").collect()}
    mixed = by["en"] + " " + by["de"]
    (_, score, spans), und, digits, other = langid.label([mixed, None, "12 !", "Привет"], model)
    assert {k for *_, k in spans} >= {"en", "de"} and 0 < score < 1 and all(mixed[a:z] == mixed[a:z].strip() for a, z, _ in spans)
    assert und == digits == ("und", 0.0, []) and other[1] == 0
    rows = langid.identify(odd, model).collect()
    assert len(rows) == len(ROWS) and {r["lang_pred"] for r in rows if r["doc_id"] in (2, 3, 6)} == {"und"}
    assert langid.identify(none).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd.where("lang is null")).collect()} == {"und"}


def brute_spans(text):
    rules = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    for kind, rule in rules.items():
        for m in re.finditer(rule, text):
            d = [int(c) for c in m[0] if c in "0123456789"]
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and (not 13 <= len(d) <= 19 or sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1])) % 10):
                continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            yield f"{kind}:{m.start()}:{m.end()}"


def test_plain_spans_equal_the_rules(spark):
    rng = random.Random(4)
    for _ in range(20_000):
        text = "".join(rng.choice("a1.@+-_ 0(5b9") for _ in range(rng.randint(1, 40)))
        assert [":".join(map(str, s)) for s in pii.plain_spans(text)] == list(brute_spans(text))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    for r in queries.op3_pii(spark, "/root/testdata/sf0.01").collect():
        want = list(brute_spans(texts[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest() and set(want) <= set(r["spans"].split(",")) | {""}


@pytest.mark.parametrize(("text", "kind", "part"), [
    ("write john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
    ("write john dot doe at mail dot com now", "email", "john dot doe at mail dot com"),
    ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"), ("u​ser@exa​mple.com", "email", "u​ser@exa​mple.com"),
    ("ip one nine two dot one six eight dot one dot seven ok", "ip", "one nine two dot one six eight dot one dot seven"),
    ("pay ４１１１ １１１１ １１１１ １１１１ ok", "card", "４１１１ １１１１ １１１１ １１１１"),
    ("call plus four nine one five one two three four five six seven eight ok", "phone", "plus four nine one five one two three four five six seven eight"),
])
def test_disguised_spans(text, kind, part):
    plain, every = pii.scan(text)
    assert not plain and [(k, text[a:z]) for k, a, z in every] == [(kind, part)]


@pytest.mark.parametrize(("text", "kind", "part"), [
    ("pay 4111 dash 1111 dash 1111 dash 1111", "card", "4111 dash 1111 dash 1111 dash 1111"),
    ("call +49 30 dash 1234567 ok", "phone", "+49 30 dash 1234567"), ("call plus\t49 30 1234567 ok", "phone", "plus\t49 30 1234567"),
    ("write joe_at-example.com now", "email", "joe_at-example.com"), ("pay 4111 Minus 1111 hyphen 1111 1111", "card", "4111 Minus 1111 hyphen 1111 1111"),
])
def test_disguised_signs(text, kind, part):
    assert (kind, part) in [(k, text[a:z]) for k, a, z in pii.scan(text)[1]]


def test_hints_cover_every_rule():
    rng = random.Random(9)
    words = "one ſix SIX FÜNF fİve dot plus at dash hyphen minus arroba punkt [at] (a) {.} <dot> &#64; &#46; &period; &commat; %40 @ . _ - 4 12 joe example.com a b".split()
    changed = Counter()
    for _ in range(60_000):
        text = "".join(rng.choice(words) + rng.choice(["", " ", " ", "\t", "\n", "-", "_", "  "]) for _ in range(rng.randint(2, 6)))
        rules = [i for i, (rule, output) in enumerate(pii.CHAIN) if any(output(m[0]) != m[0] for m in rule.finditer(text))]
        changed.update(rules)
        assert pii.hinted(text) or not rules, (text, rules)
    assert len(changed) == len(pii.CHAIN)


def test_clean_text_and_odd_tables_have_no_hidden_spans(spark, odd, none):
    for text in ["we met at home. Then at noon dot", "one two three four", "une un deux trois cats", "Привет мир", ""]:
        assert pii.scan(text) == ([], [])
    rows = pii.find(odd).collect()
    assert len(rows) == len(ROWS) and [r["plain"][0]["kind"] for r in rows if r["doc_id"] is None] == ["email"]
    assert pii.find(none).count() == 0


def test_shards_are_minimax(spark):
    rows = queries.op5_sharding(spark, "/root/testdata/sf0.01").collect()
    keys = {r["doc_id"]: r["k"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", F.xxhash64("text").alias("k")).collect()}
    groups, shard_of = Counter(), {}
    for r in rows:
        groups[keys[r["doc_id"]]] += r["size"]
        assert shard_of.setdefault(keys[r["doc_id"]], r["shard"]) == r["shard"]
    sizes = [groups[k] for k in sorted(groups)]
    assert [shard_of[k] for k in sorted(groups)] == sorted(shard_of.values())

    def fits(capacity):
        used, room = 1, capacity
        for s in sizes:
            if s > room:
                used, room = used + 1, capacity
            room -= s
        return used <= sharding.SHARDS

    low, high = max(sizes), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    total = Counter()
    for r in rows:
        total[r["shard"]] += r["size"]
    assert max(total.values()) == low
    for s in total:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))


def test_shards_beside_a_hot_text_are_near_equal(spark):
    rng = random.Random(3)
    texts = ["hot text " * 10] * 3000 + [f"{i} " + "x" * rng.randint(50, 150) for i in range(4000)]
    rows = sharding.shard(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    total = Counter()
    for r in rows:
        total[r["shard"]] += r["size"]
    hot = {r["shard"] for r in rows if r["doc_id"] < 3000}
    assert len(rows) == len(texts) and len(hot) == 1 and total[hot.pop()] == max(total.values()) == 3000 * (90 + 16)
    rest = sorted(total.values())[:-1]
    assert len(rest) == sharding.SHARDS - 1 and rest[-1] < 1.05 * sum(rest) / len(rest) and rest[0] > 0.5 * rest[-1]


def test_shards_of_odd_tables(odd, none):
    rows = sharding.shard(odd, 3).collect()
    assert len(rows) == len(ROWS) and sum(r["size"] == 16 for r in rows) == 2
    assert sharding.shard(none).count() == 0


def brute_lines(docs):
    seen, out = set(), {}
    for doc, text in sorted(docs):
        lines = text.split("\n")
        gone = set()
        for i in range(len(lines) - 2):
            w = tuple(x.strip(" ") for x in lines[i : i + 3])
            if any(w):
                if w in seen:
                    gone |= {i, i + 1, i + 2}
                seen.add(w)
        out[doc] = (len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def test_line_dedup(spark, odd, none):
    rng = random.Random(5)
    docs = [(i, "\n".join(rng.choice("ab ") for _ in range(rng.randint(1, 9)))) for i in range(60)]
    got = linededup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_removed"], r["text"]) for r in got} == brute_lines(docs)
    done = linededup.dedup_lines(odd)
    assert done.columns == [c for c in odd.columns if c != "n_removed"] + ["n_removed"]
    rows = done.collect()
    assert sorted(r["n_removed"] for r in rows) == [0] * 6 + [3, 3] and [r["text"] for r in rows if r["doc_id"] == 4] == ["", ""]
    assert next(r["text"] for r in rows if r["doc_id"] == 2) is None and linededup.dedup_lines(none).count() == 0


def test_exponent_meets_its_target():
    shares = {"a": 0.7, "b": 0.2, "c": 0.1}
    x = mixing.exponent(shares, target_entropy=1.0)
    assert abs(mixing.entropy(mixing.weights(shares, x)) - 1.0) < 1e-9
    x = mixing.exponent(shares, repeats=2.0)
    assert abs(max(mixing.epochs(shares, mixing.weights(shares, x)).values()) - 2.0) < 1e-9
    assert mixing.exponent(shares, repeats=0.5) == 1.0 and mixing.exponent(shares, target_entropy=9.0) == 0.0


def test_mixture(spark, odd, none):
    rng = random.Random(6)
    docs = [(i, "w " * rng.randint(1, 30), "big" if i % 3 else f"s{i % 7}") for i in range(900)]
    table = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mixing.mixture(table, block_tokens=2000).collect()
    reads = Counter((r["source"], r["doc_id"]) for r in rows)
    assert {d for _, d in reads} == set(range(900)) and max(reads.values()) == 2
    words, tokens = Counter(), Counter()
    for r in rows:
        tokens[r["source"]] += r["tokens"]
    for _, text, s in docs:
        words[s] += len(text.split())
    weight = {r["source"]: r["weight"] for r in rows}
    total = sum(tokens.values())
    assert all(abs(tokens[s] - weight[s] * total) <= 40 for s in words) and all(1 <= tokens[s] / words[s] <= 1.51 + 31 / words[s] for s in words)
    for b in {r["block"] for r in rows}:
        own = [r for r in rows if r["block"] == b]
        assert sorted(r["position"] for r in own) == list(range(len(own)))
    repeated = Counter(r["doc_id"] for r in mixing.mix(table).collect())
    assert repeated == Counter(r["doc_id"] for r in rows)
    kept = mixing.mix(odd)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 4, 5, 6, None}
    assert mixing.mix(none).count() == 0 and mixing.mixture(none).count() == 0


def test_pages_equal_a_plain_reading(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in queries.op8_html(spark, "/root/testdata/sf0.01").join(pages.select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_pages_parts_and_odd_tables(spark):
    page = (
        '<body class="has-sidebar"><div id="cookie-notice">We use cookies on this site as you would expect of us</div><nav><a href=x>Home</a></nav>'
        "<main><article><h1>Title</h1><p>First <a href=x>link</a> para &amp; more<p>Next one<aside>Related stuff</aside><form><label>Mail</label></form>"
        '<section class="comments"><h2>Comments</h2><p>I liked this a lot, it is long enough to be an article.</p></section></article></main><footer>End</footer>'
    )
    assert htmltext.main_text(page) == "Title\n\nFirst link para & more\n\nNext one"
    for table, node in zip((htmltext.TABLE, htmltext.BARE_TABLE), htmltext.trees()):
        x, y = htmltext.labelled(table)
        assert all(htmltext.decide(node, tuple(r)) == label for r, label in zip(x, y))
    rows = [(1, None, None, 1), (2, "u", "", 1), (2, "u", "", 1), (None, "u", page, 1), (3, "u", "<p" * 50_000 + "<a \"" * 50_000, 1)]
    got = htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")).collect()
    assert len(got) == 5 and [r["n_chars"] for r in got if r["page_id"] in (1, 2)] == [0, 0, 0]
    assert htmltext.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("wrapper", [
    '<div class="has-sidebar">', '<section class="content-with-sidebar">', '<div id="no-ads">', '<div class="search-page">', '<div class="widget">', "<form>",
])
def test_article_in_a_layout_wrapper(wrapper):
    body = "<p>The first paragraph of the article is long enough to count as text.</p><aside>Related stuff</aside>"
    beside = '<section class="comments"><article><p>I liked this a lot, it is long enough to be an article.</p></article></section>'
    teaser = '<div class="related"><article><p>Another article of this site that you may like to read next.</p></article></div>'
    end = "</" + wrapper[1:].split()[0].rstrip(">") + ">"
    want = "The first paragraph of the article is long enough to count as text."
    assert htmltext.main_text(f"{wrapper}<article>{body}{beside}</article>{teaser}{end}") == want
    assert htmltext.main_text(f"<main>{body}{beside}</main>{teaser}") == want


LONG = "The quick brown fox jumps over the lazy dog and then runs on through the wide green field until evening falls again."
FOOT = '<div class="site-footer"><p>All rights are with the publisher of this site, who may be written to at any time.</p></div>'


@pytest.mark.parametrize("page, want", [
    (f'<div class="site-header"><p>Best news in the whole wide town every day</p></div><div class="post-body"><p>{LONG}</p></div>{FOOT}', [LONG]),
    (f'<div class="header">Menu</div><div class="content"><p>{LONG}</p><p>{LONG}</p><p>Short end.</p></div><div class="comments"><p>{LONG}</p></div>',
     [LONG, LONG, "Short end."]),
    ("<div><h1>Title</h1><p>One two three four.</p><p>Five six seven eight nine.</p><p>Ten eleven twelve.</p></div>",
     ["Title", "One two three four.", "Five six seven eight nine.", "Ten eleven twelve."]),
    (f'<div class="entry"><div class="entry-header"><h1>Title</h1></div><p>{LONG}</p><p>{LONG}</p></div>{FOOT}', ["Title", LONG, LONG]),
    (f"<ul><li><a href=x>Home</a><li><a href=y>About us</a></ul><div><h1>Big title</h1><p>{LONG}</p><ul><li>one thing<li>two things</ul><p>{LONG}</p></div>"
     "<div>Copyright of this page</div>", ["Big title", LONG, "one thing", "two things", LONG]),
    (f"<div><p>{LONG}</p><blockquote>To be or not to be</blockquote><p>{LONG}</p></div>{FOOT}", [LONG, "To be or not to be", LONG]),
    (f"<table><tr><td><a href=x>Home</a><td><a href=y>News</a></table><table><tr><td>{LONG}<tr><td>{LONG}</table><p>Copyright us", [LONG, LONG]),
    (f"<a href=1>Home</a> | <a href=2>More</a><hr><h2>Title</h2><p>{LONG}<p>{LONG}<p>Short one.<hr><p><a href=1>Prev</a> <a href=2>Next</a>",
     ["Title", LONG, LONG, "Short one."]),
    ("<ul><li><a href=x>Home</a><li><a href=y>About us</a></ul><p>Copyright of this page</p>", []),
])
def test_pages_that_name_no_main_part(page, want):
    assert htmltext.main_text(page) == "\n\n".join(want)


@pytest.mark.parametrize("body, want", [
    ('<p>Hello <span class="alert">world of news</p><p>next</p>', ["Hello world of news", "next"]),
    ('<p>Some text <span class="ad">BUY NOW</span> goes on.</p>', ["Some text goes on."]),
    ('<p>Some text <span class="ad">BUY <span>IT</span> NOW</span> goes on.</p>', ["Some text goes on."]),
    ('<p>Some text <span class="promo">BUY NOW</p><p>goes on.</p>', ["Some text", "goes on."]),
    ('<p>Some text</p><span class="ad"><p>BUY NOW</p></span><p>goes on.</p>', ["Some text", "goes on."]),
    ('<p>Some text</p><span class="ad"><span>BUY</span> NOW</span><p>goes on.</p>', ["Some text", "goes on."]),
    ('<pre>x = 1 <span class="ad comment"># kept</span></pre>', ["x = 1 # kept"]),
])
def test_inline_side_parts(body, want):
    assert htmltext.main_text(f"<article>{body}</article>") == "\n\n".join(want)

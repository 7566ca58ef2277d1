"""Token alignment against sets of ends and plain loops over the libraries' own output; odd tables."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lexiloom.llm import alignment_tokens as at
from lexiloom.llm import queries
from lexiloom.llm.packing import plain_ids

SF = "/root/testdata/sf0.001"
A, B = queries.tokenizer_path(), queries.tokenizer_path("piece_bpe_32k.model")
HARD = [
    None, "", "Hello  world", "<|endoftext|> <s> </s> <unk> <0x41>", "a▁b", "x\x00y\r\n\tz", "éß日本 ①ﬁ 👩‍👩‍👧", " ", "\n\n\n", "a" * 5_000, "日本語" * 3_000,
    "don't 12345 ~~~ ###", "The same. The same. The same.", "ab" + "́" * 40, "x" + " " * 300 + "y",
]


LIB, MODEL = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
LIB.encode_special_tokens = True
LETTERS = [*range(33, 127), *range(161, 173), *range(174, 256)]
TABLE = {chr(x): x for x in LETTERS} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in LETTERS)}


def plain(text):
    """(A ids, B ids, groups) by the libraries and a set of common ends."""
    if not text:
        return [], [], []
    a = LIB.encode(" " + text, add_special_tokens=False).ids
    sides = [[bytes(TABLE[c] for c in LIB.id_to_token(i)) for i in a]]
    b = MODEL.encode(text)
    pieces = [MODEL.id_to_piece(i) for i in b]
    sides.append([bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in pieces])
    if any(b"".join(side) != (" " + text).encode() for side in sides):
        return [], [], []
    ends = []
    for side in sides:
        total, out = 0, []
        for part in side:
            total += len(part)
            out.append(total)
        ends.append(out)
    common = set(ends[0]) & set(ends[1])
    groups, i, j = [], 0, 0
    place = [{end: k + 1 for k, end in enumerate(side)} for side in ends]
    for end in sorted(common):
        p, q = place[0][end], place[1][end]
        groups.append((a[i:p], b[j:q]))
        i, j = p, q
    return a, b, groups


def expected(texts):
    sides = [plain(t) for t in texts]
    links = [Counter((x, y) for ga, gb in groups for x in ga for y in gb) for _, _, groups in sides]
    count = Counter(k for held in links for k in held)
    best = Counter()
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (a, b, groups), held in zip(sides, links):
        joined = ";".join(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}" for ga, gb in groups)
        out.append((
            len(a), len(b), len(groups), sum(held.values()), sum(n for k, n in held.items() if count[k] == best[k[0]]),
            sum(n * count[k] for k, n in held.items()), hashlib.sha256(joined.encode()).hexdigest() if a else "",
        ))
    return out


FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_common_ends_equal_the_intersection():
    rng = random.Random(2)
    for trial in range(600):
        last = rng.randrange(1, 400)
        density = rng.choice([0.05, 0.5, 0.95])
        shared = [x for x in range(1, last) if rng.random() < density]
        a, b = (sorted({*shared, *[x for x in range(1, last) if rng.random() < rng.choice([0, 0.02, 0.3])], last}) for _ in range(2))
        common = sorted(set(a) & set(b))
        assert at.common_ends(a, b) == ([a.index(x) + 1 for x in common], [b.index(x) + 1 for x in common])
    assert at.common_ends([], []) == ([], [])


def test_long_runs_are_jumped_in_few_comparisons():
    class Seen(list):
        reads = 0

        def __getitem__(self, k):
            Seen.reads += 1
            return super().__getitem__(k)

    a = Seen(range(1, 100_001))
    assert at.common_ends(a, list(range(1, 100_001)))[0] == list(range(1, 100_001))
    assert Seen.reads < 60


def test_wide_groups_are_counted_without_writing_out_their_links():
    x = at.Aligned(np.array([1, 2] * 3_000), np.array([5] * 4_000), [6_000], [4_000])
    keys, times = x.links()
    assert keys.tolist() == [1 << 32 | 5, 2 << 32 | 5] and times.tolist() == [3_000 * 4_000] * 2
    assert x.groups(at.side_a(A), at.side_b(B)).count(b",") == 9_998


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i if i else None, t, 3, "k", [1]) for i, t in enumerate(HARD * 2)] + [(9007199254740993, "long word " * 30_000, 3, "k", [1])]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, row int, keys string, times array<int>")


@pytest.mark.parametrize("frequent", [at.FREQUENT, 60, 0])
def test_odd_texts_equal_brute_force(odd, frequent):
    rows, df = odd
    got = sorted(tuple(r[f] for f in FIELDS) for r in at.link_counts(df, A, B, frequent).collect())
    assert got == sorted(expected([r[1] for r in rows]))


def test_empty_table(odd):
    assert at.link_counts(odd[1].limit(0), A, B).count() == 0


def test_query_equals_brute_force(spark):
    docs = queries.read(spark, SF, "documents").collect()
    want = {r["doc_id"]: x for r, x in zip(docs, expected([r["text"] for r in docs]))}
    assert {r["doc_id"]: tuple(r[f] for f in FIELDS) for r in queries.op11_alignment(spark, SF).collect()} == want


def test_align_gives_tokens_and_groups(odd):
    for r in at.align(odd[1].where("doc_id < 12"), A, B).collect():
        a, b, groups = plain(HARD[r["doc_id"]])
        assert (r["a_ids"], r["b_ids"]) == (a, b)
        assert (r["a_cuts"], r["b_cuts"]) == tuple([sum(len(g[k]) for g in groups[: n + 1]) for n in range(len(groups))] for k in (0, 1))


def test_very_long_runs_of_blanks_do_not_stop_the_encoder():
    text = "a" + " " * 2_000_000 + "b"
    assert at.side_a(A).joined(plain_ids(text, A).tolist()) == text.encode()

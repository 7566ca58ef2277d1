"""Language of whole texts, and language spans of mixed texts.

A word's script decides which languages it may have; its letter trigrams, looked up in smoothed tables learned from labelled
texts, give a score per remaining language; and Viterbi over the words of a text, where a change of language costs a fixed
penalty, labels spans. The language that covers most letters is the text's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm.common import slices, small_batches, tidy

BUCKETS = 1 << 15
TRAIN_DOCS = 20_000  # about as many different labelled texts of each language, spread evenly over the table, fit the tables
MAX_LANGS = 256  # the most frequent labels are learned; so many tables of BUCKETS numbers reach the driver at most
SWITCH = 12.0  # cost of a change of language, in nats
SMOOTH = 0.5
SCRIPT_SHARE = 0.001  # a language uses a script that holds at least this share of its letters
WORD_NATS = 20.0  # a word's scores differ by at most this much

#: Script blocks (first code point, last code point, script).
SCRIPTS = (
    (0x41, 0x24F, "latin"), (0x1E00, 0x1EFF, "latin"), (0x2C60, 0x2C7F, "latin"), (0xA720, 0xA7FF, "latin"), (0xFF21, 0xFF5A, "latin"),
    (0x370, 0x3FF, "greek"), (0x1F00, 0x1FFF, "greek"), (0x400, 0x52F, "cyrillic"), (0x1C80, 0x1C8F, "cyrillic"),
    (0x2DE0, 0x2DFF, "cyrillic"), (0xA640, 0xA69F, "cyrillic"), (0x531, 0x58F, "armenian"), (0x590, 0x5FF, "hebrew"),
    (0x600, 0x6FF, "arabic"), (0x750, 0x77F, "arabic"), (0x8A0, 0x8FF, "arabic"), (0xFB50, 0xFDFF, "arabic"), (0xFE70, 0xFEFE, "arabic"),
    (0x900, 0x97F, "devanagari"), (0x980, 0x9FF, "bengali"), (0xA00, 0xA7F, "gurmukhi"), (0xA80, 0xAFF, "gujarati"),
    (0xB00, 0xB7F, "oriya"), (0xB80, 0xBFF, "tamil"), (0xC00, 0xC7F, "telugu"), (0xC80, 0xCFF, "kannada"), (0xD00, 0xD7F, "malayalam"),
    (0xD80, 0xDFF, "sinhala"), (0xE00, 0xE7F, "thai"), (0xE80, 0xEFF, "lao"), (0xF00, 0xFFF, "tibetan"), (0x1000, 0x109F, "myanmar"),
    (0x10A0, 0x10FF, "georgian"), (0x1100, 0x11FF, "hangul"), (0x3130, 0x318F, "hangul"), (0xAC00, 0xD7AF, "hangul"),
    (0x1200, 0x137F, "ethiopic"), (0x1780, 0x17FF, "khmer"), (0x3040, 0x309F, "kana"), (0x30A0, 0x30FF, "kana"),
    (0x3400, 0x4DBF, "han"), (0x4E00, 0x9FFF, "han"), (0xF900, 0xFAFF, "han"), (0x20000, 0x323AF, "han"),
)
NAMES = ["other", *dict.fromkeys(name for *_, name in SCRIPTS)]


@cache
def alphabet() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the script of a letter (0 other script, 255 not a letter), and the lower-case letter."""
    top = 0x110000
    script, lower = np.full(top, 255, np.uint8), np.arange(top, dtype=np.uint32)
    for p in range(top):
        c = chr(p)
        if c.isalpha():
            script[p] = 0
            if len(small := c.lower()) == 1:
                lower[p] = ord(small)
    for first, last, name in SCRIPTS:
        part = script[first : last + 1]
        part[part == 0] = NAMES.index(name)
    return script, lower


@dataclass
class Words:
    """Words (runs of letters) of several texts, in order."""

    text: np.ndarray  # which text
    start: np.ndarray  # first code point in the text
    end: np.ndarray
    script: np.ndarray  # of the first letter
    gram_word: np.ndarray  # start of each word's trigrams in grams
    grams: np.ndarray  # trigram buckets, one for each letter: it with its neighbours


def words_of(texts: list[str | None]) -> Words:
    """Split ``texts`` into words, all at once; letters are lower-cased, and a word's outer neighbours are blanks."""
    script_of, lower_of = alphabet()
    lengths = np.array([len(t) if t else 0 for t in texts], np.int64)
    codes = np.frombuffer(" ".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint32)
    script = script_of[codes]
    letter = script != 255
    edge = np.diff(letter.view(np.int8))
    starts, ends = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    low = np.where(letter, lower_of[codes], 0)
    at = np.flatnonzero(letter)
    with np.errstate(over="ignore"):
        mixed = low[at - 1] * np.uint32(0x9E3779B1) ^ low[at] * np.uint32(0x85EBCA6B) ^ low[at + 1] * np.uint32(0xC2B2AE35)
        mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    grams = (mixed >> np.uint32(17)) % BUCKETS
    first = np.concatenate([[0], np.cumsum(lengths + 1)]) + 1  # of each text in codes
    text = np.searchsorted(first, starts, "right") - 1
    return Words(text, starts - first[text], ends - first[text], script[starts], np.concatenate([[0], np.cumsum(ends - starts)]), grams)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # (BUCKETS, languages) log probabilities
    allowed: np.ndarray  # (scripts, languages) may a word of the script have the language

    def known(self, words: Words) -> np.ndarray:
        """Whether some language uses the script of each word."""
        return self.allowed[np.minimum(words.script, len(NAMES) - 1)].any(axis=1)

    def scores(self, words: Words) -> np.ndarray:
        """Score of each word and language, 0 for the best; languages that do not use the word's script are out of reach."""
        if not len(words.start):
            return np.zeros((0, len(self.langs)), np.float32)
        s = np.stack([np.add.reduceat(self.table[:, k][words.grams], words.gram_word[:-1]) for k in range(len(self.langs))], axis=1)
        may = self.allowed[words.script]
        may |= ~may.any(axis=1, keepdims=True)  # a script nobody uses says nothing
        s -= np.where(may, s, -np.inf).max(axis=1, keepdims=True)
        return np.where(self.known(words)[:, None], np.where(may, np.maximum(s, -WORD_NATS), -2 * WORD_NATS), 0).astype(np.float32)


def viterbi(scores: np.ndarray, text: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language of every word: the path of each text that maximises its scores less ``switch`` per change.

    ``text`` (ascending) says which text a word is of. All texts advance together, longest first. Ties keep the language of
    the neighbouring word, then take the first language.
    """
    path = np.zeros(len(text), np.int16)
    if not len(text):
        return path
    begin = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    size = np.diff(np.append(begin, len(text)))
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    live = np.searchsorted(-size, -np.arange(size[0]), "left")  # texts with more than t words
    back = np.zeros(scores.shape, np.int16)
    value = scores[begin].astype(np.float64)
    own = np.arange(scores.shape[1], dtype=np.int16)
    last = np.zeros(len(begin), np.int16)
    ended = len(begin)
    for t in range(1, size[0]):
        k = live[t]
        if k < ended:
            last[k:ended] = value[k:ended].argmax(axis=1)
            ended = k
            value = value[:k]
        best = value.argmax(axis=1)
        moved = value[np.arange(k), best][:, None] - switch
        stay = value >= moved
        at = begin[:k] + t
        back[at] = np.where(stay, own, best[:, None])
        value = np.where(stay, value, moved) + scores[at]
    last[:ended] = value.argmax(axis=1)
    for t in range(size[0] - 1, -1, -1):
        k = live[t] if t else len(begin)
        at = begin[:k] + t
        path[at] = last[:k]
        last[:k] = back[at, last[:k]]
    return path


def held_out(doc_id) -> F.Column:
    """crc32 of the id as text, remainder 2 of 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2


def sampled(docs: DataFrame, max_docs: int = TRAIN_DOCS, max_langs: int = MAX_LANGS) -> DataFrame:
    """About ``max_docs`` different texts of each of the ``max_langs`` most frequent languages of ``docs``: (text, lang).

    Texts are picked by their hash at a rate per language, so a rare language keeps all its texts however large the table is,
    and a text with very many copies counts once.
    """
    known = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    hashed = known.withColumn("h", F.xxhash64("text"))
    sizes = hashed.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs)
    rates = [(r["lang"], int(min(1.0, max_docs / max(r["n"], 1)) * (1 << 30))) for r in sizes.collect()]  # max_langs rows at most
    limits = docs.sparkSession.createDataFrame(rates, "lang string, rate long")
    picked = hashed.join(F.broadcast(limits), "lang").where(F.pmod(F.xxhash64(F.lit(1), "h"), F.lit(1 << 30)) < F.col("rate"))
    return picked.dropDuplicates(["lang", "h"]).select("text", "lang")


def fit(docs: DataFrame, max_docs: int = TRAIN_DOCS, max_langs: int = MAX_LANGS) -> Model:
    """Learn the trigram tables from ``docs`` (text, lang): rows with a null text or lang say nothing.

    About ``max_docs`` different texts of each language are used (see ``sampled``). Each task counts its own trigrams; what
    reaches the driver is at most one number per language and bucket, so it does not grow with the corpus.
    """
    small_batches()
    known = sampled(docs, max_docs, max_langs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in tidy(batches):
            for lang, part in batch.groupby("lang"):
                texts = list(part["text"])
                for lo, hi in slices(texts, 250_000):
                    words = words_of(texts[lo:hi])
                    letters = np.bincount(words.script, weights=np.diff(words.gram_word), minlength=256)[: len(NAMES)]
                    got = np.concatenate([np.bincount(words.grams, minlength=BUCKETS), letters]).astype(np.int64)
                    sums[lang] = sums[lang] + got if lang in sums else got
        for lang, got in sums.items():
            at = np.flatnonzero(got)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": got[at]})

    counted = known.mapInPandas(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counted["lang"].unique())
    full = np.zeros((BUCKETS + len(NAMES), len(langs)))
    for k, lang in enumerate(langs):
        rows = counted[counted["lang"] == lang]
        full[rows["bucket"].to_numpy(), k] = rows["n"].to_numpy()
    grams, letters = full[:BUCKETS], full[BUCKETS:]
    used = grams.sum(axis=1) > 0
    table = np.log((grams + SMOOTH) / (grams.sum(axis=0) + SMOOTH * (used.sum() + 1))).astype(np.float32)
    return Model(langs, table, letters >= SCRIPT_SHARE * np.maximum(letters.sum(axis=0), 1))


def label(texts: list[str | None], model: Model, switch: float = SWITCH) -> list[tuple[str, float, list]]:
    """(language, share of its letters, spans (start, end, language)) of each text."""
    if not model.langs:
        return [("und", 0.0, []) for _ in texts]
    parts, scored = [], []
    for lo, hi in slices(texts, 250_000):
        words = words_of(texts[lo:hi])
        scored.append(model.scores(words))
        parts.append((words.text + lo, words.start, words.end, model.known(words)))
    text, start, end, known = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(4))
    path = viterbi(np.concatenate(scored) if scored else np.zeros((0, len(model.langs))), text, switch)
    letters = np.zeros((len(texts), len(model.langs)))
    np.add.at(letters, (text, path), (end - start) * known)
    total = np.bincount(text, weights=end - start, minlength=len(texts)) if len(texts) else np.zeros(0)
    opens = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (path[1:] != path[:-1])])) if len(text) else np.zeros(0, np.int64)
    closes = np.append(opens[1:], len(text)) - 1
    spans: list[list] = [[] for _ in texts]
    for t, a, z, k in zip(text[opens].tolist(), start[opens].tolist(), end[closes].tolist() if len(opens) else [], path[opens].tolist()):
        spans[t].append((a, z, model.langs[k]))
    best = letters.argmax(axis=1)
    return [
        (model.langs[b], float(letters[i, b] / n), spans[i]) if n else ("und", 0.0, [])
        for i, (b, n) in enumerate(zip(best, total))
    ]


def predictor(model: Model, switch: float = SWITCH) -> Callable:
    """Column function: text -> struct(lang_pred, score, spans).

    A text that is null or has no letter, and any text when nothing was learned, is ``und`` with score 0 and no spans.
    Score is the share of letters in words labelled with the predicted language; equal shares take the first language by
    name; words in a script that no learned language uses belong to none. Whole texts are read, in batches bounded by characters.
    """
    small_batches()
    shared = SparkSession.active().sparkContext.broadcast(model)  # BUCKETS numbers a language, MAX_LANGS languages at most

    @F.pandas_udf("lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in tidy(batches):
            texts, rows = list(batch), []
            for lo, hi in slices(texts, 8_000_000):
                rows += label(texts[lo:hi], shared.value, switch)
            yield pd.DataFrame({
                "lang_pred": [r[0] for r in rows], "score": [r[1] for r in rows],
                "spans": [[{"start": a, "end": z, "lang": k} for a, z, k in r[2]] for r in rows],
            }, columns=["lang_pred", "score", "spans"])

    return predict


def identify(docs: DataFrame, model: Model | None = None, switch: float = SWITCH, max_docs: int = TRAIN_DOCS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score, spans.

    Without a ``model``, one is learned from the rows that are not held out. Predictions see the text only.
    """
    model = model or fit(docs.where(~held_out("doc_id")), max_docs)
    predict = predictor(model, switch)
    return (
        docs.select("doc_id", held_out("doc_id").alias("held_out"), predict(F.col("text").cast("string")).alias("p"))
        .select("doc_id", "held_out", "p.lang_pred", "p.score", "p.spans")
    )

"""Personal data in plain and in disguised form, as spans of the text as it was given.

Plain identifiers are found in the text itself. Then a chain of small transducers rewrites the text: look-alike characters
become ASCII, runs of spelled digits become digits, and disguises of at, dot, plus and dash become the sign. Each rewrite
keeps the place of what it replaced, so identifiers found in the normalised text are mapped back to source characters.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import small_batches, tidy

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
DOTTED = re.compile(r"[0-9]\.[0-9]")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterator[Span]:
    """Scan from sign to sign: a local part is the run before it, so long runs of letters cost nothing extra."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = floor + len(text[floor:at].rstrip(LOCAL))
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield "email", start, m.end()
            floor = m.end()
            at = text.find("@", floor)
        else:
            floor = at + 1
            at = text.find("@", floor)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def small(part: str) -> bool:
    """At most 255 as a number, with leading zeros allowed."""
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def plain_spans(text: str) -> list[Span]:
    """Identifiers as they stand, leftmost and non-overlapping per kind, in the order of KINDS and then of start."""
    found = list(emails(text))
    if DOTTED.search(text):
        found += [("ip", *m.span()) for m in IP.finditer(text) if all(map(small, m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := only_digits(m[0])) <= 19 and luhn(d):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(only_digits(m[0])) <= 15]
    return found


#: Look-alikes of ASCII letters in other scripts.
LOOKALIKES = dict(zip(
    "АВЕЅІЈКМНОРСТУХЗаеокрсухіјѕһԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧοανρικυɑɡıｌ",
    "ABESIJKMHOPCTYX3aeokpcyxijshdqwABEZHIKMNOPTYXoavpikuagil",
))
#: Dashes and dots that normalisation forms leave alone.
SIGNS = dict.fromkeys("‐‑‒–—―−", "-") | dict.fromkeys("․。｡", ".")
#: What the first transducer looks at: look-alikes, signs, invisible characters, and other forms of ASCII characters.
ODD = re.compile(
    "[" + re.escape("".join(LOOKALIKES) + "".join(SIGNS)) + " ­᠎ -‏⁠-⁤ ﻿"
    "²³¹⁰-⁹₀-₉①-⓿　٠-٩۰-۹०-९"
    "﹐-﹫！-～\U0001d400-\U0001d7ff]"
)
#: The digits spelled in four languages, from zero.
SPELLED = (
    "zero oh null cero zéro", "one eins uno une un", "two zwei dos deux", "three drei tres trois", "four vier cuatro quatre",
    "five fünf cinco cinq", "six sechs seis", "seven sieben siete sept", "eight acht ocho huit", "nine neun nueve neuf",
)
DIGIT_OF = {w: str(i) for i, words in enumerate(SPELLED) for w in words.split()}
#: Domain endings that a spaced "at" needs when the dot is plain.
ENDINGS = "com|org|net|edu|gov|info|biz|io|co|de|fr|es|it|uk|us|eu|ch|at|example|test|invalid"

_WORD = "(?:" + "|".join(sorted(DIGIT_OF, key=lambda w: (-len(w), w))) + r")(?![^\W_])"  # whole words, so a run ends where it stops being one
_OPEN, _SHUT = r"\s{0,2}[\[({<]\s{0,2}", r"\s{0,2}[\])}>]\s{0,2}"
_DOT = rf"(?:{_OPEN}(?:dot|punkt|punto|point|\.){_SHUT}|\s{{1,3}}dot\s{{1,3}}|&\#46;|&period;)"
_STEP = rf"(?:{_DOT}|\.)[a-z0-9-]"
#: A label of a host has at most 63 characters, and a host that is looked for at most 16 labels, so each look ahead is bounded.
_LABEL = r"[a-z0-9-]{1,63}+(?![a-z0-9-])"
_HOST = rf"{_LABEL}(?:(?:{_DOT}|\.){_LABEL}){{0,14}}?(?:{_DOT}[a-z]{{2,63}}+|\.(?:{ENDINGS}))(?![a-z0-9-])(?!\s{{1,3}}at\s)"

#: At least three spelled digits in a row.
RUNS = re.compile(rf"(?<![^\W_]){_WORD}(?:[ -]{_WORD}){{2,}}+", re.I)
#: A marked "at" before anything with a dot; a spaced one only before a host with a disguised dot or a known ending.
AT = re.compile(
    rf"(?<=[a-z0-9._%+-])(?:(?:{_OPEN}(?:at|a|@){_SHUT}|&\#64;|&\#x40;|&commat;|%40)(?=[a-z0-9-]++{_STEP})"
    rf"|(?:\s{{1,3}}(?:at|arroba|@)\s{{1,3}}|[_-]at[_-])(?={_HOST}))",
    re.I,
)
DOT = re.compile(rf"(?<=[a-z0-9]){_DOT}(?=[a-z0-9])", re.I)
PLUS = re.compile(r"(?<![^\W_])plus\s{1,2}(?=[0-9])", re.I)
DASH = re.compile(r"(?<=[0-9])\s{1,2}(?:dash|hyphen|minus)\s{1,2}(?=[0-9])", re.I)
#: Spelled digits beside a disguised dot or plus may be one or two.
BESIDE = re.compile(rf"(?:(?<=dot )|(?<=plus )){_WORD}(?:[ -]{_WORD})*+(?![^\W_])|(?<![^\W_]){_WORD}(?:[ -]{_WORD})*+(?= dot )", re.I)
_LITERAL = ("dot", "&#", "&commat;", "&period;", "%40", "arroba", " @ ")
_MARKED = re.compile(rf"{_OPEN}(?:at|a|@|punkt|punto|point|\.){_SHUT}".removeprefix(r"\s{0,2}"))
_SIGNED = re.compile(r"[_-]at[_-]|plus\s|[0-9]\s{1,2}(?:dash|hyphen|minus)\s")
_SPACED = re.compile(r"\sat\s{1,3}[a-z0-9-]++\.|\s@\s")
_DIGIT = re.compile(rf"(?<![^\W_]){_WORD}[ -]{_WORD}[ -]{_WORD}(?![^\W_])")
_DIGIT_FIRST = re.compile(rf"[ -]{_WORD}[ -]")


#: Other characters that patterns without regard to case take for ASCII letters.
FOLD = str.maketrans("ſıİ\u212a", "siik")


def lower(text: str) -> str:
    """Lower case as the patterns see it."""
    return (text if text.isascii() else text.translate(FOLD)).lower()


def hinted(text: str) -> bool:
    """Whether the word transducers can have anything to do: true whenever a rule of CHAIN changes the text."""
    low = lower(text)
    return (
        any(x in low for x in _LITERAL) or bool(_MARKED.search(low)) or bool(_SIGNED.search(low)) or bool(_SPACED.search(low))
        or bool(_DIGIT_FIRST.search(low) and _DIGIT.search(low))
    )


def plain_char(c: str) -> str:
    """ASCII for a look-alike or another form of an ASCII character, nothing for an invisible one, else the character."""
    if c in LOOKALIKES or c in SIGNS:
        return LOOKALIKES.get(c) or SIGNS[c]
    form = unicodedata.normalize("NFKC", c)
    if form.isascii():
        return form
    if unicodedata.category(c) == "Cf":
        return ""
    digit = unicodedata.decimal(c, None)
    return c if digit is None else str(digit)


class Rewritten:
    """A text after a transducer, with the source places of its changes."""

    def __init__(self, text: str, rule: re.Pattern, output):
        self.new_start, self.new_end, self.old_start, self.old_end = [], [], [], []
        parts, done, size = [], 0, 0
        for m in rule.finditer(text):
            got = output(m[0])
            if got == m[0]:
                continue
            parts += [text[done : m.start()], got]
            size += m.start() - done
            self.new_start.append(size)
            size += len(got)
            self.new_end.append(size)
            self.old_start.append(m.start())
            self.old_end.append(m.end())
            done = m.end()
        self.text = "".join(parts) + text[done:] if parts else text

    def changed(self, start: int, end: int) -> bool:
        """Whether a change lies inside a span of the new text."""
        k = bisect_right(self.new_end, start)
        while k < len(self.new_start) and self.new_start[k] < end:
            if self.new_end[k] > start:
                return True
            k += 1
        return False

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The span of the old text that a non-empty span of the new one came from."""
        return self._place(start, False), self._place(end - 1, True)

    def _place(self, at: int, end: bool) -> int:
        k = bisect_right(self.new_start, at) - 1
        while k >= 0 and self.new_start[k] == self.new_end[k]:  # a deletion before the character
            if self.new_end[k] <= at:
                return self.old_end[k] + at - self.new_end[k] + end
            k -= 1
        if k < 0:
            return at + end
        if at < self.new_end[k]:
            return self.old_end[k] if end else self.old_start[k]
        return self.old_end[k] + at - self.new_end[k] + end


def spelled(run: str) -> str:
    return "".join(DIGIT_OF[w] for w in re.split("[ -]", lower(run)))


#: The transducers that work on words, in order.
CHAIN = ((RUNS, spelled), (BESIDE, spelled), (AT, lambda _: "@"), (DOT, lambda _: "."), (PLUS, lambda _: "+"), (DASH, lambda _: "-"))


def hidden_spans(text: str, plain: list[Span]) -> list[Span]:
    """Identifiers that show only after normalisation, as source spans; none that lies inside a plain span of its kind."""
    chain = []
    if not text.isascii() and ODD.search(text):
        chain.append(Rewritten(text, ODD, plain_char))
    now = chain[-1].text if chain else text
    if hinted(now):
        for rule, output in CHAIN:
            chain.append(Rewritten(chain[-1].text if chain else text, rule, output))
    chain = [step for step in chain if step.new_start]
    if not chain:
        return []
    found: set[Span] = set()
    known = {kind: ([a for k, a, _ in plain if k == kind], [z for k, _, z in plain if k == kind]) for kind in KINDS}  # by start, apart
    for kind, start, end in plain_spans(chain[-1].text):
        touched = False
        for step in reversed(chain):
            touched = touched or step.changed(start, end)
            start, end = step.source(start, end)
        starts, ends = known[kind]
        k = bisect_right(starts, start) - 1  # the one plain span that may hold this one
        if touched and not (k >= 0 and end <= ends[k]):
            found.add((kind, start, end))
    return list(found)


def scan(text: str | None) -> tuple[list[Span], list[Span]]:
    """(plain spans, all spans), both by kind and start."""
    text = text or ""
    plain = plain_spans(text)
    hidden = hidden_spans(text, plain)
    every = sorted({*plain, *hidden}, key=lambda s: (KINDS.index(s[0]), s[1], s[2])) if hidden else plain
    return plain, every


def scanner():
    """Column function: text -> struct(plain, spans), whole texts in Arrow batches."""
    small_batches()
    spans = "array<struct<kind:string,start:int,end:int>>"

    def rows(found: list[Span]) -> list[dict]:
        return [{"kind": k, "start": a, "end": z} for k, a, z in found]

    @F.pandas_udf(f"plain {spans}, spans {spans}")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in tidy(batches):
            got = [scan(t) for t in batch]
            yield pd.DataFrame({"plain": [rows(p) for p, _ in got], "spans": [rows(e) for _, e in got]}, columns=["plain", "spans"])

    return run


def find(docs: DataFrame) -> DataFrame:
    """Spans of personal data in every whole text of ``docs`` (doc_id, text): doc_id, plain, spans.

    Both are arrays of (kind, start, end) in code points, end exclusive, by kind and start. ``plain`` holds what stands in
    the text undisguised, leftmost and non-overlapping per kind; ``spans`` adds the disguised ones (one may reach beyond a
    plain one, when only part of an identifier was disguised). A null text counts as empty and has none; repeated rows are
    scanned alike; other columns are ignored. The work is linear in the text, and one text at a time is held.
    """
    return docs.select("doc_id", scanner()(F.col("text").cast("string")).alias("p")).select("doc_id", "p.plain", "p.spans")

"""Main text of web pages from flat text blocks, classified by a small decision tree.

A page is read once into blocks, runs of text between block-level tags. A block is described by its words and link density,
those of its neighbours, and whether it stands in a page's main part, in a part that is not (menu, form, advert, ...) or in a
heading. Decision trees learned from the labelled tables below tell article text from the rest: one for pages that name their
main part, and one for pages that do not, where words and links decide, those of the block's own part of the page among them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import small_batches, tidy

#: Elements by their part in a page.
RAW = frozenset("script style noscript template title textarea iframe object svg math canvas audio video select head".split())
MAIN = frozenset("article main".split())
ASIDE = frozenset("nav header footer aside form menu dialog button fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BREAKS = MAIN | ASIDE | HEADINGS | frozenset(
    "address blockquote body caption center dd details div dl dt figcaption figure hr html legend li ol option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OPEN_ENDED = frozenset("p li dt dd option tr td th tbody thead tfoot".split())  # ended by what follows, so not kept open
#: Words in class, id or role that name a part beside the article.
SIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "alert popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs footer toolbar pagination pager share "
    "sharing social related recommended recommendations newsletter subscribe subscription signup login comment comments respond "
    "disqus replies widget masthead search contentinfo complementary hidden".split()
)
MAIN_WORDS = frozenset("article main".split())
#: Words before and after a side word in a name that tells of the layout around it.
LAYOUT_BEFORE, LAYOUT_AFTER = frozenset("has with no without".split()), frozenset("page layout".split())
#: A header of these is the article's own; side words whose text is no part of the sentence around it.
OWN_HEADERS = frozenset("entry post article content story section".split())
ADVERT_WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner share sharing".split())
WRAPPERS = frozenset("nav header footer aside menu dialog button".split())  # never around an article as its layout

FEATURES = "words links before_words before_links after_words after_links side main heading page_main".split()
#: Labelled blocks (1 article text), the features in the order of FEATURES.
TABLE = """
60 0.00 40 0.00 50 0.00 0 1 0 1 1 | 120 0.05 0 0.00 80 0.00 0 1 0 1 1 | 1 0.00 60 0.00 70 0.00 0 1 0 1 1 | 2 0.00 0 0.00 3 0.00 0 1 0 1 1
8 0.00 0 0.00 60 0.00 0 1 1 1 1 | 4 0.00 80 0.00 90 0.00 0 1 1 1 1 | 12 0.10 10 0.00 9 0.00 0 1 0 1 1 | 30 0.30 50 0.00 40 0.10 0 1 0 1 1
25 0.50 60 0.00 45 0.00 0 1 0 1 1 | 6 1.00 60 0.00 80 0.00 0 1 0 1 1 | 3 0.00 1 1.00 9 0.00 0 1 1 1 1 | 1 0.00 1 1.00 0 0.00 0 1 0 1 1
5 1.00 5 1.00 6 1.00 0 1 0 1 0 | 3 1.00 70 0.00 4 1.00 0 1 0 1 0 | 4 1.00 3 1.00 2 0.00 0 1 0 1 0 | 2 1.00 2 1.00 0 0.00 0 1 0 1 0
7 0.95 6 1.00 60 0.00 0 1 0 1 0 | 90 0.00 0 0.00 0 0.00 0 1 0 1 1 | 1 0.00 0 0.00 0 0.00 0 1 1 1 1 | 300 0.02 8 0.00 200 0.00 0 1 0 1 1
1 1.00 0 0.00 1 1.00 1 0 0 1 0 | 1 1.00 1 1.00 1 1.00 1 0 0 1 0 | 9 0.00 1 1.00 8 0.00 1 0 0 1 0 | 40 0.00 1 1.00 8 0.00 1 0 0 1 0
12 0.00 80 0.00 0 0.00 1 0 0 1 0 | 80 0.00 60 0.00 70 0.00 1 1 0 1 0 | 5 0.00 70 0.00 60 0.00 1 1 0 1 0 | 3 0.00 0 0.00 2 0.00 1 0 1 1 0
150 0.00 90 0.00 0 0.00 1 0 0 1 0 | 6 0.50 30 0.00 20 0.00 1 1 0 1 0 | 20 0.00 30 0.00 40 0.00 1 0 0 0 0 | 70 0.00 60 0.00 60 0.00 1 0 0 0 0
1 1.00 0 0.00 1 1.00 1 0 0 0 0 | 8 0.00 60 0.00 0 0.00 1 0 0 0 0 | 4 0.00 0 0.00 50 0.00 1 0 1 0 0 | 200 0.00 100 0.00 10 0.00 1 0 0 0 0
30 0.00 5 1.00 6 0.00 0 0 0 1 0 | 8 0.00 70 0.00 0 0.00 0 0 0 1 0 | 3 1.00 2 1.00 1 1.00 0 0 0 1 0 | 60 0.00 40 0.00 50 0.00 0 0 0 1 0
2 0.00 0 0.00 3 1.00 0 0 1 1 0 | 15 0.20 60 0.00 3 0.00 0 0 0 1 0 | 1 0.00 90 0.00 1 0.00 0 0 0 1 0 | 120 0.00 9 0.00 1 1.00 0 0 0 1 0
60 0.00 40 0.00 50 0.00 0 0 0 0 1 | 25 0.05 0 0.00 40 0.00 0 0 0 0 1 | 18 0.00 50 0.00 30 0.00 0 0 0 0 1 | 9 0.00 60 0.00 70 0.00 0 0 0 0 1
3 0.00 45 0.00 50 0.00 0 0 0 0 1 | 14 0.00 0 0.00 60 0.00 0 0 0 0 1 | 7 0.00 1 1.00 60 0.00 0 0 1 0 1 | 5 0.00 60 0.00 50 0.00 0 0 1 0 1
9 0.00 2 0.00 80 0.00 0 0 1 0 1 | 45 0.25 30 0.00 30 0.00 0 0 0 0 1 | 90 0.00 0 0.00 0 0.00 0 0 0 0 1 | 30 0.00 60 0.00 2 1.00 0 0 0 0 1
1 1.00 1 1.00 1 1.00 0 0 0 0 0 | 3 1.00 0 0.00 2 1.00 0 0 0 0 0 | 4 0.00 1 1.00 2 1.00 0 0 0 0 0 | 6 0.00 3 1.00 1 0.00 0 0 0 0 0
2 0.00 1 1.00 1 1.00 0 0 1 0 0 | 12 0.90 3 1.00 2 1.00 0 0 0 0 0 | 5 0.00 4 0.00 3 0.00 0 0 0 0 0 | 8 0.60 60 0.00 2 1.00 0 0 0 0 0
3 0.00 50 0.00 1 0.00 1 1 0 1 0 | 1 0.00 3 0.00 1 0.00 1 1 0 1 0 | 16 0.00 2 0.00 0 0.00 1 1 0 1 0 | 40 0.00 3 0.00 2 0.00 1 1 0 1 0
2 0.00 16 0.00 20 0.00 1 1 1 1 0 | 1 0.50 1 0.00 1 0.00 1 1 0 1 0 | 100 0.00 1 1.00 7 0.00 1 1 0 1 0 | 9 0.10 9 0.00 6 0.00 1 1 1 1 0
55 0.00 0 0.00 0 0.00 1 0 0 0 0 | 35 0.00 30 0.00 5 0.00 1 0 0 0 0 | 25 0.10 2 0.00 3 0.00 1 0 0 0 0 | 7 0.00 40 0.00 45 0.00 1 0 1 0 0
18 0.00 60 0.00 80 0.00 1 1 0 1 0 | 12 0.00 1 0.00 25 0.30 1 1 0 1 0 | 90 0.00 70 0.00 4 0.00 1 1 1 1 0 | 65 0.20 0 0.00 3 0.00 1 1 0 1 0
1 0.00 2 0.00 1 0.00 0 1 0 1 1 | 2 0.00 1 0.00 4 0.20 0 1 0 1 1 | 3 0.10 20 0.00 2 0.00 0 1 1 1 1 | 50 0.00 1 0.00 1 0.00 0 1 0 1 1
5 0.00 40 0.00 30 0.00 0 0 0 1 0 | 25 0.00 1 1.00 60 0.00 0 0 0 1 0 | 44 0.00 30 0.00 2 0.00 0 0 1 1 0 | 9 0.00 9 0.00 7 0.00 0 0 0 1 0
30 0.00 4 1.00 50 0.00 0 1 0 1 1 | 2 0.00 3 1.00 20 0.00 0 1 0 1 1 | 80 0.05 1 1.00 12 0.00 0 1 0 1 1 | 6 0.95 5 1.00 30 0.00 0 1 0 1 0
15 0.00 2 1.00 40 0.50 0 1 0 1 1 | 1 0.00 6 1.00 9 0.00 0 1 0 1 1 | 200 0.00 8 1.00 100 0.00 0 1 0 1 1 | 2 1.00 4 1.00 60 0.00 0 1 0 1 0
7 0.00 2 1.00 0 0.00 0 0 0 0 0 | 30 0.80 4 1.00 6 1.00 0 0 0 0 0 | 3 0.00 5 0.00 0 0.00 0 0 0 0 0 | 10 0.00 60 0.00 0 0.00 0 0 0 0 1
"""

#: Pages that name no main part; part_words are the words outside links of the other blocks in the same part of the page.
BARE_FEATURES = "words links before_words before_links after_words after_links side heading part_words".split()
#: Labelled blocks (1 article text) of such pages, the features in the order of BARE_FEATURES.
BARE_TABLE = """
60 0.00 40 0.00 50 0.00 0 0 90 1 | 25 0.05 0 0.00 40 0.00 0 0 40 1 | 18 0.00 50 0.00 30 0.00 0 0 80 1 | 9 0.00 60 0.00 70 0.00 0 0 130 1
3 0.00 45 0.00 50 0.00 0 0 95 1 | 14 0.00 0 0.00 60 0.00 0 0 60 1 | 7 0.00 1 1.00 60 0.00 0 1 60 1 | 5 0.00 60 0.00 50 0.00 0 1 110 1
9 0.00 2 0.00 80 0.00 0 1 0 1 | 45 0.25 30 0.00 30 0.00 0 0 200 1 | 90 0.00 0 0.00 0 0.00 0 0 0 1 | 30 0.00 60 0.00 2 1.00 0 0 150 1
40 0.00 4 0.00 35 0.00 0 0 37 1 | 35 0.00 40 0.00 2 0.00 0 0 42 1 | 2 0.00 35 0.00 12 0.00 0 0 75 1 | 2 0.00 35 0.00 9 0.00 1 0 75 0
1 0.00 4 0.00 5 0.00 0 1 14 1 | 4 0.00 1 0.00 5 0.00 0 0 11 1 | 5 0.00 4 0.00 5 0.00 0 0 10 1 | 5 0.00 5 0.00 0 0.00 0 0 10 1
2 0.00 0 0.00 6 0.00 0 1 19 1 | 6 0.00 2 0.00 7 0.00 0 0 15 1 | 7 0.00 6 0.00 6 0.00 0 0 15 1 | 6 0.00 7 0.00 3 0.00 0 0 15 1
3 0.00 1 1.00 12 0.00 0 1 30 1 | 12 0.00 3 0.00 9 0.00 0 0 21 1 | 9 0.00 12 0.00 9 0.00 0 0 24 1 | 9 0.00 9 0.00 4 1.00 0 0 24 1
12 0.30 20 0.00 30 0.00 0 0 60 1 | 2 1.00 40 0.00 50 0.00 0 0 140 1 | 4 1.00 30 0.00 45 0.00 0 0 90 1 | 20 0.60 50 0.00 45 0.00 0 0 120 1
6 0.00 50 0.00 4 0.00 0 0 9 1 | 4 0.00 6 0.00 5 0.00 0 0 11 1 | 5 0.00 4 0.00 70 0.00 0 0 10 1 | 8 0.00 60 0.00 55 0.00 0 0 0 1
20 0.00 40 0.00 30 0.00 0 0 0 1 | 35 0.10 2 1.00 3 1.00 0 0 0 1 | 30 0.00 3 0.00 8 0.00 0 0 0 1 | 150 0.02 1 1.00 6 0.00 0 0 0 1
50 0.00 2 1.00 2 0.00 0 0 60 1 | 70 0.10 4 0.00 0 0.00 0 0 4 1 | 5 0.00 1 1.00 70 0.00 0 1 70 1 | 6 0.00 0 0.00 80 0.00 0 1 0 1
4 0.00 70 0.00 60 0.00 0 1 0 1 | 10 0.10 9 0.00 12 0.20 0 0 40 1 | 1 0.00 20 0.00 18 0.00 0 0 38 1 | 3 0.00 8 0.00 1 0.00 0 0 30 1
1 1.00 1 1.00 1 1.00 0 0 0 0 | 3 1.00 0 0.00 2 1.00 0 0 0 0 | 4 0.00 1 1.00 2 1.00 0 0 0 0 | 6 0.00 3 1.00 1 0.00 0 0 0 0
2 0.00 1 1.00 1 1.00 0 1 0 0 | 12 0.90 3 1.00 2 1.00 0 0 2 0 | 5 0.00 4 0.00 3 0.00 0 0 0 0 | 8 0.60 60 0.00 2 1.00 0 0 3 0
7 0.00 2 1.00 0 0.00 0 0 0 0 | 30 0.80 4 1.00 6 1.00 0 0 2 0 | 3 0.00 5 0.00 0 0.00 0 0 0 0 | 10 0.00 60 0.00 0 0.00 0 0 0 0
1 0.00 0 0.00 50 0.00 0 0 0 0 | 3 0.00 0 0.00 1 1.00 0 0 0 0 | 2 0.00 0 0.00 1 1.00 0 1 1 0 | 5 0.00 0 0.00 40 0.00 0 0 0 0
1 1.00 2 0.00 1 1.00 0 0 3 0 | 2 1.00 1 1.00 30 0.00 0 0 0 0 | 2 1.00 40 0.00 3 1.00 0 0 0 0 | 5 1.00 5 1.00 6 1.00 0 0 1 0
7 0.95 6 1.00 60 0.00 0 0 0 0 | 9 1.00 50 0.00 8 1.00 0 0 2 0 | 6 1.00 2 0.00 7 1.00 0 0 2 0 | 2 0.00 60 0.00 6 1.00 0 1 0 0
4 0.00 50 0.00 0 0.00 0 0 0 0 | 8 0.20 40 0.00 0 0.00 0 0 0 0 | 6 0.00 1 1.00 1 1.00 0 0 2 0 | 9 0.00 2 1.00 3 1.00 0 0 0 0
1 0.00 1 1.00 60 0.00 0 0 0 0 | 2 0.50 0 0.00 1 1.00 0 0 1 0 | 3 1.00 9 0.00 3 1.00 0 0 0 0 | 10 0.70 3 1.00 12 0.80 0 0 6 0
1 1.00 0 0.00 1 1.00 1 0 0 0 | 8 0.00 60 0.00 0 0.00 1 0 0 0 | 4 0.00 0 0.00 50 0.00 1 1 20 0 | 200 0.00 100 0.00 10 0.00 1 0 110 0
20 0.00 30 0.00 40 0.00 1 0 70 0 | 70 0.00 60 0.00 60 0.00 1 0 0 0 | 35 0.00 30 0.00 5 0.00 1 0 35 0 | 12 0.00 0 0.00 40 0.00 1 0 0 0
5 0.00 30 0.00 25 0.00 1 0 90 0 | 25 0.10 2 0.00 3 0.00 1 0 5 0 | 7 0.00 40 0.00 45 0.00 1 1 85 0 | 9 0.00 9 0.00 8 0.00 1 0 17 0
6 0.00 1 0.00 20 0.00 1 0 14 0 | 3 0.00 12 0.00 5 0.00 1 1 30 0 | 15 0.00 3 0.00 15 0.00 1 0 18 0 | 60 0.00 3 0.00 40 0.00 1 0 43 0
6 0.00 22 0.00 22 0.00 0 0 0 1 | 5 0.00 30 0.00 45 0.00 0 0 0 1 | 11 0.00 35 0.00 28 0.00 0 0 0 1 | 2 0.00 22 0.00 2 0.00 0 0 2 1
2 0.00 2 0.00 22 0.00 0 0 2 1 | 3 0.00 30 0.00 4 0.00 0 0 8 1 | 4 0.00 3 0.00 4 0.00 0 0 7 1 | 4 0.00 4 0.00 35 0.00 0 0 7 1
3 0.67 0 0.00 1 0.00 0 0 100 0 | 2 1.00 2 0.00 0 0.00 0 0 110 0 | 4 0.50 0 0.00 5 0.00 0 0 60 0 | 6 0.80 30 0.00 0 0.00 0 0 90 0
1 1.00 1 1.00 1 1.00 0 0 80 0 | 1 1.00 1 1.00 20 0.00 0 0 80 0 | 2 1.00 3 1.00 0 0.00 0 0 70 0 | 3 1.00 40 0.00 2 1.00 0 0 75 0
4 0.00 40 0.00 5 1.00 0 0 0 0 | 5 0.00 2 1.00 30 0.00 0 0 1 0 | 3 0.00 22 0.00 0 0.00 0 0 0 0 | 12 0.00 25 0.00 0 0.00 0 0 0 0
25 0.00 22 0.00 0 0.00 0 0 22 1 | 22 0.00 1 1.00 25 0.00 0 0 0 1 | 22 0.00 25 0.00 3 0.00 0 0 0 1 | 8 0.15 40 0.00 30 0.10 0 0 60 1
1 0.00 0 0.00 22 0.00 0 1 0 1 | 2 0.00 1 1.00 25 0.00 0 1 0 1 | 3 0.00 2 0.00 12 0.00 0 1 0 1 | 4 0.00 30 0.00 35 0.00 0 1 2 1
1 0.00 6 0.00 40 0.00 0 1 0 1 | 2 0.00 8 0.00 18 0.00 0 1 1 1 | 3 0.00 22 0.00 1 1.00 0 1 0 0 | 2 0.00 30 0.00 0 0.00 0 1 0 0
2 0.00 22 0.00 2 1.00 0 0 46 1 | 5 0.00 30 0.00 3 1.00 0 0 80 1 | 9 0.00 14 0.00 6 0.90 0 0 60 1 | 6 0.00 12 0.00 0 0.00 0 0 70 1
3 0.00 50 0.00 4 1.00 0 0 0 0 | 5 0.00 22 0.00 2 1.00 0 0 2 0 | 4 0.00 40 0.00 1 1.00 0 0 1 0 | 2 1.00 2 0.00 2 1.00 0 0 70 0
"""


def labelled(table: str = TABLE) -> tuple[np.ndarray, np.ndarray]:
    rows = np.array([[float(x) for x in row.split()] for line in table.strip().splitlines() for row in line.split("|")])
    return rows[:, :-1], rows[:, -1].astype(int)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 12):
    """A tree of (feature, threshold, at most, above) with leaves 0 or 1: each split lowers Gini impurity most, first wins."""
    if depth == 0 or y.min() == y.max():
        return int(2 * y.sum() > len(y))

    def impurity(part: np.ndarray) -> float:
        p = part.mean()
        return len(part) * 2 * p * (1 - p)

    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= t
            score = impurity(y[low]) + impurity(y[~low])
            if best is None or score < best[0] - 1e-12:
                best = (score, f, float(t))
    if best is None:
        return int(2 * y.sum() > len(y))
    _, f, t = best
    low = x[:, f] <= t
    return f, t, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


@cache
def trees():
    """The tree for pages that name their main part, and the one for pages that do not."""
    return grow(*labelled()), grow(*labelled(BARE_TABLE))


def decide(node, row: tuple) -> int:
    while not isinstance(node, int):
        f, t, low, high = node
        node = low if row[f] <= t else high
    return node


TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)/?>")
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)>")
NAME = re.compile(r"</?[a-zA-Z]")
NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
UNSEEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Reader:
    """Blocks of one page: (text, words, words in links, in a side part, in the main part, heading, number of its part)."""

    def __init__(self, html: str):
        self.blocks: list[tuple] = []
        self.parts: list[str] = []
        self.words = self.linked = self.link = 0
        self.open: list[tuple] = []  # element, side part, main part, side part by name or form, outermost article, number
        self.numbers = 0
        self.inline = self.mute = ""  # the paragraph that is open; the advert inside a sentence that is being left out
        self.muted = 0
        self.soft, self.outer = 0, -1  # side parts by name or form; those around the outermost article or main, -1 outside
        self.count: Counter = Counter()
        self.side = self.main = 0
        self.heading = False
        self.read(html)

    def say(self, text: str) -> None:
        if text and not self.mute:
            text = unescape(text) if "&" in text else text
            self.parts.append(text)
            n = len(text.split())
            self.words += n
            self.linked += n * (self.link > 0)

    def end_block(self) -> None:
        if self.words:
            text = " ".join("".join(self.parts).split())
            n = len(text.split())
            part = self.open[-1][5] if self.open else 0
            self.blocks.append((text, n, min(1.0, self.linked / n), self.side, self.main > 0, self.heading, part, self.outer))
        self.parts, self.words, self.linked = [], 0, 0

    def start(self, name: str, attributes: str) -> None:
        if name == "br":
            self.parts.append(" ")
        if name == "a":
            self.link += 1
        if name not in BREAKS:
            if self.mute:
                self.muted += name == self.mute
            elif self.count[name]:
                self.push(name, False, False, False)  # inside an inline side part, so that its end is told from theirs
            elif name not in VOID and name != "a" and attributes and not self.count["pre"]:
                self.phrase(name, self.names(attributes) & SIDE_WORDS)
            return
        self.end_block()
        self.mute, self.inline = "", name if name in OPEN_ENDED or name in HEADINGS else ""
        self.link = 0  # no link reaches over blocks
        self.heading = name in HEADINGS
        if name in VOID or name in OPEN_ENDED or name in HEADINGS:
            return
        names = self.names(attributes) if attributes else frozenset()
        main = name in MAIN or bool(names & MAIN_WORDS)
        side = name in ASIDE and not (name == "header" and self.main) or bool(names & SIDE_WORDS) or bool(attributes and UNSEEN.search(attributes))
        side = side or "header" in names and not self.main and not names & OWN_HEADERS
        soft = name not in WRAPPERS and not (attributes and UNSEEN.search(attributes))
        self.push(name, side and name not in ("body", "html") and not (main and name in MAIN), main, soft)

    def phrase(self, name: str, words: frozenset) -> None:
        """An inline element named as a side part: around blocks it is one; inside a sentence an advert is left out, until its own end
        or that of the paragraph, and anything else is a part of the sentence."""
        if words and not self.inline and not self.words:
            self.end_block()
            self.push(name, True, False, True)
        elif words & ADVERT_WORDS:
            self.mute, self.muted = name, 1

    def names(self, attributes: str) -> frozenset:
        found = set()
        for m in NAMES.finditer(attributes):
            for name in m[1].split():
                words = [w.lower() for w in PARTS.findall(name)]
                for before, w, after in zip(["", *words], words, [*words[1:], ""]):
                    if w not in SIDE_WORDS or before not in LAYOUT_BEFORE and after not in LAYOUT_AFTER:
                        found.add(w)
        return frozenset(found)

    def push(self, name: str, side: bool, main: bool, soft: bool) -> None:
        soft, top = side and soft, name in MAIN and self.outer < 0
        if top:
            self.outer = self.soft
        self.numbers += 1
        self.open.append((name, side, main, soft, top, self.numbers))
        self.soft += soft
        self.count[name] += 1
        self.side += side
        self.main += main

    def stop(self, name: str) -> None:
        if name == "a":
            self.link = 0
        if name in BREAKS:
            self.end_block()
            self.heading, self.mute, self.inline = False, "", ""
        elif self.mute:
            self.muted -= name == self.mute
            self.mute = self.mute if self.muted else ""
            return
        elif self.count[name]:
            self.end_block()  # an inline element around blocks
        if self.count[name]:
            while True:
                was, side, main, soft, top, _ = self.open.pop()
                self.soft -= soft
                if top:
                    self.outer = -1
                self.count[was] -= 1
                self.side -= side
                self.main -= main
                if was == name:
                    break

    def read(self, html: str) -> None:
        at, low = 0, None
        tag, ends = TAG, True  # plainer tags once a quote stays open to the end; whether any tag ends are left
        while True:
            lt = html.find("<", at)
            if lt < 0:
                self.say(html[at:])
                break
            self.say(html[at:lt])
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                at = len(html) if end < 0 else end + 3
                continue
            if html.startswith(("<!", "<?"), lt):
                end = html.find(">", lt)
                at = len(html) if end < 0 else end + 1
                continue
            m = None
            if ends and NAME.match(html, lt):
                ends = html.find(">", lt) >= 0
                m = tag.match(html, lt) if ends else None
                if ends and not m:
                    tag = PLAIN_TAG
                    m = tag.match(html, lt)
            if not m:
                self.say("<")
                at = lt + 1
                continue
            name, at = m[2].lower(), m.end()
            if m[1]:
                self.stop(name)
            elif name in RAW and name != "head":
                low = html.lower() if low is None else low
                end = low.find(f"</{name}", at)
                at = len(html) if end < 0 else end
            else:
                self.start(name, m[3])
        self.end_block()
        self.settle()

    def settle(self) -> None:
        """Side parts by name or form that every article of the page stands in are its layout; they do not count for the articles.
        An article in further ones, such as a teaser, stays beside."""
        layout = min((b[7] for b in self.blocks if b[7] >= 0), default=0)
        self.blocks = [(*b[:3], b[3] > (layout if b[7] >= 0 else 0), *b[4:7]) for b in self.blocks]


def main_text(html: str | None, nodes=None) -> str:
    """The article's blocks in page order, two line feeds between; empty if there is none."""
    blocks = Reader(html or "").blocks
    named, bare = trees() if nodes is None else nodes
    page_main = any(b[4] for b in blocks)
    plain = [round(words * (1 - links)) for _, words, links, *_ in blocks]
    parts = Counter()
    for block, words in zip(blocks, plain):
        parts[block[6]] += words
    edge = ("", 0, 0.0)
    kept = []
    for i, (text, words, links, side, main, heading, part) in enumerate(blocks):
        before, after = blocks[i - 1] if i else edge, blocks[i + 1] if i + 1 < len(blocks) else edge
        around = (words, links, before[1], before[2], after[1], after[2], side)
        if page_main:
            good = decide(named, (*around, main, heading, page_main))
        else:
            good = decide(bare, (*around, heading, parts[part] - plain[i]))
        if good:
            kept.append(text)
    return "\n\n".join(kept)


def extractor():
    """Column function: html -> main text."""
    small_batches()
    nodes = trees()

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in tidy(batches):
            yield pd.Series([main_text(h, nodes) for h in batch], dtype=object)

    return run


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html; other columns are ignored).

    White space inside a block is one space, character references are decoded, and blocks are joined in page order. A null
    or empty page, and one without article text, has an empty text. Markup may be broken or cut off anywhere. Repeated rows
    are read alike. Whole pages are read; nothing is shuffled.
    """
    return pages.select("page_id", "url", extractor()(F.col("html").cast("string")).alias("text")).withColumn("n_chars", F.length("text").cast("long"))

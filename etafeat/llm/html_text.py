"""HTML extraction (operator 9): text blocks classified by a decision tree.

A page is cut into flat blocks at block-level tags. Each block has a word count,
a link density (share of its words inside links), the same of its neighbours,
and its place: inside an article or main element, inside a region named as
something else (menu, header, footer, sidebar, notice, advert, form, comments),
or neither. A decision tree, trained on the small labelled table below, says
which blocks are main text. Scripts, styles, comments in the markup and the
page's head are never blocks.

Defined results: a NULL or empty page, or one without main text, gives the empty
text. Markup that the page breaks off in is dropped; what it leaves open lasts
to its end. Character references are decoded as browsers do; white space in a
block becomes one space, blocks are joined by one space, in page order, whole.
Repeated rows are extracted alike. Only id, url and html are read.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etafeat.llm.common import table

NOWHERE, ARTICLE, ELSEWHERE = 0, 1, 2
#: words and link density of the block, of the one before, of the one after; place; main text?
LABELLED = (
    # paragraphs, headings and one-word lines of articles
    (120, 0.00, 14, 0.00, 90, 0.02, 1, 1), (90, 0.02, 120, 0.00, 45, 0.00, 1, 1), (45, 0.00, 90, 0.02, 1, 0.00, 1, 1),
    (14, 0.00, 6, 1.00, 120, 0.00, 1, 1), (1, 0.00, 45, 0.00, 60, 0.00, 1, 1), (3, 0.00, 2, 0.00, 4, 0.00, 1, 1),
    (60, 0.10, 1, 0.00, 12, 0.00, 1, 1), (8, 0.00, 0, 0.00, 0, 0.00, 1, 1), (5, 1.00, 60, 0.00, 70, 0.00, 1, 1),
    (2, 1.00, 30, 0.00, 2, 1.00, 1, 1), (25, 0.60, 40, 0.00, 30, 0.00, 1, 1), (350, 0.01, 9, 0.00, 5, 1.00, 1, 1),
    (1, 0.00, 1, 0.00, 1, 0.00, 1, 1), (2, 0.00, 3, 0.00, 2, 0.00, 1, 1), (3, 0.00, 1, 0.00, 0, 0.00, 1, 1),
    (1, 1.00, 1, 1.00, 1, 1.00, 1, 1), (2, 1.00, 0, 0.00, 3, 1.00, 1, 1), (4, 0.75, 2, 1.00, 3, 0.66, 1, 1),
    (9, 0.90, 5, 1.00, 2, 0.00, 1, 1), (30, 0.80, 4, 0.00, 25, 0.70, 1, 1), (4, 0.00, 3, 1.00, 0, 0.00, 1, 1),
    (1, 0.00, 0, 0.00, 0, 0.00, 1, 1), (6, 0.50, 2, 0.00, 4, 0.00, 1, 1), (40, 0.45, 4, 0.00, 3, 0.00, 1, 1),
    (7, 0.00, 8, 0.00, 0, 0.00, 1, 1), (16, 0.00, 5, 1.00, 10, 0.00, 1, 1), (2, 0.50, 0, 0.00, 25, 0.00, 1, 1),
    # named regions: menus, headers, footers, sidebars, notices, adverts, forms, comments
    (1, 1.00, 0, 0.00, 1, 1.00, 2, 0), (1, 1.00, 1, 1.00, 1, 1.00, 2, 0), (4, 1.00, 1, 1.00, 8, 0.00, 2, 0),
    (8, 0.00, 1, 1.00, 14, 0.00, 2, 0), (30, 0.00, 1, 1.00, 12, 0.00, 2, 0), (60, 0.05, 40, 0.00, 0, 0.00, 2, 0),
    (90, 0.00, 120, 0.00, 80, 0.00, 2, 0), (2, 0.00, 6, 0.00, 1, 0.00, 2, 0), (12, 0.20, 200, 0.00, 0, 0.00, 2, 0),
    (45, 0.00, 50, 0.00, 30, 0.00, 2, 0), (20, 0.00, 0, 0.00, 9, 0.00, 2, 0), (150, 0.01, 20, 0.00, 100, 0.00, 2, 0),
    (6, 0.00, 350, 0.00, 0, 0.00, 2, 0), (16, 0.50, 3, 1.00, 10, 0.00, 2, 0), (5, 0.00, 90, 0.00, 8, 0.00, 2, 0),
    # pages that name nothing: text blocks and the short lines between them
    (80, 0.00, 2, 1.00, 70, 0.00, 0, 1), (70, 0.03, 80, 0.00, 30, 0.00, 0, 1), (30, 0.00, 70, 0.03, 25, 0.08, 0, 1),
    (25, 0.08, 30, 0.00, 110, 0.00, 0, 1), (110, 0.00, 6, 0.00, 2, 1.00, 0, 1), (18, 0.00, 60, 0.00, 45, 0.00, 0, 1),
    (14, 0.00, 0, 0.00, 0, 0.00, 0, 1), (40, 0.20, 35, 0.00, 50, 0.00, 0, 1), (12, 0.00, 55, 0.00, 4, 1.00, 0, 1),
    (6, 0.00, 80, 0.00, 70, 0.00, 0, 1), (5, 0.00, 40, 0.00, 100, 0.00, 0, 1), (7, 0.00, 3, 1.00, 90, 0.00, 0, 1),
    # and their menus, link lists, labels and small print
    (1, 1.00, 0, 0.00, 1, 1.00, 0, 0), (2, 1.00, 1, 1.00, 1, 1.00, 0, 0), (3, 1.00, 2, 1.00, 80, 0.00, 0, 0),
    (9, 0.80, 4, 1.00, 7, 0.90, 0, 0), (22, 0.70, 90, 0.00, 15, 0.60, 0, 0), (35, 0.90, 3, 1.00, 6, 1.00, 0, 0),
    (15, 0.60, 22, 0.70, 0, 0.00, 0, 0), (3, 0.00, 1, 1.00, 1, 1.00, 0, 0), (2, 0.00, 3, 0.00, 2, 0.00, 0, 0),
    (4, 0.00, 2, 1.00, 0, 0.00, 0, 0), (6, 0.50, 40, 0.00, 5, 0.50, 0, 0), (5, 0.00, 4, 0.00, 3, 1.00, 0, 0),
    (60, 0.55, 90, 0.00, 4, 1.00, 0, 0), (7, 1.00, 70, 0.00, 60, 0.00, 0, 0),
)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6) -> tuple | float:
    """A decision tree: (feature, value, at most, above), or the share of main text at a leaf."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0):
        return share
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[:-1] + values[1:]) / 2:
            left = x[:, f] <= cut
            impurity = sum(m.sum() * y[m].mean() * (1 - y[m].mean()) for m in (left, ~left))
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, f, float(cut), left
    if best is None:
        return share
    _, f, cut, left = best
    return f, cut, grow(x[left], y[left], depth - 1), grow(x[~left], y[~left], depth - 1)


def train(rows=LABELLED) -> tuple | float:
    table_ = np.array(rows, np.float64)
    return grow(table_[:, :-1], table_[:, -1])


def is_main(tree: tuple | float, features: tuple) -> bool:
    while isinstance(tree, tuple):
        f, cut, left, right = tree
        tree = left if features[f] <= cut else right
    return tree >= 0.5


TAG = re.compile(r"<(?:!--(?P<comment>.*?)(?:--!?>|\Z)|(?P<decl>[!?][^>]*(?:>|\Z))|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)"
                 r"(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?P<end>>|\Z|(?=[\"'])))", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)
#: no text of the page: skipped up to their end tag
UNSEEN = frozenset("script style noscript template svg math iframe object video audio canvas select textarea head title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q ruby rb rp rt s samp "
    "small span strike strong sub sup time tt u var wbr".split())
#: regions that stay what they are whatever is inside
FIRM = frozenset("nav aside footer dialog menu".split())
LOOSE = frozenset("form button fieldset".split())  # an article may stand inside
#: class, id and role words that name a region that is not main text
NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice alert popup modal overlay sidebar sidenav menu menubar nav navbar navigation breadcrumb breadcrumbs footer "
    "header masthead topbar toolbar share sharing social related recommended newsletter subscribe subscription signup login "
    "search widget pagination pager contentinfo complementary disclaimer".split())
REPLIES = frozenset("comment comments commentlist disqus replies reply respond".split())
CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())
WORD = re.compile(r"[^\W_]+")


def region(name: str, attrs: str) -> str:
    """What a start tag says of its content: ``firm`` or ``loose`` boilerplate, ``article`` or nothing."""
    kind = "firm" if name in FIRM else "loose" if name in LOOSE else "article" if name in ("article", "main") else ""
    if "=" not in attrs and "hidden" not in attrs or name in ("html", "body"):
        return kind
    for key, *values in ATTRIBUTE.findall(attrs):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or key == "style" and "display:none" in value.replace(" ", ""):
            return "firm"
        if key in ("class", "id", "role"):
            for part in value.split():
                words = WORD.findall(part)
                if not words or words[0] in ("has", "with", "no", "without"):
                    continue
                if not REPLIES.isdisjoint(words):
                    return "firm"
                if kind != "article" and not NAMED.isdisjoint(words):
                    kind = kind or "loose"
                elif not kind and (key == "role" and part in ("main", "article") or part == "article"):
                    kind = "article"
    return kind


def blocks(page: str) -> list[tuple[str, int, int, int]]:
    """(text, words, words in links, place) of each block that has text."""
    out: list[tuple[str, int, int, int]] = []
    stack: list[tuple[str, int, bool]] = []  # open elements: name, place inside, firm
    pieces: list[tuple[str, bool]] = []
    place, firm, in_link = NOWHERE, False, 0

    def flush() -> None:
        if pieces:
            text = " ".join(html_lib.unescape("".join(t for t, _ in pieces)).split())
            if text:
                linked = len(html_lib.unescape(" ".join(t for t, a in pieces if a)).split())
                n = len(text.split())
                out.append((text, n, min(n, linked), place))
            pieces.clear()

    def pop(to: int) -> None:
        nonlocal place, firm
        flush()
        del stack[to:]
        _, place, firm = stack[-1] if stack else ("", NOWHERE, False)

    at = 0
    while True:
        lt = page.find("<", at)
        if lt < 0:
            if at < len(page):
                pieces.append((page[at:], in_link > 0))
            break
        if lt > at:
            pieces.append((page[at:lt], in_link > 0))
        m = TAG.match(page, lt)
        if not m:
            if page.startswith("</", lt):  # a bogus comment
                at = page.find(">", lt) + 1 or len(page)
            else:
                pieces.append(("<", in_link > 0))
                at = lt + 1
            continue
        at = m.end()
        if m["name"] is None:
            continue
        if m["end"] != ">":  # an open quote: up to the next > as browsers recover, or the page breaks off here
            gt = page.find(">", at)
            if gt < 0:
                break
            at = gt + 1
        name = m["name"].lower()
        if m["close"]:
            if name == "a":
                in_link = max(0, in_link - 1)
            if name in INLINE and not any(s[0] == name for s in stack):
                continue
            if name in ("br", "p") or name not in INLINE:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    pop(i)
                    break
            continue
        closed = m["attrs"].rstrip().endswith("/")
        if name in UNSEEN:
            if not closed or name in ("script", "style", "textarea", "title"):
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            if name not in INLINE:
                flush()
            continue
        if name == "br":
            pieces.append((" ", in_link > 0))
            continue
        if name == "a":
            in_link = 1
        kind = region(name, m["attrs"])
        if name in INLINE:
            if not kind or name in VOID:
                continue
        flush()
        if name in VOID:
            continue
        if stack and stack[-1][0] == name and name in CLOSES_ITSELF or stack and stack[-1][0] == "p" and name not in INLINE:
            pop(len(stack) - 1)
        if name == "p" and not kind:
            continue  # nothing depends on where a plain paragraph ends but the blocks themselves
        if name == "header" and not kind and place != ARTICLE:
            kind = "loose"
        if not firm:
            if kind == "article":
                place = ARTICLE
            elif kind:
                place, firm = ELSEWHERE, kind == "firm"
        stack.append((name, place, firm))
    flush()
    return out


def main_text(page: str | None, tree: tuple | float) -> str:
    found = blocks(page or "")
    shape = [(n, linked / n) for _, n, linked, _ in found]
    none = (0, 0.0)
    kept = []
    for i, (text, _, _, place) in enumerate(found):
        before, after = shape[i - 1] if i else none, shape[i + 1] if i + 1 < len(shape) else none
        if is_main(tree, (*shape[i], *before, *after, place)):
            kept.append(text)
    return " ".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text): a row per row of ``pages``."""
    tree = train()

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([main_text(p, tree) for p in b], dtype=object)

    return pages.select("page_id", "url", F.pandas_udf(run, "string")("html").alias("text"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))

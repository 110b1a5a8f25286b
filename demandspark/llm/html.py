"""Main text of HTML pages by the maximum-scoring subsequence.

A page is a sequence of tokens: words and tags. A tag weighs against the main text; a word weighs by the innermost block
element that it stands in (words of links outside paragraphs by themselves). Weights are log-odds of being inside against
outside the main text, learnt from labelled pages: those whose markup says where the article is (one ``<article>`` or
``<main>`` element). Kadane's linear scan finds the contiguous region of largest total weight, whose text is the main text.

Page furniture is told by the names of elements and classes, and is left out of the region's text. It weighs once for
each of its elements, whatever is in it: little inside an article or amid other text, as an aside, an advert or a table of
contents stands between two parts of one text; more where an element of its kind ends the page's text (``nav``, ``footer``
and the like). So what it holds teaches nothing about lists, tables and links elsewhere, and a list or table that no
labelled article has keeps its prior weight, under which its words outweigh its tags.

Weights are fitted on a bounded sample of pages (``max_pages``, chosen by hash, one page of each chosen page_id) and smoothed
towards prior weights: by element names, and for class names all of whose parts are usual names of page furniture (``ad-slot``
is one, ``related-work`` is not). So pages without such markup, and tables without any such page, have weights too; there,
text outside the article that stands in neither furniture nor links is not told from the article's.

The scan over the markup is linear in the page: a tag ends at its ``>``, quotes are heeded until one stays open.

Edge cases: null or empty html gives an empty text; unclosed, stray and malformed tags are tolerated; character
references are decoded; repeated rows are extracted alike; texts are never cut; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of elements and parts of class or id names, as HTML authors use them.
RAW = "script style noscript template iframe svg textarea title"
APART = "nav header footer aside form button select menu dialog head"
FURNITURE = "ad ads advert advertisement advertising banner sponsor sponsored promo sidebar nav navbar navigation menu breadcrumb breadcrumbs footer header masthead comment comments respond reply replies cookie cookies consent notice gdpr popup modal newsletter subscribe signup login share sharing social related recommended widget toolbar pagination pager disclaimer copyright"
NEUTRAL = "area bar block body bottom box btn button container content field form group holder inner item items left link links list main module outer page panel right row section site slot space thread title top unit wrap wrapper"
BLOCK = "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul"
VOID = "area base br col embed hr img input link meta param source track wbr"
TEXTUAL = "p h1 h2 h3 h4 h5 h6 blockquote pre article main section"
LISTED = "caption dd details dl dt figcaption figure li ol summary table tbody td tfoot th thead tr ul"
CLOSING = "nav header footer form menu dialog"

RAW_SET, APART_SET, FURNITURE_SET, NEUTRAL_SET, BLOCK_SET, VOID_SET, TEXT_SET, LIST_SET, CLOSING_SET = (frozenset(x.split()) for x in (RAW, APART, FURNITURE, NEUTRAL, BLOCK, VOID, TEXTUAL, LISTED, CLOSING))
START = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|(/?)([a-zA-Z][a-zA-Z0-9:-]*))")
QUOTED = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
NAMED = re.compile(r"\b(?:class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.I)
PART = re.compile(r"[a-z]+")
PRIOR, OUT = 20.0, -1.5
#: Largest weight of a word and of a tag, so that no element decides alone; what furniture weighs within a text, and where it ends one.
MOST_WORD, MOST_TAG, WITHIN, ENDING = 4.0, 1.5, 1.0, 4.0
LINK = ".link"


def is_furniture(name: str) -> bool:
    """Whether all parts of a class or id name are usual for page furniture, one of them for certain."""
    found = PART.findall(name.lower())
    return not FURNITURE_SET.isdisjoint(found) and all(p in FURNITURE_SET or p in NEUTRAL_SET for p in found)


def prior(key: str) -> float:
    """Weight of a key before any page is seen. Keys are ``<name`` of tags, ``.name`` of words by block, ``#name`` of classes and elements."""
    kind, name = key[:1], key[1:]
    if kind == "#":
        return -3.0 if name in APART_SET or is_furniture(name) else 0.0
    if kind == ".":
        return -0.5 if key == LINK else 1.0 if name in TEXT_SET else 0.5 if name in LIST_SET else 0.3
    return -0.05 if name in LIST_SET else -0.1 if name not in BLOCK_SET else -0.3 if name in TEXT_SET or name == "br" else -0.5


class Page:
    """Tokens of a page in order.

    ``items`` are (word or None, key, sign, depth in an article, glue): ``sign`` is the number of the innermost element
    with names, an index into ``signs``; ``glue`` tells a word that follows the one before without a break. The tags of an
    element bear its own sign.
    """

    def __init__(self, html: str | None):
        self.items: list[tuple[str | None, str, int, int, bool]] = []
        self.signs: list[tuple[int, tuple[str, ...]]] = [(0, ())]  # (sign of the element around, own names)
        self.articles = 0
        # open elements: name, block name for words, sign
        self._stack: list[tuple[str, str, int]] = []
        self._open: Counter = Counter()
        self._depth, self._space = 0, True
        self._read(html or "")

    def _read(self, html: str) -> None:
        at = text = 0  # where to look for a tag, and where text not yet read begins
        quotes, end = True, len(html)
        while True:
            m = START.search(html, at)
            if m is None:
                break
            if m.start() > text:
                self._words(html[text : m.start()])
            kind = m[0]
            if kind == "<!--" or kind == "<![CDATA[":
                close = html.find("-->" if kind == "<!--" else "]]>", m.end())
                if kind != "<!--":
                    self._words(html[m.end() : close if close >= 0 else end])
                at = text = close + 3 if close >= 0 else end
                continue
            got = QUOTED.match(html, m.end()) if quotes else None
            if got is None:
                # an open quote, or no end at all: from here on a tag ends at the next ">", so this is tried once
                quotes = False
                close = html.find(">", m.end())
                if close < 0:
                    text = m.start()
                    break
                stop = close + 1
            else:
                stop = got.end()
            at = text = stop
            if m[2] is None:
                continue
            name, rest = m[2].lower(), html[m.end() : stop - 1]
            if name in BLOCK_SET:
                self._space = True
            if m[1]:
                self._close(name)
                continue
            if name in VOID_SET or name in RAW_SET or rest.endswith("/"):
                self._tag(name, self._sign())
            if name in RAW_SET and not rest.endswith("/"):
                skip = re.compile(rf"</{name}\s*>", re.I).search(html, at)
                at = text = skip.end() if skip else end
                self._space |= name == "title"
            elif name not in VOID_SET and not rest.endswith("/"):
                self._enter(name, rest)
        if text < end:
            self._words(html[text:])

    def _enter(self, name: str, rest: str) -> None:
        stack = self._stack
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
            self._close(name)
        article = name in ("article", "main")
        names = [] if article or name in ("html", "body") else [w for q in NAMED.findall(rest) for w in "".join(q).lower().split()]
        # the header of an article is part of it
        if name in APART_SET and not (name == "header" and self._depth):
            names.append(name)
        around = stack[-1][2] if stack else 0
        if names:
            self.signs.append((around, tuple(dict.fromkeys(names))))
            around = len(self.signs) - 1
        block = name if name in BLOCK_SET else stack[-1][1] if stack else ""
        stack.append((name, block, around))
        self._open[name] += 1
        self._depth += article
        self.articles += article and self._depth == 1
        self._tag(name, around)

    def _close(self, name: str) -> None:
        if not self._open[name]:
            return
        while True:
            got, _, sign = self._stack.pop()
            self._tag(got, sign)
            self._open[got] -= 1
            self._depth -= got in ("article", "main")
            if got == name:
                return

    def _sign(self) -> int:
        return self._stack[-1][2] if self._stack else 0

    def _tag(self, name: str, sign: int) -> None:
        self.items.append((None, "<" + name, sign, self._depth, False))

    def _words(self, raw: str) -> None:
        text = unescape(raw) if "&" in raw else raw
        _, block, sign = self._stack[-1] if self._stack else ("", "", 0)
        self._space |= text[:1].isspace()
        key = LINK if self._open["a"] and block not in TEXT_SET else "." + block
        for w in text.split():
            self.items.append((w, key, sign, self._depth, not self._space))
            self._space = True
        if text.strip():
            self._space = text[-1:].isspace()


def furniture(page: Page) -> list[bool]:
    """By sign: whether the element, or one around it, is furniture by its names alone."""
    out: list[bool] = []
    for around, names in page.signs:
        out.append((bool(out) and out[around]) or any(prior("#" + n) < 0 for n in names))
    return out


def count(page: Page) -> tuple[Counter, Counter]:
    """Tokens by key, inside and outside the article of a labelled page. Tokens of furniture count for the names of it only."""
    good, bad = Counter(), Counter()
    off = furniture(page)
    words: Counter = Counter()
    for word, key, sign, depth, _ in page.items:
        inside = depth > 0 and not off[sign]
        if not off[sign]:
            (good if inside else bad)[key] += 1
        if word is not None:
            words[sign, inside] += 1
    # a name gets all words in its element, so those of inner elements are handed outwards
    for inside, counter in ((True, good), (False, bad)):
        total = [words[s, inside] for s in range(len(page.signs))]
        for s in range(len(page.signs) - 1, 0, -1):
            around, names = page.signs[s]
            for n in names:
                counter["#" + n] += total[s]
            total[around] += total[s]
    return good, bad


def learn(pages: DataFrame, max_pages: int = 5_000) -> dict[str, float]:
    """Weight of every key met in the sampled pages with exactly one article element."""
    chosen = pages.select("page_id").where("page_id is not null").distinct().select("page_id", F.xxhash64("page_id").alias("_at")).orderBy("_at", "page_id").limit(max_pages).select("page_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = Counter(), Counter()
        for b in batches:
            for html in b.column("html").to_pylist():
                page = Page(html)
                if page.articles == 1:
                    g, x = count(page)
                    good.update(g)
                    bad.update(x)
        keys = sorted({*good, *bad})
        yield pa.record_batch([pa.array(keys, pa.string()), pa.array([good[k] for k in keys], pa.int64()), pa.array([bad[k] for k in keys], pa.int64())], ["key", "good", "bad"])

    # at most max_pages ids: bounded, so broadcast; one page of each, and the keys are those of so many pages
    sample = pages.select("page_id", "html").join(F.broadcast(chosen), "page_id").groupBy("page_id").agg(F.min("html").alias("html"))
    counted = sample.mapInArrow(run, "key string, good long, bad long")
    rows = counted.groupBy("key").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).collect()
    return weights_of({r.key: (r.good, r.bad) for r in rows})


def weights_of(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Smoothed log-odds within bounds; a tag never counts for the main text, as the method has it."""
    out = {}
    for key, (good, bad) in counts.items():
        p = 1 / (1 + np.exp(-prior(key)))
        w = float(np.log((good + PRIOR * p) / (bad + PRIOR * (1 - p))))
        out[key] = min(max(w, -MOST_TAG), -0.05) if key[0] == "<" else min(max(w, -MOST_WORD), MOST_WORD)
    return out


def scored(page: Page, weights: dict[str, float]) -> tuple[list[float], list[float]]:
    """Weight of every token, and by sign the lowest weight of the names around (0 if none counts against)."""
    known = lambda key: weights[key] if key in weights else prior(key)
    low, root = [], []  # by sign; root is the outermost furniture element around
    for s, (around, names) in enumerate(page.signs):
        low.append(min([low[around] if low else 0.0, *(known("#" + n) for n in names)]))
        root.append(-1 if low[s] >= OUT else root[around] if s and root[around] >= 0 else s)
    scores, last = [], -1
    for word, key, sign, depth, _ in page.items:
        at = root[sign]
        if at < 0:
            scores.append(known(key) + (low[sign] if word is not None else 0.0))
        else:
            ends = depth == 0 and not CLOSING_SET.isdisjoint(page.signs[at][1])
            scores.append(0.0 if at == last else -ENDING if ends else -WITHIN)
        last = at
    return scores, low


def region(scores: list[float]) -> tuple[int, int]:
    """First and last+1 token of the contiguous region of largest weight; the earliest and shortest on ties."""
    best, total, start = (0.0, 0, 0), 0.0, 0
    for i, w in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += w
        if total > best[0]:
            best = (total, start, i + 1)
    return best[1], best[2]


def main_text(html: str | None, weights: dict[str, float]) -> str:
    page = Page(html)
    scores, low = scored(page, weights)
    a, b = region(scores)
    out: list[str] = []
    for word, _, sign, _, glue in page.items[a:b]:
        if word is None or low[sign] < OUT:
            continue
        if glue and out:
            out[-1] += word
        else:
            out.append(word)
    return " ".join(out)


def extract_pages(pages: DataFrame, max_pages: int = 5_000) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    weights = learn(pages, max_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 200):
                s = b.slice(at, 200)
                texts = [main_text(h, weights) for h in s.column("html").to_pylist()]
                yield pa.record_batch([s.column("page_id"), s.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")

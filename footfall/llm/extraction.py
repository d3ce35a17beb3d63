"""Main text of web pages: boosted trees over the elements of each page, decided together per page.

Every element of a page (and every line of text that stands straight inside a container) gets features:
its depth, its place among its siblings and their sizes, the text, links, elements and punctuation of its
subtree, their densities and shares of the page, and what the words of its name and attributes, and those
of the elements around it, spoke for in training. Gradient-boosted trees give each the log odds of holding
main text. The decisions of a page are then taken together, from the leaves up and back down: the set of
kept elements with the largest sum of log odds in which nothing is kept inside what is dropped. The text of
kept elements is put together block by block in page order.

The trees are trained on a bounded sample (``SAMPLE_PAGES`` pages of at most ``SAMPLE_CHARS`` characters):
some as they are, labelled by their own markup (``article``, ``main``, ``nav``, ...), and ``LAYOUTS``
made-up layouts into which the sampled text is dealt anew, so that the trees also learn from pages whose
markup says little. The words of attributes are weighed on other layouts than the trees are trained on.
Every page is extracted from its whole source, in the tasks that read it; nothing is shuffled.

Edges
-----
* A null or empty page, or one without main text, gives an empty text of 0 characters.
* Character references are decoded; white space is what ``str.split`` takes for it; ``<br>`` is white space.
* An unfinished tag or comment at the end of a page is no text, an unclosed script or style runs to its end.
* Repeated rows, rows without an id: one result row each. An empty table gives no rows.
* A page of any length and depth is taken whole, in time linear in its length.
* Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm import boosting
from footfall.llm.dom import Page, blocks_of
from footfall.llm.layouts import Writer
from footfall.llm.text import plain

SAMPLE_PAGES = 120
SAMPLE_CHARS = 1 << 16
LAYOUTS = 400
#: Characters of source whose elements are judged together, unless a page is longer.
CHUNK_CHARS = 1 << 20
#: Stands in for the text of pages where the sample has none.
FILLER = "Some words that stand in where no page of the sample has any text, with a comma and a full stop."

_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|style|hidden|itemprop)(?![\w-])(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""", re.I)
_WORD = re.compile("[A-Z]?[a-z]+|[A-Z]+")
_MARK = re.compile("data-main=([01])")
#: Element names that tell main text from the rest, used as labels of real pages only.
KEPT_NAMES = frozenset("article main".split())
DROPPED_NAMES = frozenset("nav header footer aside form dialog menu".split())
#: Attribute words that name what is no main text, used likewise.
DROPPED_WORDS = frozenset("ad ads advert sidebar menu nav footer cookie notice comments share".split())
FEATURES = 30


def words_of(name: str, attributes: str) -> tuple[str, ...]:
    """The element's name in angle brackets and the words of its telling attributes."""
    found = {f"<{name}>"}
    if attributes:
        for kind, value in _ATTRIBUTE.findall(attributes):
            if kind.lower() == "hidden" or (kind.lower() == "style" and re.search(r"display\s*:\s*none", value, re.I)):
                found.add("hidden")
            elif kind.lower() != "style":
                found.update(w.lower() for w in _WORD.findall(value))
    return tuple(found)


class Elements:
    """The elements of some pages as arrays; an element's subtree is a range."""

    def __init__(self, pages: list[Page], weights: dict[str, float], known: dict):
        sizes = np.array([len(p.parent) for p in pages])
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        base = np.repeat(self.first[:-1], sizes)
        self.n = int(self.first[-1])
        joined = lambda name: np.fromiter((x for p in pages for x in getattr(p, name)), np.int64, self.n)
        self.depth = joined("depth")
        self.end = joined("end") + base
        self.parent = joined("parent")
        self.parent = np.where(self.parent < 0, np.arange(self.n), self.parent + base)
        self.root = base
        self.words = []
        for page in pages:
            for pair in zip(page.tag, page.attributes):
                if pair not in known:
                    if len(known) > 100_000:
                        known.clear()
                    telling = pair[0] in KEPT_NAMES or pair[0] in DROPPED_NAMES
                    scores = [weights.get(w, 0.0) for w in words_of(*pair) if telling or w[0] != "<"] or [0.0]
                    known[pair] = (weights.get(f"<{pair[0]}>", 0.0), min(scores), max(scores))
                self.words.append(known[pair])
        self.words = np.array(self.words, dtype=np.float64).reshape(-1, 3)
        self.tags = [t for p in pages for t in p.tag]
        own = np.zeros((self.n, 4))  # characters, of links, marks between words, words
        for page, at in zip(pages, self.first):
            for node, _, text, linked in page.runs:
                size = len(text)
                marks = text.count(",") + text.count(".") + text.count("!") + text.count("?")
                own[at + node] += (size, size if linked else 0, marks, text.count(" ") + 1) if not text.isspace() else (0, 0, 0, 0)
        self.own = own
        order = np.argsort(self.depth, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(self.depth[order])) + 1) if self.n else []

    def below(self, values: np.ndarray) -> np.ndarray:
        """Sums over each element's subtree."""
        total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
        return total[self.end] - total[np.arange(self.n)]

    def features(self) -> np.ndarray:
        x = np.zeros((self.n, FEATURES))
        sums = self.below(self.own)
        chars, linked, marks, words = sums.T
        nodes = self.end - np.arange(self.n)
        page = chars[self.root]
        before = np.concatenate([[0], np.cumsum(self.own[:, 0])])[:-1]
        before -= before[self.root]
        tag = np.array(self.tags, dtype=object)
        lines = self.below(np.isin(tag, ["p"]) * 1.0)
        in_lines = self.below(np.where(np.isin(tag, ["p"]), chars, 0))
        inputs = self.below(np.isin(tag, ["form", "label", "fieldset"]) * 1.0)
        heads = self.below(np.isin(tag, ["h1", "h2", "h3", "h4", "h5", "h6"]) * 1.0)
        items = self.below(np.isin(tag, ["li", "a"]) * 1.0)
        above_min, above_max = np.zeros(self.n), np.zeros(self.n)
        worst, best = self.words[:, 1], self.words[:, 2]
        for level in self.levels[1:]:
            up = self.parent[level]
            above_min[level] = np.minimum(above_min[up], worst[up])
            above_max[level] = np.maximum(above_max[up], best[up])
        # Siblings: sorted by parent, in page order.
        order = np.lexsort((np.arange(self.n), self.parent))
        order = order[self.parent[order] != order]
        up = self.parent[order]
        starts = np.flatnonzero(np.concatenate([[True], up[1:] != up[:-1]])) if len(up) else np.empty(0, np.int64)
        count = np.diff(np.append(starts, len(up)))
        place = np.arange(len(up)) - np.repeat(starts, count)
        of = np.repeat(count, count)
        left, right = np.zeros(self.n), np.zeros(self.n)
        same = np.zeros(len(up), dtype=bool)
        if len(up) > 1:
            adjacent = up[1:] == up[:-1]
            left[order[1:][adjacent]] = chars[order[:-1][adjacent]]
            right[order[:-1][adjacent]] = chars[order[1:][adjacent]]
            same[1:] = adjacent & (tag[order[1:]] == tag[order[:-1]])
        bad = self.below(np.where(np.minimum(above_min, worst) < -1.5, self.own[:, 0], 0))
        log = np.log1p
        columns = [
            np.minimum(self.depth, 30), log(chars), log(self.own[:, 0]), linked / np.maximum(chars, 1), log(nodes),
            chars / (nodes + 1), marks / np.maximum(words, 1), words / np.maximum(nodes, 1), chars / np.maximum(page, 1),
            before / np.maximum(page, 1), log(lines), in_lines / np.maximum(chars, 1), log(inputs), log(heads),
            log(items), items / nodes, left, right, above_min, above_max, self.words[:, 0], worst, best,
            bad / np.maximum(chars, 1), chars / np.maximum(chars[self.parent], 1), log(chars[self.parent]),
            log(self.end - 1 - np.arange(self.n)),
        ]
        for i, column in enumerate(columns):
            x[:, i] = column
        x[order, 27], x[order, 28], x[order, 29] = place / np.maximum(of - 1, 1), np.minimum(of, 100), same
        x[:, 16:18] = log(x[:, 16:18])
        self.chars = chars
        return x

    def kept(self, odds: np.ndarray) -> np.ndarray:
        """The elements of the best choice in which a kept element's parent is kept."""
        gain = np.where(self.chars > 0, odds, 0.0)
        for level in reversed(self.levels[1:]):
            np.add.at(gain, self.parent[level], np.maximum(gain[level], 0))
        kept = gain > 0
        for level in self.levels[1:]:
            kept[level] &= kept[self.parent[level]]
        return kept


@dataclass
class Model:
    weights: dict[str, float]
    forest: boosting.Forest

    def texts(self, sources: list[str], known: dict) -> list[str]:
        pages = [Page(source) for source in sources]
        elements = Elements(pages, self.weights, known)
        kept = elements.kept(self.forest.log_odds(elements.features()))
        return [
            "\n".join(blocks_of((block, text) for node, block, text, _ in page.runs if kept[at + node]))
            for page, at in zip(pages, elements.first)
        ]


def _marked(page: Page) -> np.ndarray:
    """Which elements of a made-up page hold main text; the marks are taken off."""
    own = np.zeros(len(page.parent))
    marks = [0] * len(page.parent)
    for i, attributes in enumerate(page.attributes):
        found = _MARK.search(attributes)
        marks[i] = int(found[1]) if found else marks[page.parent[i]] if i else 0
        page.attributes[i] = _MARK.sub("", attributes)
    for node, _, text, _ in page.runs:
        own[node] += marks[node] and not text.isspace()
    return _holds(page, own)


def _by_markup(page: Page) -> np.ndarray | None:
    """The same for a real page that says which part is its article; None where it does not."""
    if not KEPT_NAMES & set(page.tag):
        return None
    own, marks = np.zeros(len(page.parent)), [0] * len(page.parent)
    for i, (name, attributes) in enumerate(zip(page.tag, page.attributes)):
        marks[i] = marks[page.parent[i]] if i else 0
        if name in KEPT_NAMES and marks[i] == 0:
            marks[i] = 1
        if name in DROPPED_NAMES or DROPPED_WORDS & set(words_of(name, attributes)):
            marks[i] = -1
    for node, _, text, _ in page.runs:
        own[node] += marks[node] == 1 and not text.isspace()
    return _holds(page, own)


def _holds(page: Page, own: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(own)])
    return total[np.array(page.end)] - total[:-1] > 0


def _weights(pages: list[Page], labels: list[np.ndarray]) -> dict[str, float]:
    """What each word speaks for: smoothed log odds among the elements that have text."""
    main, rest = Counter(), Counter()
    for page, held in zip(pages, labels):
        filled = _holds(page, np.bincount([r[0] for r in page.runs if not r[2].isspace()], minlength=len(page.parent)))
        for i in np.flatnonzero(filled):
            (main if held[i] else rest).update(words_of(page.tag[i], page.attributes[i]))
    return {w: float(np.log((main[w] + 1) / (rest[w] + 1))) for w in main.keys() | rest.keys() if main[w] + rest[w] >= 4}


def train(sources: list[str], layouts: int = LAYOUTS, seed: int = 0) -> Model:
    """The model from some real pages."""
    real = [(page, held) for page in map(Page, sources) if (held := _by_markup(page)) is not None]
    blocks, phrases = [], []
    for page, held in real:
        texts = blocks_of((block, text) for node, block, text, _ in page.runs if held[node])
        blocks += [t for t in texts if len(t) < 4000]
        phrases += blocks_of((block, text) for node, block, text, _ in page.runs if not held[node])
    for source in sources if not blocks else ():
        blocks += blocks_of((block, text) for _, block, text, _ in Page(source).runs)
    blocks = blocks or [FILLER]
    phrases = (phrases or []) + random.Random(seed).sample(blocks, min(len(blocks), 200))
    made = [Page(Writer(seed * layouts + i, blocks, phrases).page()) for i in range(layouts)]
    made = [(page, _marked(page)) for page in made]
    weights = _weights(*zip(*(made[::2] + real[::2])))
    rest = made[1::2] + real[1::2]
    elements = Elements([page for page, _ in rest], weights, {})
    x, y = elements.features(), np.concatenate([held for _, held in rest]).astype(float)
    filled = elements.chars > 0
    return Model(weights, boosting.fit(x[filled], y[filled], np.ones(int(filled.sum()))))


def sampled(pages: DataFrame) -> list[str]:
    """The pages to train on: those with the least hashes among the ones that are not too long.

    Hashes are compared with a bound that some four times as many different pages are expected to pass,
    so that tasks send a few pages in all, not as many each.
    """
    short = pages.where((F.char_length("html") <= SAMPLE_CHARS) & (F.char_length("html") > 0))
    drawn = short.select(F.xxhash64("html").alias("draw"), "html")
    different = drawn.agg(F.approx_count_distinct("draw")).first()[0]
    share = min(1.0, 4 * SAMPLE_PAGES / max(different, 1))
    few = drawn.where(F.col("draw") <= int(share * (1 << 64)) - (1 << 63) - 1)
    rows = few.groupBy("draw").agg(F.first("html").alias("html")).orderBy("draw").limit(SAMPLE_PAGES)
    return [r["html"] for r in rows.collect()]


def main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``; without a model, one is trained on them."""
    model = model or train(sampled(pages))
    fields = {f.name: f.dataType.simpleString() for f in pages.schema}

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            sources = plain(batch.column("html"))
            sizes = np.cumsum([len(s) for s in sources.to_pylist()]) if len(sources) else np.empty(0, np.int64)
            at = 0
            while at < len(sources):
                done = sizes[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(sizes, done + CHUNK_CHARS, side="right")))
                texts = model.texts(sources.slice(at, to - at).to_pylist(), known)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("page_id").slice(at, to - at), batch.column("url").slice(at, to - at),
                        pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    ["page_id", "url", "text", "n_chars"],
                )
                at = to

    return pages.select("page_id", "url", "html").mapInArrow(
        extract, f"page_id {fields['page_id']}, url {fields['url']}, text string, n_chars long"
    )

"""Main text of web pages: boosted trees over DOM nodes, and a decoding that fits the tree.

Every node of a page (elements and pieces of text) gets features: its tag, attribute tokens on it
and above it, depth, place among its siblings, and the density of text, links, tags and sentences in
its subtree. Gradient-boosted trees give the odds that the node belongs to the main text. Decoding
goes through the tree from its leaves: a node may be kept only if its ancestors are, and the set of
kept nodes has the largest sum of log odds, weighted by text. So no text is kept inside a dropped part,
and a whole part is dropped when what it holds does not outweigh it.

The trees are fitted on a bounded sample: ``PAGES`` pages with an ``article`` or ``main`` tag, the first by hash of their number, and
``VARIANTS`` altered forms of each. The given tables have no marked nodes, so the teacher is the
markup that pages carry themselves: the content of ``article`` or ``main`` is main text, the rest of
the body is not. The altered forms rename and move these known parts (an article in a plain ``div``,
a menu as a side bar, forms, notices and reader comments also inside the article), so that the trees
learn more than the names of two tags. If no page carries such markup, a fixed rule stands for the trees: all
text is main text but that in or below a part whose tag or attributes name it a frame.

Edge cases: null, empty and broken html give the text that is left, or an empty one; equal rows get
equal texts; an empty table gives no rows and needs no model; other columns are not read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from palaver.llm.dom import FRAME_WORDS, N_FEATURES, ROOTS, TAG_KINDS, TEXT_WORDS, Page, features, read_page

PAGES, VARIANTS = 160, 3
TREES, TREE_DEPTH = 20, 5
FRAMES = ["nav", "aside", "footer", "header", "form", "div", "div", "div", "section", "ul"]
BODIES = [("article", False), ("main", False), ("div", True), ("div", True), ("section", True), ("div", False)]


def content_marks(page: Page) -> list[bool]:
    """The teacher: nodes in an ``article``, or else in a ``main``."""
    wanted = "article" if "article" in page.tag else "main"
    inside = [False] * len(page.tag)
    for i in range(1, len(inside)):
        inside[i] = inside[page.parent[i]] or page.tag[i] == wanted
    return inside


class Altered:
    """A copy of a page with known parts renamed, moved and added; ``marks`` says what is main text."""

    def __init__(self, page: Page, marks: list[bool], seed: int):
        self.random = np.random.default_rng(seed)
        self.source, self.source_marks, self.kids = page, marks, page.children()
        self.page, self.marks = Page(), [False]
        self.sentences = [t for t, g in zip(page.text, page.tag) if g == "#text" and len(t.split()) > 3] or ["Text."]
        self.copy(0, 0)

    def pick(self, values):
        return values[int(self.random.integers(len(values)))]

    def add(self, parent: int, tag: str, words=(), text: str = "", mark: bool = False) -> int:
        self.marks.append(mark)
        return self.page.add(parent, tag, frozenset(words), text)

    def copy(self, i: int, to: int) -> None:
        for child in self.kids[i]:
            tag, words = self.source.tag[child], self.source.words[child]
            mark = self.source_marks[child]
            if tag == "#text":
                self.add(to, tag, (), self.source.text[child], mark)
                continue
            top = mark and not self.source_marks[i]
            if top:
                tag, named = self.pick(BODIES)
                words = {self.pick(WORDS_OF_TEXT)} if named else set()
            elif not mark and self.source.tag[i] in ROOTS and tag not in ROOTS and self.random.random() < 0.8:
                tag = self.pick(FRAMES)
                words = {self.pick(WORDS_OF_FRAMES)} if tag in ("div", "section", "ul") or self.random.random() < 0.3 else set()
            elif mark and tag == "p" and self.random.random() < 0.1:
                tag = self.pick(["li", "blockquote", "h2", "div", "td"])
            node = self.add(to, tag, words, "", mark)
            self.copy(child, node)
            if top:
                self.extras(node)
            if top or tag == "body":
                self.extras(to)

    def extras(self, to: int) -> None:
        """Parts that are not main text, inside the article or beside it."""
        for _ in range(int(self.random.integers(0, 3))):
            tag = self.pick(FRAMES)
            named = {self.pick(WORDS_OF_FRAMES)} if tag in ("div", "section", "ul") else set()
            part = self.add(to, tag, named)
            for _ in range(int(self.random.integers(1, 5))):
                text = self.pick(self.sentences)
                words = text.split()
                item = self.add(part, self.pick(["p", "p", "li", "div", "h3", "a"]))
                short = " ".join(words[:int(self.random.integers(1, max(2, min(len(words), 40))))])
                holder = self.add(item, "a") if self.random.random() < 0.3 else item
                self.add(holder, "#text", (), short)


WORDS_OF_FRAMES, WORDS_OF_TEXT = sorted(FRAME_WORDS), sorted(TEXT_WORDS)


def node_rows(page: Page, marks: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the nodes that have text. An element is main text if most of its text is."""
    chars = [len(t.strip()) if g == "#text" else 0 for t, g in zip(page.text, page.tag)]
    good = [c * m for c, m in zip(chars, marks)]
    for i in range(len(chars) - 1, 0, -1):
        chars[page.parent[i]] += chars[i]
        good[page.parent[i]] += good[i]
    use = np.array([c > 0 and g not in ROOTS for c, g in zip(chars, page.tag)])
    label = np.array([2 * g > c for g, c in zip(good, chars)], float)
    return features(page)[use], label[use]


def training_rows(batches):
    for batch in batches:
        xs, ys = [], []
        for number, html in zip(batch["page_id"], batch["html"]):
            page = read_page(html)
            marks = content_marks(page)
            if not any(marks):
                continue
            seed = zlib.crc32(str(number).encode())
            for v in range(VARIANTS + 1):
                altered = Altered(page, marks, seed + v) if v else None
                x, y = node_rows(altered.page, altered.marks) if altered else node_rows(page, marks)
                xs += x.tolist()
                ys += y.tolist()
        yield pd.DataFrame({"x": xs, "label": ys})


def parse_trees(text: str) -> list[tuple[np.ndarray, ...]]:
    """Trees as arrays ``(feature or -1, cut, right child, value)`` from the model's printed form; left is the next node."""
    trees: list[list[list[float]]] = []
    open_: list[tuple[int, int]] = []
    weights = []
    for line in text.splitlines():
        depth = len(line) - len(line.lstrip())
        line = line.strip()
        if m := re.match(r"Tree \d+ \(weight (\S+)\):", line):
            trees.append([])
            weights.append(float(m[1]))
            open_ = []
        elif m := re.match(r"If \(feature (\d+) <= (\S+)\)", line):
            open_.append((depth, len(trees[-1])))
            trees[-1].append([int(m[1]), float(m[2]), -1, 0.0])
        elif line.startswith("Else"):
            while open_[-1][0] != depth:
                open_.pop()
            trees[-1][open_.pop()[1]][2] = len(trees[-1])
        elif m := re.match(r"Predict: (\S+)", line):
            trees[-1].append([-1, 0.0, -1, float(m[1]) * weights[-1]])
    return [tuple(np.array(c) for c in zip(*t)) for t in trees]


def fit_trees(pages: DataFrame) -> list[tuple[np.ndarray, ...]]:
    """Boosted trees from the bounded sample; none if no page carries a mark."""
    sample = pages.filter(F.col("html").rlike(r"(?i)<(article|main)[\s/>]")).orderBy(F.xxhash64("page_id", F.length("html"))).limit(PAGES)
    rows = sample.repartition(8).mapInPandas(training_rows, "x array<double>, label double").select(
        array_to_vector("x").alias("features"), "label").cache()
    try:
        if rows.select("label").distinct().count() < 2:
            return []
        model = GBTClassifier(maxIter=TREES, maxDepth=TREE_DEPTH, seed=1, stepSize=0.2).fit(rows)
    finally:
        rows.unpersist()
    return parse_trees(model.toDebugString)


def log_odds(trees: list, rows: np.ndarray) -> np.ndarray:
    total = np.zeros(len(rows))
    for feature, cut, right, value in trees:
        at = np.zeros(len(rows), np.int64)
        while True:
            i = np.flatnonzero(feature[at] >= 0)
            if not len(i):
                break
            node = at[i]
            at[i] = np.where(rows[i, feature[node].astype(int)] <= cut[node], node + 1, right[node])
        total += value[at]
    return 2 * total


def frame_rule(rows: np.ndarray) -> np.ndarray:
    """Odds without a model: against what is in a frame (its tag or attributes say so), for all else."""
    return np.where(rows[:, len(TAG_KINDS) + 2] > 0, -1.0, 1.0)


def decode(page: Page, odds: np.ndarray) -> list[bool]:
    """The consistent choice of largest weight: a node's gain is its own and those of the children worth keeping."""
    n = len(page.tag)
    chars = [len(t.strip()) if g == "#text" else 0 for t, g in zip(page.text, page.tag)]
    for i in range(n - 1, 0, -1):
        chars[page.parent[i]] += chars[i]
    gain = [0.0 if page.tag[i] in ROOTS else float(odds[i] * np.log1p(chars[i])) for i in range(n)]
    for i in range(n - 1, 0, -1):
        if gain[i] > 0 and page.tag[i] not in ROOTS:
            gain[page.parent[i]] += gain[i]
    kept = [False] * n
    kept[0] = True
    for i in range(1, n):
        kept[i] = kept[page.parent[i]] and (page.tag[i] in ROOTS or gain[i] > 0)
    return kept


def block_text(page: Page, kept: list[bool]) -> str:
    """Kept text by block: white space to one space, empty blocks left out, one line feed between."""
    blocks: dict[int, list[str]] = {}
    for i, tag in enumerate(page.tag):
        if tag == "#text" and kept[i]:
            blocks.setdefault(page.block[i], []).append(page.text[i])
    joined = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(b for b in joined if b)


def main_texts(df: DataFrame, trees: list, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every page."""

    def run(incoming):
        for batch in incoming:
            pages = [read_page(h) for h in batch.column(2).to_pylist()]
            rows = [features(p) for p in pages]
            every = np.concatenate(rows) if rows else np.zeros((0, N_FEATURES))
            odds = log_odds(trees, every) if trees else frame_rule(every)
            ends = np.cumsum([len(r) for r in rows])
            texts = [block_text(p, decode(p, odds[e - len(r):e])) for p, r, e in zip(pages, rows, ends)]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:2] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    narrow = df.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    kind = df.schema[page_id].dataType.simpleString()
    return narrow.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def extract(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Fit on the bounded sample of the table and extract all its pages."""
    sample = df.select(F.col(page_id).alias("page_id"), F.col(html).alias("html")).filter("html IS NOT NULL")
    return main_texts(df, fit_trees(sample), page_id, url, html)

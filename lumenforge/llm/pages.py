"""Operator 13: the main text of pages by a graphical model over their trees.

Every block element of a page and every run of text is a variable, content or not. Its own potential is linear in what is seen of it:
its tag, what its class, id and role speak of, how much text it holds and how much of that are links. A table of two by two joins it to
its parent, one table each for text, for elements of running text, for plain containers and for those whose tags say what they are. The
tree makes sum-product exact: messages go up, level by level from the deepest, then down again, for all pages of a batch at
once, and every node has its marginal. Runs of text with a marginal above one half are the page's text.

The model is trained by likelihood, whose gradient is what the labels show less what the marginals expect. Labelled are: pages of the
table with just one <article> (or <main>), whose own markup says what is content; and pages in the layouts of `layouts`, filled with
the words of the same sample, so that the weights hold for pages that name nothing. The sample is at most TRAIN_PAGES pages of at most
TRAIN_CHARS characters each, those of the least hashes of their content, each once: the one thing here that does not read the whole table.
Each page is then told from its own whole html alone, without a shuffle.

What odd rows give. Null and empty html, and pages without content, have an empty text. Repeated rows are told alike, each on its own; an empty
table has no rows, and a sample without words trains on layouts of one word. Bytes that are no UTF-8 are replaced. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenforge.llm.layouts import Layouts
from lumenforge.llm.markup import GROUPS, LEAF, OTHER, TAG, Page
from lumenforge.llm.shared import table

#: The sample to train on, and the pages laid out from its words.
TRAIN_PAGES, TRAIN_CHARS, LAYOUTS = 120, 100_000, 600
STEPS, RATE, PENALTY = 150, 0.15, 0.5
#: Pages whose trees go through the model at once, by their characters.
BLOCK_CHARS = 2 << 20

# Elements by what they do to the text in them
FLOWING = {TAG[t] for t in "p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre tr td th".split()}
MEANT = {TAG[t] for t in "main article header footer nav aside form".split()}
#: A row of pairwise potentials for each tag: text, running text, named containers, others.
PAIR = np.array([2 if t in MEANT else 1 if t in FLOWING else 3 for t in range(OTHER + 1)] + [0])
WORDS = np.array([1, 2, 4, 8, 16, 32, 64, 128, 256, 512])
SHARES = np.array([0.02, 0.1, 0.3, 0.5, 0.7, 0.9])
LINKED = np.array([0.01, 0.3, 0.6, 0.9])
ENDS = (".", "!", "?", '"', "”", "…", "»")


class Forest:
    """The trees of some pages as arrays, parents before children."""

    def __init__(self, pages: list[Page]):
        sizes = np.array([len(p.parent) for p in pages], np.int64)
        self.page = np.repeat(np.arange(len(pages)), sizes)
        start = np.repeat(np.cumsum(sizes) - sizes, sizes)
        joined = lambda name, kind: np.array([x for p in pages for x in getattr(p, name)], kind)
        parent = joined("parent", np.int64)
        self.root = parent < 0
        self.parent = np.where(self.root, 0, parent + start)
        self.tag, self.hint, self.hidden, self.truth = joined("tag", np.int64), joined("hint", np.int64), joined("hidden", bool), joined("truth", np.int8)
        self.leaf = np.flatnonzero(self.tag == LEAF)
        self.blocks = [b for p in pages for b in p.block.values()]
        n = len(parent)
        self.words, self.linked = np.zeros(n), np.zeros(n)
        self.words[self.leaf] = [w for p in pages for w in p.words.values()]
        self.linked[self.leaf] = [w for p in pages for w in p.linked.values()]
        # levels of nodes by depth: a node's depth is its parent's and one more
        level = np.flatnonzero(self.root)
        self.levels = [level]
        kids = np.flatnonzero(~self.root)
        kids = kids[np.argsort(self.parent[kids], kind="stable")]
        first = np.searchsorted(self.parent[kids], np.arange(n + 1))
        while len(level):
            count = first[level + 1] - first[level]
            level = kids[np.repeat(first[level] - (np.cumsum(count) - count), count) + np.arange(count.sum())]
            if len(level):
                self.levels.append(level)
        for level in reversed(self.levels[1:]):
            np.add.at(self.words, self.parent[level], self.words[level])
            np.add.at(self.linked, self.parent[level], self.linked[level])

    def features(self) -> np.ndarray:
        """One row a node of what is seen of it."""
        n = len(self.tag)
        flag = lambda k, size: np.eye(size, dtype=np.float32)[k]
        leaf = self.tag == LEAF
        total = np.maximum(self.words[self.root][self.page], 1)
        size, share = np.searchsorted(WORDS, self.words, "right"), np.searchsorted(SHARES, self.words / total, "right")
        linked = np.searchsorted(LINKED, self.linked / np.maximum(self.words, 1), "right")
        flowing = np.bincount(self.parent[~self.root], np.isin(self.tag[~self.root], [TAG["p"], LEAF]), n)
        seen = [np.ones((n, 1), np.float32), flag(self.tag, LEAF + 1), (self.hint[:, None] >> np.arange(len(GROUPS)) & 1).astype(np.float32), self.hidden[:, None].astype(np.float32)]
        # what text says is one thing for a run of text and another for all the text of an element
        for k, sizes in ((size, len(WORDS) + 1), (share, len(SHARES) + 1), (linked, len(LINKED) + 1)):
            seen += [flag(k, sizes) * leaf[:, None], flag(k, sizes) * ~leaf[:, None]]
        seen.append(flag(np.searchsorted([1, 2, 5], flowing, "right"), 4) * ~leaf[:, None])
        marks = np.zeros((n, 2), np.float32)
        marks[self.leaf] = [(b.endswith(ENDS), "©" in b) for b in self.blocks] if self.blocks else np.zeros((0, 2))
        return np.hstack([*seen, marks]).astype(np.float32)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis=axis))


def sum_product(forest: Forest, own: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """own: (nodes, 2) log potentials; pair: (kinds, parent, child). Marginals of nodes, and of (parent, child) by node; both exact."""
    edge = pair[PAIR[forest.tag]]
    below = own.copy()  # a node's own potential and what came up to it
    up = np.zeros_like(own)
    for level in reversed(forest.levels[1:]):
        up[level] = _lse(edge[level] + below[level][:, None, :], 2)
        np.add.at(below, forest.parent[level], up[level])
    above = below.copy()  # and what came down
    both = np.zeros((len(own), 2, 2))
    for level in forest.levels[1:]:
        rest = above[forest.parent[level]] - up[level]
        joint = edge[level] + rest[:, :, None]
        above[level] += _lse(joint, 1)
        joint = joint + below[level][:, None, :]
        both[level] = np.exp(joint - _lse(joint.reshape(-1, 4), 1)[:, None, None])
    return np.exp(above - _lse(above, 1)[:, None]), both


class Model:
    def __init__(self, weights: np.ndarray, pair: np.ndarray):
        self.weights, self.pair = weights, pair

    def own(self, forest: Forest) -> np.ndarray:
        out = np.zeros((len(forest.tag), 2))
        out[:, 1] = forest.features() @ self.weights
        return out

    def marginals(self, forest: Forest) -> np.ndarray:
        """The probability of each node to be content."""
        return sum_product(forest, self.own(forest), self.pair)[0][:, 1]

    def texts(self, pages: list[Page]) -> list[str]:
        forest = Forest(pages)
        out: list[list[str]] = [[] for _ in pages]
        likely = self.marginals(forest)[forest.leaf] > 0.5
        for k in np.flatnonzero(likely):
            out[forest.page[forest.leaf[k]]].append(forest.blocks[k])
        return ["\n".join(blocks) for blocks in out]


def fit(pages: list[Page]) -> Model:
    """The most likely model of labelled pages (every node with its truth), by Adam on the whole sample."""
    forest = Forest(pages)
    x, y = forest.features(), forest.truth.astype(np.int64)
    kinds, inner = PAIR[forest.tag], ~forest.root
    shown = x.T @ (y == 1).astype(np.float32)
    shown_pairs = np.zeros((4, 2, 2))
    np.add.at(shown_pairs, (kinds[inner], y[forest.parent[inner]], y[inner]), 1)
    at, moment, spread = np.zeros(x.shape[1] + 16), 0.0, 0.0
    for step in range(1, STEPS + 1):
        weights, pair = at[:-16], at[-16:].reshape(4, 2, 2)
        own = np.zeros((len(y), 2))
        own[:, 1] = x @ weights.astype(np.float32)
        node, both = sum_product(forest, own, pair)
        expected = np.zeros((4, 2, 2))
        for k in range(4):
            expected[k] = both[inner & (kinds == k)].sum(axis=0)
        slope = np.concatenate([shown - x.T @ node[:, 1].astype(np.float32), (shown_pairs - expected).ravel()]) - PENALTY * at
        moment, spread = 0.9 * moment + 0.1 * slope, 0.99 * spread + 0.01 * slope * slope
        at = at + RATE * (1 - step / (STEPS + 1)) * (moment / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
    return Model(at[:-16], at[-16:].reshape(4, 2, 2))


def by_own_markup(html: str) -> Page | None:
    """A page labelled by its own markup: what its one <article> (or, without one, its one <main>) holds, but for what says there that
    it is something else. None where the markup does not say."""
    page = Page(html)
    roots = [k for k, t in enumerate(page.tag) if t == TAG["article"]] or [k for k, t in enumerate(page.tag) if t == TAG["main"]]
    if len(roots) != 1:
        return None
    not_content = MEANT - {TAG["article"], TAG["main"], TAG["header"]}
    other = ~((1 << GROUPS.index("content")) | (1 << GROUPS.index("header")))
    for k, up in enumerate(page.parent):
        page.truth[k] = int(k == roots[0] or (up >= 0 and page.truth[up] == 1 and page.tag[k] not in not_content and not page.hint[k] & other))
    return page


def train(pages: DataFrame, train_pages: int = TRAIN_PAGES, layouts: int = LAYOUTS) -> Model:
    """The model of a table of pages (html)."""
    text = F.col("html").cast("string")
    short = pages.select(text.alias("html"), F.xxhash64(text).alias("hash")).filter(text.isNotNull() & (F.length(text) <= TRAIN_CHARS))
    # the hashes alone first: every task would send so many whole pages to the driver
    least = [r["hash"] for r in short.select("hash").distinct().orderBy("hash").limit(train_pages).collect()]
    sample = short.filter(F.col("hash").isin(least)).groupBy("hash").agg(F.min("html").alias("html")).orderBy("hash").collect() if least else []
    labelled = [p for r in sample if (p := by_own_markup(r["html"]))]
    words = sorted({w for r in sample for b in Page(r["html"]).block.values() for w in b.split() if "<" not in w and "&" not in w and len(w) < 40})
    return fit(labelled + [Page(Layouts(words, seed).page()) for seed in range(layouts)])


def main_texts(pages: DataFrame, model: Model, columns: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The named columns of pages with `text` and `n_chars`, its code points."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = batch.column(batch.num_columns - 1).fill_null(b"")
            sizes = np.diff(np.frombuffer(html.buffers()[1], np.int32)[html.offset : html.offset + len(html) + 1]) if len(html) else np.zeros(0)
            low = 0
            while low < batch.num_rows:
                high = low + max(1, int(np.searchsorted(np.cumsum(sizes[low:]), BLOCK_CHARS, "right")))
                some = batch.slice(low, high - low)
                texts = shared.value.texts([Page(h.decode("utf-8", "replace")) for h in html.slice(low, high - low).to_pylist()])
                yield pa.RecordBatch.from_arrays([*some.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*columns, "text", "n_chars"])
                low = high

    read = pages.select(*columns, F.col("html").cast("binary").alias("html "))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*columns).schema]
    return read.mapInArrow(run, ", ".join([*kinds, "text string", "n_chars long"]))


def op13_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return main_texts(pages, train(pages))

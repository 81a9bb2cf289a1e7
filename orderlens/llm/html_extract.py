"""HTML extraction: gradient-boosted trees over DOM-node features, decoded hierarchically.

Every block element of a page is a node with features: depth and place among its siblings,
density of text, links, punctuation and controls in its subtree, and what its tag and the
words of its class, id and role, and those of its ancestors, speak for. Spark's boosted trees
learn from a bounded sample of pages which nodes belong to the article. As nobody labelled the
pages, those whose own markup names the article teach, each three times: as they are, with
further boilerplate of all kinds put in, and without the tags that give it away.

A page is then decoded as a whole: of all labellings in which a kept node's ancestors are kept
too, the one with the highest probability is taken, by dynamic programming over the tree. So a
paragraph cannot survive inside a menu, nor the article without its container.

Defined results: null and empty pages, and pages without an article, give an empty text; broken
markup is read as browsers do; white space inside a block is one space, and blocks are joined
by two line feeds. Repeated rows give equal rows. Without any page whose markup names an
article, elements are kept but for those that markup speaks against. Text outside all elements
is in an implied body, and an unclosed silent element (object, video, ...) ends with the one
around it. Other columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.html_nodes import FEATURES, KINDS, Page
from orderlens.session import cut_lineage

TRAINING_PAGES = 300
TREES, DEPTH = 20, 4
EXTRACTED = "page_id long, url string, text string, n_chars long"
NODES = "label int, features array<float>"
#: Boilerplate put into training pages; {a} to {c} become words of the page.
EXTRA = [
    '<aside class="sidebar"><h3>{a}</h3><ul><li><a href="#">{b}</a></li><li><a href="#">{c}</a></li></ul></aside>',
    '<div class="cookie-notice"><p>{b}</p><button>{a}</button></div>',
    '<section id="comments"><h2>{a}</h2><div class="comment"><p>{b}</p></div><div class="comment"><p>{c}</p></div></section>',
    '<form action="#"><label>{a}</label><input type="text"><p>{b}</p><button>{a}</button></form>',
    '<div class="ad-banner"><p>{b}</p></div>',
    '<div class="related"><h4>{a}</h4><a href="#">{b}</a> <a href="#">{c}</a></div>',
    '<div class="newsletter"><p>{b}</p><input type="email"></div>',
    '<header class="site-header"><p>{b}</p><nav><a href="#">{a}</a></nav></header>',
    '<header><p>{b}</p></header>',
    '<header><h2>{a}</h2><p>{b}</p></header>',
    '<footer><p>{b}</p><p>{c}</p></footer>',
    '<div role="alert"><p>{b}</p></div>',
]


def _with_extra(html: str, page_id: int) -> str:
    """The page with boilerplate before, in and after its article, from its own words."""
    pick = random.Random(page_id)
    words = [t for _, text, _ in Page(html).blocks for t in text.split()] or ["-"]

    def phrase(most: int) -> str:
        at = pick.randrange(len(words))
        return " ".join(words[at : at + pick.randint(1, most)]).replace("<", " ").replace("&", " ")

    def part() -> str:
        return pick.choice(EXTRA).format(a=phrase(3), b=phrase(30), c=phrase(20))

    html = html.replace("<article", part() + part() + "<article", 1)
    html = html.replace("</article>", part() + part() + "</article>" + part() + part(), 1)
    return html.replace("</p>", "</p>" + part(), 1)


def _lessons(html: str, page_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for k, text in enumerate((html, _with_extra(html, page_id), html)):
        page = Page(text)
        labels = page.taught()
        if labels is None:
            return
        rows = page.features()
        if k == 2:
            # without the tags of the page's parts and all attributes, the rest must tell
            hidden = [11, 12, 13, 14] + [16 + g * len(KINDS) + i for g in range(3) for i in (0, 1, 2, 3, 4)]
            rows[:, hidden] = 0
        yield labels[1:], rows[1:]


def lessons(pages: DataFrame, most: int) -> DataFrame:
    """Rows of NODES from about `most` of the pages that name their article, by a hash of ids and pages."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = [html is not None and Page(html).taught() is not None for html in batch.column("html").to_pylist()]
            yield batch.filter(pa.array(named, pa.bool_()))

    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), "html")
    place = F.xxhash64("page_id", "html")
    every = max(1, narrow.count() // most)
    chosen = narrow.where(F.pmod(place, F.lit(every)) == 0).mapInArrow(look, "page_id long, html string")
    if every > 1 and chosen.limit(most // 2).count() < most // 2:
        # few of the sample are marked, so all pages are looked at, and the marked ones sampled
        marked = cut_lineage(narrow.mapInArrow(look, "page_id long, html string"))
        every = max(1, marked.count() // most)
        chosen = marked.where(F.pmod(place, F.lit(every)) == 0)

    def teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page_id, html in zip(batch.column("page_id").to_pylist(), batch.column("html").to_pylist()):
                for labels, rows in _lessons(html or "", page_id or 0):
                    flat = pa.array(rows.astype(np.float32).ravel())
                    at = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * FEATURES)
                    yield pa.record_batch(
                        [pa.array(labels, pa.int32()), pa.ListArray.from_arrays(at, flat)],
                        names=["label", "features"],
                    )

    return chosen.mapInArrow(teach, NODES)


class Forest:
    """Boosted trees as arrays: feature (-1 at a leaf), threshold, children, value, per tree."""

    def __init__(self, trees: list[tuple[np.ndarray, ...]], weights: list[float]):
        self.trees, self.weights = trees, weights

    @staticmethod
    def of(model) -> Forest:
        trees = []
        for tree in model.trees:
            rows: list[list[float]] = []

            def add(node) -> int:
                at = len(rows)
                rows.append([-1, 0.0, 0, 0, node.prediction()])
                if node.subtreeDepth():
                    rows[at][0] = node.split().featureIndex()
                    rows[at][1] = node.split().threshold()
                    rows[at][2] = add(node.leftChild())
                    rows[at][3] = add(node.rightChild())
                return at

            add(tree._call_java("rootNode"))
            table = np.array(rows)
            trees.append((table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int), table[:, 4]))
        return Forest(trees, list(model.treeWeights))

    def chance(self, rows: np.ndarray) -> np.ndarray:
        margin, every = np.zeros(len(rows)), np.arange(len(rows))
        for (feature, threshold, left, right, value), weight in zip(self.trees, self.weights):
            at = np.zeros(len(rows), int)
            for _ in range(DEPTH):
                inner = feature[at] >= 0
                low = rows[every, np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(low, left[at], right[at]), at)
            margin += weight * value[at]
        return 1.0 / (1.0 + np.exp(-2.0 * margin))


def train(pages: DataFrame, most: int = TRAINING_PAGES) -> Forest | None:
    """A forest from pages whose markup names the article; None if there are none."""
    rows = cut_lineage(lessons(pages, most))
    kinds = {r[0] for r in rows.select("label").distinct().collect()}
    if kinds != {0, 1}:
        return None
    model = GBTClassifier(
        featuresCol="vector", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=1, maxBins=32
    ).fit(rows.select("label", array_to_vector(F.col("features").cast("array<double>")).alias("vector")))
    return Forest.of(model)


def decode(page: Page, chance: np.ndarray) -> np.ndarray:
    """The most likely labelling in which every kept node has kept ancestors."""
    keep, drop = np.log(np.clip(chance, 1e-6, 1)), np.log(np.clip(1 - chance, 1e-6, 1))
    n = len(keep)
    best, gone = keep.copy(), drop.copy()
    for k in range(n - 1, 0, -1):
        p = page.parents[k]
        best[p] += max(best[k], gone[k])
        gone[p] += gone[k]
    kept = np.zeros(n, bool)
    kept[0] = True
    for k in range(1, n):
        kept[k] = kept[page.parents[k]] and best[k] >= gone[k]
    return kept


def by_markup(page: Page) -> np.ndarray:
    """Without a forest: what the page's marks name, or else all that they do not speak against."""
    label = page.taught()
    if label is not None:
        kept = label.astype(bool)
        # what leads to the article is not of it
        inside = np.zeros(len(kept), bool)
        for k in range(1, len(kept)):
            inside[k] = kept[k] and (inside[page.parents[k]] or page.favour[k] > 0)
        return inside
    kept = np.ones(len(page.tags), bool)
    for k in range(1, len(kept)):
        kept[k] = kept[page.parents[k]] and not page.against[k] and page.tags[k] != "header"
    kept[0] = False
    return kept


def main_text(html: str | None, forest: Forest | None) -> str:
    page = Page(html or "")
    if not page.blocks:
        return ""
    if forest is None:
        kept = by_markup(page)
    else:
        kept = decode(page, forest.chance(page.features().astype(np.float32)))
        kept[0] = False
    return "\n\n".join(text for node, text, _ in page.blocks if kept[node])


def extract(pages: DataFrame, most: int = TRAINING_PAGES) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    trained = train(pages, most)
    # plain values, as workers need not know the class
    shared = pages.sparkSession.sparkContext.broadcast(trained and vars(trained))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value and Forest(**shared.value)
        for batch in batches:
            texts = [main_text(html, forest) for html in batch.column("html").to_pylist()]
            yield pa.record_batch(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return narrow.mapInArrow(read, EXTRACTED)

"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. The n-grams of the test items are counted over all documents. Those in few documents
   (RARE of all, or RARE_DOCS) are seeds; the rest are phrases of the language. Every item
   keeps those of at most USUAL times its own median frequency too, which are at least half,
   so an item copied everywhere is still found, edited copies included.
2. Documents are searched for the seeds, which are broadcast AT_ONCE at most; a larger
   benchmark is searched in as many parts. Seeds of one item that follow each other closely
   in a document form one passage, cut out with some words on either side.
3. Passage and item are aligned. The score is the best local alignment's points over those
   of a perfect copy; edits cost points, so edited and paraphrased copies score lower.

Defined results: null or empty texts and items give no rows, nor do items with fewer words
than a seed; repeated rows of one (doc_id, item_id) give one row, the best; null ids stay
null. Other columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm import words as W
from orderlens.llm.toxicity import bare_words

SEED = 3
RARE, RARE_DOCS, USUAL = 0.001, 100, 2
#: Item words broadcast at once: some 40 bytes each.
AT_ONCE = 500_000
#: Points of the alignment: equal words, different words, a word too many on either side.
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of a perfect copy's points from which a passage counts as a copy.
SCORE = 0.5
#: Words on either side of a passage, as a share of the item.
SLACK = 0.25
#: Words of passages aligned in one numpy step.
CELLS_AT_ONCE = 200_000
ITEMS = "item_id long, hashes array<long>"
FOUND = "doc_id long, item_id long, score double, begin long, end long"


def item_words(items: DataFrame) -> DataFrame:
    """Word hashes of each test item that has a seed, one row per id and text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begins, hashes = bare_words(W.whole(batch.column("text")))
            lists = pa.ListArray.from_arrays(
                pa.array(begins, pa.int32()), pa.array(hashes.view(np.int64))
            )
            yield pa.record_batch([batch.column("item_id"), lists], names=["item_id", "hashes"])

    narrow = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return narrow.mapInArrow(read, ITEMS).where(F.size("hashes") >= SEED).distinct()


class Items:
    """Words and n-grams of some test items."""

    def __init__(self, ids: list, words: list[np.ndarray]):
        self.ids, self.words = ids, words
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in words])]).astype(np.int64)
        flat = np.concatenate([*words, np.zeros(0, np.uint64)])
        starts = W.inside(bounds, SEED)
        grams = W.windows(flat, SEED)[starts]
        order = np.argsort(grams, kind="stable")
        self.grams, starts = grams[order], starts[order]
        self.item = np.searchsorted(bounds, starts, side="right") - 1
        self.at = starts - bounds[self.item]

    @staticmethod
    def of(plain: dict) -> Items:
        """From what `vars` gives: broadcasts hold plain values, as workers need not know this class."""
        items = Items.__new__(Items)
        vars(items).update(plain)
        return items

    def distinct(self) -> np.ndarray:
        return self.grams[np.diff(self.grams, prepend=self.grams[:1] + np.uint64(1)) != 0]

    def rare(self, documents: dict[int, int], rows: int) -> Items:
        """Only the n-grams that serve as seeds."""
        n = np.array([documents.get(x, 0) for x in self.grams.view(np.int64).tolist()], np.int64)
        order = np.lexsort((n, self.item))
        starts = np.searchsorted(self.item[order], np.arange(len(self.words)))
        sizes = np.bincount(self.item, minlength=len(self.words))
        median = n[order[np.minimum(starts + sizes // 2, max(0, len(n) - 1))]] if len(n) else n
        keep = n <= np.maximum(max(RARE * rows, RARE_DOCS), USUAL * median[self.item])
        self.grams, self.item, self.at = self.grams[keep], self.item[keep], self.at[keep]
        return self


def _parts(words: DataFrame) -> Iterator[Items]:
    """The items in parts of at most AT_ONCE words (or one item), as rows arrive."""
    ids, lists, total = [], [], 0
    for row in words.toLocalIterator():
        if ids and total + len(row["hashes"]) > AT_ONCE:
            yield Items(ids, lists)
            ids, lists, total = [], [], 0
        ids.append(row["item_id"])
        lists.append(np.array(row["hashes"], np.int64).view(np.uint64))
        total += len(row["hashes"])
    if ids:
        yield Items(ids, lists)


def _hits(texts: pa.Array, grams: np.ndarray):
    """Bounds and word hashes of the texts, and (start, place in grams) of windows that are there."""
    begins, hashes = bare_words(texts)
    starts = W.inside(begins, SEED)
    found = W.windows(hashes, SEED)[starts]
    # most windows are no seed: a small table of hash prefixes settles that
    filled = np.zeros(2**20, bool)
    filled[(grams >> np.uint64(44)).astype(np.int64)] = True
    maybe = filled[(found >> np.uint64(44)).astype(np.int64)]
    starts, found = starts[maybe], found[maybe]
    place = np.searchsorted(grams, found)
    hit = (place < len(grams)) & (grams[np.minimum(place, len(grams) - 1)] == found)
    return begins, hashes, starts[hit], place[hit]


def document_frequency(docs: DataFrame, items: Items) -> dict[int, int]:
    """Documents that have each n-gram of the items."""
    shared = docs.sparkSession.sparkContext.broadcast(items.distinct())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = shared.value
        total = np.zeros(len(grams), np.int64)
        for batch in batches:
            for piece in W.pieces(batch):
                begins, _, starts, place = _hits(W.whole(piece.column("text")), grams)
                doc = np.searchsorted(begins, starts, side="right") - 1
                pairs = np.unique(doc * len(grams) + place)
                total += np.bincount(pairs % len(grams), minlength=len(grams))
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(grams[at].view(np.int64)), pa.array(total[at])], names=["gram", "n"])

    counted = docs.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n"))
    return {gram: n for gram, n in counted.collect()}  # at most AT_ONCE rows


def find(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of FOUND: copies of test items in documents, with their span in words."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = docs.count()
    results = [
        _search(narrow, part.rare(document_frequency(narrow, part), rows))
        for part in _parts(item_words(items))
    ]
    if not results:
        return docs.sparkSession.createDataFrame([], FOUND)
    best = F.max_by(F.struct("begin", "end"), F.struct("score", -F.col("begin")))
    return (
        reduce(DataFrame.union, results)
        .groupBy("doc_id", "item_id")
        .agg(F.max("score").alias("score"), best.alias("span"))
        .select("doc_id", "item_id", "score", "span.begin", "span.end")
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs` without a copy of a test item, with all their columns.

    The decision falls where the row is read, so no text is shuffled; with several parts of
    items the rows pass one search after another.
    """
    rows = docs.count()
    left = docs
    for part in _parts(item_words(items)):
        seeds = part.rare(document_frequency(docs, part), rows)
        left = _without(left, seeds)
    return left


def _without(docs: DataFrame, items: Items) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(vars(items))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items.of(shared.value)
        for piece in (x for batch in batches for x in W.pieces(batch)):
            begins, hashes, starts, place = _hits(W.whole(piece.column("text")), items.grams)
            doc, item, low, high = _passages(begins, starts, place, items)
            good = np.ones(piece.num_rows, bool)
            for k, *_ in _aligned(hashes, items.words, item, low, high):
                good[doc[k]] = False
            yield piece.filter(pa.array(good))
        W.tidy(None)

    return docs.mapInArrow(keep, docs.schema)


def _search(docs: DataFrame, items: Items) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(vars(items))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items.of(shared.value)
        for batch in batches:
            for piece in W.pieces(batch):
                begins, hashes, starts, place = _hits(W.whole(piece.column("text")), items.grams)
                doc, item, low, high = _passages(begins, starts, place, items)
                for k, score, begin, end in _aligned(hashes, items.words, item, low, high):
                    yield pa.record_batch(
                        [
                            piece.column("doc_id").take(pa.array(doc[k])),
                            pa.array([items.ids[x] for x in item[k]], pa.int64()),
                            pa.array(score),
                            pa.array(begin - begins[doc[k]]),
                            pa.array(end - begins[doc[k]]),
                        ],
                        names=["doc_id", "item_id", "score", "begin", "end"],
                    )

    return docs.mapInArrow(search, FOUND)


def _passages(begins, starts, place, items: Items):
    """Document, item and bounds in words of each run of seeds of one item."""
    # a seed may belong to several items: one row for each
    last = np.searchsorted(items.grams, items.grams[place], side="right")
    first = np.searchsorted(items.grams, items.grams[place], side="left")
    n = last - first
    own = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    start = np.repeat(starts, n)
    doc = np.searchsorted(begins, start, side="right") - 1
    item, at = items.item[own], items.at[own]
    length = np.array([len(x) for x in items.words], np.int64)[item]
    order = np.lexsort((start, item, doc))
    doc, item, start, at, length = (x[order] for x in (doc, item, start, at, length))
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (np.diff(start) > length[1:])
    runs = np.flatnonzero(new)
    if not len(runs):
        return doc, item, start, start
    slack = (SLACK * length).astype(np.int64)
    low = np.minimum.reduceat(start - at - slack, runs)
    high = np.maximum.reduceat(start - at + length + slack, runs)
    doc, item = doc[runs], item[runs]
    return doc, item, np.maximum(low, begins[doc]), np.minimum(high, begins[doc + 1])


def _aligned(hashes, words, item, low, high):
    """Passages that score enough: their numbers, scores and bounds, group by group."""
    order = np.lexsort((high - low, np.array([len(words[x]) for x in item], np.int64)))
    at = 0
    while at < len(order):
        n = max(1, CELLS_AT_ONCE // max(1, int((high - low)[order[at:at + 4096]].max())))
        k = order[at : at + min(n, 4096)]
        at += len(k)
        left = _padded([hashes[a:b] for a, b in zip(low[k], high[k])])
        right = _padded([words[x] for x in item[k]])
        points, end = smith_waterman(left, right)
        size = np.array([len(words[x]) for x in item[k]])
        score = points / (MATCH * size)
        good = np.flatnonzero(score >= SCORE)
        if not len(good):
            continue
        k, score, end = k[good], score[good], end[good]
        # the same alignment backwards, from its end, tells where it begins
        left = _padded([hashes[a : a + e][::-1] for a, e in zip(low[k], end)])
        _, back = smith_waterman(left, _padded([words[x][::-1] for x in item[k]]))
        yield k, score, low[k] + end - back, low[k] + end


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(x) for x in rows])
    out = np.zeros((len(rows), max(1, size.max())), np.uint64)
    for k, row in enumerate(rows):
        out[k, : len(row)] = row
    return out, size


def smith_waterman(left, right) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment of each pair of rows: points, and words of `left` up to its end.

    All pairs advance together by a word of `right`. A gap in `left` costs the same for every
    word, so the best way to end at a word by such a gap is a running maximum.
    """
    (a, n), (b, m) = left, right
    slope = -GAP * np.arange(a.shape[1], dtype=np.int32)
    real = np.arange(a.shape[1]) < n[:, None]
    h = np.zeros(a.shape, np.int32)
    best, end = np.zeros(len(a), np.int32), np.zeros(len(a), np.int64)
    for i in range(b.shape[1]):
        points = np.where((a == b[:, i : i + 1]) & real, MATCH, MISMATCH).astype(np.int32)
        now = np.maximum(h + GAP, 0)
        now[:, 1:] = np.maximum(now[:, 1:], h[:, :-1] + points[:, 1:])
        now[:, 0] = np.maximum(now[:, 0], points[:, 0])
        h = np.maximum.accumulate(now + slope, axis=1) - slope
        top = h.argmax(axis=1)
        value = h[np.arange(len(a)), top]
        better = (value > best) & (i < m)
        best, end = np.where(better, value, best), np.where(better, top + 1, end)
    return best, end

"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A feature is present in a document or not: a word, a pair of neighbours, or a pair with one or
two words between, lower-cased and without punctuation around it, hashed to 2**BITS places.
Training passes once over at most TRAINING_ROWS labelled documents, chosen and ordered by a
hash of doc_id, with a rate per coordinate; the L1 term leaves most weights at zero, so the
weights that scoring broadcasts are bounded by the hash space and are small in practice.

Defined results: null and empty texts have no features and score as the bias; a doc_id with
several labels is toxic if one of them says so; null labels and null ids teach nothing; without
labels every score is 0.5. Repeated rows score alike. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm import words as W

BITS = 20
TRAINING_ROWS = 20_000
#: FTRL-proximal: rate, smoothing, L1, L2.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 3.0, 1.0
THRESHOLD = 0.3
EDGE = r"^[^\pL\pN]+|[^\pL\pN]+$"
_STEPS = {0: 1, 1: 0x9E3779B97F4A7C15, 2: 0xC2B2AE3D27D4EB4F, 3: 0x165667B19E3779F9}
SCORED = "doc_id long, score double"


def held_out(doc_id: Column) -> Column:
    """Rows that never teach."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def bare_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and hashes of lower-case words without outer punctuation; the rest drops out."""
    begins, flat = W.split(pc.utf8_lower(texts))
    if not len(flat):
        return begins, np.zeros(0, np.uint64)
    coded = flat.dictionary_encode()
    clean = pc.replace_substring_regex(coded.dictionary, EDGE, "")
    some = pc.greater(pc.binary_length(clean), 0).to_numpy(zero_copy_only=False)
    at = coded.indices.to_numpy()
    keep = some[at]
    total = np.concatenate([[0], np.cumsum(keep)])
    return total[begins], W.hashed(clean)[at[keep]]


def features(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document, place) of every feature present, each once, in order; `wanted` masks places."""
    begins, hashes = bare_words(texts)
    doc = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    docs, places = [], []
    for gap, step in _STEPS.items():
        size = max(0, len(hashes) - gap)
        if gap:
            mixed = W.mixed(hashes[:size] * np.uint64(step) + hashes[gap:])
            same = doc[:size] == doc[gap:]
        else:
            mixed, same = W.mixed(hashes), None
        place = (mixed >> np.uint64(64 - BITS)).astype(np.int64)
        owner = doc[:size]
        use = same if wanted is None else wanted[place] if same is None else same & wanted[place]
        docs.append(owner if use is None else owner[use])
        places.append(place if use is None else place[use])
    key = np.sort((np.concatenate(docs) << BITS) | np.concatenate(places))
    key = key[np.diff(key, prepend=-1) != 0]
    return key >> BITS, key & (2**BITS - 1)


class Ftrl:
    """FTRL-proximal state; the last place is the bias, which L1 leaves alone."""

    def __init__(self):
        self.z, self.n = np.zeros(2**BITS + 1), np.zeros(2**BITS + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.full(len(z), L1)
        if isinstance(at, slice) or len(at):
            l1[-1] = 0.0
        w = -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, places: np.ndarray, label: int) -> None:
        at = np.append(places, 2**BITS)
        w = self.weights(at)
        gradient = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        square = gradient * gradient
        sigma = (np.sqrt(self.n[at] + square) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += gradient - sigma * w
        self.n[at] += square


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """Places and weights that are not zero, and the bias."""
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("label"))
        .withColumn("turn", F.xxhash64("doc_id"))
        .orderBy("turn", "doc_id")
        .limit(rows)
    )
    # at most `rows` narrow rows, so the side is safe to broadcast
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(known), "doc_id"
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, place = features(W.whole(batch.column("text")))
            cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(place.astype(np.int32)))
            yield pa.record_batch(
                [batch.column("turn"), batch.column("label"), lists], names=["turn", "label", "places"]
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Ftrl()
        for batch in batches:
            cuts = batch.column("places").offsets.to_numpy()
            flat = batch.column("places").values.to_numpy()
            for a, b, label in zip(cuts, cuts[1:], batch.column("label").to_pylist()):
                model.learn(flat[a:b].astype(np.int64), label)
        weights = model.weights()
        at = np.flatnonzero(weights)
        yield pa.record_batch(
            [pa.array([at.astype("<i4").tobytes()]), pa.array([weights[at].astype("<f8").tobytes()])],
            names=["places", "weights"],
        )

    row = (
        chosen.select("turn", "label", "text")
        .mapInArrow(extract, "turn long, label int, places array<int>")
        .repartition(1)  # the order of learning matters, and the rows are bounded
        .sortWithinPartitions("turn", "label", F.size("places"))
        .mapInArrow(learn, "places binary, weights binary")
        .first()
    )
    if row is None:
        return np.zeros(0, np.int64), np.zeros(0), 0.0
    at, weights = np.frombuffer(row[0], "<i4").astype(np.int64), np.frombuffer(row[1], "<f8")
    bias = weights[at == 2**BITS].sum()
    return at[at < 2**BITS], weights[at < 2**BITS], float(bias)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float]) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values, bias = shared.value
        weights = np.zeros(2**BITS)
        weights[at] = values
        for piece in (x for batch in batches for x in W.pieces(batch)):
            doc, place = features(W.whole(piece.column("text")), weights != 0)
            total = bias + np.bincount(doc, weights[place], piece.num_rows)
            chance = 1.0 / (1.0 + np.exp(-np.clip(total, -500, 500)))
            yield pa.record_batch([piece.column("doc_id"), pa.array(chance)], names=["doc_id", "score"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(rate, SCORED)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    rated = score(docs, train(docs, labels))
    return rated.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

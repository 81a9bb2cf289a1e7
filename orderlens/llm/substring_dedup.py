"""Substring dedup: factors of each document that an earlier document already has.

Relative Lempel-Ziv parsing against all earlier documents, distributed: blocks of
neighbouring ids are the reference blocks, and every block is factored against every earlier
one through `blocks.exchange`, whose nodes hold the windows of neighbouring blocks in order of
their hash. Windows that follow each other and are all known chain up to a factor, so a
factor is as long as any greedy match could be, across the bounds of the documents it copies;
windows over the seam of two factors are looked up too, as a seam may hide a match.

Two windows are equal when their 64-bit hashes are; among n distinct windows of a corpus one
pair meets by chance with probability n**2 / 2**65.

Defined results: null text has no words; fewer words than a window lose none; of rows with
the same doc_id none counts as earlier, so repeated rows do not remove each other; a null
doc_id comes after all others. Other columns are ignored. Empty in, empty out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from orderlens.llm import blocks
from orderlens.llm import words as W

WINDOW = 13
FIELDS = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start: long, stop: long>>"


def _unknown(hashes, extra, known) -> np.ndarray:
    """A shard holds all blocks, so none is earlier than what it holds."""
    return np.zeros(len(hashes), np.uint8)


def _earlier(codes, first) -> np.ndarray:
    """1 where an earlier block of the same node, or one earlier than all of them, has the hash."""
    return codes | ~first


def dedup(
    docs: DataFrame,
    window: int = WINDOW,
    block_bytes: int = blocks.BLOCK_BYTES,
    with_text: bool = False,
) -> DataFrame:
    """Per document: words, removed words, digest of what stays, removed spans in words.

    `with_text` adds the kept words, joined by one space, as `kept_text`.
    """
    bounds = blocks.bounds_of(docs, block_bytes)

    def ask(table: pa.Table) -> tuple[np.ndarray, None]:
        begins, flat = W.split(W.whole(table["text"]))
        hashes = np.sort(W.windows(W.hashed(flat), window)[W.inside(begins, window)])
        return hashes[np.diff(hashes, prepend=hashes[:1] + np.uint64(1)) != 0], None

    def finish(block: int, table: pa.Table, said: np.ndarray) -> pa.Table:
        begins, flat = W.split(W.whole(table["text"]))
        starts = W.inside(begins, window)
        hashes = W.windows(W.hashed(flat), window)[starts]
        # documents are in order of id, so of equal hashes the first has the smallest
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        first = np.diff(ordered, prepend=ordered[:1] + np.uint64(1)) != 0
        group = np.cumsum(first) - 1
        ids = W.ids(table["doc_id"])
        owner = ids[np.searchsorted(begins, starts, side="right") - 1][order]
        known = said.astype(bool)[group] if len(order) else first
        known = known | (owner > owner[np.flatnonzero(first)][group]) if len(order) else first
        gone = _covered(starts[order[known]], window, len(flat))
        return _told(table, begins, flat, gone, with_text)

    schema = FIELDS + (", kept_text string" if with_text else "")
    return blocks.exchange(
        blocks.packed(docs, bounds), len(bounds) + 1, ask, np.uint8, _unknown, finish, schema, _earlier
    )


def _covered(starts: np.ndarray, window: int, size: int) -> np.ndarray:
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return np.cumsum(edge[:-1]) > 0


def _told(table: pa.Table, begins, flat, gone, with_text: bool) -> pa.Table:
    counts = np.diff(begins)
    lost = np.concatenate([[0], np.cumsum(gone)])
    removed = lost[begins[1:]] - lost[begins[:-1]]
    kept = flat.filter(pa.array(~gone))
    cuts = np.concatenate([[0], np.cumsum(counts - removed)])
    texts = pc.binary_join(
        pa.LargeListArray.from_arrays(pa.array(cuts, pa.int64()), kept.cast(pa.large_string())),
        pa.scalar(" ", pa.large_string()),
    )
    digests = [hashlib.sha256(x).hexdigest() for x in texts.cast(pa.large_binary()).to_pylist()]
    # a span begins where a word is gone and the one before is not, or is another document's
    opens, closes = gone.copy(), gone.copy()
    opens[1:] &= ~gone[:-1]
    closes[:-1] &= ~gone[1:]
    first = begins[:-1][counts > 0]
    opens[first] = gone[first]
    last = begins[1:][counts > 0] - 1
    closes[last] = gone[last]
    start, stop = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    doc = np.searchsorted(begins, start, side="right") - 1
    spans = pa.StructArray.from_arrays(
        [pa.array(start - begins[doc]), pa.array(stop - begins[doc])], names=["start", "stop"]
    )
    per = np.searchsorted(doc, np.arange(len(counts) + 1))
    columns = {
        "doc_id": table["doc_id"].cast(pa.int64()).combine_chunks(),
        "n_words": pa.array(counts),
        "n_removed": pa.array(removed),
        "kept_sha256": pa.array(digests, pa.string()),
        "spans": pa.ListArray.from_arrays(pa.array(per, pa.int32()), spans),
    }
    if with_text:
        columns["kept_text"] = texts.cast(pa.string())
    return pa.table(columns)

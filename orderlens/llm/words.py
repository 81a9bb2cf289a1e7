"""Words and word windows of whole Arrow batches, as numpy arrays of 64-bit hashes."""

from __future__ import annotations

import ctypes
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WHITE_SPACE = "\t\n\x0b\x0c\r "
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
LAST_ID = 2**63 - 1


def whole(column) -> pa.Array:
    """A text column as one array; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    return pc.fill_null(column.cast(pa.large_string()), "")


def split(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Bounds of each text in the flat list of words, and that list."""
    trimmed = pc.ascii_trim(texts, characters=WHITE_SPACE)
    lists = pc.ascii_split_whitespace(trimmed)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    words = lists.flatten()
    blank = pc.binary_length(trimmed).to_numpy(zero_copy_only=False) == 0
    if blank.any():
        counts[blank] = 0
        words = words.filter(pc.greater(pc.binary_length(words), 0))
    return np.concatenate([[0], np.cumsum(counts)]), words


def hashed(words: pa.Array) -> np.ndarray:
    """A hash per word; each distinct word is hashed once."""
    if not len(words):
        return np.zeros(0, np.uint64)
    coded = words.dictionary_encode()
    distinct = coded.dictionary.cast(pa.large_binary()).to_pylist()
    values = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
    return values[coded.indices.to_numpy()]


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values = values * _MIX
    return values ^ (values >> np.uint64(29))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words, also across texts; see `inside`."""
    size = max(0, len(hashes) - n + 1)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out = out * _STEP + hashes[k : k + size]
    return mixed(out)


def inside(bounds: np.ndarray, n: int) -> np.ndarray:
    """Starts of the windows that lie in one text."""
    total = int(bounds[-1])
    ok = np.ones(max(0, total - n + 1), bool)
    for back in range(1, n):
        cut = bounds[1:-1] - back
        ok[cut[(cut >= 0) & (cut < len(ok))]] = False
    return np.flatnonzero(ok)


def ids(column) -> np.ndarray:
    """Ids as numbers; null sorts after all others."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.int64()), LAST_ID).to_numpy(zero_copy_only=False)


def tidy(result):
    """`result`, after memory that earlier steps of this worker freed went back to the system.

    Workers live long and their allocators keep what the largest block once took.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
    return result


#: Where encoders that live as long as their worker are kept, by library.
_KEPT = (("tokenizers", "_word_encoders"), ("tokenizers", "_aligners"), ("sentencepiece", "_piece_encoders"))


def forget_encoders():
    """Drops what encoders of an earlier step remember in this worker, for steps that need the room.

    A later step that encodes makes its encoder anew.
    """
    for library, name in _KEPT:
        kept = getattr(sys.modules.get(library), name, None)
        if kept:
            kept.clear()
            tidy(None)


def pieces(batch: pa.RecordBatch, most: int = 8_000_000):
    """The batch in slices of at most `most` bytes of text (or one row)."""
    size = np.cumsum(pc.binary_length(whole(batch.column("text"))).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = size[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(size, before + most, side="right")))
        yield batch.slice(at, upto - at)
        at = upto

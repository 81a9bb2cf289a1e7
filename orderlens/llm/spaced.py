"""Texts cut where no token of a byte-level or piece vocabulary can reach across.

A space between two characters that are neither white space nor U+2581 starts a new token in
both kinds: byte-level patterns attach it to what follows, and no piece holds the mark of a
space after another character (`pieces.py` and `alignment.py` check that of a vocabulary). So
the ids of a text are those of its parts in turn, and equal parts need be encoded once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa

MARK = "▁"
_CUT = re.compile(rf"(?<=[^\s{MARK}]) (?=[^\s{MARK}])")
#: The characters that `_CUT` does not cut beside, in UTF-8, as numbers, by their length.
_BLANK = [c.encode() for c in [*filter(str.isspace, map(chr, range(0x3001))), MARK]]
_BLANKS = {n: np.array([int.from_bytes(c) for c in _BLANK if len(c) == n], np.uint32) for n in (1, 2, 3)}
_ONE_BYTE = np.isin(np.arange(256), _BLANKS[1])
_FIRST = {n: np.isin(np.arange(256), _BLANKS[n] >> np.uint32(8 * n - 8)) for n in (2, 3)}
#: Parts remembered by a worker, and their characters, beyond which it starts anew. This bounds
#: memory, not results.
REMEMBERED = 600_000
REMEMBERED_CHARS = 16_000_000


def _blank(data: np.ndarray) -> np.ndarray:
    """Which bytes are those of white space or of a mark."""
    found = _ONE_BYTE[data]
    for n in (2, 3):
        at = np.flatnonzero(_FIRST[n][data[: 1 - n]])
        value = np.zeros(len(at), np.uint32)
        for k in range(n):
            value = value << np.uint32(8) | data[at + k]
        at = at[np.isin(value, _BLANKS[n])]
        for k in range(n):
            found[at + k] = True
    return found


def cut(texts: list[str]) -> tuple[np.ndarray, pa.Array]:
    """Bounds of each text in the flat list of its parts, and that list, each part led by a space.

    The same cuts as those of `_CUT`, found in the bytes of all texts at once.
    """
    led = [f" {text}".encode() if text else b"" for text in texts]
    ends = np.cumsum(np.fromiter(map(len, led), np.int64, len(led)))
    begins = np.concatenate([[0], ends])
    data = np.frombuffer(b"".join([b" ", *led, b"  "]), np.uint8)  # so that all have neighbours
    blank = _blank(data)
    starts_here = (data[1:-2] == 0x20) & ~blank[:-3] & ~blank[2:-1]
    starts_here[begins[:-1][np.diff(begins) > 0]] = True
    starts = np.flatnonzero(starts_here)
    offsets = np.append(starts, begins[-1]) + 1
    parts = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))
    return np.searchsorted(starts, begins), parts


class Parts:
    """Distinct parts of the texts seen by a worker, numbered in the order they were met.

    `learn` is called with each list of new parts, `forget` before the numbers start anew.
    """

    def __init__(self, learn: Callable[[list[str]], None], forget: Callable[[], None], most: int | None = None):
        self.learn, self.forget, self.most = learn, forget, most or REMEMBERED
        self.known: dict[str, int] = {}
        self.chars = 0

    def make_room(self):
        """Starts anew if too much is remembered; numbers given out before are void then."""
        if len(self.known) > self.most or self.chars > REMEMBERED_CHARS:
            self.known, self.chars = {}, 0
            self.forget()

    def number(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of each text in the flat list of its parts, and that list as numbers.

        The space before a part is not in it. A text without characters has no parts.
        """
        known, new = self.known, []
        numbers: list[int] = []
        bounds = [0]
        for text in texts:
            if text:
                parts = _CUT.split(text)
                found = list(map(known.get, parts))
                if None in found:
                    for k, part in enumerate(parts):
                        if found[k] is None:
                            at = known.get(part)  # it may be there since an earlier place
                            if at is None:
                                at = known[part] = len(known)
                                new.append(part)
                            found[k] = at
                numbers += found
            bounds.append(len(numbers))
        if new:
            self.chars += sum(map(len, new))
            self.learn(new)
        return np.array(bounds, np.int64), np.array(numbers, np.int64)


    def number_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As `number`, but each distinct part of the texts is looked up once."""
        bounds, parts = cut(texts)
        coded = parts.dictionary_encode()
        known = self.known
        distinct = [x[1:] for x in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]
        found = list(map(known.get, distinct))
        places = [k for k, at in enumerate(found) if at is None]
        if places:
            new = [distinct[k] for k in places]
            for k, at, part in zip(places, range(len(known), len(known) + len(new)), new):
                found[k] = known[part] = at
            self.chars += sum(map(len, new))
            self.learn(new)
        return bounds, np.array(found, np.int64)[coded.indices.to_numpy()]


class Ragged:
    """Lists of numbers, added in batches and read by the numbers of the lists."""

    def __init__(self, dtype):
        self.dtype = dtype
        self.clear()

    def clear(self):
        self.count = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)
        self.flat = np.zeros(0, self.dtype)

    def add(self, counts: list[int], values):
        counts = np.array(counts, np.int64)
        ends = np.cumsum(counts) + len(self.flat)
        self.count = np.concatenate([self.count, counts])
        self.start = np.concatenate([self.start, ends - counts])
        self.flat = np.concatenate([self.flat, np.asarray(values, self.dtype)])

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the lists `at` in their concatenation, and that."""
        count = self.count[at]
        bounds = np.concatenate([[0], np.cumsum(count)])
        return bounds, self.flat[np.repeat(self.start[at] - bounds[:-1], count) + np.arange(bounds[-1])]

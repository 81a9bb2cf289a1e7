"""The contracts of the corpus operators, word for word, without Spark."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def substring(rows: list[tuple[int, str | None]], n: int = 13) -> dict[int, tuple]:
    first: dict[tuple, int] = {}
    split = {d: words(t) for d, t in rows}
    for d in split:
        for k in range(len(split[d]) - n + 1):
            key = tuple(split[d][k : k + n])
            first[key] = min(first.get(key, d), d)
    out = {}
    for d, w in split.items():
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if first[tuple(w[k : k + n])] < d:
                gone[k : k + n] = [True] * n
        kept = [x for x, g in zip(w, gone) if not g]
        out[d] = (len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def shingles(text: str | None, n: int = 5) -> set[tuple]:
    w = words(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}


def components(rows: list[tuple[int, str | None]]) -> dict[int, tuple]:
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    common: dict[tuple, int] = defaultdict(int)
    for ds in where.values():
        for a in ds:
            for b in ds:
                if a < b:
                    common[a, b] += 1
    for (a, b), i in common.items():
        if 100 * i >= 75 * (len(sets[a]) + len(sets[b]) - i):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def token_digests(rows: list[tuple[int, str | None]], path: str) -> dict[int, tuple]:
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    start, out = 0, {}
    for d, text in sorted(rows):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        out[d] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out

"""Token ids of whole texts, with each distinct word encoded once per Python worker.

The tokenizers used here never join text across white space, so a text's ids are those of its
words in turn. Words are marked off by a special token, which the library cuts out before it
normalises; a word that holds such a mark itself is encoded alone.

Tokenizers that lower-case, and that part letters and digits from other signs, have the same ids
for `Word,` as for `word` and `,`. With them words are folded and cut so, which leaves about two
thirds as many to encode and to remember.
"""

from __future__ import annotations

import hashlib
import json
import os
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from orderlens.llm import words as W

#: Words remembered by a worker, beyond which it starts anew. It bounds memory, not results.
REMEMBERED = 800_000
_AT_ONCE = 1_000
#: What a tokenizer file says if it lower-cases and parts letters and digits from other signs.
_NORMALIZER = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_SPLIT = {
    "type": "Split",
    "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
    "behavior": "Removed",
    "invert": True,
}
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_ALNUM = np.isin(np.arange(256), [ord(c) for c in "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"])


def version(path: str) -> str:
    """Name of a tokenizer file and the start of its digest."""
    data = Path(path).read_bytes()
    return f"{Path(path).stem}-{hashlib.sha256(data).hexdigest()[:12]}"


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file, with all it remembers."""
    import tokenizers

    # this module comes with each task, the library's stays for the life of the worker
    opened = tokenizers.__dict__.setdefault("_word_encoders", {})
    if path not in opened:
        opened[path] = WordEncoder(path)
    return opened[path]


def _parts_signs(spec: dict) -> bool:
    normalizer, first = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    known = normalizer.get("normalizers") == _NORMALIZER and first.get("pretokenizers", [None])[0] == _SPLIT
    known = known and spec["model"].get("end_of_word_suffix") and not spec["model"].get("dropout")
    return bool(known) and not any(t["normalized"] for t in spec.get("added_tokens", []))


def _folded(words: pa.Array) -> pa.Array:
    """ASCII words in lower case; in others a capital may compose differently with what follows."""
    return pc.if_else(pc.string_is_ascii(words), pc.ascii_lower(words), words)


def _cut_signs(begins: np.ndarray, words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words cut before the signs that end them, if a letter or digit of ASCII comes before these."""
    bounds = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)
    size = pc.binary_length(pc.ascii_rtrim(words, characters=_SIGNS)).to_numpy(zero_copy_only=False)
    ends = bounds[:-1] + size
    cut = (size > 0) & (ends < bounds[1:])
    cut[cut] = _ALNUM[data[ends[cut] - 1]]
    at = np.flatnonzero(cut)
    parts = np.insert(bounds, at + 1, ends[at])
    before = np.concatenate([[0], np.cumsum(cut)])
    made = pa.LargeStringArray.from_buffers(len(parts) - 1, pa.py_buffer(parts), words.buffers()[2])
    return begins + before[begins], made


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        special = {t.content: i for i, t in added.items()}
        self.mark, self.mark_id = next(iter(special.items()))
        self.special = [x.lower() for x in special]
        spec = json.loads(self.tokenizer.to_str())
        self.parts_signs = _parts_signs(spec)
        if self.parts_signs:
            self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
            suffix = spec["model"]["end_of_word_suffix"]
            self.ends_word[[i for t, i in spec["model"]["vocab"].items() if t.endswith(suffix)]] = True
        self._forget()

    def _forget(self):
        self.known: dict[str, int] = {}
        self.count = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, new: list[str]):
        odd = [w for w in new if self.mark in w]
        plain = [w for w in new if self.mark not in w] if odd else new
        # a word of letters ends with the one token that says so; white space then is mark enough
        letters = [w for w in plain if w.isalpha() and w.isascii()] if self.parts_signs else []
        marked = [w for w in plain if not (w.isalpha() and w.isascii())] if letters else plain
        lists, counts = [], []
        for words, between in ((letters, " "), (marked, self.mark)):
            groups = [words[k : k + _AT_ONCE] for k in range(0, len(words), _AT_ONCE)]
            texts = [between.join(g) for g in groups]
            for found, group in zip(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), groups):
                ids = np.array(found.ids, np.uint32)
                if between == " ":
                    cuts = np.concatenate([[0], np.flatnonzero(self.ends_word[ids]) + 1])
                else:
                    marks = np.flatnonzero(ids == self.mark_id)
                    ids = ids[ids != self.mark_id]
                    cuts = np.concatenate([[0], marks - np.arange(len(marks)), [len(ids)]])
                assert len(cuts) == len(group) + 1 and cuts[-1] == len(ids)
                lists.append(ids)
                counts.append(np.diff(cuts))
        alone = [
            np.array(x.ids, np.uint32)
            for x in self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)
        ] if odd else []
        counts.append(np.array([len(x) for x in alone], np.int64))
        count = np.concatenate(counts).astype(np.int64)
        base = len(self.known)
        self.known.update(zip(letters + marked + odd, range(base, base + len(new))))
        ends = np.cumsum(count) + len(self.flat)
        self.start = np.concatenate([self.start, ends - count])
        self.count = np.concatenate([self.count, count])
        self.flat = np.concatenate([self.flat, *lists, *alone])

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the texts in words, and for each word its place in what is remembered."""
        begins, flat = W.split(texts)
        if not len(flat):
            return begins, np.zeros(0, np.int64)
        if self.parts_signs:
            folded = _folded(flat)
            # a word that holds a special token, or would in lower case, has its batch left as it is
            if not any(pc.any(pc.match_substring(flat, x, ignore_case=True)).as_py() for x in self.special):
                begins, flat = _cut_signs(begins, folded)
        coded = flat.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) + len(distinct) > REMEMBERED:
            self._forget()
        new = [w for w in distinct if w not in self.known]
        if new:
            self._learn(new)
        at = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        return begins, at[coded.indices.to_numpy()]

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        begins, at = self._words(texts)
        total = np.concatenate([[0], np.cumsum(self.count[at])])
        return total[begins[1:]] - total[begins[:-1]]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of each text's ids, and all ids."""
        begins, at = self._words(texts)
        count = self.count[at]
        total = np.concatenate([[0], np.cumsum(count)])
        # places in 32 bits, added up in place: they are the largest arrays a worker makes
        kind = np.int32 if max(total[-1], len(self.flat)) < 2**31 else np.int64
        place = np.repeat((self.start[at] - total[:-1]).astype(kind), count)
        del at, count
        place += np.arange(total[-1], dtype=kind)
        return total[begins], self.flat[place]

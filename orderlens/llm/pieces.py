"""SentencePiece ids by merging adjacent symbols in the order of their scores, and texts from ids.

For vocabularies of the merge type with byte fallback, whose normaliser only puts a mark before
the text and in the place of spaces. A text starts as one symbol per character. The agenda holds
every pair of neighbours that together are a piece; the pair of the highest score is merged, the
leftmost of equal ones, and the pairs with its new neighbours join the agenda. A pair is stale
once one of its symbols has changed. What is left are pieces; a character that is none becomes
its bytes. Parts of a text that no piece reaches across are encoded once per worker.

`encoded` can check each Arrow batch against the sentencepiece library: ids and decoded text.

Cases: null and empty texts have no ids, no tokens, and decode to the empty text. Repeated rows
and ids give one row each; null ids stay null. A long text needs memory in proportion to it. An
empty table gives no rows. Columns other than `doc_id` and `text` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm import spaced
from orderlens.llm import words as W
from orderlens.llm.spaced import MARK

SCHEMA = (
    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean, agrees boolean"
)
_PIECE_BYTES = 2_000_000
#: Parts of up to so many characters are merged many at once; both ways merge alike.
_WIDTHS = (12, 20, 40)
_NEVER = 1 << 30
_AT_ONCE = 4_000


def marked(part: str) -> str:
    """A text, or a part of one without the space before it, as the merges see it."""
    return MARK + part.replace(" ", MARK)


class PieceVocabulary:
    """Pieces with scores and ids; encodes and decodes single texts."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lib.get_piece_size()
        names = [lib.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))]
        self.byte_id = {int(names[i][3:5], 16): i for i in range(size) if lib.is_byte(i)}
        self.id = {names[i]: i for i in plain}
        # heap entries are (rank, left symbol, ...): equal scores share a rank
        ranks = {s: k for k, s in enumerate(sorted({lib.get_score(i) for i in plain}, reverse=True))}
        self.rank = {names[i]: ranks[lib.get_score(i)] for i in plain}
        if len(self.byte_id) != 256:
            raise ValueError("the vocabulary has no byte fallback")
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("a piece reaches across a space")
        if any(lib.is_unused(i) for i in plain) or lib.normalize(" a  ﬁ b ") != f"{MARK * 2}a{MARK * 2}ﬁ{MARK}b{MARK}":
            raise ValueError("unused pieces or another normaliser")
        shown = [b"" for _ in names]
        for i in plain:
            shown[i] = names[i].replace(MARK, " ").encode()
        for value, i in self.byte_id.items():
            shown[i] = bytes([value])
        self.shown = shown
        self.is_byte = np.zeros(size, bool)
        self.is_byte[list(self.byte_id.values())] = True

    def merge(self, text: str) -> list[str]:
        """The pieces and left-over characters of a text that is already marked."""
        rank = self.rank
        symbols = list(text)
        end = len(symbols)
        after = list(range(1, end + 1))
        before = list(range(-1, end - 1))
        agenda = []
        for k in range(end - 1):
            both = symbols[k] + symbols[k + 1]
            if both in rank:
                agenda.append((rank[both], k, k + 1, both))
        heapify(agenda)
        while agenda:
            _, left, right, both = heappop(agenda)
            # a swallowed symbol is empty and a grown one longer, so a stale pair differs
            if not symbols[left] or after[left] != right or symbols[left] + symbols[right] != both:
                continue
            symbols[left], symbols[right] = both, ""
            follower = after[left] = after[right]
            if follower < end:
                before[follower] = left
                wider = both + symbols[follower]
                if wider in rank:
                    heappush(agenda, (rank[wider], left, follower, wider))
            prior = before[left]
            if prior >= 0:
                wider = symbols[prior] + both
                if wider in rank:
                    heappush(agenda, (rank[wider], prior, left, wider))
        return [s for s in symbols if s]

    def ids_of(self, symbols: list[str]) -> list[int]:
        ids = []
        for symbol in symbols:
            at = self.id.get(symbol)
            if at is None:
                ids.extend([self.byte_id[b] for b in symbol.encode()])
            else:
                ids.append(at)
        return ids

    def encode(self, text: str | None) -> list[int]:
        return self.ids_of(self.merge(marked(text))) if text else []

    def decode(self, ids) -> str:
        """The text of ids: marks are spaces, the first of which was put there by the encoder.

        Bytes that are no UTF-8 become U+FFFD one by one; control ids show nothing.
        """
        whole = b"".join(self.shown[i] for i in ids)
        if whole.startswith(b" ") and not self.is_byte[ids[0]]:
            whole = whole[1:]
        try:
            return whole.decode()
        except UnicodeDecodeError:
            return whole.decode(errors="piece-bytes")


class Agendas:
    """The same merges for many short parts at once, one merge of each part at a time.

    Symbols are numbers: pieces by id, then characters that are no pieces. A row per part holds
    its symbols by place and, for each place, the rank of the pair that starts there.
    """

    def __init__(self, vocabulary: PieceVocabulary):
        self.vocabulary = vocabulary
        number = dict(vocabulary.id)
        self.ids = [[i] for i in range(vocabulary.library.get_piece_size())]  # the ids of each symbol
        single = {c for piece in number for c in piece} - number.keys()
        for c in sorted(single):
            number[c] = self._add(c)
        keys, ranks, merged = [], [], []
        for piece, rank in vocabulary.rank.items():
            for k in range(1, len(piece)):
                left, right = number.get(piece[:k]), number.get(piece[k:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    ranks.append(rank)
                    merged.append(vocabulary.id[piece])
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.int64(2**62))
        self.ranks = np.append(np.array(ranks, np.int32)[order], _NEVER).astype(np.int32)
        self.merged = np.append(np.array(merged, np.int64)[order], 0)
        self._hash()
        self.of_char = np.full(0x110000, -1, np.int64)
        for c, n in number.items():
            if len(c) == 1:
                self.of_char[ord(c)] = n

    def _add(self, char: str) -> int:
        self.ids.append([self.vocabulary.byte_id[b] for b in char.encode()])
        return len(self.ids) - 1

    def _hash(self):
        """Slots with the places of keys; a key that finds its slot taken goes to the next one."""
        none = len(self.keys) - 1
        self.bits = max(10, int(none).bit_length() + 2)
        self.slots = np.full(2**self.bits, none, np.int32)
        left = np.arange(none)
        slot = self._slot(self.keys[:-1])
        while len(left):
            free = self.slots[slot] == none
            self.slots[slot[free]] = left[free]  # the last of several stays
            more = self.slots[slot] != left
            left, slot = left[more], slot[more] + 1 & (1 << self.bits) - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and place in the table of each pair of symbols; a symbol of -1 is the end."""
        wanted = left << 32 | right
        none = len(self.keys) - 1
        slot = self._slot(wanted)
        at = self.slots[slot]
        other = np.flatnonzero((self.keys[at] != wanted) & (at != none))
        while len(other):
            slot[other] = slot[other] + 1 & (1 << self.bits) - 1
            at[other] = self.slots[slot[other]]
            found = at[other]
            other = other[(self.keys[found] != wanted[other]) & (found != none)]
        return self.ranks[at], at

    def merge(self, marked: list[str]) -> list[list[int]]:
        """The ids of texts that are already marked."""
        out: list = [None] * len(marked)
        sizes = np.fromiter(map(len, marked), np.int64, len(marked))
        least = 0
        for width in _WIDTHS:
            chosen = np.flatnonzero((sizes > least) & (sizes <= width))
            for k in range(0, len(chosen), _AT_ONCE):
                rows = chosen[k : k + _AT_ONCE]
                self._merge(marked, rows, sizes[rows], width, out)
            least = width
        for k in np.flatnonzero(sizes > least):
            out[k] = self.vocabulary.ids_of(self.vocabulary.merge(marked[k]))
        return out

    def _merge(self, marked: list[str], rows: np.ndarray, sizes: np.ndarray, width: int, out: list):
        chars = np.frombuffer("".join([marked[k] for k in rows]).encode("utf-32-le"), np.uint32)
        for c in np.unique(chars[self.of_char[chars] < 0]):
            self.of_char[c] = self._add(chr(c))
        n, place = len(rows), np.arange(width)
        inside = place < sizes[:, None]
        symbol = np.full((n, width + 1), -1, np.int64)
        symbol[:, :width][inside] = self.of_char[chars]
        after = np.minimum(np.tile(np.arange(1, width + 2), (n, 1)), width)  # the last place is the end
        before = np.tile(np.arange(-1, width), (n, 1))
        rank, pair = np.full((n, width), _NEVER, np.int32), np.zeros((n, width), np.int64)
        both = inside[:, 1:]
        rank[:, :-1][both], pair[:, :-1][both] = self._pairs(symbol[:, : width - 1][both], symbol[:, 1:width][both])
        going = np.arange(n)
        while len(going):
            left = rank[going].argmin(axis=1)
            more = rank[going, left] < _NEVER
            going, left = going[more], left[more]
            right = after[going, left]
            follower, prior = after[going, right], before[going, left]
            symbol[going, left] = self.merged[pair[going, left]]
            symbol[going, right] = -1
            rank[going, right.clip(max=width - 1)] = _NEVER
            after[going, left] = follower
            before[going, follower] = left
            ahead = symbol[going, follower]
            rank[going, left], pair[going, left] = self._pairs(symbol[going, left], ahead)
            has = prior >= 0
            r, at = going[has], prior[has]
            rank[r, at], pair[r, at] = self._pairs(symbol[r, at], symbol[r, left[has]])
        left_over = symbol >= 0
        flat = symbol[left_over].tolist()
        ids, start = self.ids, 0
        plain = not flat or max(flat) < self.vocabulary.library.get_piece_size()  # then symbols are ids
        for k, size in zip(rows.tolist(), left_over.sum(axis=1).tolist()):
            found = flat[start : start + size]
            start += size
            out[k] = found if plain else [i for s in found for i in ids[s]]


def _one_by_one(error):
    """Stands in for the first byte of a bad sequence only; the next ones are looked at anew."""
    return "�", error.start + 1


class BatchEncoder:
    """Ids of whole batches, with each distinct part encoded once by this worker."""

    def __init__(self, path: str):
        import codecs

        codecs.register_error("piece-bytes", _one_by_one)
        self.vocabulary = PieceVocabulary(path)
        self.agendas = Agendas(self.vocabulary)
        self.ids = spaced.Ragged(np.int32)
        self.parts = spaced.Parts(self._learn, self.ids.clear)
        self.decimal = pa.array(map(str, range(self.vocabulary.library.get_piece_size())), pa.large_string())

    def _learn(self, new: list[str]):
        lists = self.agendas.merge(list(map(marked, new)))
        self.ids.add(list(map(len, lists)), list(chain.from_iterable(lists)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Bounds of each text's ids, all ids, and each text's ids in decimal."""
        self.parts.make_room()
        bounds, at = self.parts.number_all(texts)
        within, flat = self.ids.take(at)
        bounds = within[bounds]
        shown = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), self.decimal.take(pa.array(flat)))
        return bounds, flat, pc.binary_join(shown, pa.scalar(",", pa.large_string())).to_pylist()


def worker_encoder(path: str) -> BatchEncoder:
    """The worker's encoder for a vocabulary, with all it remembers."""
    import sentencepiece

    # this module comes with each task, the library's stays for the life of the worker
    opened = sentencepiece.__dict__.setdefault("_piece_encoders", {})
    if path not in opened:
        opened[path] = BatchEncoder(path)
    return opened[path]


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(docs: DataFrame, path: str, check: bool = True) -> DataFrame:
    """Per document: tokens, digests of its ids and of the text decoded from them.

    `round_trip` says whether that is the text itself. With `check`, `agrees` says whether the
    library gives the same ids and decodes them to the same text; otherwise it is null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path)
        vocabulary = encoder.vocabulary
        for batch in chain.from_iterable(W.pieces(b, _PIECE_BYTES) for b in batches):
            texts = W.whole(batch.column("text")).to_pylist()
            bounds, flat, written = encoder.encode(texts)
            lists = [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
            decoded = list(map(vocabulary.decode, lists))
            agrees = None
            if check:
                theirs = vocabulary.library.encode(texts, num_threads=1)
                back = vocabulary.library.decode(theirs, num_threads=1) if theirs else []
                agrees = [a == b and c == d for a, b, c, d in zip(lists, theirs, decoded, back)]
            yield pa.record_batch(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array(map(_digest, written), pa.string()),
                    pa.array(map(_digest, decoded), pa.string()),
                    pa.array([a == b for a, b in zip(decoded, texts)], pa.bool_()),
                    pa.array(agrees if check else [None] * len(texts), pa.bool_()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip", "agrees"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def token_ids(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): the ids of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path)
        for batch in chain.from_iterable(W.pieces(b, _PIECE_BYTES) for b in batches):
            bounds, flat, _ = encoder.encode(W.whole(batch.column("text")).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), lists], names=["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def texts_of(ids: DataFrame, path: str) -> DataFrame:
    """(doc_id, text): the text that the ids of each row decode to; null ids give an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = worker_encoder(path).vocabulary
        for batch in batches:
            texts = [vocabulary.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows = ids.select(F.col("doc_id").cast("long").alias("doc_id"), "ids")
    return rows.mapInArrow(run, "doc_id long, text string")

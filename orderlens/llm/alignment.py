"""Two tokenizers over the same texts: which tokens share bytes, and how often over the corpus.

Each text is tokenised whole by a byte-level vocabulary (A, after a space) and by a piece
vocabulary (B). Where a token of both ends at the same byte and both go on with a token that is
marked by a space, the text is cut: what lies between two cuts is a window of token ids. Windows
are aligned once per worker, remembered by their ids: byte offsets where tokens of both end cut
a window into groups, and all tokens of a group are linked.

Counts go over blocks of documents, a few MB of text each. A block sends each of its distinct id
pairs once, with the number of its documents that hold it, and gets back the pair's count over
all documents and whether that is the highest of its A id. So a pair that every document holds
costs one row per block, and documents stay where they are.

Cases: null and empty texts have no tokens, nor have texts whose tokens of either kind do not
spell the text with a space before it (U+2581 is a space to B): zeros and an empty column. Every
row is a document of its own, also with a repeated or null id. A long text is a block by itself.
An empty table gives no rows. Columns other than `doc_id` and `text` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm import spaced
from orderlens.llm import words as W
from orderlens.session import cut_lineage

#: Bytes of text that a worker aligns at once, and that share one list of id pairs.
_PIECE_BYTES = 2_000_000
_BLOCK_BYTES = 24_000_000
#: Windows remembered by a worker, beyond which it starts anew. It bounds memory, not results.
_REMEMBERED = 400_000
_MANY = 4_096

_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
ALIGNED = (
    "block string, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " at array<int>, times array<long>, pairs array<long>, docs array<int>"
)
COUNTED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


class Tokenizers:
    """Both tokenizers, by parts of texts that neither reaches across."""

    def __init__(self, byte_path: str, piece_path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.bytes_a, self.bytes_b = self._spelled_a(), self._spelled_b()
        self.len_a, self.len_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        self.spaced_a = np.array([x.startswith(b" ") for x in self.bytes_a])
        self.spaced_b = np.array([x.startswith(b" ") for x in self.bytes_b])
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(spaced.MARK in n.lstrip(spaced.MARK) for n in names):
            raise ValueError("a piece reaches across a space")
        self.ids_a, self.ids_b, self.spelled = (spaced.Ragged(t) for t in (np.int32, np.int32, np.bool_))
        self.parts = spaced.Parts(self._learn, self._forget, _REMEMBERED)

    def _spelled_a(self) -> list[bytes]:
        """The bytes of each A id: the byte-level alphabet shows printable bytes as themselves."""
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        added = set(self.a.get_added_tokens_decoder())
        names = [self.a.id_to_token(i) for i in range(self.a.get_vocab_size())]
        return [n.encode() if i in added else bytes(byte_of[c] for c in n) for i, n in enumerate(names)]

    def _spelled_b(self) -> list[bytes]:
        out = []
        for i in range(self.b.get_piece_size()):
            name = self.b.id_to_piece(i)
            out.append(bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace(spaced.MARK, " ").encode())
        return out

    def _forget(self):
        for lists in (self.ids_a, self.ids_b, self.spelled):
            lists.clear()

    def _learn(self, new: list[str]):
        a = [x.ids for x in self.a.encode_batch_fast([" " + p for p in new], add_special_tokens=False)]
        b = self.b.encode(new, num_threads=1)
        sizes = np.fromiter((len(p.encode()) + 1 for p in new), np.int64, len(new))
        whole = (" " + " ".join(new)).encode()
        spelled = np.ones(len(new), bool)
        for ids, lists, shown in ((a, self.ids_a, self.bytes_a), (b, self.ids_b, self.bytes_b)):
            flat = list(chain.from_iterable(ids))
            counts = list(map(len, ids))
            lists.add(counts, flat)
            tokens = list(map(shown.__getitem__, flat))
            ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))])
            same = np.diff(ends[np.concatenate([[0], np.cumsum(counts)])]) == sizes
            if not same.all() or b"".join(tokens) != whole:
                same &= [b"".join(map(shown.__getitem__, x)) == b" " + p.encode() for x, p in zip(ids, new)]
            spelled &= same
        self.spelled.add([1] * len(new), spelled)

    def tokenise(self, texts: list[str]):
        """Bounds and ids of A and of B of each text; none for a text they do not spell."""
        self.parts.make_room()
        bounds, at = self.parts.number(texts)
        bad = np.concatenate([[0], np.cumsum(~self.spelled.take(at)[1])])
        lost = bad[bounds[1:]] > bad[bounds[:-1]]
        if lost.any():
            size = np.diff(bounds)
            at = at[~np.repeat(lost, size)]
            bounds = np.concatenate([[0], np.cumsum(np.where(lost, 0, size))])
        in_a, flat_a = self.ids_a.take(at)
        in_b, flat_b = self.ids_b.take(at)
        return in_a[bounds], flat_a, in_b[bounds], flat_b


class Windows:
    """Alignments of windows, remembered by their ids."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        # ids in decimal with what follows them: more of their group, or its end
        self.written = [f"{i}{c}" for i in range(len(tokenizers.len_a)) for c in ",|"]
        self.written += [f"{i}{c}" for i in range(len(tokenizers.len_b)) for c in ",;"]
        self.clear()

    def clear(self):
        self.known: dict[bytes, int] = {}
        self.groups: list[str] = []
        self.pair_number: dict[int, int] = {}
        self.pair: list[int] = []  # A id above, B id in the lower 32 bits
        self.n_groups, self.n_links = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.linked, self.times = spaced.Ragged(np.int32), spaced.Ragged(np.int64)

    def full(self) -> bool:
        return len(self.known) > _REMEMBERED or len(self.linked.flat) > 8 * _REMEMBERED

    def _align(self, keys: list[bytes]):
        """Alignments of new windows, many at once."""
        t = self.tokenizers
        ids = np.frombuffer(b"".join(keys), np.int32)
        starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, keys), np.int64, len(keys)) // 4)])
        split = np.flatnonzero(ids < 0)
        n_a, n_b = split - starts[:-1], starts[1:] - split - 1
        window = np.repeat(np.arange(len(keys)), np.diff(starts))
        in_a = np.arange(len(ids)) < split[window]
        a, b = ids[in_a].astype(np.int64), ids[~in_a & (ids >= 0)].astype(np.int64)
        # bytes of a window add up to the same in A and B, so offsets may run on
        end_a, end_b = np.cumsum(t.len_a[a]), np.cumsum(t.len_b[b])
        to_b = np.searchsorted(end_b, end_a)
        last_a = np.flatnonzero(end_b[to_b] == end_a)  # the last tokens of each group
        last_b = to_b[last_a]
        size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        of = np.searchsorted(np.cumsum(n_a), last_a, side="right")
        n_groups = np.bincount(of, minlength=len(keys))
        n_links = np.zeros(len(keys), np.int64)
        np.add.at(n_links, of, size_a * size_b)
        places, pairs, times = self._pairs(a, b, last_a, last_b, size_a, size_b, of)
        known = self.pair_number
        distinct, inverse = np.unique(pairs, return_inverse=True)
        numbers = []
        for pair in distinct.tolist():
            at = known.get(pair)
            if at is None:
                at = known[pair] = len(known)
                self.pair.append(pair)
            numbers.append(at)
        self.linked.add(np.bincount(places, minlength=len(keys)), np.array(numbers, np.int64)[inverse])
        self.times.add(np.bincount(places, minlength=len(keys)), times)
        self.n_groups = np.concatenate([self.n_groups, n_groups])
        self.n_links = np.concatenate([self.n_links, n_links])
        self.groups += self._shown(a, b, last_a, last_b, size_a, size_b, n_a + n_b)

    def _pairs(self, a, b, last_a, last_b, size_a, size_b, of):
        """Window, pair and links of the distinct pairs of each window."""
        big = size_a * size_b > _MANY
        out = []
        for g in np.flatnonzero(big):  # ids of a large group repeat, so they are counted first
            one, n = np.unique(a[last_a[g] + 1 - size_a[g] : last_a[g] + 1], return_counts=True)
            two, m = np.unique(b[last_b[g] + 1 - size_b[g] : last_b[g] + 1], return_counts=True)
            pair = (one[:, None] << 32 | two).ravel()
            out.append((np.full(len(pair), of[g]), pair, np.outer(n, m).ravel()))
        group = np.repeat(np.arange(len(size_a)), size_a)
        small = ~big[group]
        group, left = group[small], a[small]
        each = size_b[group]
        run = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        right = b[np.repeat(last_b[group] + 1 - each, each) + run]
        pair = np.repeat(left, each) << 32 | right
        out.append((np.repeat(of[group], each), pair, np.ones(len(pair), np.int64)))
        place, pair, times = (np.concatenate(x) for x in zip(*out))
        order = np.lexsort((pair, place))
        place, pair, times = place[order], pair[order], times[order]
        first = np.flatnonzero((np.diff(place, prepend=-1) != 0) | (np.diff(pair, prepend=-1) != 0))
        return place[first], pair[first], np.add.reduceat(times, first)

    def _shown(self, a, b, last_a, last_b, size_a, size_b, tokens) -> list[str]:
        """Each window's groups as text."""
        code = np.zeros(len(a) + len(b), np.int64)
        ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        ends_a[last_a], ends_b[last_b] = 1, 1
        code[np.arange(len(a)) + np.repeat(last_b + 1 - size_b, size_a)] = 2 * a + ends_a
        code[np.arange(len(b)) + np.repeat(last_a + 1, size_b)] = 2 * (len(self.tokenizers.len_a) + b) + ends_b
        parts = list(map(self.written.__getitem__, code.tolist()))
        ends = np.cumsum(tokens).tolist()
        return ["".join(parts[x:y])[:-1] for x, y in zip([0, *ends], ends)]

    def number(self, keys: pa.Array) -> np.ndarray:
        """The number of each window, given as its A ids, -1 and its B ids in 32 bits each."""
        coded = keys.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [k for k in distinct if k not in self.known]
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self._align(new)
        at = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        return at[coded.indices.to_numpy()]


class Aligner:
    def __init__(self, byte_path: str, piece_path: str):
        self.tokenizers = Tokenizers(byte_path, piece_path)
        self.windows = Windows(self.tokenizers)

    def cut(self, a: np.ndarray, b: np.ndarray, doc_a: np.ndarray, doc_b: np.ndarray):
        """Ends of the windows of all documents, in A tokens and in B tokens.

        Token bytes of a document add up to the same in A and B, so offsets may run on.
        """
        t = self.tokenizers
        end_a, end_b = np.cumsum(t.len_a[a]), np.cumsum(t.len_b[b])
        to_b = np.searchsorted(end_b, end_a)
        shared = np.flatnonzero(end_b[to_b] == end_a)  # A tokens whose end is one of B, too
        upto_a, upto_b = shared + 1, to_b[shared] + 1
        anchor = np.append(t.spaced_a[a], True)[upto_a] & np.append(t.spaced_b[b], True)[upto_b]
        last = np.zeros(len(a) + 1, bool)
        last[doc_a] = True
        keep = anchor | last[upto_a]
        return upto_a[keep], upto_b[keep]

    def _keys(self, a, b, upto_a, upto_b) -> pa.Array:
        size_a, size_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
        start = np.concatenate([[0], np.cumsum(size_a + size_b + 1)])
        flat = np.full(start[-1], -1, np.int32)
        flat[np.repeat(start[:-1] - (upto_a - size_a), size_a) + np.arange(len(a))] = a
        flat[np.repeat(start[:-1] + size_a + 1 - (upto_b - size_b), size_b) + np.arange(len(b))] = b
        offsets = pa.py_buffer((start * 4).astype(np.int64).tobytes())
        return pa.Array.from_buffers(pa.large_binary(), len(upto_a), [None, offsets, pa.py_buffer(flat.tobytes())])

    def align(self, texts: list[str]):
        """Numbers and group digest of each text, and its distinct pairs with their links."""
        doc_a, a, doc_b, b = self.tokenizers.tokenise(texts)
        upto_a, upto_b = self.cut(a, b, doc_a, doc_b) if len(a) else (np.zeros(0, np.int64),) * 2
        windows = self.windows
        at = windows.number(self._keys(a, b, upto_a, upto_b)) if len(a) else upto_a
        bounds = np.searchsorted(upto_a, doc_a, side="right")

        def total(values):
            run = np.concatenate([[0], np.cumsum(values[at])])
            return run[bounds[1:]] - run[bounds[:-1]]

        numbers = np.diff(doc_a), np.diff(doc_b), total(windows.n_groups), total(windows.n_links)
        digests, shown, listed = [], windows.groups, at.tolist()
        for x, y in zip(bounds.tolist(), bounds[1:].tolist()):
            groups = ";".join([shown[n] for n in listed[x:y]])
            digests.append(hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        within, linked = windows.linked.take(at)
        _, times = windows.times.take(at)
        doc = np.repeat(np.arange(len(texts)), np.diff(within[bounds]))
        # one entry per document and pair
        key = doc * (len(windows.pair) + 1) + linked  # in 64 bits, as `doc` is
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        summed = np.add.reduceat(times[order], first) if len(first) else times
        held = np.bincount(doc[order][first], minlength=len(texts))
        return numbers, digests, held, linked[order][first].astype(np.int32), summed


def worker_aligner(byte_path: str, piece_path: str) -> Aligner:
    """The worker's aligner, with all it remembers."""
    import tokenizers

    # this module comes with each task, the library's stays for the life of the worker
    opened = tokenizers.__dict__.setdefault("_aligners", {})
    key = byte_path, piece_path
    if key not in opened:
        opened[key] = Aligner(*key)
    return opened[key]


def _block_rows(name: str, done: list, aligner: Aligner) -> Iterator[pa.RecordBatch]:
    """One row for the pairs of a block, then its documents with places in that list."""
    held = np.concatenate([d[4] for d in done])
    numbers, docs = np.unique(held, return_counts=True)
    pair = np.array(aligner.windows.pair, np.int64)[numbers]
    schema = pa.schema([
        ("block", pa.string()), ("doc_id", pa.int64()), *((n, pa.int64()) for n in _NUMBERS), ("groups_sha256", pa.string()),
        ("at", pa.list_(pa.int32())), ("times", pa.list_(pa.int64())), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32())),
    ])
    head = {"block": [name], "pairs": [pair], "docs": [docs.astype(np.int32)]}
    yield pa.record_batch([pa.array(head.get(f.name, [None]), f.type) for f in schema], schema=schema)
    for ids, counts, digests, sizes, linked, times in done:
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        places = np.searchsorted(numbers, linked)
        none = pa.nulls(len(ids), pa.list_(pa.int64())), pa.nulls(len(ids), pa.list_(pa.int32()))
        yield pa.record_batch(
            [
                pa.array([name] * len(ids)), ids, *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                pa.ListArray.from_arrays(offsets, pa.array(places, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())), *none,
            ],
            schema=schema,
        )


def aligned(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Documents with their own numbers and pairs, and a row of pairs for each block of them.

    `at` holds places in the block's `pairs`, `times` the links of that pair; `docs` counts the
    documents of the block that hold each pair.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_aligner(byte_path, piece_path)
        aligner.windows.clear()
        part, blocks, done, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in chain.from_iterable(W.pieces(b, _PIECE_BYTES) for b in batches):
            texts = W.whole(batch.column("text"))
            if done and (size + texts.nbytes > _BLOCK_BYTES or aligner.windows.full()):
                yield from _block_rows(f"{part}-{blocks}", done, aligner)
                blocks, done, size = blocks + 1, [], 0
                if aligner.windows.full():
                    aligner.windows.clear()
            counts, digests, held, linked, times = aligner.align(texts.to_pylist())
            done.append((batch.column("doc_id").cast(pa.int64()), counts, digests, held, linked, times))
            size += texts.nbytes
        if done:
            yield from _block_rows(f"{part}-{blocks}", done, aligner)
        W.tidy(None)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ALIGNED)


def pair_counts(placed: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold each id pair, and whether no other of its A id has more."""
    asked = placed.where("pairs is not null").select(F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
    counts = asked.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("n"))
    counts = counts.withColumn("a", F.shiftright("pair", 32))
    highest = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _score(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """The links of a block's documents, weighed by what their pairs count over all documents."""
    n = np.zeros(len(answers), np.int64)
    best = np.zeros(len(answers), np.int64)
    place = answers.column("place").to_numpy()
    n[place] = answers.column("n").to_numpy()
    best[place] = answers.column("best").to_numpy(zero_copy_only=False)
    docs = docs.combine_chunks()
    at, times = (docs.column(c).combine_chunks() for c in ("at", "times"))
    flat = at.flatten().to_numpy()
    weight = times.flatten().to_numpy().astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(at.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))])

    def total(values):
        run = np.concatenate([[0], np.cumsum(values[flat] * weight)])
        return pa.array(run[bounds[1:]] - run[bounds[:-1]], pa.int64())

    kept = [docs.column(c) for c in ("doc_id", *_NUMBERS)]
    return pa.table(
        [*kept, total(best), total(n), docs.column("groups_sha256")],
        names=["doc_id", *_NUMBERS, "n_best", "count_sum", "groups_sha256"],
    )


def links(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Per document: tokens, groups, links, and what the linked pairs count over the corpus."""
    placed = cut_lineage(aligned(docs, byte_path, piece_path))
    asked = placed.where("pairs is not null").select("block", F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(pair_counts(placed), "pair").select(F.col("block").alias("asking"), "place", "n", "best")
    rows = placed.where("pairs is null").drop("pairs", "docs")
    return rows.groupBy("block").cogroup(answers.groupBy("asking")).applyInArrow(_score, COUNTED)

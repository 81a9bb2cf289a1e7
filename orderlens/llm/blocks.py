"""Questions about hashes of a whole corpus, asked by blocks of documents.

Sending every hash of every window to where its equals meet, and the answer back, costs two
shuffles of many narrow rows. Here documents are first dealt into blocks of neighbouring ids.
A block sends each of its distinct hashes once, sorted and delta-coded, in FAN or fewer ranges.
Neighbouring blocks meet at a node for each range, which sends the union on in narrower ranges,
until one node, the shard, holds a range of all blocks' hashes. Answers go the same way back:
a node answers with one small code per hash in the same order, which the asker can read because
its own order is determined by its content.

So a hash that occurs in a third of all documents costs one entry per block; nodes hold about as
much as a block, and with n blocks there are at most FAN * n * log(n) rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm import words as W

BLOCK_BYTES = 5_000_000
ROW_BYTES = 2_000_000
PACKED = "block long, docs binary"
#: Ranges of hashes that a block or node sends to; rows grow with FAN, levels with its logarithm.
FAN = 32
#: Ids whose text may be weighed as one piece when blocks are cut, in bytes.
WEIGHT_BYTES = 1024
ASKED = "node long, child long, n long, hashes binary, extra binary"
ANSWERED = "child long, node long, answer binary"


def bounds_of(docs: DataFrame, block_bytes: int) -> list[int]:
    """Ids at which blocks of about `block_bytes` of text begin; the first block has no entry."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    if blocks == 1:
        return []
    at = F.array(*(F.lit(k / blocks) for k in range(1, blocks)))
    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(W.LAST_ID)).alias("id")
    # an id counts once for each piece of its text, so that blocks are cut by bytes
    pieces = F.sequence(F.lit(0), F.floor(F.coalesce(F.octet_length("text"), F.lit(0)) / WEIGHT_BYTES))
    weighed = docs.select(ids, F.explode(pieces))
    cuts = weighed.agg(F.percentile_approx("id", at, max(10_000, 20 * blocks))).first()[0]
    return sorted(set(cuts or []))


def packed(
    docs: DataFrame,
    bounds: list[int],
    columns: tuple[str, ...] = (),
    wanted: Callable[[np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """Documents as compressed rows of their block, with doc_id, text and `columns`.

    `wanted` tells by their ids which documents are needed at all.
    """
    cuts = np.array(bounds, np.int64)
    names = ["doc_id", "text", *columns]
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *names[1:])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        W.forget_encoders()
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if wanted is not None:
                table = table.filter(pa.array(wanted(W.ids(table["doc_id"]))))
            if not table.num_rows:
                continue
            block = np.searchsorted(cuts, W.ids(table["doc_id"]), side="right")
            order = np.argsort(block, kind="stable")
            table, block = table.take(order), block[order]
            size = np.cumsum(pa.compute.binary_length(W.whole(table["text"])).to_numpy(zero_copy_only=False))
            part = block * 2**32 + size // ROW_BYTES
            starts = np.flatnonzero(np.diff(part, prepend=part[:1] - 1))
            for a, b in zip(starts, [*starts[1:], len(block)]):
                yield pa.record_batch(
                    [pa.array([block[a]], pa.int64()), pa.array([dumped(table.slice(a, b - a))], pa.binary())],
                    names=["block", "docs"],
                )
        W.tidy(None)

    return narrow.mapInArrow(pack, PACKED)


def dumped(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table.combine_chunks())
    return zstandard.ZstdCompressor(6).compress(sink.getvalue())


def loaded(rows: pa.Table) -> pa.Table:
    """The documents of a block in order of id; of equal ids, in order of text."""
    W.forget_encoders()
    expand = zstandard.ZstdDecompressor()
    parts = [
        pa.ipc.open_stream(expand.decompress(x)).read_all() for x in rows["docs"].to_pylist()
    ]
    table = pa.concat_tables(parts, promote_options="default").combine_chunks()
    ids = W.ids(table["doc_id"])
    order = np.argsort(ids, kind="stable")
    if len(ids) > 1 and not (np.diff(ids[order]) > 0).all():
        texts = W.whole(table["text"]).to_pylist()
        order = np.array(sorted(range(len(ids)), key=lambda k: (ids[k], texts[k])))
    return table.take(order)


def encoded(values: np.ndarray) -> bytes:
    """Sorted numbers: differences, byte by byte of equal weight, compressed."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(1).compress(planes.tobytes())


def decoded(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def tree(blocks: int) -> tuple[int, int]:
    """Ranges per sender and levels of nodes for so many blocks; fan ** levels is not below them."""
    levels = 1
    while FAN**levels < blocks:
        levels += 1
    fan = 1
    while fan**levels < blocks:
        fan += 1
    return fan, levels


def range_cuts(first: int, many: int, whole: int) -> np.ndarray:
    """Least hashes of the ranges after `first` among `many` of `whole` equal ranges of all hashes."""
    return np.array([((first + k) << 64) // whole for k in range(1, many)], np.uint64)


def questions(child: int, level: int, fan: int, hashes: np.ndarray, extra: np.ndarray | None) -> pa.Table:
    """Rows of ASKED for the sorted distinct `hashes` of a node of `level`; blocks are level 0.

    A node's number is that of its group of fan ** level blocks, times fan ** level, and its range.
    """
    group, place = divmod(child, fan**level)
    first, whole = place * fan, fan ** (level + 1)
    cuts = [0, *np.searchsorted(hashes, range_cuts(first, fan, whole)).tolist(), len(hashes)]
    rows = [
        (group // fan * whole + first + k, child, b - a, encoded(hashes[a:b]), None if extra is None else squeezed(extra[a:b]))
        for k, (a, b) in enumerate(zip(cuts, cuts[1:]))
        if b > a
    ]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) or [[]] * 5
    return pa.table(
        [pa.array(c, k) for c, k in zip(columns, kinds)],
        names=["node", "child", "n", "hashes", "extra"],
    )


def squeezed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(values).tobytes())


def spread(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


class Asked:
    """The entries of a node, in order of hash and then of child.

    order: where each entry came from; first: where a new hash begins; hashes: the distinct ones;
    extra: the sum for each of them of what was sent beside it.
    """

    def __init__(self, rows: pa.Table):
        W.forget_encoders()
        self.rows = rows.sort_by("child")
        values = np.concatenate([decoded(x) for x in self.rows["hashes"].to_pylist()])
        self.order = np.argsort(values, kind="stable")
        values = values[self.order]
        self.first = np.ones(len(values), bool)
        self.first[1:] = values[1:] != values[:-1]
        self.hashes = values[self.first]

    def extra(self) -> np.ndarray | None:
        sent = self.rows["extra"].to_pylist()
        if sent[0] is None:
            return None
        whole = np.concatenate([spread(x, np.uint64) for x in sent])[self.order]
        return np.add.reduceat(whole, np.flatnonzero(self.first))

    def answers(self, codes: np.ndarray, tell: Callable) -> pa.Table:
        """Rows of ANSWERED from a code for each distinct hash."""
        own = np.empty(len(self.order), codes.dtype)
        own[self.order] = tell(codes[np.cumsum(self.first) - 1], self.first)
        cuts = np.cumsum(self.rows["n"].to_numpy())[:-1]
        said = pa.array([squeezed(x) for x in np.split(own, cuts)], pa.binary())
        return pa.table([self.rows["child"], self.rows["node"], said], names=["child", "node", "answer"])


def heard(rows: pa.Table, kind) -> np.ndarray:
    """The answers of all nodes that were asked, in the order of the sorted distinct hashes."""
    if not rows.num_rows:
        return np.zeros(0, kind)
    rows = rows.sort_by("node")
    return np.concatenate([spread(x, kind) for x in rows["answer"].to_pylist()])


def exchange(
    docs: DataFrame,
    blocks: int,
    ask: Callable[[pa.Table], tuple[np.ndarray, np.ndarray | None]],
    kind,
    rule: Callable,
    finish: Callable[[int, pa.Table, np.ndarray], pa.Table],
    schema: str,
    tell: Callable = lambda codes, first: codes,
    known: DataFrame | None = None,
) -> DataFrame:
    """Blocks ask, shards answer, blocks finish. `docs` is a result of `packed`.

    ask: a block's sorted distinct hashes and, if any, a uint64 for each, which nodes add up.
    rule: codes of type `kind` for a shard's distinct hashes, from those, what was added up, and
    the shard's rows of `known` (by its column shard, numbered as `range_cuts` does).
    tell: codes for a node's entries in order, from that of their hash and where hashes begin.

    What is read twice is the same exchange, which Spark writes once. The inner functions carry
    no type hints, from which Spark would infer another kind of function.
    """
    fan, levels = tree(blocks)

    def ask_block(key, rows):
        return W.tidy(questions(key[0].as_py(), 0, fan, *ask(loaded(rows))))

    def pass_on(level):
        def gather(key, rows):
            asked = Asked(rows)
            return W.tidy(questions(key[0].as_py(), level, fan, asked.hashes, asked.extra()))

        return gather

    def answer_shard(rows):
        asked = Asked(rows)
        return W.tidy(asked.answers(rule(asked.hashes, asked.extra(), None), tell))

    def answer_known(key, rows, own):
        if not rows.num_rows:
            return pa.schema([("child", pa.int64()), ("node", pa.int64()), ("answer", pa.binary())]).empty_table()
        asked = Asked(rows)
        return W.tidy(asked.answers(rule(asked.hashes, asked.extra(), own), tell))

    def hand_back(key, rows, said):
        return W.tidy(Asked(rows).answers(heard(said, kind), tell))

    def finish_block(key, rows, said):
        return W.tidy(finish(key[0].as_py(), loaded(rows), heard(said, kind)))

    asked = [docs.groupBy("block").applyInArrow(ask_block, ASKED)]
    for level in range(1, levels):
        asked.append(asked[-1].groupBy("node").applyInArrow(pass_on(level), ASKED))
    shards = asked[-1].groupBy("node")
    if known is None:
        answered = shards.applyInArrow(answer_shard, ANSWERED)
    else:
        answered = shards.cogroup(known.groupBy("shard")).applyInArrow(answer_known, ANSWERED)
    for below in asked[-2::-1]:
        answered = below.groupBy("node").cogroup(answered.groupBy("child")).applyInArrow(hand_back, ANSWERED)
    return docs.groupBy("block").cogroup(answered.groupBy("child")).applyInArrow(finish_block, schema)

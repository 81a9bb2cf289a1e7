"""Token ids in binary blocks, each document compressed alone with a shared dictionary.

A store is a folder with two tables: `dictionary`, one row with the zstandard dictionary, and
`blocks`, whose rows hold the frames of neighbouring documents end to end in `payload` with
an index of ids, token counts and frame ends. A short document is read by its block's range of
ids and its own frame alone, without the other frames being expanded. Every block names the
digest of its dictionary, and readers refuse another one.

Documents are dealt by ranges of doc_id and sorted inside each part, so parts and blocks are
in ascending order; where each begins follows from the token totals of the parts.

Defined results: null text is an empty document, which still has its end id; null doc_id
comes first; rows with the same doc_id all stay, in order of text. Other columns are ignored.
An empty table makes a store without blocks.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm import words as W
from orderlens.llm.tokens import encoder, version

END_ID = 1
#: Documents the dictionary is trained on, about; and its size.
TRAINING_DOCS = 2_000
DICTIONARY_BYTES = 64_000
LEVEL = 3
PART_BYTES = 24_000_000
BLOCK_BYTES = 1_000_000
#: Bytes of text that a worker encodes at once; what that took goes back to the system after each.
PIECE_BYTES = 8_000_000
BLOCKS = (
    "part long, seq long, first_id long, last_id long, before long, tokens long, width int, "
    "dictionary string, doc_ids array<long>, n_tokens array<long>, ends array<long>, payload binary"
)
DECODED = "doc_id long, start long, n_tokens long, ids binary"
DIGESTED = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _width(path: str) -> int:
    return 2 if encoder(path).tokenizer.get_vocab_size() <= 2**16 else 4


def _batches(batch: pa.RecordBatch, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and ids of a batch's documents, end ids included."""
    texts = W.whole(batch.column("text"))
    bounds, ids = encoder(path).encode(texts)
    ends = bounds[1:] + np.arange(len(bounds) - 1)
    ended = np.full(len(ids) + len(ends), END_ID, ids.dtype)
    kept = np.ones(len(ended), bool)
    kept[ends] = False
    ended[kept] = ids
    return bounds + np.arange(len(bounds)), ended


def train_dictionary(docs: DataFrame, path: str) -> bytes:
    """A dictionary from about TRAINING_DOCS documents chosen by a hash of their ids."""
    rows = docs.count()
    every = max(1, rows // TRAINING_DOCS)
    chosen = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = f"<u{_width(path)}"
        for batch in (x for whole in batches for x in W.pieces(whole, PIECE_BYTES)):
            bounds, ids = _batches(batch, path)
            ids = ids.astype(kind)
            W.tidy(None)
            parts = [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
            one = pa.array([0] * len(parts), pa.int32())
            yield pa.record_batch([one, pa.array(parts, pa.binary())], names=["one", "ids"])

    def train(rows):
        samples = sorted(rows["ids"].to_pylist())
        try:
            made = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:  # too few samples: their own bytes serve as the dictionary
            made = (b"".join(samples) + bytes(8))[:DICTIONARY_BYTES]
        return pa.table({"dictionary": pa.array([made], pa.binary())})

    made = (
        chosen.mapInArrow(encode, "one int, ids binary")
        .groupBy("one")
        .applyInArrow(train, "dictionary binary")
    ).first()
    return made[0] if made else bytes(8)


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data)


def write(docs: DataFrame, root: str, tokenizer_path: str, block_bytes: int = BLOCK_BYTES) -> None:
    """Write `docs` as a new store in `root`."""
    spark = docs.sparkSession
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dictionary = train_dictionary(narrow, tokenizer_path)
    name = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame(
        [(name, bytearray(dictionary), version(tokenizer_path), END_ID)],
        "hash string, dictionary binary, tokenizer string, end_id int",
    ).write.parquet(f"{root}/dictionary")
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / PART_BYTES))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(LEVEL, dict_data=_dictionary(dictionary))
        width = _width(tokenizer_path)
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        ids_, counts, frames, total = [], [], [], 0

        def block() -> pa.RecordBatch:
            tokens = sum(counts)
            known = [x for x in ids_ if x is not None]
            row = (
                part, seq, min(known, default=None), max(known, default=None), before, tokens, width, name,
                list(ids_), list(counts), np.cumsum([len(x) for x in frames]).tolist(), b"".join(frames),
            )
            return pa.record_batch([pa.array([v], t) for v, t in zip(row, _BLOCK_KINDS)], names=_BLOCK_NAMES)

        for batch in (x for whole in batches for x in W.pieces(whole, PIECE_BYTES)):
            bounds, ids = _batches(batch, tokenizer_path)
            ids = ids.astype(f"<u{width}")
            W.tidy(None)
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), bounds.tolist(), bounds[1:].tolist()):
                ids_.append(doc)
                counts.append(b - a)
                frames.append(press.compress(ids[a:b].tobytes()))
                total += len(frames[-1])
                if total >= block_bytes:
                    yield block()
                    before += sum(counts)
                    seq, ids_, counts, frames, total = seq + 1, [], [], [], 0
        if ids_:
            yield block()

    (
        narrow.repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(pack, BLOCKS)
        .write.option("compression", "none")
        .parquet(f"{root}/blocks")
    )


_BLOCK_NAMES = [x.split()[0] for x in BLOCKS.split(", ")]
_BLOCK_KINDS = [
    {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}.get(
        x.split()[1], pa.list_(pa.int64())
    )
    for x in BLOCKS.split(", ")
]


class TokenStore:
    """A written store."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.blocks = spark.read.schema(BLOCKS).parquet(f"{root}/blocks")
        row = spark.read.parquet(f"{root}/dictionary").first()
        self.hash, self.dictionary = row["hash"], bytes(row["dictionary"])
        if hashlib.sha256(self.dictionary).hexdigest() != self.hash:
            raise ValueError(f"the dictionary in {root} is damaged")

    def placed(self) -> DataFrame:
        """Blocks with the number of ids before them; one row per part is broadcast."""
        upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        parts = self.blocks.groupBy("part").agg(F.sum("tokens").alias("n"))
        base = parts.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))
        return self.blocks.join(F.broadcast(base), "part")

    def read(self, ids: list[int] | None = None) -> DataFrame:
        """Documents with their ids as unsigned 32-bit numbers; `ids` picks a few by the index."""
        blocks = self.placed()
        if ids is not None:
            low, high = F.col("first_id"), F.col("last_id")
            blocks = blocks.where(
                F.exists(F.array(*(F.lit(x).cast("long") for x in ids)), lambda x: x.between(low, high))
            )
        return self._frames(blocks, DECODED, lambda data: data, ids)

    def digests(self) -> DataFrame:
        """Every document's place, length and crc32, from its expanded ids."""
        return self._frames(self.placed(), DIGESTED, zlib.crc32, None)

    def _frames(self, blocks: DataFrame, schema: str, result, ids: list[int] | None) -> DataFrame:
        dictionary, name = self.dictionary, self.hash
        wanted = None if ids is None else set(ids)
        names = [x.split()[0] for x in schema.split(", ")]
        last = pa.int64() if names[-1] == "ids_crc32" else pa.binary()

        def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            frames = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
            for batch in batches:
                for row in batch.to_pylist():
                    if row["dictionary"] != name:
                        raise ValueError(f"block {row['part']}/{row['seq']} needs another dictionary")
                    yield _expanded(row, frames, names, last, result, wanted)

        columns = ["part", "seq", "base", "before", "width", "dictionary", "doc_ids", "n_tokens", "ends", "payload"]
        return blocks.select(*columns).mapInArrow(expand, schema)


def _expanded(row: dict, frames, names: list[str], last: pa.DataType, result, wanted) -> pa.RecordBatch:
    start, at = row["base"] + row["before"], 0
    payload = memoryview(row["payload"])
    out: list[list] = [[], [], [], []]
    for doc, n, end in zip(row["doc_ids"], row["n_tokens"], row["ends"]):
        if wanted is None or doc in wanted:
            ids = np.frombuffer(frames.decompress(payload[at:end]), f"<u{row['width']}")
            if len(ids) != n:
                raise ValueError(f"block {row['part']}/{row['seq']} is damaged")
            for column, value in zip(out, (doc, start, n, result(ids.astype("<u4").tobytes()))):
                column.append(value)
        start, at = start + n, end
    kinds = [pa.int64(), pa.int64(), pa.int64(), last]
    return pa.record_batch([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

"""Token counts as delta-maintained rollups.

A batch of changes is turned into signed entries: an insert adds a document's tokens under its
source, language and tokenizer version; a delete takes back what the ledger has for the
document; a revision does both. The entries are summed to additive deltas per key, and totals
are sums of the deltas of committed batches.

A batch writes its entries and deltas under its own name, and then its row in the log, which
commits it. Work that was lost before the log row is done again over the same folders; a batch
that has its row is not done again. One writer per rollup.

Changes are (op, doc_id, source, lang, text) with op 'insert', 'delete' or 'revise'. Defined
results: null text has 0 tokens; a null source, language or id is a key of its own; several
inserts of a doc_id in one batch add up, as do repeated rows; deletes and revisions take back
everything that earlier batches hold of the id under this tokenizer version, once, whatever
their number; of several revisions the texts add up; an id that is not there loses nothing.
Other columns are ignored. An empty batch commits with empty deltas.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm import words as W
from orderlens.llm.tokens import encoder, version

KEYS = ["source", "lang", "tokenizer"]
SUMS = ["documents", "tokens"]
_LONG, _TEXT = T.LongType(), T.StringType()
DELTAS = T.StructType([*(T.StructField(k, _TEXT) for k in KEYS), *(T.StructField(s, _LONG) for s in SUMS)])
ENTRIES = T.StructType([T.StructField("doc_id", _LONG), *DELTAS])
LOG = T.StructType([T.StructField("batch", _TEXT), T.StructField("tokenizer", _TEXT)])


def counted(changes: DataFrame, path: str) -> DataFrame:
    """op, doc_id, source, lang, n_tokens of every row."""
    narrow = changes.select("op", F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        for piece in (x for batch in batches for x in W.pieces(batch)):
            n = words.counts(W.whole(piece.column("text")))
            columns = [piece.column(c) for c in ("op", "doc_id", "source", "lang")]
            yield pa.record_batch([*columns, pa.array(n)], names=["op", "doc_id", "source", "lang", "n_tokens"])

    return narrow.mapInArrow(count, "op string, doc_id long, source string, lang string, n_tokens long")


class TokenRollup:
    """The rollup in the folder `root`, for one tokenizer file."""

    def __init__(self, spark: SparkSession, root: str, tokenizer_path: str):
        self.spark, self.root, self.path = spark, root.rstrip("/"), tokenizer_path
        self.version = version(tokenizer_path)
        for name, schema in (("entries", ENTRIES), ("deltas", DELTAS), ("log", LOG)):
            # an empty table, so that readers find a folder before the first batch
            own = T.StructType([f for f in schema if f.name != "batch"])
            spark.createDataFrame([], own).coalesce(1).write.mode("ignore").parquet(
                f"{self.root}/{name}/batch=none"
            )

    def _table(self, name: str, schema: T.StructType) -> DataFrame:
        whole = T.StructType([f for f in schema if f.name != "batch"] + [T.StructField("batch", _TEXT)])
        return self.spark.read.schema(whole).parquet(f"{self.root}/{name}")

    def log(self) -> DataFrame:
        return self._table("log", LOG)

    def _committed(self, name: str, schema: T.StructType) -> DataFrame:
        return self._table(name, schema).join(self.log().select("batch"), "batch", "left_semi")

    def ledger(self) -> DataFrame:
        """What every document counts for: the sum of its committed entries."""
        entries = self._committed("entries", ENTRIES)
        sums = [F.sum(s).alias(s) for s in SUMS]
        return entries.groupBy("doc_id", *KEYS).agg(*sums).where("documents <> 0 or tokens <> 0")

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, documents, tokens."""
        deltas = self._committed("deltas", DELTAS)
        return deltas.groupBy(*KEYS).agg(*(F.sum(s).alias(s) for s in SUMS)).where("documents <> 0")

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commit a batch; False if it was committed before. `batch` becomes a folder's name."""
        if not re.fullmatch(r"[\w.-]+", batch) or batch == "none":
            raise ValueError(f"not a name for a batch: {batch!r}")
        if self.log().where(F.col("batch") == batch).limit(1).count():
            return False
        now = counted(changes, self.path)
        added = now.where("op <> 'delete'").select(
            "doc_id", "source", "lang", F.lit(self.version).alias("tokenizer"),
            F.lit(1).cast("long").alias("documents"), F.col("n_tokens").alias("tokens"),
        )
        gone = changes.where("op <> 'insert'").select(F.col("doc_id").cast("long").alias("_id")).distinct()
        held = self.ledger().where(F.col("tokenizer") == self.version)
        taken = held.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select(
            "doc_id", *KEYS, *((-F.col(s)).alias(s) for s in SUMS)
        )
        entries = f"{self.root}/entries/batch={batch}"
        added.union(taken).write.mode("overwrite").parquet(entries)
        written = self.spark.read.schema(ENTRIES).parquet(entries)
        sums = [F.sum(s).alias(s) for s in SUMS]
        written.groupBy(*KEYS).agg(*sums).write.mode("overwrite").parquet(f"{self.root}/deltas/batch={batch}")
        self.spark.createDataFrame([(self.version,)], "tokenizer string").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{self.root}/log/batch={batch}")
        return True

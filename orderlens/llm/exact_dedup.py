"""Exact dedup by a persistent digest index, bucketed and sorted by digest.

A batch is reduced to one row per digest before anything is shuffled, so a text with
any number of copies costs one row per task. The index is a table of buckets sorted by
digest; a batch meets it in a sort-merge anti-join, and what is new is appended as one
more set of files. Nothing here leaves the JVM.

Defined results: a null text counts as empty, and all empty texts are equal. A null
doc_id sorts after every other id and is kept only if all copies have none. Equal rows
are copies of each other, and one of them stays. A group's size is what its first batch held.
An empty batch appends nothing. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHITE_SPACE = r"[\x20\x09-\x0D]"
INDEX = T.StructType(
    [
        T.StructField("digest", T.BinaryType()),
        T.StructField("keep_id", T.LongType()),
        T.StructField("keep_length", T.IntegerType()),
        T.StructField("group_size", T.LongType()),
        T.StructField("batch", T.StringType()),
    ]
)
LAST_ID = 2**63 - 1


def digest(text: Column) -> Column:
    """SHA-256 of the text without white space."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE + "+", "")
    return F.unhex(F.sha2(F.encode(bare, "UTF-8"), 256))


def digests(docs: DataFrame) -> DataFrame:
    """One narrow row per document: id, digest, length in code points."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        digest(F.col("text")).alias("digest"),
        F.char_length(F.coalesce(F.col("text"), F.lit(""))).alias("length"),
    )


def groups(digested: DataFrame) -> DataFrame:
    """The row that stays and the number of copies, per digest."""
    best = F.min_by(
        "doc_id", F.struct(-F.col("length"), F.coalesce("doc_id", F.lit(LAST_ID)))
    )
    return digested.groupBy("digest").agg(
        best.alias("keep_id"), F.max("length").alias("keep_length"), F.count(F.lit(1)).alias("group_size")
    )


class DigestIndex:
    """Digests seen so far, at `path`, registered as `name` in the session's catalog.

    The table's definition is made anew from its folder, so another session opens the same
    index by the same path and number of buckets.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in INDEX)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def seen(self) -> DataFrame:
        """The index as buckets, which a join on the digest need not shuffle."""
        return self.spark.table(self.name)

    def rows(self) -> DataFrame:
        """The index as plain files, for joins whose other side may be skewed."""
        return self.spark.read.schema(INDEX).parquet(self.path)

    def add(self, fresh: DataFrame, batch: str) -> None:
        """Append the digests of `fresh` (one row each) that the index lacks.

        A batch that is run again finds its own digests and adds none.
        """
        new = (
            fresh.hint("merge")
            .join(self.seen().select("digest").hint("merge"), "digest", "left_anti")
            .withColumn("batch", F.lit(batch))
            .select(INDEX.names)
        )
        # the rows lie as the buckets do, so each task writes its own buckets
        (
            new.repartition(self.buckets, "digest")
            .write.insertInto(self.name)
        )
        self.spark.catalog.refreshTable(self.name)

    def settle(self, digested: DataFrame, batch: str) -> DataFrame:
        """Every row with its group; copies of earlier batches' texts follow the earlier row."""
        known = self.rows().withColumnRenamed("batch", "of")
        alike = digested.groupBy("digest", "doc_id", "length").agg(F.count(F.lit(1)).alias("rows"))
        stays = (
            F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("length") == F.col("keep_length")) & (F.col("of") == batch)
        )
        # both sides are shuffled, so a digest with very many copies is split at run time
        return alike.join(known.hint("merge"), "digest").select(
            "doc_id",
            "keep_id",
            "group_size",
            F.explode(F.transform(F.sequence(F.lit(1), F.col("rows")), lambda k: stays & (k == 1))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )


def dedup(spark: SparkSession, docs: DataFrame, index: DigestIndex, batch: str) -> DataFrame:
    """Add `docs` to the index and return one row per document with its decision."""
    digested = digests(docs)
    index.add(groups(digested), batch)
    return index.settle(digested, batch)

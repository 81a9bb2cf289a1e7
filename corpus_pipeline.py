"""From raw documents to token ids: quality, near copies, test items, source weights, storage.

Every stage takes and returns the columns of documents; the last returns what it reads back
from the token store. Stages see all rows that the one before kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm import decontaminate, mixing, ngram_join, quality, token_store
from orderlens.llm.queries import table, tokenizer_path
from orderlens.session import shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# A trained model and an alignment decide, which SQL cannot express.
ORACLE_SQL = None


def key() -> Column:
    """The id to join by; null ids are joined like any other."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("_key")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    judged = quality.judged(docs.select(COLUMNS), table(spark, sf_dir, "labels"), tuple(COLUMNS[1:]))
    return judged.where("accepted").select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the least id, and of equal ids the least text, of each group of similar ones.

    Rows with the same id and text are one document.
    """
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("_text")
    kept = ngram_join.linked_rows(docs).where("first").select(key(), F.col("text_digest").alias("_text")).distinct()
    same = Window.partitionBy("_key", "_text").orderBy("lang", "source", "n_chars")
    return (
        docs.select(*COLUMNS, key(), digest)
        .join(kept.hint("merge"), ["_key", "_text"], "left_semi")  # the window needs no other partitioning
        .withColumn("_nth", F.row_number().over(same))
        .where("_nth = 1")
        .select(COLUMNS)
    )


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    return decontaminate.clean(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, whole: its words over their size, rounded.

    A source takes a run of its shuffled documents, so only the one at the run's end is rounded.
    """
    alike = ["_key", "_words", "_source"]
    source = F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("_source")
    took = mixing.taken(docs).where("taken > 0").select(
        key(), F.col("size").alias("_words"), source,
        F.round(F.col("taken") / F.col("size")).cast("int").alias("_times"),
    )
    # rows alike to the mix are numbered on both sides; all is partitioned by what makes them alike
    took = took.withColumn("_nth", F.row_number().over(Window.partitionBy(*alike).orderBy(F.desc("_times"))))
    rows = docs.select(*COLUMNS, key(), mixing.words_in(F.col("text")).alias("_words"), source)
    rows = rows.withColumn("_row", F.row_number().over(Window.partitionBy(*alike).orderBy("lang", "n_chars")))
    return (
        rows.join(took.where("_times > 0").hint("merge"), alike)
        .where(F.abs(F.col("_row") - F.col("_nth")) < 1)
        .withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times"))))
        .select(COLUMNS)
    )


def store_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in a store, and what is read back from it."""
    root = f"{shared_dir(spark).rstrip('/')}/corpus-tokens-{uuid.uuid4().hex}"
    token_store.write(docs, root, tokenizer_path())
    return token_store.TokenStore(spark, root).digests()


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_test_items),
    ("mixing sources", mix_sources),
    ("token output", store_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = f"{shared_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

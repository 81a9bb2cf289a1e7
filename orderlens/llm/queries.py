"""The operators of this folder as registered queries over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import (
    alignment,
    conversations,
    decontaminate,
    exact_dedup,
    html_extract,
    mixing,
    ngram_join,
    oracle,
    pieces,
    quality,
    substring_dedup,
    token_counts,
    token_store,
    toxicity,
)
from orderlens.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as one batch into an empty digest index."""
    name = f"digest_index_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark).rstrip('/')}/{name}"
    index = exact_dedup.DigestIndex(spark, name, path, tasks(spark))
    return exact_dedup.dedup(spark, table(spark, sf_dir, "documents"), index, "documents")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The public vocabulary the queries use; operators take any path."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as a store, and read it back."""
    root = f"{shared_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    token_store.write(table(spark, sf_dir, "documents"), root, tokenizer_path())
    return token_store.TokenStore(spark, root).digests()


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as one batch of inserts into an empty rollup."""
    root = f"{shared_dir(spark).rstrip('/')}/token-counts-{uuid.uuid4().hex}"
    rollup = token_counts.TokenRollup(spark, root, tokenizer_path())
    inserts = table(spark, sf_dir, "documents").withColumn("op", F.lit("insert"))
    rollup.apply("documents", inserts)
    return rollup.totals()


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    byte_level, piece_level = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return alignment.links(table(spark, sf_dir, "documents"), byte_level, piece_level)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by the CRC of their keys, and repaired."""
    given = table(spark, sf_dir, "conversations")
    return conversations.with_empty(given, conversations.repair(conversations.damage(given)))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents and texts decoded from them, with the library's answer beside."""
    return pieces.encoded(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_quality": op3_quality,
        "op4_token_store": op4_token_store,
        "op5_html_extract": op5_html_extract,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_token_counts": op7_token_counts,
        "op8_toxicity": op8_toxicity,
        "op9_source_mix": op9_source_mix,
        "op10_ngram_join": op10_ngram_join,
        "op11_token_alignment": op11_token_alignment,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_sentencepiece": op13_sentencepiece,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_exact_dedup": oracle.EXACT_DEDUP,
        "op9_source_mix": oracle.MIXING,
        "op12_conversation_repair": oracle.conversation_repair(),
    }

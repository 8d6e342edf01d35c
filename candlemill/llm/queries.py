"""The operators as queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from candlemill.llm.conversation_trie import conversation_trie
from candlemill.llm.decontaminate import leaks
from candlemill.llm.embed_dedup import near_vectors
from candlemill.llm.language import language
from candlemill.llm.ngram_jaccard import jaccard_classes
from candlemill.llm.packing import pack
from candlemill.llm.phrases import collocations
from candlemill.llm.piece_encoding import piece_digests
from candlemill.llm.pii import sanitise
from candlemill.llm.quality import quality
from candlemill.llm.repeats import remove_repeats
from candlemill.llm.toxicity import toxicity
from candlemill.llm.training_order import materialise
from candlemill.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(_table(spark, sf_dir, "documents"), size=4, percent=85)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(_table(spark, sf_dir, "documents"), scratch_path(spark, "shards"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_term")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(_table(spark, sf_dir, "documents"), length=400)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language(_table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(_table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(_table(spark, sf_dir, "conversations"))


def registered() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_ngram_jaccard, op2_toxicity, op3_training_order, op4_pii, op5_decontamination,
            op6_quality, op7_repeated_strings, op8_embedding_dedup, op9_packing, op10_language,
            op11_phrases, op12_pieces, op13_conversation_trie,
        )
    }

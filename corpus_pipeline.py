"""From raw documents to packed training sequences, in five stages.

Toxic documents go, then near copies, then documents that hold benchmark
items; personal data is replaced in what stays, and the rest is packed. Every
stage works on the written result of the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm.decontaminate import leaks
from candlemill.llm.ngram_jaccard import jaccard_classes
from candlemill.llm.packing import pack
from candlemill.llm.pii import sanitise
from candlemill.llm.toxicity import without_toxic
from candlemill.session import pin, scratch_path

#: Near copies share at least this percentage of their five-word shingles.
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def _free_name(docs: DataFrame, name: str) -> str:
    """A name that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject. Null and empty texts stay."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the least id, a null id after all others.

    Every (doc_id, text) is a document of its own, also where ids repeat or are
    null. Documents without words are no copies of each other; all their rows
    stay.
    """
    key = _free_name(docs, "row_key")
    # Only ids and texts go through the search; other columns stay with their rows.
    own = docs.select(F.xxhash64("doc_id", "text").alias("row_key"), "doc_id", "text")
    classes = jaccard_classes(own.select(F.col("row_key").alias("doc_id"), "text"), SHINGLE_WORDS, SIMILAR_PERCENT)
    members = classes.groupBy(F.col("doc_id").alias("row_key")).agg(
        F.first("component_id").alias("component_id"), F.max("n_shingles").alias("n_shingles"), F.count("*").alias("rows")
    )
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    heads = members.join(own.select("row_key", "doc_id").distinct(), "row_key").groupBy("component_id").agg(
        F.min_by(F.struct("row_key", "n_shingles", "rows"), order).alias("head")
    )
    kept = pin(heads.select(F.col("head.row_key").alias(key), F.col("head.n_shingles").alias("n"), F.col("head.rows").alias("times")))
    repeated = kept.where("times > 1 and n > 0")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    if repeated.isEmpty():
        return keyed.join(kept.select(key), key, "left_semi").select(docs.columns)
    once = keyed.join(kept.where("times = 1 or n = 0").select(key), key, "left_semi")
    first = keyed.join(repeated.select(key), key, "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(first).select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified benchmark item. Null and empty texts stay."""
    # The text stands for the row, so repeated and null ids need no care.
    found = leaks(docs.select(F.xxhash64("text").alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    key = _free_name(docs, "text_key")
    marked = found.select(F.col("doc_id").alias(key)).distinct()
    return docs.withColumn(key, F.xxhash64("text")).join(marked, key, "left_anti").select(docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced and n_chars of the new text."""
    carry = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    renamed = docs.select("doc_id", "text", *(F.col(c).alias(f"carried_{k}") for k, c in enumerate(carry)))
    clean = sanitise(renamed, carry=[f"carried_{k}" for k in range(len(carry))])
    columns = {c: F.col(f"carried_{k}") for k, c in enumerate(carry)} | {
        "doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long"),
    }
    return clean.select(*(columns[c].alias(c) for c in docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_copies", near_copies_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: A trained classifier and token ids can't be expressed in SQL; tests compare with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; each is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""Bounded samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlemill.llm.common import hashed_place, held_out
from candlemill.session import pin

#: Most bytes of text of a sample over all classes, but for one text of each class at least; it bounds the driver's memory.
MAX_BYTES = 16 << 20
#: Most rows of a sample over all classes; with many classes each has fewer rows, but one at least.
MAX_ROWS = 12_000


def class_sample(rows: DataFrame, target: str, cap: int, by: list[str]) -> DataFrame:
    """About ``cap`` rows of each class of ``target`` that isn't null, chosen by a hash of the columns ``by``.

    Rows that are equal in ``by`` count once. If ``cap`` rows of every class
    were more than MAX_ROWS, each class has an equal share of MAX_ROWS; that
    with the least hash is always taken, so no class is left out.
    """
    place = hashed_place(by)
    own = rows.where(F.col(target).isNotNull()).select(target, F.xxhash64(*by).alias("row_hash"), place.alias("place")).distinct()
    counts = pin(own.groupBy(target).agg(F.count("*").alias("class_rows"), F.min("place").alias("least_place")))
    share = F.lit(float(max(1, min(cap, MAX_ROWS // max(1, counts.count()))))) / F.col("class_rows")
    # One narrow row of each class.
    marked = rows.join(F.broadcast(counts), target)
    return marked.where((place < share) | (place == F.col("least_place"))).select(rows.columns)


def within_bytes(rows: DataFrame, target: str, by: list[str]) -> DataFrame:
    """The rows of a sample whose texts fit in MAX_BYTES, an equal share of them for each class of ``target``.

    Rows are taken in the order of a hash of ``by``, those longer than a share
    last, until the share is used up: long texts mean fewer rows, and no class
    is without a row.
    """
    kept = pin(rows.withColumn("sample_row", F.monotonically_increasing_id()))
    sized = kept.select(target, "sample_row", F.octet_length("text").alias("n_bytes"), hashed_place(by).alias("place"))
    share = MAX_BYTES // max(1, sized.select(target).distinct().count())
    # Narrow rows of the bounded sample.
    order = W.partitionBy(target).orderBy(F.col("n_bytes") > share, "place", "sample_row")
    used = F.sum("n_bytes").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n_bytes")
    chosen = sized.withColumn("used", used).where((F.col("used") == 0) | (F.col("used") + F.col("n_bytes") <= share))
    return kept.join(F.broadcast(chosen.select("sample_row")), "sample_row", "left_semi").drop("sample_row")


def labelled_texts(docs: DataFrame, labels: DataFrame, target: str, cap: int, parts: int = 3, part: int = 1):
    """(texts, labels) of the bounded sample, without the held-out ids; in a fixed order.

    Labels other than 0 and 1 are not used; of several labels of an id the
    highest counts.
    """
    marked = (
        labels.where(F.col(target).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id", parts, part))
        .groupBy("doc_id")
        .agg(F.max(target).cast("int").alias("y"))
    )
    # At most about 2 * cap ids: small enough to send everywhere.
    chosen = F.broadcast(class_sample(marked, "y", cap, ["doc_id"]))
    found = docs.select("doc_id", "text").where("text is not null").join(chosen, "doc_id").dropDuplicates(["doc_id"])
    rows = within_bytes(found, "y", ["doc_id"]).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return [r["text"] for r in rows], [r["y"] for r in rows]

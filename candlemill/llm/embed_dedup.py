"""Near duplicates of vectors: sign hashing in several tables, exact cosine, components.

A table gives every vector ``bits`` signs of random hyperplanes. Vectors at
cosine ``c`` agree on one sign with probability ``1 - acos(c) / pi``; bits and
tables follow from the number of vectors and the recall wanted at the
threshold, so that buckets of unlike vectors stay small at every size. Vectors
of equal components are one class and take part once; each candidate pair is
verified in double precision.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import components
from candlemill.session import pin


def hash_plan(count: int, threshold: float, recall: float) -> tuple[int, int]:
    """(bits, tables): buckets of a few unlike vectors, ``recall`` for a pair at the threshold."""
    bits = min(62, max(6, math.ceil(math.log2(max(count, 2))) - 1))
    hit = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - hit))


def _arrays(column: pa.Array) -> list[np.ndarray | None]:
    """Usable vectors as doubles; None where there is none."""
    out = []
    for item in column:
        if not item.is_valid or item.values.null_count or not len(item.values):
            out.append(None)
            continue
        v = item.values.to_numpy(zero_copy_only=False).astype(np.float64)
        out.append(v if np.isfinite(v).all() and v.any() else None)
    return out


def near_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    threshold: float = 0.9,
    recall: float = 0.95,
    seed: int = 7,
) -> DataFrame:
    """One row per row of ``vectors``: (vec_id, n_links, component_id, kept).

    Vectors of cosine >= ``threshold`` are linked when a table puts them into
    one bucket; pairs below it never are. Null vectors, zero vectors, empty ones
    and those with null or non-finite components have no links; vectors of
    different lengths neither. Rows of the same components are linked with each
    other. A null id has no component and isn't kept. Other columns are not
    read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))

    def usable(batches):
        for batch in batches:
            good = _arrays(batch.column("v"))
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column("vec_id"),
                    "class": pa.array([None if x is None else (x + 0.0).tobytes() for x in good], pa.binary()),
                }
            )

    # The components as bytes tell equal vectors; -0.0 counts as 0.0.
    coded = rows.mapInArrow(usable, "vec_id long, class binary").select(
        "vec_id", F.when(F.col("class").isNotNull(), F.unhex(F.md5("class"))).alias("class"), F.col("class").alias("raw")
    )
    coded = pin(coded)
    classes = pin(
        coded.where("class is not null and vec_id is not null")
        .groupBy("class")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.min_by("raw", "vec_id").alias("raw"))
    )
    bits, tables = hash_plan(classes.count(), threshold, recall)

    def signs(batches):
        planes: dict[int, np.ndarray] = {}
        weights = (np.int64(1) << np.arange(bits, dtype=np.int64)).astype(np.int64)
        for batch in batches:
            reps = batch.column("rep").to_numpy()
            by_size: dict[int, list[int]] = {}
            arrays = [np.frombuffer(x.as_py(), np.float64) for x in batch.column("raw")]
            for i, v in enumerate(arrays):
                by_size.setdefault(len(v), []).append(i)
            for size, where in by_size.items():
                if size not in planes:
                    planes[size] = np.random.default_rng([seed, size]).standard_normal((size, tables * bits))
                for low in range(0, len(where), 512):
                    part = where[low : low + 512]
                    on = (np.stack([arrays[i] for i in part]) @ planes[size] > 0).reshape(len(part), tables, bits)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "size": pa.array(np.full(len(part) * tables, size), pa.int64()),
                            "table": pa.array(np.tile(np.arange(tables), len(part)), pa.int64()),
                            "bucket": pa.array((on @ weights).reshape(-1)),
                            "rep": pa.array(np.repeat(reps[part], tables)),
                        }
                    )

    entries = pin(classes.select("rep", "raw").mapInArrow(signs, "size long, table long, bucket long, rep long"))
    key = ["size", "table", "bucket"]
    shared = entries.join(entries.groupBy(*key).agg(F.count("*").alias("c")).where("c > 1").drop("c"), key)
    shared = pin(shared)
    pairs = (
        shared.select(*key, F.col("rep").alias("a"))
        .join(shared.select(*key, F.col("rep").alias("b")), key)
        .where("a < b")
        .select("a", "b")
        .distinct()
    )

    def close(batches):
        for batch in batches:
            keep = []
            left, right = batch.column("left"), batch.column("right")
            for low in range(0, batch.num_rows, 2000):
                high = min(low + 2000, batch.num_rows)
                x = np.stack([np.frombuffer(left[i].as_py(), np.float64) for i in range(low, high)]) if high > low else None
                by = [np.frombuffer(right[i].as_py(), np.float64) for i in range(low, high)]
                if x is None:
                    continue
                y = np.stack(by)
                x = x / np.abs(x).max(axis=1, keepdims=True)  # large components don't overflow
                y = y / np.abs(y).max(axis=1, keepdims=True)
                cosine = (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1))
                keep.append(low + np.flatnonzero(cosine >= threshold))
            taken = pa.array(np.concatenate(keep) if keep else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_pydict({"a": batch.column("a").take(taken), "b": batch.column("b").take(taken)})

    raw = classes.select("rep", "raw")
    by_size = (
        pairs.join(raw.select(F.col("rep").alias("a"), F.col("raw").alias("left")), "a")
        .join(raw.select(F.col("rep").alias("b"), F.col("raw").alias("right")), "b")
        .select("a", "b", "left", "right", F.length("left").alias("size"))
    )
    links = pin(_same_size(by_size, close))
    found = components(links)
    ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = (
        ends.join(classes.select(F.col("rep").alias("b"), "copies"), "b")
        .groupBy(F.col("a").alias("rep"))
        .agg(F.sum("copies").alias("near"))
    )
    labels = (
        classes.select("class", "rep", "copies")
        .join(degree, "rep", "left")
        .join(found.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "class",
            (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"),
            F.coalesce("root", "rep").alias("component_id"),
        )
    )
    return (
        coded.join(labels, "class", "left")
        .withColumn("usable", F.col("vec_id").isNotNull())
        .select(
            "vec_id",
            F.when(F.col("usable"), F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("usable"), F.coalesce("component_id", "vec_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )


def _same_size(pairs: DataFrame, close) -> DataFrame:
    """Verify pairs; vectors of several lengths are handled length by length in a batch."""

    def run(batches):
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                yield from close([batch.take(pa.array(np.flatnonzero(sizes == size)))])

    return pairs.mapInArrow(run, "a long, b long")

"""Helpers shared by the operators on documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.session import pin

#: Text handled at once in a Python worker, in bytes; one document may be larger.
SLICE_BYTES = 4 << 20

_MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``limit`` bytes in each."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        low = 0
        while low < len(ends):
            before = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(low, high - low)
            low = high


def map_text(df: DataFrame, columns: list[str], work: Callable[[pa.RecordBatch], dict | None], schema: str) -> DataFrame:
    """Apply ``work`` to slices of ``columns``, whose text column is ``text``.

    ``work`` is made in each task by calling the factory once, so that caches
    live as long as the task. It returns a dict of arrays for ``schema``.
    """

    def run(batches):
        handle = work()
        for part in slices(batches):
            out = handle(part)
            if out is not None:
                yield pa.RecordBatch.from_pydict(out)
        # The worker lives on; the next task may be another stage's.
        pa.default_memory_pool().release_unused()

    return df.select(*columns).mapInArrow(run, schema)


def ddl(df: DataFrame, columns: list[str]) -> str:
    """Names and types of columns as a schema string, with a comma before each."""
    return "".join(f", `{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


class WordHashes(dict):
    """64-bit hash of a word; forgets everything when it holds ``limit`` words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; of the whole sequence if it is shorter."""
    if not len(hashes):
        return hashes
    size_here = min(size, len(hashes))
    out = np.full(len(hashes) - size_here + 1, size_here, np.uint64)
    for k in range(size_here):
        out = out * _MIX[0] + hashes[k : len(hashes) - size_here + 1 + k]
        out ^= out >> np.uint64(32)
    return mix(out)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: A-Z in lower case, cut at ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def held_out(column: str, parts: int, part: int):
    """Whether crc32 of the id as text leaves ``part`` when divided by ``parts``."""
    return F.crc32(F.col(column).cast("string")) % F.lit(parts) == F.lit(part)


def hashed_place(columns: list[str]):
    """A number from 0 to 1 (not included) from a hash of ``columns``, the same for each row each time."""
    return F.pmod(F.xxhash64(*columns, F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the pairs (a, b): rows (node, root), root the least node.

    Large-star and small-star steps in turn; every step is joins and sums by
    key, written to the shared folder, until no pair changes. Nodes without a
    pair are not in the result.
    """

    def mark(df: DataFrame):
        return df.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("h")).first()

    pairs = pin(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    seen = mark(pairs)
    while seen["n"]:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(down.select("a", F.col("m").alias("b")))
            .distinct()
        )
        pairs = pin(small)
        now = mark(pairs)
        if now == seen:
            break
        seen = now
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )

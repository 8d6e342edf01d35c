"""Phrases of two and three words that stand together more often than their parts do.

Words are counted by language over slices of texts; words that are frequent
enough to be in a phrase get dense ids. Each slice's n-grams of such words are
packed, permuted and counted in counting quotient filters; filters of the same
shard are merged, and what is frequent comes back as n-grams. There is no bound
on the number of words, and no count is approximate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlemill.llm import quotient_filter as qf
from candlemill.llm.common import slices
from candlemill.operators.keys import sequential_ids
from candlemill.session import pin

MIN_COUNT = 10
#: A phrase goes if a longer one that holds it has at least this percentage of its occurrences.
INSIDE_PERCENT = 50
KEPT = 2000
SCALE = 1_000_000
UNKNOWN = "und"
#: Text whose words are numbered together, in bytes.
SLICE_BYTES = 8 << 20
#: N-grams that a task counts before it hands on its filters, and those expected in a merged filter at most.
GRAMS_AT_ONCE = 6_000_000
GRAMS_A_SHARD = 2_000_000
#: Groups of the first of two selections of the best phrases.
GROUPS = 256
_BREAK = b"."
_CUT = bytes.maketrans(b",;:!?\n\x0b\x0c\r", _BREAK * 9)


def tokens_of(text: bytes | None) -> list[bytes]:
    """Words of a text in lower case (A-Z only), and a full stop where a piece ends."""
    return (text or b"").lower().translate(_CUT).replace(_BREAK, b" . ").split()


class Numbers(dict):
    """Numbers of words in the order of their first occurrence; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _numbered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of texts by language: the different words with their counts, and the sequence of their numbers."""
    part, n = TaskContext.get().partitionId(), 0
    for batch in slices(batches, limit=limit):
        by_lang: dict[str, list[bytes | None]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            numbers = Numbers({_BREAK: 0})
            parts = []
            for text in texts:
                tokens = tokens_of(text)
                parts.append(np.fromiter(map(numbers.__getitem__, tokens), np.uint32, len(tokens)))
                parts.append(np.zeros(1, np.uint32))
            sequence = np.concatenate(parts)
            counts = np.bincount(sequence, minlength=len(numbers))[1:]
            narrow = len(numbers) <= 1 << 16
            n += 1
            yield pa.RecordBatch.from_pydict(
                {
                    "slice_id": pa.array([(part << 33) + n], pa.int64()),
                    "lang": pa.array([lang], pa.string()),
                    "words": pa.array([list(numbers)[1:]], pa.list_(pa.binary())),
                    "counts": pa.array([counts], pa.list_(pa.int64())),
                    "width": pa.array([2 if narrow else 4], pa.int32()),
                    "sequence": pa.array([sequence.astype("<u2" if narrow else "<u4").tobytes()], pa.binary()),
                }
            )


def numbered_slices(docs: DataFrame) -> DataFrame:
    """Written slices of the texts; see ``_numbered``."""
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("binary").alias("text"))
    schema = "slice_id long, lang string, words array<binary>, counts array<bigint>, width int, sequence binary"
    limit = SLICE_BYTES
    return pin(texts.mapInArrow(lambda batches: _numbered(batches, limit), schema))


def word_table(sliced: DataFrame) -> DataFrame:
    """Rows (lang, word, f) of all words."""
    each = sliced.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    return each.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f"))


def gram_filters(placed: DataFrame, id_bits: int, shard_bits: int) -> DataFrame:
    """Rows (shard, filter) from slices with the ids of their words."""

    def run(batches):
        numbers = qf.Permutation(id_bits)
        waiting, n_waiting = [], 0

        def hand_on():
            entries = qf.counted(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
            found = qf.shards_of(entries, numbers.high_bits, shard_bits)
            left = numbers.high_bits - shard_bits
            raw = [qf.encode(part, left, numbers.low_bits) for _, part in found]
            return pa.RecordBatch.from_pydict(
                {"shard": pa.array([k for k, _ in found], pa.int64()), "filter": pa.array(raw, pa.binary())}
            )

        for batch in batches:
            for row in range(batch.num_rows):
                one = {name: batch.column(name)[row] for name in batch.schema.names}
                local = np.frombuffer(one["sequence"].as_py(), "<u2" if one["width"].as_py() == 2 else "<u4")
                ids = np.zeros(int(local.max(initial=0)) + 1, np.uint64)
                if one["ids"].is_valid:
                    pairs = one["ids"].values
                    ids[pairs.field("number").to_numpy()] = pairs.field("word_id").to_numpy().astype(np.uint64)
                words = ids[local]
                known = words > 0
                for size in (2, 3):
                    if len(words) < size:
                        continue
                    at = np.flatnonzero(np.logical_and.reduce([known[k : len(known) - size + 1 + k] for k in range(size)]))
                    third = words[at + 2] if size == 3 else np.zeros(len(at), np.uint64)
                    waiting.append(numbers.forward(words[at], words[at + 1], third))
                    n_waiting += len(at)
                if n_waiting >= GRAMS_AT_ONCE:
                    yield hand_on()
                    waiting, n_waiting = [], 0
        if n_waiting:
            yield hand_on()

    return placed.select("width", "sequence", "ids").mapInArrow(run, "shard long, filter binary")


def frequent_grams(filters: DataFrame, id_bits: int, shard_bits: int, least: int) -> DataFrame:
    """Rows (one, two, three, a) of n-grams with at least ``least`` occurrences, from merged filters."""

    def merge(table: pa.Table) -> pa.Table:
        numbers = qf.Permutation(id_bits)
        left = numbers.high_bits - shard_bits
        shard = table.column("shard")[0].as_py()
        # Merged a few at a time, so that never all are unpacked at once.
        whole, parts, n = None, [], 0
        for raw in table.column("filter"):
            entries = qf.decode(raw.as_buffer().to_pybytes(), shard, left)
            parts.append(entries)
            n += len(entries.high)
            if n >= GRAMS_A_SHARD:
                whole = qf.merged([whole, *parts] if whole else parts)
                parts, n = [], 0
        whole = qf.merged([whole, *parts] if whole else parts) if parts else whole
        kept = np.flatnonzero(whole.counts >= least)
        ids = numbers.back(whole.high[kept], whole.low[kept])
        columns = {name: pa.array(x.astype(np.int64)) for name, x in zip(("one", "two", "three"), ids, strict=True)}
        return pa.table(columns | {"a": pa.array(whole.counts[kept].astype(np.int64))})

    return filters.groupBy("shard").applyInArrow(merge, "one long, two long, three long, a long")


def score_of(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)), exact for counts below 10^15."""
    wide = "cast({} as decimal(15,0))"
    top = f"cast({SCALE} as decimal(7,0)) * {wide.format(a)} * {wide.format(a)}"
    return F.expr(f"({top}) div ({wide.format(left)} * {wide.format(right)})")


def scored(grams: DataFrame, words: DataFrame) -> DataFrame:
    """Rows (lang, phrase, a, l, r, score) of all candidates that no longer one takes in."""

    def word(k: str) -> DataFrame:
        return words.select(
            F.col("word_id").alias(k), F.col("word").cast("string").alias(f"word_{k}"), F.col("f").alias(f"f_{k}"), F.col("lang").alias(f"lang_{k}")
        )

    def text(*names: str) -> Column:
        return F.concat_ws(" ", *(f"word_{k}" for k in names)).alias("phrase")

    two, three = grams.where("three = 0").drop("three"), grams.where("three > 0")
    inside = three.select("one", "two", "a").unionByName(three.select(F.col("two").alias("one"), F.col("three").alias("two"), "a"))
    most = inside.groupBy("one", "two").agg(F.max("a").alias("longer"))
    pairs = (
        two.join(most, ["one", "two"], "left")
        .where(f"longer is null or 100 * longer < {INSIDE_PERCENT} * a")
        .join(word("one"), "one")
        .join(word("two").drop("lang_two"), "two")
        .select(F.col("lang_one").alias("lang"), text("one", "two"), "a", F.col("f_one").alias("l"), F.col("f_two").alias("r"))
        .withColumn("score", score_of("a", "l", "r"))
    )
    first = two.select("one", "two", F.col("a").alias("f_first"))
    last = two.select(F.col("one").alias("two"), F.col("two").alias("three"), F.col("a").alias("f_last"))
    cuts = (
        three.join(first, ["one", "two"])
        .join(last, ["two", "three"])
        .join(word("one"), "one")
        .join(word("two").select("two", "word_two"), "two")
        .join(word("three").drop("lang_three"), "three")
        .withColumn("score_1", score_of("a", "f_one", "f_last"))
        .withColumn("score_2", score_of("a", "f_first", "f_three"))
    )
    second = F.col("score_2") < F.col("score_1")
    triples = cuts.select(
        F.col("lang_one").alias("lang"), text("one", "two", "three"), "a",
        F.when(second, F.col("f_first")).otherwise(F.col("f_one")).alias("l"),
        F.when(second, F.col("f_three")).otherwise(F.col("f_last")).alias("r"),
        F.least("score_1", "score_2").alias("score"),
    )
    return pairs.unionByName(triples)


def best(rows: DataFrame, kept: int = KEPT) -> DataFrame:
    """The first ``kept`` rows of each language with their rank; a language is first selected in many groups."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(GROUPS))
    near = (
        rows.withColumn("group", group)
        .withColumn("rank", F.row_number().over(W.partitionBy("lang", "group").orderBy(*order)))
        .where(F.col("rank") <= kept)
    )
    rank = F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")
    return near.withColumn("rank", rank).where(F.col("rank") <= kept).drop("group")


def collocations(docs: DataFrame, least: int = MIN_COUNT, kept: int = KEPT) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): the phrases of each language that hang together most.

    A null lang is ``und``, null and empty texts have no words, repeated rows
    count each time; a language without candidates has no row. Equal scores are
    ordered by a, then by the phrase's bytes. Other columns are not read.
    """
    sliced = numbered_slices(docs)
    counts = pin(word_table(sliced))
    totals = pin(counts.groupBy("lang").agg(F.sum("f").alias("n")))
    words = pin(sequential_ids(counts.where(F.col("f") >= least), [], ["lang", "word"], "word_id"))
    id_bits = max(1, words.count().bit_length())
    if id_bits > qf.MOST_ID_BITS:
        raise ValueError("too many different words")
    occurrences = 2 * (totals.agg(F.sum("n")).first()[0] or 0)
    shard_bits = min(max(0, (occurrences // GRAMS_A_SHARD).bit_length()), qf.Permutation(id_bits).high_bits - 1)

    each = sliced.select("slice_id", "lang", F.posexplode("words").alias("number", "word"))
    known = each.join(words.select("lang", "word", "word_id"), ["lang", "word"])
    ids = known.groupBy("slice_id").agg(
        F.collect_list(F.struct((F.col("number") + 1).alias("number"), "word_id")).alias("ids")
    )
    placed = sliced.select("slice_id", "width", "sequence").join(ids, "slice_id")
    filters = gram_filters(placed, id_bits, shard_bits)
    grams = pin(frequent_grams(filters, id_bits, shard_bits, least))
    ranked = best(scored(grams, words), kept)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

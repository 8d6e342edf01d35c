"""Best-fit packing by a configuration linear program over the length histogram.

The input of the plan is the number of pieces of every length from 1 to the
capacity, so its size doesn't depend on the data. The covering program "use as
few sequences as possible, each filled by a pattern of lengths, so that every
piece has a place" is solved approximately by multiplicative weights: every
length has a price; an unbounded knapsack finds the pattern of the highest
price; prices of lengths it serves fall. Patterns are used as often as the
averaged solution says, rounded down; what is left is placed best-fit by
decreasing length, also over the histogram. Pieces then find their places in
Spark: they are numbered within their length, and every number has a place in
the plan.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlemill.llm.common import map_text
from candlemill.llm.tokens import worker_encoder
from candlemill.session import pin

CAPACITY = 2048
END_ID = 0


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int, counts: np.ndarray) -> dict[int, int]:
    """Pattern of the highest total price: unbounded knapsack by dynamic programming.

    ``sizes`` ascend. A size is used at most as often as there are pieces of it.
    """
    value = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1, np.int64)
    for room in range(1, capacity + 1):
        value[room] = value[room - 1]
        fitting = np.searchsorted(sizes, room, "right")
        if fitting:
            got = value[room - sizes[:fitting]] + prices[:fitting]
            k = int(np.argmax(got))
            if got[k] > value[room]:
                value[room], choice[room] = got[k], k
    pattern: dict[int, int] = {}
    room = capacity
    while room > 0:
        k = choice[room]
        if k < 0:
            room -= 1
            continue
        pattern[int(k)] = pattern.get(int(k), 0) + 1
        room -= int(sizes[k])
    return {k: min(n, int(counts[k])) for k, n in pattern.items()}


def configuration_plan(counts: np.ndarray, capacity: int, rounds: int = 100, step: float = 0.5) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns [(length, times), ...] and how many sequences use each.

    ``counts[s]`` is the number of pieces of length s. Each piece gets exactly
    one place.
    """
    left = counts.astype(np.int64).copy()
    plan: list[tuple[list[tuple[int, int]], int]] = []
    if left[capacity]:
        plan.append(([(capacity, 1)], int(left[capacity])))
        left[capacity] = 0
    sizes = np.flatnonzero(left)
    if len(sizes):
        demand = left[sizes].astype(float)
        # Prices start at the size: a full sequence is worth its capacity.
        weight = sizes / capacity
        used: dict[tuple[tuple[int, int], ...], float] = {}
        served = np.zeros(len(sizes))
        for _ in range(rounds):
            pattern = best_pattern(weight, sizes, capacity, left[sizes])
            if not pattern:
                break
            at = np.fromiter(pattern, np.int64)
            times = np.array([pattern[k] for k in at], float)
            # As many sequences as the scarcest length allows in this round.
            amount = float((demand[at] / times).min()) * step
            key = tuple(sorted((int(sizes[k]), pattern[int(k)]) for k in at))
            used[key] = used.get(key, 0.0) + amount
            served[at] += amount * times
            weight[at] *= np.exp(-step * amount * times / demand[at])
        # Scale the averaged solution so that no length is served more than it needs.
        for key, amount in sorted(used.items(), key=lambda x: -x[1]):
            most = min(int(left[s] // t) for s, t in key)
            ratio = max(max(served[np.searchsorted(sizes, s)] / demand[np.searchsorted(sizes, s)] for s, _ in key), 1.0)
            number = min(int(amount / ratio), most)
            if number:
                plan.append((list(key), number))
                for s, t in key:
                    left[s] -= number * t
    plan.extend(_best_fit(left, capacity))
    return plan


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best-fit decreasing over a histogram: fill a sequence greedily, use it while the pieces last.

    A sequence starts with the longest piece left and takes the fullest filling
    that the pieces left allow. The sums that fillings reach are the bits of an
    integer; it is shifted by a length once for each piece of it.
    """
    left = left.copy()
    plan = []
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        left[longest] -= 1
        pattern = {longest: 1}
        room = capacity - longest
        mask, reach, before = (2 << room) - 1, 1, []
        for size in np.flatnonzero(left[: room + 1])[::-1].tolist():
            before.append((size, reach))
            for _ in range(min(int(left[size]), room // size)):
                reach |= reach << size & mask
            if reach >> room & 1:
                break
        total = reach.bit_length() - 1
        for size, held in reversed(before):
            while not held >> total & 1:
                total -= size
                pattern[size] = pattern.get(size, 0) + 1
        left[longest] += 1
        number = min(int(left[s]) // t for s, t in pattern.items())
        for s, t in pattern.items():
            left[s] -= number * t
        plan.append((sorted(pattern.items()), number))
    return plan


def places(plan: list[tuple[list[tuple[int, int]], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: arrays (first number, times in a sequence, first sequence, offset) of its runs of places."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    given: dict[int, int] = {}
    sequence = 0
    for pattern, number in plan:
        offset = 0
        for size, times in pattern:
            runs.setdefault(size, []).append((given.get(size, 0), times, sequence, offset))
            given[size] = given.get(size, 0) + times * number
            offset += size * times
        sequence += number
    return {size: tuple(np.array(x, np.int64) for x in zip(*rows, strict=True)) for size, rows in runs.items()}


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32): documents as token ids, cut at the capacity."""

    def work():
        encoder = worker_encoder(vocabulary)

        def handle(batch):
            owner, piece, start, length, crc = [], [], [], [], []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text").to_pylist()), strict=True):
                raw = np.append(ids, END_ID).astype("<u4").tobytes()
                for k, low in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[low : low + 4 * capacity]
                    owner.append(doc), piece.append(k), start.append(low // 4), length.append(len(part) // 4), crc.append(zlib.crc32(part))
            return {
                "doc_id": pa.array(owner, pa.int64()),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }

        return handle

    return map_text(docs, ["doc_id", "text"], work, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    A document is its token ids and an end id; longer ones are cut into pieces
    of ``capacity``, the last may be shorter. Null and empty texts are one piece
    of the end id. Every row of ``docs`` is packed, also repeated rows and null
    ids. Within a sequence the pieces lie without gaps from offset 0. An empty
    table gives no rows. Other columns are not read.
    """
    cut = pin(pieces(docs, capacity, vocabulary))
    # Number the pieces within their length: in each part of the table, after those of the parts before.
    parts = cut.withColumn("part", F.spark_partition_id())
    numbered = pin(_numbered(parts))
    histogram = numbered.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in histogram.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["n"]
    where = places(configuration_plan(counts, capacity))
    before = histogram.select(
        "part",
        "length",
        (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"),
    )

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("before").to_numpy() + batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for size in np.unique(length):
                at = np.flatnonzero(length == size)
                first, times, start, begin = where[int(size)]
                run = np.searchsorted(first, number[at], "right") - 1
                inside = number[at] - first[run]
                sequence[at] = start[run] + inside // times[run]
                offset[at] = begin[run] + inside % times[run] * size
            yield pa.RecordBatch.from_pydict(
                {c: batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
                | {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
            )

    return (
        numbered.join(before, ["part", "length"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", "rank", "before")
        .mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    )


def _numbered(parts: DataFrame) -> DataFrame:
    """Add ``rank``: the number of the piece among those of its length in its part, from 0."""

    def count(batches):
        seen: dict[int, int] = {}
        for batch in batches:
            length = batch.column("length").to_numpy()
            order = np.argsort(length, kind="stable")
            held = length[order]
            first = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]])) if len(held) else np.zeros(0, np.int64)
            sizes = np.diff(np.append(first, len(held)))
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(held)) - np.repeat(first, sizes) + np.repeat([seen.get(int(held[k]), 0) for k in first], sizes)
            for k, n in zip(first, sizes, strict=True):
                seen[int(held[k])] = seen.get(int(held[k]), 0) + int(n)
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in batch.schema.names} | {"rank": pa.array(rank)})

    return parts.mapInArrow(
        count, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"
    )

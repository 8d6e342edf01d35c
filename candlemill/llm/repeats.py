"""Repeated byte strings, found by anchors, hashes of contexts and suffix order.

A string of ``length`` bytes that starts in two places has, in both, the same
*anchor*: the least hash of the ``GRAM``-byte strings in it (the first of
equals). So every start of such a string belongs to one anchor, the anchors of
all documents are a small sample of their positions, and equal strings meet
under equal anchors, wherever they are.

1. Every anchor is written with a hash of its *context*: all bytes of the
   strings that belong to it. Anchors of one place drop out.
2. Contexts that occur again as a whole are repeated as a whole.
3. The distinct contexts of an anchor go to one task. Their suffixes are
   ordered by prefix doubling. The previous and next smaller place of a suffix
   in that order give its longest previous factor, the previous and next greater
   one its longest next factor; a string is a later copy if the first reaches
   ``length``, and one that is repeated later if the second does.
4. An anchor with more than ``CROWD`` distinct contexts (the edge of a passage
   in very many documents) is not given to one task: its strings are counted by
   their 128-bit hashes instead, with sums before the shuffle.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import map_text, mix
from candlemill.session import pin

GRAM = 64
#: Text whose anchors are searched at once, in bytes.
BLOCK = 1 << 17
CROWD = 64
#: Contexts whose suffixes are ordered at once, in bytes.
SUFFIXES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64((1 << 18) - 1)


def raw_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of every string of ``size`` (a power of two) bytes."""
    out = mix(data.astype(np.uint64) + np.uint64(1))
    width, base = 1, _BASE
    with np.errstate(over="ignore"):
        while width < size:
            out = out[:-width] * base + out[width:]
            base = base * base
            width *= 2
    return mix(out)


def window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` values in a row."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(data: bytes, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor position, first start, last start) of the strings of ``length`` bytes."""
    starts = len(data) - length + 1
    if starts <= 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    found = []
    width = length - gram + 1
    for low in range(0, starts, BLOCK):
        count = min(BLOCK, starts - low)
        part = np.frombuffer(data, np.uint8, count + length - 1, low)
        hashes = gram_hashes(part, gram)
        # Hash above, place below: the least is the first of the least hashes.
        keys = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
        found.append((window_least(keys, width) & _LOW).astype(np.int64) + low)
    at = np.concatenate(found)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:], [starts]]) - 1
    return at[first], first, last


def doubled_ranks(data: np.ndarray, length: int) -> dict[int, np.ndarray]:
    """Prefix doubling: {width: rank of the string of that width at every position}.

    Widths are 8, 16, ... and ``length`` (only ``length`` if it is below 8);
    equal strings have equal ranks, and ranks of a width are in the order of
    its strings. Positions with less bytes left than the width have no rank.
    """
    if len(data) < length:
        return {length: np.zeros(0, np.int64)}
    width = min(8, length)
    ranks = {width: np.unique(_leading(data, width), return_inverse=True)[1]}
    while width < length:
        held = ranks[width].astype(np.uint64)
        step = min(width, length - width)
        pairs = (held[: len(held) - step] << np.uint64(32)) | held[step:]
        width += step
        ranks[width] = np.unique(pairs, return_inverse=True)[1]
    return ranks


def _leading(data: np.ndarray, width: int) -> np.ndarray:
    """The string of ``width`` (at most 8) bytes at every position as a big-endian number."""
    keys = np.zeros(len(data) - width + 1, np.uint64)
    for k in range(width):
        keys = (keys << np.uint64(8)) | data[k : len(data) - width + 1 + k].astype(np.uint64)
    return keys


def common_lengths(ranks: dict[int, np.ndarray], x: np.ndarray, y: np.ndarray, length: int) -> np.ndarray:
    """How many bytes the strings at ``x`` and ``y`` have in common, ``length`` at most.

    From the widest rank down; every width is passed at most once, as what is
    left is shorter than twice the width. Bytes below the least width don't count.
    """
    out = np.zeros(len(x), np.int64)
    for width in sorted(ranks, reverse=True):
        at = np.flatnonzero(out + width <= length)
        same = ranks[width][x[at] + out[at]] == ranks[width][y[at] + out[at]]
        out[at[same]] += width
    return out


def longest_earlier(values: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Longest match of each suffix with the nearest one before it, in suffix order, that has a smaller value.

    ``shared[i]`` is what the suffixes i - 1 and i have in common. All
    candidates move at once: from a suffix that is no smaller to its own
    candidate, as what lies between is no smaller either; the match becomes the
    least on the way, and a suffix without any match stops.
    """
    at = np.arange(len(values)) - 1
    match = shared.copy()
    match[:1] = 0
    moving = np.flatnonzero(match > 0)
    while len(moving := moving[values[at[moving]] > values[moving]]):
        over = at[moving]
        match[moving], at[moving] = np.minimum(match[moving], match[over]), at[over]
        moving = moving[match[moving] > 0]
    return match


def longest_factors(ranks: dict[int, np.ndarray], starts: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Arrays of the longest previous and the longest next factor of the suffixes at ``starts``, cut at ``length``.

    The longest match of a suffix with one at a smaller place is that with the
    previous or the next smaller place in suffix order; for greater places
    likewise. Suffixes are ordered by their first ``length`` bytes, ties by place.
    """
    order = np.lexsort((places, ranks[length][starts]))
    at, values = starts[order], places[order]
    shared = np.zeros(len(order) + 1, np.int64)
    shared[1:-1] = common_lengths(ranks, at[:-1], at[1:], length)
    found = []
    for value in (values, -values):
        before = longest_earlier(value, shared[:-1])
        after = longest_earlier(value[::-1], shared[:0:-1])[::-1]
        factor = np.empty(len(order), np.int64)
        factor[order] = np.maximum(before, after)
        found.append(factor)
    return found[0], found[1]


def _anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    """Rows (doc, at, lo, hi, anchor, context): every anchor, the starts it holds, hashes of both."""

    def work():
        def handle(batch):
            docs_, ats, los, his, grams, contexts = [], [], [], [], [], []
            keys = batch.column("doc")
            for i, text in enumerate(batch.column("text").to_pylist()):
                data = raw_bytes(text)
                at, lo, hi = anchors(data, length)
                if not len(at):
                    continue
                view = memoryview(data)
                docs_.append((keys[i].as_py(), len(at)))
                ats.append(at), los.append(lo), his.append(hi)
                for a, b, c in zip(at.tolist(), lo.tolist(), hi.tolist(), strict=True):
                    grams.append(xxhash.xxh3_64_intdigest(view[a : a + GRAM]))
                    # The place of the anchor in its context belongs to it.
                    contexts.append(xxhash.xxh3_128_digest(view[b : c + length], a - b))
            if not docs_:
                return None
            return {
                "doc": pa.array([k for k, n in docs_ for _ in range(n)], pa.binary()),
                "at": pa.array(np.concatenate(ats)),
                "lo": pa.array(np.concatenate(los)),
                "hi": pa.array(np.concatenate(his)),
                "anchor": pa.array(np.array(grams, np.uint64).view(np.int64)),
                "context": pa.array(contexts, pa.binary()),
            }

        return handle

    return map_text(docs, ["doc", "text"], work, "doc binary, at long, lo long, hi long, anchor long, context binary")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc, doc_id, text): ``doc`` tells rows of different id or text apart and is in the order of ids, null ids last.

    It has the id with its sign bit turned, so that bytes sort as numbers, and 96 bits of a hash of id and text.
    """
    number = F.coalesce(F.col("doc_id").cast("long").bitwiseXOR(F.lit(-(2**63))), F.lit(-1).cast("long"))
    row = F.md5(F.concat_ws("\0", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))))
    key = F.unhex(F.concat(F.lpad(F.hex(number), 16, "0"), F.substring(row, 1, 24)))
    return docs.select(key.alias("doc"), "doc_id", "text")


def repeated_starts(docs: DataFrame, length: int = 400, keep_first: bool = False) -> DataFrame:
    """Rows (doc, lo, hi): starts lo..hi of strings of ``length`` bytes that start elsewhere too.

    With ``keep_first`` the first start of each string, in the order of (doc_id,
    place), is left out. ``docs`` has the columns of ``keyed``.
    """
    rows = pin(_anchor_rows(docs, length))
    # Rows of equal (doc, text) have equal places; they count as often as they are there.
    contexts = rows.groupBy("anchor", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("doc", "at", "lo", "hi")).alias("one")
    )
    contexts = pin(contexts)
    crowds = contexts.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("n").alias("places")).where("places > 1")
    marked = pin(contexts.join(crowds, "anchor"))

    whole = (
        rows.join(marked.where("n > 1").select("anchor", "context", "one"), ["anchor", "context"])
        .where(F.lit(not keep_first) | (F.struct("doc", "at", "lo", "hi") != F.col("one")))
        .select("doc", "lo", "hi")
    )
    # The bytes of one context of each kind, where an anchor has several.
    wanted = pin(marked.where("kinds > 1").select("anchor", "kinds", "n", "one.*"))
    texts = docs.select("doc", "text").join(wanted.select("doc").distinct(), "doc", "left_semi").dropDuplicates(["doc"])

    lists = wanted.groupBy("doc").agg(F.collect_list(F.struct("anchor", "kinds", "n", "at", "lo", "hi")).alias("places"))

    def cut_lists(batches):
        """Contexts of a document at a time; its list is bounded by its length."""
        for batch in batches:
            for i in range(batch.num_rows):
                data = raw_bytes(batch.column("text")[i].as_py())
                places = batch.column("places")[i].values
                fields = {c: places.field(c) for c in ("anchor", "kinds", "n", "at", "lo", "hi")}
                lo, hi = fields["lo"].to_numpy(), fields["hi"].to_numpy()
                yield pa.RecordBatch.from_pydict(
                    fields
                    | {
                        "doc": pa.array([batch.column("doc")[i].as_py()] * len(lo), pa.binary()),
                        "bytes": pa.array([data[a : b + length] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)], pa.binary()),
                    }
                )

    pieces = pin(
        texts.join(lists, "doc").select("doc", "text", "places").mapInArrow(
            cut_lists, "anchor long, kinds long, n long, at long, lo long, hi long, doc binary, bytes binary"
        )
    )

    def suffixes(table: pa.Table) -> pa.RecordBatch:
        """The contexts of some anchors: which strings start elsewhere among them.

        Equal strings have equal anchors, so contexts of several anchors can
        share one suffix order.
        """
        raws, docs_ = table.column("bytes").to_pylist(), table.column("doc").to_pylist()
        lo, n = table.column("lo").to_numpy(), table.column("n").to_numpy()
        number = {d: k for k, d in enumerate(sorted(set(docs_)))}
        sizes = np.array([len(x) for x in raws])
        counts = sizes - length + 1
        owner = np.repeat(np.arange(len(raws)), counts)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = np.repeat(np.cumsum(sizes) - sizes, counts) + inside
        at = lo[owner] + inside
        place = (np.array([number[d] for d in docs_])[owner] << 40) + at
        ranks = doubled_ranks(np.frombuffer(b"".join(raws), np.uint8), length)
        previous, following = longest_factors(ranks, starts, place, length)
        earlier = previous >= length
        rows_ = np.flatnonzero(earlier if keep_first else earlier | (following >= length) | (n[owner] > 1))
        at, owner = at[rows_], owner[rows_]
        new = np.ones(len(rows_), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(rows_)]])[: len(first)] - 1
        return pa.RecordBatch.from_pydict(
            {
                "doc": pa.array([docs_[k] for k in owner[first]], pa.binary()),
                "lo": pa.array(at[first], pa.int64()),
                "hi": pa.array(at[last], pa.int64()),
            }
        )

    def by_anchor(batches):
        """Whole anchors, about ``SUFFIXES`` bytes at once; the last anchor of a batch waits for the next."""
        held = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            names = table.column("anchor").to_numpy()
            ends = np.flatnonzero(names[1:] != names[:-1]) + 1  # where an anchor ends and another begins
            filled = np.cumsum(pc.binary_length(table.column("bytes")).to_numpy())
            low = 0
            for k, end in enumerate(ends):
                if k + 1 == len(ends) or filled[end - 1] - (filled[low - 1] if low else 0) >= SUFFIXES:
                    yield suffixes(table.slice(low, end - low))
                    low = end
            held = table.slice(low).combine_chunks().to_batches()
        if held:
            yield suffixes(pa.Table.from_batches(held))

    few = (
        pieces.where(F.col("kinds") <= CROWD)
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(by_anchor, "doc binary, lo long, hi long")
    )

    def strings(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                raw = memoryview(batch.column("bytes")[i].as_py())
                count = len(raw) - length + 1
                lo = batch.column("lo")[i].as_py()
                yield pa.RecordBatch.from_pydict(
                    {
                        "string": pa.array([xxhash.xxh3_128_digest(raw[k : k + length]) for k in range(count)], pa.binary()),
                        "doc": pa.array([batch.column("doc")[i].as_py()] * count, pa.binary()),
                        "lo": pa.array(np.arange(lo, lo + count)),
                        "n": pa.array(np.full(count, batch.column("n")[i].as_py())),
                    }
                )

    crowd = pieces.where(F.col("kinds") > CROWD).select("bytes", "doc", "lo", "n").mapInArrow(
        strings, "string binary, doc binary, lo long, n long"
    )
    counted = crowd.groupBy("string").agg(F.sum("n").alias("places"), F.min(F.struct("doc", "lo")).alias("one")).where("places > 1")
    many = (
        crowd.join(counted, "string")
        .where(F.lit(not keep_first) | (F.struct("doc", "lo") != F.col("one")))
        .select("doc", "lo", F.col("lo").alias("hi"))
    )
    return whole.unionByName(few).unionByName(many)


def remove_repeats(docs: DataFrame, length: int = 400, keep_first: bool = False) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept).

    Removes every byte covered by a string of ``length`` bytes that also starts
    elsewhere, in the same document or another; with ``keep_first`` the first
    of its places stays, that of the least doc_id (null ids come last). Null and short texts lose nothing. Strings are judged
    on the input. Rows of equal id and text are cut alike. ``spans`` are the maximal removed runs (start, end), ``kept``
    the remaining bytes. Repeated rows repeat each other. Other columns are not
    read.
    """
    source = keyed(docs)
    found = pin(repeated_starts(source, length, keep_first))
    spans = found.groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("starts"))

    def work():
        def handle(batch):
            rows = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept")}
            for text, starts in zip(batch.column("text"), batch.column("starts"), strict=True):
                data = raw_bytes(text.as_py())
                cuts = []
                if starts.is_valid:
                    lo = starts.values.field("lo").to_numpy()
                    hi = starts.values.field("hi").to_numpy() + length
                    order = np.argsort(lo, kind="stable")
                    lo, reach = lo[order], np.maximum.accumulate(hi[order])
                    first = np.flatnonzero(np.concatenate([[True], lo[1:] > reach[:-1]]))
                    last = np.concatenate([first[1:], [len(lo)]]) - 1
                    cuts = list(zip(lo[first].tolist(), reach[last].tolist(), strict=True))
                kept, at = [], 0
                for a, b in cuts:
                    kept.append(data[at:a])
                    at = b
                rest = b"".join([*kept, data[at:]])
                rows["n_bytes"].append(len(data))
                rows["n_removed"].append(len(data) - len(rest))
                rows["n_spans"].append(len(cuts))
                rows["kept_sha256"].append(hashlib.sha256(rest).hexdigest())
                rows["spans"].append([{"start": a, "end": b} for a, b in cuts])
                rows["kept"].append(rest)
            kinds = {
                "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(),
                "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), "kept": pa.binary(),
            }
            return {"doc_id": batch.column("doc_id")} | {k: pa.array(v, kinds[k]) for k, v in rows.items()}

        return handle

    return map_text(
        source.join(spans, "doc", "left"),
        ["doc_id", "text", "starts"],
        work,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string,"
        " spans array<struct<start: long, end: long>>, kept binary",
    )

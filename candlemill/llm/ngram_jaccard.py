"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct word shingles. Two sets x, y with Jaccard
similarity of at least t share tokens in every fixed order of the tokens: of
the first ``n - ceil(t n) + l`` tokens of both, at least ``l`` are the same.

1. The first order is that of the token hashes; a prefix with ``l = n / 10`` is
   the *sketch* of a document. Only sketches are shuffled.
2. In the sketches, tokens are ordered by their number of documents, rarest
   first. Tokens of one document come first and cost nothing. The prefix that
   needs one shared token is lengthened by ``e`` tokens, ``e`` chosen for each
   document by estimated cost; a pair is a candidate if it shares
   ``1 + min(e_x, e_y)`` tokens of both prefixes.
3. Candidates are verified on whole sets.

Classes of equal sets are found first and take part once. In dense groups the
candidates would grow with the square of the group, so two things come first.
Tokens that only one of the documents with postings has are counted on whole
sets: ``n - u`` bounds every intersection; and parities of whole sets bound
their difference: both rule out nearly all unlike pairs of a group, and no
other. And the join first verifies only pairs with a *pivot* of each token
(the document with the smallest share of own tokens, the middle of its group),
and components follow; afterwards only candidates of different components
remain, which can change the components. No link between components is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import WordHashes, components, map_text, shingle_hashes, words_of
from candlemill.session import pin

#: Cost of verifying one candidate, in postings read.
VERIFY_COST = 8.0
#: Lengths by which a prefix may grow, as shares of the room in the sketch.
GROWTH = (0.0, 0.25, 0.5, 1.0)
PIVOT_ROUNDS = 3
#: Integers of parities that rule out unlike pairs before their sets are compared.
MARKS = 8


def least_shared(n, percent: int):
    """Tokens that a set of ``n`` must share with any set similar to it."""
    return -(-n * percent // 100)


def sketch_room(n):
    """Tokens by which a sketch is longer than the prefix of no shared token."""
    return max(1, -(-n // 10))


def sketch_length(n: int, percent: int) -> int:
    """Tokens of a set of ``n`` in its sketch.

    Two similar sets share at least the smaller room of the two in their
    sketches, and the smaller set has at least ``least_shared(n)`` tokens.
    """
    return n - least_shared(n, percent) + sketch_room(n) if n else 0


def shingle_set(hashes: WordHashes, text: str | None, size: int) -> np.ndarray:
    return np.unique(shingle_hashes(hashes.of(words_of(text)), size))


def sketches(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Rows (doc_id, n_shingles, digest, sketch): set size, hash of the set, sketch tokens."""

    def work():
        hashes = WordHashes()

        def handle(batch):
            counts, digests, kept = [], [], []
            for text in batch.column("text").to_pylist():
                tokens = shingle_set(hashes, text, size)
                n = len(tokens)
                counts.append(n)
                digests.append(xxhash.xxh3_128_digest(tokens.tobytes()))
                kept.append(tokens[: sketch_length(n, percent)].tobytes())
            return {
                "doc_id": batch.column("doc_id"),
                "n_shingles": pa.array(counts, pa.int64()),
                "digest": pa.array(digests, pa.binary()),
                "sketch": pa.array(kept, pa.binary()),
            }

        return handle

    return map_text(docs, ["doc_id", "text"], work, "doc_id long, n_shingles long, digest binary, sketch binary")


def postings(sketched: DataFrame, percent: int) -> DataFrame:
    """Rows (token, rep, n, extra, df): the chosen prefix of each document, without tokens of one document."""

    def explode(batches):
        for batch in batches:
            reps, sizes, raw = (batch.column(c) for c in ("rep", "n", "sketch"))
            arrays = [np.frombuffer(x.as_py(), np.int64) for x in raw]
            lengths = [len(a) for a in arrays]
            # A slice at a time: a batch holds up to 10,000 documents.
            for low in range(0, len(arrays), 500):
                part = lengths[low : low + 500]
                if not sum(part):
                    continue
                yield pa.RecordBatch.from_pydict(
                    {
                        "token": pa.array(np.concatenate(arrays[low : low + 500])),
                        "rep": pa.array(np.repeat(reps.slice(low, 500).to_numpy(zero_copy_only=False), part)),
                        "n": pa.array(np.repeat(sizes.slice(low, 500).to_numpy(zero_copy_only=False), part)),
                    }
                )

    tokens = sketched.select("rep", "n", "sketch").mapInArrow(explode, "token long, rep long, n long")
    # One document has a token once; what is left of a token after the count are its documents.
    counted = tokens.groupBy("token").agg(
        F.count("*").alias("df")
    ).where("df > 1").select("token", "df")
    shared = pin(tokens.join(counted, "token"))

    # (token, df) lists by document; a list is bounded by the sketch of the document.
    lists = shared.groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("tokens"))

    def choose(batches):
        for batch in batches:
            rep_out, n_out, extra_out, token_out = [], [], [], []
            for rep, n, tokens in zip(*(batch.column(c) for c in ("rep", "n", "tokens")), strict=True):
                rep, n = rep.as_py(), n.as_py()
                values = tokens.values
                df = values.field("df").to_numpy()
                token = values.field("token").to_numpy()
                whole = sketch_length(n, percent)
                # Any similar set shares so many tokens of the sketch.
                room = sketch_room(least_shared(n, percent))
                base = whole - room
                alone = whole - len(df)  # tokens of this document only come first
                read = np.concatenate([[0], np.cumsum(df - 1)])
                best = None
                for e in sorted({int(g * (room - 1)) for g in GROWTH}):
                    take = min(max(0, base + 1 + e - alone), len(df))
                    cost = read[take] + VERIFY_COST * read[take] / (1 + e)
                    if best is None or cost < best[0]:
                        best = (cost, e, take)
                _, e, take = best
                if take:
                    rep_out.append(np.full(take, rep))
                    n_out.append(np.full(take, n))
                    extra_out.append(np.full(take, e))
                    token_out.append(token[:take])
            if rep_out:
                yield pa.RecordBatch.from_pydict(
                    {
                        "token": pa.array(np.concatenate(token_out)),
                        "rep": pa.array(np.concatenate(rep_out)),
                        "n": pa.array(np.concatenate(n_out)),
                        "extra": pa.array(np.concatenate(extra_out)),
                    }
                )

    chosen = lists.mapInArrow(choose, "token long, rep long, n long, extra long")
    return pin(chosen)


def _can_be_similar(percent: int) -> str:
    """Whether the tokens that others have at all, and the sizes, allow a similar pair."""
    return f"{100 + percent} * least(n_a - u_a, n_b - u_b) >= {percent} * (n_a + n_b)"


def parities(tokens: np.ndarray) -> np.ndarray:
    """``MARKS`` integers of 64 parities: of the number of tokens with each remainder.

    Two sets differ in at least as many tokens as their parities differ in bits.
    """
    odd = np.bincount((tokens % np.uint64(64 * MARKS)).astype(np.int64), minlength=64 * MARKS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _marks_allow(percent: int) -> str:
    differ = " + ".join(f"bit_count(a_m{k} ^ b_m{k})" for k in range(MARKS))
    return f"{100 + percent} * ({differ}) <= {100 - percent} * (n_a + n_b)"


def own_tokens(sets: DataFrame) -> DataFrame:
    """Rows (rep, u): how many tokens of a whole set no other set has."""

    def explode(batches):
        for batch in batches:
            reps = batch.column("rep").to_numpy()
            for low in range(0, batch.num_rows, 200):
                arrays = [np.frombuffer(x.as_py(), np.int64) for x in batch.column("tokens").slice(low, 200)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "token": pa.array(np.concatenate(arrays)),
                        "rep": pa.array(np.repeat(reps[low : low + 200], [len(a) for a in arrays])),
                    }
                )

    tokens = sets.select("rep", "tokens").mapInArrow(explode, "token long, rep long")
    alone = tokens.groupBy("token").agg(F.count("*").alias("df"), F.min("rep").alias("rep")).where("df = 1")
    return alone.groupBy("rep").agg(F.count("*").alias("u"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar, with the size of the intersection."""

    def check(batches):
        for batch in batches:
            left, right = batch.column("left"), batch.column("right")
            keep, shared = [], []
            for i in range(batch.num_rows):
                x = np.frombuffer(left[i].as_py(), np.uint64)
                y = np.frombuffer(right[i].as_py(), np.uint64)
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int((y[at] == x).sum()) if len(y) else 0
                if both and 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
                    shared.append(both)
            taken = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_pydict(
                {"a": batch.column("a").take(taken), "b": batch.column("b").take(taken), "shared": pa.array(shared, pa.int64())}
            )

    joined = (
        pairs.select("a", "b")
        .join(sets.select(F.col("rep").alias("a"), F.col("tokens").alias("left")), "a")
        .join(sets.select(F.col("rep").alias("b"), F.col("tokens").alias("right")), "b")
    )
    return joined.select("a", "b", "left", "right").mapInArrow(check, "a long, b long, shared long")


def jaccard_classes(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id).

    Documents with ``100 * |x & y| >= percent * |x | y|`` are linked;
    ``component_id`` is the least doc_id reached by links. Documents without
    words, and rows with a null doc_id, have no links: a document without words
    is its own component, a null id has a null component. Repeated ids take
    part with all their texts. Other columns are not read.
    """
    spark = docs.sparkSession
    sketched = pin(sketches(docs, size, percent))
    classes = pin(
        sketched.where("n_shingles > 0 and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"))
    )
    # One sketch for each class; an id with several texts stands for all of them.
    one = sketched.join(
        classes.select("digest", F.col("rep").alias("doc_id")), ["digest", "doc_id"], "left_semi"
    ).dropDuplicates(["doc_id", "digest"])
    posted = postings(one.select(F.xxhash64("digest").alias("rep"), F.col("n_shingles").alias("n"), "sketch"), percent)

    def keyed(batch_docs: DataFrame) -> DataFrame:
        """Whole sets (rep, tokens) of the texts that have postings."""

        def work():
            hashes = WordHashes()

            def handle(batch):
                found = [shingle_set(hashes, text, size) for text in batch.column("text").to_pylist()]
                tokens = [x.tobytes() for x in found]
                marks = np.array([parities(x) for x in found], np.int64).reshape(-1, MARKS)
                return {
                    "digest": pa.array([xxhash.xxh3_128_digest(t) for t in tokens], pa.binary()),
                    "tokens": pa.array(tokens, pa.binary()),
                } | {f"m{k}": pa.array(marks[:, k].copy()) for k in range(MARKS)}

            return handle

        marks = [f"m{k}" for k in range(MARKS)]
        return map_text(
            batch_docs, ["text"], work, "digest binary, tokens binary" + "".join(f", {m} long" for m in marks)
        ).select(F.xxhash64("digest").alias("rep"), "tokens", *marks)

    wanted = posted.select("rep").distinct()
    owners = classes.select(F.xxhash64("digest").alias("rep"), F.col("rep").alias("doc_id")).join(wanted, "rep", "left_semi")
    sets = pin(
        keyed(docs.select("doc_id", "text").join(owners.select("doc_id").distinct(), "doc_id", "left_semi"))
        .join(wanted, "rep", "left_semi")
        .dropDuplicates(["rep"])
    )

    # A document with too many own tokens has no similar one.
    posted = pin(
        posted.join(own_tokens(sets), "rep", "left")
        .withColumn("u", F.coalesce("u", F.lit(0)))
        .where(f"100 * (n - u) >= {percent} * n")
    )
    links = spark.createDataFrame([], "a long, b long")
    found = spark.createDataFrame([], "node long, root long")
    for turn in range(PIVOT_ROUNDS):
        labelled = pin(
            posted.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
        )
        # Lists whose documents are all of one component have nothing to add.
        order = F.col("u") / F.col("n") + F.pmod(F.xxhash64("rep", F.lit(turn)), F.lit(1000)) * (turn / 10_000)
        pivots = labelled.groupBy("token").agg(
            *(F.min_by(c, order).alias(f"p_{c}") for c in ("rep", "root", "n", "u")), F.min("root").alias("r0"), F.max("root").alias("r1")
        ).where("r0 <> r1")
        near = (
            labelled.join(pivots.select("token", "p_rep", "p_root", "p_n", "p_u"), "token")
            .where("root <> p_root")
            .select(
                F.least("rep", "p_rep").alias("a"), F.greatest("rep", "p_rep").alias("b"),
                F.col("n").alias("n_a"), F.col("p_n").alias("n_b"), F.col("u").alias("u_a"), F.col("p_u").alias("u_b"),
            )
            .where(_can_be_similar(percent))
            .select("a", "b")
            .distinct()
        )
        fresh = pin(verified(near, sets, percent).select("a", "b"))
        if fresh.isEmpty():
            break
        links = links.unionByName(fresh)
        found = components(links)

    labelled = pin(
        posted.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    )
    # A list is cut by component. Its most frequent component meets the others, and those meet each other.
    parts = labelled.groupBy("token", "root").agg(F.count("*").alias("c"))
    mixed = parts.groupBy("token").agg(
        F.count("*").alias("k"), F.max(F.struct("c", "root"))["root"].alias("main")
    ).where("k > 1").select("token", "main")
    marks = [f"m{k}" for k in range(MARKS)]
    lists = pin(labelled.join(mixed, "token").join(sets.select("rep", *marks), "rep"))
    left = lists.where("root <> main").select(
        "token", F.col("rep").alias("x"), F.col("n").alias("n_a"), F.col("u").alias("u_a"),
        F.col("extra").alias("e_a"), F.col("root").alias("root_a"), *(F.col(m).alias(f"a_{m}") for m in marks),
    )
    right = lists.select(
        "token", F.col("rep").alias("y"), F.col("n").alias("n_b"), F.col("u").alias("u_b"), F.col("extra").alias("e_b"),
        F.col("root").alias("root_b"), F.col("main").alias("main_b"), *(F.col(m).alias(f"b_{m}") for m in marks),
    )
    rest = (
        left.join(right, "token")
        .where(f"root_a <> root_b and (root_b = main_b or x < y) and {_can_be_similar(percent)} and {_marks_allow(percent)}")
        .groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .agg(F.count("*").alias("m"), F.least(F.first("e_a"), F.first("e_b")).alias("e"))
        .where("m >= 1 + e")
    )
    last = pin(verified(rest, sets, percent).select("a", "b"))
    if not last.isEmpty():
        found = components(links.unionByName(last))
    return _attach(sketched, classes, found)


def _attach(sketched: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """Carry the least doc_id of each component to all documents of its classes."""
    # An id with several texts joins the components of all of them.
    members = classes.select(F.xxhash64("digest").alias("node"), "digest", "rep").join(found, "node", "left").select(
        "digest", F.coalesce("root", "node").alias("root"), "rep"
    )
    least = members.groupBy("root").agg(F.min("rep").alias("component_id"))
    labels = members.join(least, "root").select("digest", "component_id")
    return sketched.join(labels, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )

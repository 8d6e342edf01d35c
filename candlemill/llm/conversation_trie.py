"""Prefix trie of conversations by truncation peeling.

A node is a distinct sequence of first turns. Conversations that are equal turn
by turn become one bundle. From the greatest depth that bundles share, one level
after the other is peeled: the bundles that end there, or whose own tail begins
there, are merged with the surviving nodes by key, which gives the level's nodes
with all their sums; then their last turn is stripped and they are the survivors
of the next level. A tail that a bundle shares with no other has one node a turn,
whose sums follow from the bundle alone, so levels are as many as turns are
shared, not as many as the longest conversation has.

A key is a 128-bit digest of the sequence, chained over its turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.session import pin, scratch_path

WIDTH = 16
ROOT = bytes(WIDTH)
NO_ENDS = hashlib.sha256(b"").hexdigest()
#: Conversations whose ids go through the last shuffle in one string.
IDS_AT_ONCE = 4096


def turns_of(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turns): the digests and lengths of each conversation's turns, in order.

    A null turn number comes first, equal numbers are ordered by the turn's
    digest. A null role or text is empty. Rows without conv_id belong to none.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    turn = F.struct("turn", digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    return conversations.where("conv_id is not null").groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )


def rebuilt(conversations: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Every conversation with its first turns taken from the first one of its group of ids.

    The first h turns are those of conversation ``conv_id - conv_id % group``
    (fewer or none if it has fewer or is absent), the others are its own behind
    its first h; h is the remainder of crc32 of the id as text and ``most``.
    """
    own = pin(turns_of(conversations))
    first = own.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base_id"), F.slice("turns", 1, most - 1).alias("base_turns")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % F.lit(most)).cast("int")
    rows = own.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % group).alias("base_id"), h.alias("h"))
    none = F.slice("turns", 1, 0)
    head = F.coalesce(F.slice("base_turns", F.lit(1), F.col("h")), none)
    tail = F.when(
        F.size("turns") > F.col("h"), F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    ).otherwise(none)
    return rows.join(first, "base_id", "left").select("conv_id", F.concat(head, tail).alias("turns"))


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of all first parts of each conversation, behind each other."""
    for batch in batches:
        digests, keys, paths = batch.column("digests").to_pylist(), [], []
        for own in digests:
            key, path = ROOT, []
            for digest in own:
                key = hashlib.md5(key + digest).digest()
                path.append(key)
            keys.append(key)
            paths.append(b"".join(path))
        yield pa.RecordBatch.from_pydict(
            {
                "conv_id": batch.column("conv_id"),
                "key": pa.array(keys, pa.binary()),
                "path": pa.array(paths, pa.binary()),
                "chars": batch.column("chars"),
            }
        )


def paths_of(sequences: DataFrame) -> DataFrame:
    """Rows (conv_id, key, path, chars) of conversations with their turns."""
    narrow = sequences.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.chars").alias("chars"))
    return narrow.mapInArrow(_chained, "conv_id long, key binary, path binary, chars array<bigint>")


def _joined_ids(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) rows as strings of many ids of a key."""
    key, ids = None, []

    def row():
        return pa.RecordBatch.from_pydict(
            {
                "key": pa.array([key], pa.binary()),
                "first_id": pa.array([ids[0]], pa.int64()),
                "ids": pa.array([",".join(map(str, ids))], pa.string()),
            }
        )

    for batch in batches:
        for next_key, conv_id in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if ids and (next_key != key or len(ids) >= limit):
                yield row()
                ids = []
            key = next_key
            ids.append(conv_id)
    if ids:
        yield row()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for the strings of each key, read in order and never held together."""
    key, state = None, None

    def row():
        return pa.RecordBatch.from_pydict(
            {"key": pa.array([key], pa.binary()), "ends_sha256": pa.array([state.hexdigest()], pa.string())}
        )

    for batch in batches:
        for next_key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if next_key != key or state is None:
                if state is not None:
                    yield row()
                key, state = next_key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if state is not None:
        yield row()


def ends_of(members: DataFrame) -> DataFrame:
    """Rows (key, ends_sha256): the digest of the sorted ids of each key.

    Ids are sorted over ranges of (key, conv_id), so a key with most of the
    rows is spread; what comes together again are strings of thousands of ids,
    one at a time.
    """
    limit = IDS_AT_ONCE
    strings = members.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(
        lambda batches: _joined_ids(batches, limit), "key binary, first_id long, ids string"
    )
    return strings.repartition("key").sortWithinPartitions("key", "first_id").mapInArrow(_digests, "key binary, ends_sha256 string")


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each key on each bundle's path."""
    for batch in batches:
        for low in range(0, batch.num_rows, 1024):
            part = batch.slice(low, 1024)
            paths = part.column("path").to_pylist()
            keys = [p[k : k + WIDTH] for p in paths for k in range(0, len(p), WIDTH)]
            sizes = [len(p) // WIDTH for p in paths]
            yield pa.RecordBatch.from_pydict(
                {
                    "step": pa.array(keys, pa.binary()),
                    "key": part.column("key").take(pa.array(np.repeat(np.arange(len(sizes)), sizes))),
                    "depth": pa.array(np.concatenate([np.arange(1, n + 1) for n in sizes]) if sizes else [], pa.int64()),
                }
            )


def placed_bundles(paths: DataFrame) -> DataFrame:
    """Bundles with ``at``, the depth of the deepest node they share with another bundle."""
    bundles = pin(
        paths.groupBy("key").agg(
            F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.first("path").alias("path"), F.first("chars").alias("chars")
        )
    )
    members = paths.select("key", "conv_id").join(bundles.where("n > 1").select("key"), "key", "left_semi")
    ends = pin(ends_of(members))
    steps = bundles.select("key", "path").mapInArrow(_steps, "step binary, key binary, depth long")
    shared = pin(steps.groupBy("step").agg(F.count("*").alias("n")).where("n > 1").select("step"))
    at = pin(steps.join(shared, "step", "left_semi").groupBy("key").agg(F.max("depth").alias("at")))
    alone = F.sha2(F.col("conv_id").cast("string"), 256)
    return (
        bundles.join(at, "key", "left")
        .join(ends, "key", "left")
        .withColumn("at", F.coalesce("at", F.lit(0)).cast("int"))
        .withColumn("ends_sha256", F.coalesce("ends_sha256", alone))
    )


def _key_at(path: Column, depth: Column) -> Column:
    """The key on a path at a depth."""
    found = F.substring(path, (depth - 1) * WIDTH + 1, F.lit(WIDTH))
    return F.when(depth > 0, found).otherwise(F.lit(ROOT))


def arrivals(placed: DataFrame) -> DataFrame:
    """What each bundle brings to the node at depth ``at``: its end there, or its own tail as a child."""
    ended = F.size("chars") == F.col("at")
    tail = F.slice("chars", F.col("at") + 1, F.greatest(F.size("chars") - F.col("at"), F.lit(0)))
    return placed.select(
        "at",
        _key_at(F.col("path"), F.col("at")).alias("key"),
        F.substring("path", F.lit(1), F.col("at") * WIDTH).alias("path"),
        F.slice("chars", F.lit(1), F.col("at")).alias("chars"),
        "conv_id",
        F.col("n").alias("n_convs"),
        F.when(ended, 0).otherwise(1).cast("long").alias("n_children"),
        F.when(ended, 0).otherwise(1).cast("long").alias("n_leaves"),
        (F.aggregate(tail, F.lit(0).cast("long"), lambda a, x: a + x) * (F.col("n") - 1)).alias("saved_tokens"),
        F.when(ended, F.col("ends_sha256")).alias("ends_sha256"),
    )


def merged(rows: DataFrame, depth: int) -> DataFrame:
    """Nodes of one level from what arrives there and the survivors of the level below."""
    last = F.get("chars", F.lit(depth - 1)) if depth else F.lit(0).cast("long")
    return rows.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"),
        F.max("ends_sha256").alias("ends_sha256"),
        F.first("path").alias("path"),
        F.first("chars").alias("chars"),
    ).select(
        "key", "conv_id", "n_convs", "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * last).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        "path", "chars",
        _key_at(F.col("path"), F.lit(depth - 1)).alias("parent_key"),
    )


def stripped(nodes: DataFrame, depth: int) -> DataFrame:
    """Nodes of a level without their last turn: children of the next one."""
    return nodes.select(
        F.col("parent_key").alias("key"),
        F.substring("path", F.lit(1), F.lit((depth - 1) * WIDTH)).alias("path"),
        F.slice("chars", 1, depth - 1).alias("chars"),
        "conv_id", "n_convs",
        F.lit(1).cast("long").alias("n_children"),
        "n_leaves", "saved_tokens",
        F.lit(None).cast("string").alias("ends_sha256"),
    )


NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)


def _tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes below the shared ones, one for each turn of a bundle's own tail."""
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            rows = batch.slice(low, 256).to_pylist()
            out = {name: [] for name in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "saved_tokens", "ends_sha256")}
            for r in rows:
                at, chars, n = r["at"], r["chars"], r["n"]
                size = len(chars) - at
                below = np.cumsum(np.array(chars[at:][::-1], np.int64))[::-1] * (n - 1)
                out["conv_id"] += [r["conv_id"]] * size
                out["depth"] += range(at + 1, len(chars) + 1)
                out["parent_conv_id"] += [r["above"]] + [r["conv_id"]] * (size - 1)
                out["n_convs"] += [n] * size
                out["n_children"] += [1] * (size - 1) + [0]
                out["saved_tokens"] += below.tolist()
                out["ends_sha256"] += [NO_ENDS] * (size - 1) + [r["ends_sha256"]]
            made = {name: pa.array(v, pa.string() if name == "ends_sha256" else pa.int64()) for name, v in out.items()}
            made["n_leaves"] = pa.array(np.ones(len(out["depth"]), np.int64))
            yield pa.RecordBatch.from_pydict({name: made[name] for name in (f.split()[0] for f in NODE.split(", "))})


def trie(sequences: DataFrame) -> DataFrame:
    """One row for each node of the trie of conversations (conv_id, turns), with the columns of NODE.

    ``conv_id`` is the smallest member; the root (depth 0) has no parent.
    ``saved_tokens`` counts code points. No conversations give no node, a
    conversation without turns is a member of the root alone. One conversation's
    keys (24 bytes a turn) are one row.
    """
    spark = sequences.sparkSession
    paths = pin(paths_of(sequences))
    placed = pin(placed_bundles(paths).hint("rebalance", "at"))
    top = placed.agg(F.max("at")).first()[0]
    if top is None:
        return spark.createDataFrame([], NODE)
    arriving = arrivals(placed)
    folder = scratch_path(spark, "trie")
    survivors = None
    schema = None
    for depth in range(top, -1, -1):
        rows = arriving.where(F.col("at") == depth).drop("at")
        if survivors is not None:
            rows = rows.unionByName(survivors)
        nodes = merged(rows, depth)
        schema = nodes.schema
        nodes.write.parquet(f"{folder}/depth={depth}")
        if depth:
            survivors = stripped(spark.read.schema(schema).parquet(f"{folder}/depth={depth}"), depth)
    nodes = spark.read.schema(f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in schema)}, depth long").parquet(folder)
    root_id = nodes.where("depth = 0").first()["conv_id"]
    above = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))

    def with_parent(rows: DataFrame, level: str) -> DataFrame:
        # Most rows may hang on the root; its one id needs no join.
        return rows.where(f"{level} > 0").join(above, "parent_key").unionByName(
            rows.where(f"{level} = 0").withColumn("above", F.lit(root_id).cast("long"))
        )

    inner = with_parent(nodes.where("depth > 0").withColumn("level", F.col("depth") - 1), "level")
    columns = [f.split()[0] for f in NODE.split(", ")]
    shared = (
        inner.drop("level").unionByName(nodes.where("depth = 0").withColumn("above", F.lit(None).cast("long")))
        .withColumn("parent_conv_id", F.col("above"))
        .select(columns)
    )
    tails = placed.where(F.size("chars") > F.col("at")).withColumn("parent_key", _key_at(F.col("path"), F.col("at")))
    own = with_parent(tails.drop("path", "key"), "at").select("conv_id", "n", "at", "chars", "ends_sha256", "above")
    return shared.unionByName(own.mapInArrow(_tails, NODE))


def conversation_trie(conversations: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """The trie of rebuilt conversations; see ``rebuilt`` and ``trie``. Other columns are not read."""
    return trie(rebuilt(conversations, group, most))

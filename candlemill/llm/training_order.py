"""Training-order materialisation: fixed-stride shards in the order of a keyed permutation.

The token ids of all documents form one stream, cut into sequences of equal
length. A Feistel network over the sequence numbers, walked until it falls into
their range, is a permutation known by its key: it gives every sequence a
global slot without a shuffle table. Slots are dealt to shards by range, and
each shard is a file of equal records, so slot s is at a known place and a
reader can begin anywhere.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm.common import mix, slices
from candlemill.llm.tokens import worker_encoder
from candlemill.session import pin, scratch_path

LENGTH = 512
END_ID = 0
SHARD_SEQUENCES = 8192
ROUNDS = 6


class Permutation:
    """A keyed permutation of 0 .. size - 1."""

    def __init__(self, size: int, key: int):
        self.size = size
        self.half = np.uint64(max(1, -(-max(1, size - 1).bit_length() // 2)))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        with np.errstate(over="ignore"):
            self.keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(key & (2**64 - 1)) * np.uint64(0x9E3779B97F4A7C15))

    def _rounds(self, x: np.ndarray, keys) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & self.mask)
        return (left << self.half) | right

    def slots(self, numbers: np.ndarray) -> np.ndarray:
        """Slot of each number: the network again and again until it is below ``size``."""
        with np.errstate(over="ignore"):
            out = self._rounds(numbers.astype(np.uint64), self.keys)
            while (far := np.flatnonzero(out >= self.size)).size:
                out[far] = self._rounds(out[far], self.keys)
        return out.astype(np.int64)

    def numbers(self, slots: np.ndarray) -> np.ndarray:
        """The inverse: the network with swapped halves and reversed keys."""

        def back(x):
            swapped = ((x & self.mask) << self.half) | (x >> self.half)
            y = self._rounds(swapped, self.keys[::-1])
            return ((y & self.mask) << self.half) | (y >> self.half)

        with np.errstate(over="ignore"):
            out = back(slots.astype(np.uint64))
            while (far := np.flatnonzero(out >= self.size)).size:
                out[far] = back(out[far])
        return out.astype(np.int64)


def token_rows(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Rows (doc_id, n, ids, part, within): token ids of each row and an end id, as integers of 2 or 4 bytes.

    ``within`` is the number of tokens before the row in its part of the table.
    """

    def encode(batches):
        encoder = worker_encoder(vocabulary)
        before = 0
        for part in slices(batches):
            ids = [np.append(x, encoder.kind(END_ID)) for x in encoder.encode(part.column("text").to_pylist())]
            n = np.array([len(x) for x in ids], np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id"),
                    "n": pa.array(n),
                    "ids": pa.array([x.tobytes() for x in ids], pa.binary()),
                    "within": pa.array(before + np.cumsum(n) - n),
                }
            )
            before += int(n.sum())

    return (
        docs.select("doc_id", "text")
        .mapInArrow(encode, "doc_id long, n long, ids binary, within long")
        .withColumn("part", F.spark_partition_id())
    )


def materialise(
    docs: DataFrame, folder: str, key: int = 1, length: int = LENGTH, shard_sequences: int = SHARD_SEQUENCES, vocabulary: str | None = None
) -> DataFrame:
    """Write the shards to ``folder`` and return one row per sequence.

    Columns: slot, sequence (its number in the stream), shard, byte_offset,
    n_tokens, ids_crc32 (of the record), doc_ids (of the documents in it, in
    order). Every row of ``docs`` is in the stream, null and empty texts as an
    end id; null ids are null in doc_ids. The last sequence of the stream is
    filled with end ids. An empty table gives no rows and no shards. The stream
    has the order of the written token table. Shards are written under another
    name and then renamed, so a repeated task changes nothing.
    """
    spark = docs.sparkSession
    width = worker_encoder(vocabulary).kind().itemsize
    rows = scratch_path(spark, "tokens")
    token_rows(docs, vocabulary).write.option("compression", "zstd").parquet(rows)
    tokens = spark.read.schema("doc_id long, n long, ids binary, within long, part int").parquet(rows)
    # A number for each part of the table, not for each document.
    sizes = tokens.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    starts, total = {}, 0
    for r in sizes:
        starts[r["part"]] = total
        total += r["n"]
    count = -(-total // length)
    order = Permutation(max(1, count), key)

    def pieces(batches):
        """The part of each document in each sequence, with its slot; compressed, as parts are small."""
        press = zstandard.ZstdCompressor(level=1, write_checksum=False).compress
        for batch in batches:
            ids = batch.column("ids")
            n = batch.column("n").to_numpy()
            at = batch.column("within").to_numpy() + np.array([starts[k] for k in batch.column("part").to_pylist()], np.int64)
            docs_ = batch.column("doc_id").to_pylist()
            first, last = at // length, (at + n - 1) // length
            repeat = last - first + 1
            owner = np.repeat(np.arange(len(n)), repeat)
            sequence = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(repeat) - repeat, repeat)
            low = np.maximum(sequence * length, at[owner])
            high = np.minimum((sequence + 1) * length, (at + n)[owner])
            slots = order.slots(sequence)
            for begin in range(0, len(owner), 4000):
                end = min(begin + 4000, len(owner))
                part = slice(begin, end)
                yield pa.RecordBatch.from_pydict(
                    {
                        "slot": pa.array(slots[part]),
                        "sequence": pa.array(sequence[part]),
                        "begin": pa.array(low[part] - sequence[part] * length),
                        "doc_id": pa.array([docs_[k] for k in owner[part]], pa.int64()),
                        "part": pa.array(
                            [
                                press(ids[int(k)].as_py()[(a - at[k]) * width : (b - at[k]) * width])
                                for k, a, b in zip(owner[part], low[part], high[part], strict=True)
                            ],
                            pa.binary(),
                        ),
                    }
                )

    dealt = tokens.mapInArrow(pieces, "slot long, sequence long, begin long, doc_id long, part binary").withColumn(
        "shard", F.floor(F.col("slot") / F.lit(shard_sequences)).cast("long")
    )
    shards = max(1, -(-count // shard_sequences))
    ranged = dealt.repartitionByRange(min(shards, _parallel(spark)), "shard").sortWithinPartitions("slot", "begin")

    def write(batches):
        files, root = pafs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        unpress = zstandard.ZstdDecompressor().decompress
        held, done = None, []
        current: list = [None, None, bytearray(), []]  # slot, sequence, bytes, documents

        def close_sequence():
            slot, sequence, data, owners = current
            if slot is None:
                return
            tokens_here = len(data) // width
            data.extend(np.full(length - tokens_here, END_ID, f"<u{width}").tobytes())
            done.append((slot, sequence, tokens_here, zlib.crc32(data), owners, bytes(data)))

        def close_shard():
            nonlocal done
            if not done:
                return None
            name = f"{root}/shard-{held:06d}.bin"
            mark = zlib.crc32(repr((held, len(done), done[0][0])).encode())
            temporary = f"{name}.{np.random.default_rng().integers(1 << 62)}-{mark}"
            with files.open_output_stream(temporary) as out:
                for row in done:
                    out.write(row[5])
            files.move(temporary, name)
            batch = pa.RecordBatch.from_pydict(
                {
                    "slot": pa.array([r[0] for r in done], pa.int64()),
                    "sequence": pa.array([r[1] for r in done], pa.int64()),
                    "shard": pa.array([held] * len(done), pa.int64()),
                    "byte_offset": pa.array([(r[0] - held * shard_sequences) * length * width for r in done], pa.int64()),
                    "n_tokens": pa.array([r[2] for r in done], pa.int64()),
                    "ids_crc32": pa.array([r[3] for r in done], pa.int64()),
                    "doc_ids": pa.array([r[4] for r in done], pa.list_(pa.int64())),
                }
            )
            done = []
            return batch

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("shard", "slot", "sequence", "doc_id", "part")]
            for shard, slot, sequence, doc, part in zip(*columns, strict=True):
                if slot != current[0]:
                    close_sequence()
                    current = [slot, sequence, bytearray(), []]
                    if shard != held:
                        if (ready := close_shard()) is not None:
                            yield ready
                        held = shard
                current[2].extend(unpress(part))
                current[3].append(doc)
        close_sequence()
        if (ready := close_shard()) is not None:
            yield ready

    out = pin(
        ranged.select("shard", "slot", "sequence", "doc_id", "part").mapInArrow(
            write,
            "slot long, sequence long, shard long, byte_offset long, n_tokens long, ids_crc32 long, doc_ids array<long>",
        )
    )
    manifest = {"sequences": count, "length": length, "bytes_per_token": width, "shard_sequences": shard_sequences, "key": key}
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/manifest")
    return out


def _parallel(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read_sequences(folder: str, first: int, last: int) -> np.ndarray:
    """Token ids of the slots ``first`` .. ``last - 1``, read shard by shard at known places."""
    files, root = pafs.FileSystem.from_uri(folder)
    found = [f.path for f in files.get_file_info(pafs.FileSelector(f"{root}/manifest")) if f.base_name.startswith("part-")]
    with files.open_input_stream(found[0]) as text:
        manifest = json.loads(text.read())
    length, width, per = (manifest[k] for k in ("length", "bytes_per_token", "shard_sequences"))
    out = []
    while first < min(last, manifest["sequences"]):
        shard = first // per
        stop = min(last, (shard + 1) * per, manifest["sequences"])
        with files.open_input_file(f"{root}/shard-{shard:06d}.bin") as data:
            raw = data.read_at((stop - first) * length * width, (first - shard * per) * length * width)
        out.append(np.frombuffer(raw, f"<u{width}").reshape(-1, length))
        first = stop
    return np.concatenate(out) if out else np.zeros((0, length), f"<u{width}")

"""Quality: histogram gradient-boosted trees over statistics of a document.

Statistics are binned by quantiles of the sample. Trees are grown level by
level from histograms of gradients, and kept as arrays, so that all documents
of a batch go down a tree together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import held_out, map_text
from candlemill.llm.sampling import labelled_texts

DECIDE = 0.5
#: Most labelled rows of each class that the classifier is fitted on.
SAMPLE = 4000
BINS = 64
#: Kinds of bytes that are counted.
KINDS = {
    "space": b" ",
    "newline": b"\n",
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "digit": b"0123456789",
    "stop": b".",
    "comma": b",;:",
    "shout": b"!?",
    "bar": b"|",
    "symbol": b"#$%&*+/<=>@\\^_`{}~[]()\"'-",
    "tag": b"<>",
    "control": bytes([*range(9), *range(11, 32), 127]),
    "high": bytes(range(128, 256)),
}
NAMES = (
    *(f"{k}_share" for k in KINDS), "bytes", "words", "word_bytes", "distinct_words", "longest_word",
    "lines", "line_words", "distinct_lines", "repeated_line_bytes", "capital_words", "ended_lines", "top_word", "distinct_pairs",
)


def statistics(texts: list[str | None]) -> np.ndarray:
    """A row of ``NAMES`` for each text; an empty text has zeros."""
    raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(r) for r in raws], np.int64)
    out = np.zeros((len(texts), len(NAMES)))
    if sizes.any():
        data = np.frombuffer(b"".join(raws), np.uint8)
        full = np.flatnonzero(sizes)
        starts = (np.cumsum(sizes) - sizes)[full]
        for k, members in enumerate(KINDS.values()):
            mask = np.zeros(256, np.int32)
            mask[list(members)] = 1
            out[full, k] = np.add.reduceat(mask[data], starts) / sizes[full]
    at = len(KINDS)
    for i, raw in enumerate(raws):
        words = raw.split()
        lines = raw.split(b"\n")
        n = len(words)
        if not n:
            out[i, at] = np.log1p(len(raw))
            continue
        kinds: dict[bytes, int] = {}
        for w in words:
            kinds[w] = kinds.get(w, 0) + 1
        seen: set[bytes] = set()
        again = 0
        for line in lines:
            if line in seen:
                again += len(line)
            seen.add(line)
        out[i, at:] = (
            np.log1p(len(raw)), np.log1p(n), sum(map(len, words)) / n, len(kinds) / n, min(len(max(words, key=len)), 1000),
            np.log1p(len(lines)), n / len(lines), len(seen) / len(lines), again / len(raw),
            sum(map(bytes.isupper, words)) / n, sum(line.endswith((b".", b"!", b"?")) for line in lines) / len(lines),
            max(kinds.values()) / n, len(set(zip(words, words[1:], strict=False))) / n,
        )
    return out


class Trees:
    """Boosted trees as arrays: feature, bin and leaf value by tree and node.

    A node k has the children 2k + 1 and 2k + 2; a node that isn't split sends
    every row to the left.
    """

    def __init__(self, edges: np.ndarray, depth: int):
        self.edges = edges
        self.depth = depth
        self.feature: list[np.ndarray] = []
        self.bin: list[np.ndarray] = []
        self.leaf: list[np.ndarray] = []
        self.start = 0.0

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)], axis=1).astype(np.int64)

    def logits(self, x: np.ndarray) -> np.ndarray:
        bins = self.binned(x)
        total = np.full(len(x), self.start)
        every = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.bin, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (bins[every, feature[node]] > cut[node])
            total += leaf[node - (2**self.depth - 1)]
        return total


def boost(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, ridge: float = 2.0) -> Trees:
    """Fit on the logistic loss with second-order gains."""
    edges = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    model = Trees(edges, depth)
    share = np.clip(y.mean(), 0.01, 0.99)
    model.start = float(np.log(share / (1 - share)))
    bins = model.binned(x)
    width = bins.shape[1]
    flat = bins + np.arange(width) * BINS
    z = np.full(len(y), model.start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = p - y, p * (1 - p)
        feature = np.zeros(2**depth - 1, np.int64)
        cut = np.full(2**depth - 1, BINS, np.int64)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            key = ((node - first) * (width * BINS))[:, None] + flat
            shape = (count, width, BINS)
            size = count * width * BINS
            sums = [np.bincount(key.reshape(-1), np.repeat(v, width), size).reshape(shape).cumsum(2) for v in (g, h)]
            gl, hl = sums
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            gain[(hl < 1) | (ht - hl < 1)] = 0
            best = gain.reshape(count, -1).argmax(1)
            split = gain.reshape(count, -1)[np.arange(count), best] > 1e-6
            feature[first : first + count] = np.where(split, best // BINS, 0)
            cut[first : first + count] = np.where(split, best % BINS, BINS)
            node = 2 * node + 1 + (bins[np.arange(len(y)), feature[node]] > cut[node])
        place = node - (2**depth - 1)
        total_g, total_h = np.bincount(place, g, 2**depth), np.bincount(place, h, 2**depth)
        leaf = -rate * total_g / (total_h + ridge)
        model.feature.append(feature)
        model.bin.append(cut)
        model.leaf.append(leaf)
        z += leaf[place]
    return model


def train(texts: list[str], labels: list[int]) -> Trees:
    """Fit on a sample; with one class or no rows every score is one half or that class's share."""
    y = np.array(labels, float)
    if len(set(labels)) < 2:
        model = Trees(np.zeros((len(NAMES), BINS - 1)), 1)
        model.start = 0.0 if not len(y) else (2.0 if y[0] else -2.0)
        return model
    return boost(statistics(texts), y)


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: (doc_id, held_out, score, predicted).

    Learns from at most about ``sample`` labelled rows of each class that are
    not held out; scores whole texts of all rows. Null and empty texts get the
    score of a text without bytes; a null doc_id isn't held out. Repeated rows
    are scored alike; other columns are not read.
    """
    model = train(*labelled_texts(docs, labels, "quality", sample))

    def work():
        def handle(batch):
            logits = model.logits(statistics(batch.column("text").to_pylist()))
            return {"doc_id": batch.column("doc_id"), "score": pa.array(1 / (1 + np.exp(-np.clip(logits, -30, 30))))}

        return handle

    return map_text(docs, ["doc_id", "text"], work, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(held_out("doc_id", 3, 1), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= DECIDE).cast("int").alias("predicted"),
    )

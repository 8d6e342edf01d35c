"""Language: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters are hashed; a feature is its share among
the n-grams of its length times its inverse document frequency. Weights are
trained by follow-the-regularised-leader with an elastic net, which leaves most
of them zero; a temperature calibrated on rows of the sample that weren't
fitted turns the logits into probabilities.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import held_out, map_text
from candlemill.llm.sampling import class_sample, within_bytes

#: Most rows of each language that the classifier is fitted on.
SAMPLE = 1500
BUCKETS = 1 << 15
LENGTHS = (1, 2, 3)
SCALE = 20.0
UNKNOWN = "und"
_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def characters(text: str | None) -> np.ndarray:
    """Code points of a text in lower case, everything but letters as a space; empty without letters."""
    codes = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    known = letters()[codes]
    return np.where(known, codes, np.uint32(32)) if known.any() else codes[:0]


def grams(codes: np.ndarray, length: int) -> np.ndarray:
    """Hashed feature of every n-gram of ``length`` characters; each length has its own range."""
    out = codes[: len(codes) - length + 1] * _FACTORS[0]
    for k in range(1, length):
        out = (out ^ (out >> np.uint32(15))) * _FACTORS[k] + codes[k : len(codes) - length + 1 + k]
    out ^= out >> np.uint32(16)
    out *= _FACTORS[1]
    return (out >> np.uint32(32 - 15)).astype(np.int64) + (length - 1) * BUCKETS


def features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, share among the n-grams of its length) of a text."""
    at, share = [], []
    for n in LENGTHS:
        found = grams(codes, n) if len(codes) >= n else np.zeros(0, np.int64)
        own, count = np.unique(found, return_counts=True)
        at.append(own)
        share.append(count / max(1, len(found)))
    return np.concatenate(at), np.concatenate(share)


class Model:
    def __init__(self, names: list[str]):
        self.names = names
        self.weights = np.zeros((len(LENGTHS) * BUCKETS, len(names)), np.float32)
        self.bias = np.zeros(len(names))
        self.temperature = 1.0

    def logits(self, codes: np.ndarray) -> np.ndarray:
        """Shares are linear, so the mean weight of the n-grams of each length is their product with the weights."""
        z = self.bias.copy()
        for n in LENGTHS:
            if len(codes) >= n:
                found = grams(codes, n)
                total = np.zeros(len(self.names))
                for low in range(0, len(found), 1 << 17):
                    total += self.weights[found[low : low + (1 << 17)]].sum(0, dtype=np.float64)
                z += total / len(found)
        return z


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def follow_leader(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.002, l2: float = 0.01, seed: int = 1):
    """Weights and bias by follow-the-regularised-leader (proximal), one row after the other."""
    size = len(LENGTHS) * BUCKETS + 1  # the last feature is the bias
    z, n = np.zeros((size, classes)), np.zeros((size, classes))

    def weights(at):
        active = np.abs(z[at]) > l1
        return np.where(active, -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2), 0.0)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            at, x = rows[k]
            at, x = np.append(at, size - 1), np.append(x, 1.0)
            w = weights(at)
            p = softmax(x @ w)
            p[y[k]] -= 1
            g = x[:, None] * p
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    final = np.empty((size, classes), np.float32)
    for low in range(0, size, 4096):  # with many classes the whole is large
        final[low : low + 4096] = weights(np.arange(low, min(size, low + 4096)))
    return final[:-1], final[-1].astype(float)


def train(texts: list[str], langs: list[str], seed: int = 2) -> Model:
    """Fit on four fifths of the sample, calibrate the temperature on the rest."""
    names = sorted(set(langs))
    model = Model(names)
    coded = [characters(t) for t in texts]
    kept = [k for k, c in enumerate(coded) if len(c)]
    if len(names) < 2 or not kept:
        return model
    number = {v: k for k, v in enumerate(names)}
    y = np.array([number[langs[k]] for k in kept])
    rows = [features(coded[k]) for k in kept]
    found = np.bincount(np.concatenate([at for at, _ in rows]), minlength=len(LENGTHS) * BUCKETS)
    idf = np.log((1 + len(rows)) / (1 + found)) + 1
    rows = [(at, share * idf[at] * SCALE) for at, share in rows]
    fitted = np.random.default_rng(seed).random(len(rows)) < 0.8
    fitted |= ~np.isin(y, y[fitted])  # no class without a row
    first = np.flatnonzero(fitted)
    weights, bias = follow_leader([rows[k] for k in first], y[first], len(names))
    rest = np.flatnonzero(~fitted) if not fitted.all() else first
    z = np.array([rows[k][1] @ weights[rows[k][0]] + bias for k in rest])
    scales = np.geomspace(0.2, 5, 60)
    loss = [-np.log(np.maximum(softmax(z / t)[np.arange(len(rest)), y[rest]], 1e-12)).mean() for t in scales]
    model.temperature = float(scales[int(np.argmin(loss))])
    weights *= (idf * SCALE)[:, None]
    model.weights = weights
    model.bias = bias
    return model


def language(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: (doc_id, held_out, lang_pred, score).

    Learns every non-null language, from at most about ``sample`` different rows
    of each (fewer if that is over MAX_ROWS of sampling.py in all) that are not
    held out and whose text has a letter (fewer still if their texts are long, see
    ``within_bytes``, but one at least); predicts from whole texts. Null texts and texts without a letter are ``und`` with
    score 0, as is every text if there is nothing to learn from. A null doc_id
    isn't held out. Repeated rows are predicted alike.
    """
    usable = docs.select("doc_id", "text", "lang").where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id", 4, 2)
    ).where(F.col("text").rlike(r"\p{L}"))
    picked = class_sample(usable, "lang", sample, ["doc_id", "text"]).distinct()
    rows = within_bytes(picked, "lang", ["doc_id", "text"]).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["lang"], r["text"]))
    model = train([r["text"] for r in rows], [r["lang"] for r in rows])

    def work():
        def handle(batch):
            names, scores = [], []
            for text in batch.column("text").to_pylist():
                codes = characters(text)
                if not len(codes) or not model.names:
                    names.append(UNKNOWN), scores.append(0.0)
                    continue
                p = softmax(model.logits(codes) / model.temperature)
                k = int(p.argmax())
                names.append(model.names[k]), scores.append(float(p[k]))
            return {"doc_id": batch.column("doc_id"), "lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())}

        return handle

    return map_text(docs, ["doc_id", "text"], work, "doc_id long, lang_pred string, score double").select(
        "doc_id", F.coalesce(held_out("doc_id", 4, 2), F.lit(False)).alias("held_out"), "lang_pred", "score"
    )

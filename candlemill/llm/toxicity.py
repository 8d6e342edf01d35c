"""Toxicity: a convolutional text classifier trained in numpy.

Words become sums of hashed embeddings (the word and its first letters),
filters of several widths run over the text, each keeps its maximum over the
whole text, and a logistic layer scores the maxima. A threshold is calibrated
for each language, told from common words of the text itself, and the score is
shifted so that the threshold is at ``DECIDE`` in every language.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import ddl, held_out, map_text
from candlemill.llm.sampling import labelled_texts

DECIDE = 0.7
#: Most labelled rows of each class that the classifier is fitted on.
SAMPLE = 2500
BUCKETS = 1 << 16
WIDTH = 12
FILTERS = {1: 12, 2: 8, 3: 6}
PREFIXES = (3, 4, 5, 6)
_PAD = max(FILTERS) - 1
_WORD = re.compile(r"\w+")

#: Common words that tell languages apart; texts without any are a group of their own.
COMMON = {
    "en": "the of and to in is it was for that with this are by from",
    "de": "der die und das ist nicht ein eine den dem des mit von zu auf",
    "fr": "le les et est une du des que qui dans pour sur au par pas",
    "es": "el los y las del una por con para se su como lo es no",
}
_GROUP = {word: k for k, words in enumerate(COMMON.values()) for word in words.split()}


class Words(dict):
    """Rows of a table of words: hashed ids of a word and its prefixes, and its language group."""

    def __init__(self, limit: int = 120_000):
        super().__init__()
        self.limit = limit
        self.reset()

    def reset(self) -> None:
        self.clear()
        self._ids = np.zeros((1024, 1 + len(PREFIXES)), np.int32)
        self._groups = np.zeros(1024, np.int8)

    def __missing__(self, word: str) -> int:
        at = self[word] = len(self)
        if at == len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
            self._groups = np.concatenate([self._groups, np.zeros_like(self._groups)])
        parts = [word, *("^" + word[:n] if len(word) > n else "" for n in PREFIXES)]
        self._ids[at] = [1 + zlib.crc32(p.encode("utf-8", "surrogatepass")) % (BUCKETS - 1) if p else 0 for p in parts]
        self._groups[at] = _GROUP.get(word, -1)
        return at

    @property
    def ids(self) -> np.ndarray:
        return self._ids[: len(self)]

    @property
    def groups(self) -> np.ndarray:
        return self._groups[: len(self)]

    def of(self, text: str | None) -> np.ndarray:
        found = _WORD.findall((text or "").lower())
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))


def layout(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, starts, pads): texts behind each other, each followed by empty words (-1)."""
    sizes = np.array([len(d) + _PAD for d in docs])
    starts = np.cumsum(sizes) - sizes
    rows = np.full(int(sizes.sum()), -1, np.int64)
    for d, at in zip(docs, starts, strict=True):
        rows[at : at + len(d)] = d
    return rows, starts, rows < 0


class Network:
    """The classifier; ``table`` holds the hashed embeddings, row 0 is empty."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.table = (rng.standard_normal((BUCKETS, WIDTH)) * 0.05).astype(np.float32)
        self.table[0] = 0
        self.filters = {
            w: (rng.standard_normal((w, WIDTH, n)) * 0.3).astype(np.float32) for w, n in FILTERS.items()
        }
        for w in FILTERS:
            self.filters[w][:, 0, :] = np.abs(self.filters[w][:, 0, :]) + 0.2
        self.bias = {w: np.zeros(n, np.float32) for w, n in FILTERS.items()}
        self.out = np.full(sum(FILTERS.values()), 0.1, np.float32)
        self.constant = np.float32(-1.0)
        self.shift = np.zeros(len(COMMON) + 1)

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        """Embedding of each row of hashed ids, and an empty word at the end."""
        out = np.zeros((len(ids) + 1, WIDTH), np.float32)
        for k in range(ids.shape[1]):
            out[:-1] += self.table[ids[:, k]]
        return out

    def responses(self, x: np.ndarray, pads: np.ndarray) -> dict[int, np.ndarray]:
        out = {}
        for w, kernel in self.filters.items():
            h = x @ kernel[0]
            for k in range(1, w):
                h[: len(x) - k] += x[k:] @ kernel[k]
            h[pads] = 0
            out[w] = h + self.bias[w]
        return out

    def logits(self, x: np.ndarray, starts: np.ndarray, pads: np.ndarray) -> np.ndarray:
        h = self.responses(x, pads)
        most = np.concatenate([np.maximum.reduceat(h[w], starts, axis=0) for w in FILTERS], axis=1)
        return np.maximum(most, 0) @ self.out + self.constant

    def fit(self, docs: list[np.ndarray], ids: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 48, rate: float = 0.05, seed: int = 5) -> None:
        """Adagrad on the logistic loss. The first embedding component starts from log odds of the hashed parts."""
        rng = np.random.default_rng(seed)
        seen = np.zeros((2, BUCKETS))
        for d, label in zip(docs, y, strict=True):
            seen[label, np.unique(ids[d])] += 1
        totals = np.array([(y == 0).sum(), (y == 1).sum()]) + 2.0
        odds = np.log((seen[1] + 1) / totals[1]) - np.log((seen[0] + 1) / totals[0])
        self.table[:, 0] = np.where(seen.sum(0) >= 8, np.clip(odds, -2, 3), 0) * 0.5
        self.table[0] = 0
        grads = {"out": np.full_like(self.out, 1e-3), "constant": 1e-3, "table": np.full(BUCKETS, 1e-3, np.float32)}
        for w in FILTERS:
            grads[w] = np.full_like(self.filters[w], 1e-3)
            grads["b", w] = np.full_like(self.bias[w], 1e-3)
        for _ in range(epochs):
            order = rng.permutation(len(docs))
            for low in range(0, len(order), batch):
                part = order[low : low + batch]
                rows, starts, pads = layout([docs[k] for k in part])
                own = np.unique(rows[~pads])
                local = np.searchsorted(own, rows)
                local[pads] = len(own)
                x = self.vectors(ids[own])[local]
                h = self.responses(x, pads)
                segment = np.repeat(np.arange(len(part)), np.diff(np.append(starts, len(rows))))
                most = {w: np.maximum.reduceat(h[w], starts, axis=0) for w in FILTERS}
                features = np.maximum(np.concatenate(list(most.values()), axis=1), 0)
                error = 1 / (1 + np.exp(-(features @ self.out + self.constant))) - y[part]
                error = (error / len(part)).astype(np.float32)
                back = np.outer(error, self.out) * (features > 0)
                self._step("out", features.T @ error, grads, rate)
                self.constant -= rate * error.sum() / np.sqrt(grads["constant"] + error.sum() ** 2)
                grads["constant"] += error.sum() ** 2
                at = 0
                where_all, grad_all = [], []
                for w, n in FILTERS.items():
                    place = np.where(h[w] == most[w][segment], np.arange(len(rows))[:, None], len(rows))
                    first = np.minimum.reduceat(place, starts, axis=0)
                    g = back[:, at : at + n]
                    kernel = np.zeros_like(self.filters[w])
                    for k in range(w):
                        p = np.minimum(first + k, len(rows) - 1)
                        kernel[k] = np.einsum("bfd,bf->df", x[p], g)
                        where_all.append(rows[p].reshape(-1))
                        grad_all.append((g[:, :, None] * self.filters[w][k].T[None]).reshape(-1, WIDTH))
                    bias = g.sum(0)
                    at += n
                    grads[w] += kernel**2
                    self.filters[w] -= rate * kernel / np.sqrt(grads[w])
                    grads["b", w] += bias**2
                    self.bias[w] -= rate * bias / np.sqrt(grads["b", w])
                self._embed(np.concatenate(where_all), np.concatenate(grad_all), ids, grads["table"], rate)

    def _step(self, name: str, gradient: np.ndarray, grads: dict, rate: float) -> None:
        grads[name] += gradient**2
        value = getattr(self, name)
        value -= rate * gradient / np.sqrt(grads[name])

    def _embed(self, rows: np.ndarray, gradient: np.ndarray, ids: np.ndarray, sums: np.ndarray, rate: float) -> None:
        keep = (rows >= 0) & gradient.any(axis=1)
        parts = ids[rows[keep]]
        gradient = np.repeat(gradient[keep], parts.shape[1], axis=0)
        parts = parts.reshape(-1)
        order = np.argsort(parts, kind="stable")
        parts, gradient = parts[order], gradient[order]
        if not len(parts):
            return
        first = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]]))
        total = np.add.reduceat(gradient, first, axis=0)
        at = parts[first]
        sums[at] += (total**2).mean(1)
        self.table[at] -= rate * total / np.sqrt(sums[at])[:, None]
        self.table[0] = 0

    def scores(self, logits: np.ndarray, groups: np.ndarray) -> np.ndarray:
        moved = logits - self.shift[groups] + np.log(DECIDE / (1 - DECIDE))
        return 1 / (1 + np.exp(-np.clip(moved, -30, 30)))


def language_groups(words: Words, docs: list[np.ndarray]) -> np.ndarray:
    """Group of the most common words in each text; the last group has none."""
    named = np.append(words.groups, -1).astype(np.int64)
    out = np.full(len(docs), len(COMMON), np.int64)
    for i, d in enumerate(docs):
        counts = np.bincount(named[d] + 1, minlength=len(COMMON) + 1)[1:]
        if counts.any():
            out[i] = int(counts.argmax())
    return out


def best_threshold(logits: np.ndarray, y: np.ndarray) -> float:
    """Middle of the gap with the highest F1."""
    order = np.argsort(-logits)
    z, hits = logits[order], np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(z) + 1) + y.sum())
    k = int(f1.argmax())
    return float((z[k] + z[k + 1]) / 2 if k + 1 < len(z) else z[k] - 1)


def train(texts: list[str], labels: list[int], seed: int = 3) -> Network:
    """Fit on three quarters of the sample, calibrate thresholds on the rest.

    A group of few rows takes the threshold of all. With one class or no rows,
    every score is far below the decision.
    """
    net = Network()
    y = np.array(labels, np.int64)
    if len(set(labels)) < 2:
        net.out[:] = 0
        net.constant = np.float32(-4)
        return net
    words = Words(limit=1 << 62)
    docs = [words.of(t) for t in texts]
    ids = words.ids
    kept = np.random.default_rng(seed).random(len(docs)) < 0.75
    if len(set(y[kept])) < 2 or len(set(y[~kept])) < 2:
        kept[:] = True
    fit = np.flatnonzero(kept)
    net.fit([docs[k] for k in fit], ids, y[fit])
    rest = np.flatnonzero(~kept) if not kept.all() else fit
    logits = np.empty(len(rest))
    for low in range(0, len(rest), 200):
        part = [docs[k] for k in rest[low : low + 200]]
        rows, starts, pads = layout(part)
        own = np.unique(rows[~pads])
        local = np.searchsorted(own, rows)
        local[pads] = len(own)
        logits[low : low + 200] = net.logits(net.vectors(ids[own])[local], starts, pads)
    groups = language_groups(words, [docs[k] for k in rest])
    overall = best_threshold(logits, y[rest])
    net.shift[:] = overall
    for g in range(len(net.shift)):
        own = groups == g
        if y[rest][own].sum() >= 25 and (y[rest][own] == 0).sum() >= 25:
            net.shift[g] = best_threshold(logits[own], y[rest][own])
    return net


def score_texts(docs: DataFrame, net: Network, carry: list[str], name: str = "score") -> DataFrame:
    """``carry`` and the score of every whole text as ``name``; null and empty texts too."""

    def work():
        words = Words()
        # Vectors of the words so far, with room for as many again.
        table, known = [np.zeros((1024, WIDTH), np.float32)], [0]

        def handle(batch):
            if len(words) > words.limit:
                words.reset()
                table[0], known[0] = np.zeros((1024, WIDTH), np.float32), 0
            texts = [words.of(t) for t in batch.column("text").to_pylist()]
            if len(words) > len(table[0]):
                table[0] = np.concatenate([table[0][: known[0]], np.zeros((2 * len(words) - known[0], WIDTH), np.float32)])
            table[0][known[0] : len(words)] = net.vectors(words.ids[known[0] :])[:-1]
            known[0] = len(words)
            scores = np.empty(len(texts))
            groups = language_groups(words, texts)
            sizes = np.cumsum([len(t) for t in texts])
            low = 0
            while low < len(texts):
                high = max(low + 1, int(np.searchsorted(sizes, (sizes[low - 1] if low else 0) + 60_000, "right")))
                rows, starts, pads = layout(texts[low:high])
                x = table[0][rows]
                x[pads] = 0
                scores[low:high] = net.scores(net.logits(x, starts, pads), groups[low:high])
                low = high
            return {name: pa.array(scores)} | {c: batch.column(c) for c in carry}

        return handle

    return map_text(docs, list(dict.fromkeys(["text", *carry])), work, f"`{name}` double" + ddl(docs, carry))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: (doc_id, held_out, score, predicted).

    Learns from at most about ``sample`` labelled rows of each class that are
    not held out; scores whole texts of all rows. A null or empty text gets the
    score of a text without words; a null doc_id isn't held out. Repeated rows
    are scored alike; other columns are not read.
    """
    net = train(*labelled_texts(docs, labels, "toxic", sample))
    return score_texts(docs, net, ["doc_id"]).select(
        "doc_id",
        F.coalesce(held_out("doc_id", 3, 1), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= DECIDE).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that aren't predicted to be toxic, with all their columns; each text is read once."""
    net = train(*labelled_texts(docs, labels, "toxic", sample))
    names = docs.columns
    inner = ["text" if name == "text" else f"c{k}" for k, name in enumerate(names)]
    scored = score_texts(docs.toDF(*inner), net, inner, "score of text")
    return scored.where(F.col("score of text") < DECIDE).select(inner).toDF(*names)

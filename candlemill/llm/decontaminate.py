"""Benchmark decontamination: BM25 over test items with block-max WAND.

The inverted index holds the test items; every passage of every document is a
query. Impacts are divided by the score an item gives itself, so one threshold
holds for all items. Sums of the highest impact of each term drop passages, sums
of its highest impact in each block of items drop blocks, for many passages at
once; the blocks that can still reach the threshold are traversed by pivots. What
is retrieved is verified: the words of the question and of the answer that lie in
shared five-word shingles.
"""

from __future__ import annotations

import re
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import map_text
from candlemill.session import pin

K1, B = 1.2, 0.75
#: Score of a passage as a share of the item's own score, from which it is retrieved.
THRESHOLD = 0.6
SHINGLE = 5
QUESTION_OVERLAP = 0.8
ANSWER_OVERLAP = 0.5
BLOCK = 8
#: Items and bytes of text in one index, about; a larger benchmark is searched in several.
SHARD_ITEMS = 20_000
SHARD_BYTES = 16 << 20
_WORD = re.compile(r"\w+")
_SLACK = 1e-9
#: Passages times their words times blocks that are summed at once.
_CELLS = 1 << 22


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _places(sizes: np.ndarray) -> np.ndarray:
    """0, 1, 2 … for each size, behind each other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def answer_start(text: str, words: list[str]) -> int:
    """Place of the first word of the answer: the last sentence, or the last third of a single one."""
    sentences = [s for s in re.split(r"(?<=[.?!:])\s+|\n+", text) if _WORD.search(s)]
    last = len(words_of(sentences[-1])) if len(sentences) > 1 else len(words) // 3
    return len(words) - max(1, last)


class Corpus(NamedTuple):
    """What scores need to know of all items: those with words, their words, the longest, and the items that hold a term."""

    n: int
    n_words: int
    longest: int
    found: dict[str, int]


class Index:
    """Inverted index of test items with impacts, term bounds and block bounds.

    The items are one shard of a benchmark if ``corpus`` is given; its ``found``
    then has all terms of the shard.
    """

    def __init__(self, items: list[tuple[int, str]], corpus: Corpus | None = None):
        items = [(k, t, words_of(t)) for k, t in items]
        items = sorted((x for x in items if x[2]), key=lambda x: len(x[2]))  # like lengths share a block
        self.ids = [k for k, _, _ in items]
        self.words = [w for _, _, w in items]
        self.answers = [answer_start(t, w) for _, t, w in items]
        self.terms: dict[str, int] = {}
        counts: list[dict[int, int]] = []
        for words in self.words:
            own: dict[int, int] = {}
            for w in words:
                t = self.terms.setdefault(w, len(self.terms) + 1)
                own[t] = own.get(t, 0) + 1
            counts.append(own)
        n, size = len(items), len(self.terms) + 1
        found = np.zeros(size)
        if corpus:
            found[[self.terms[w] for w in corpus.found]] = list(corpus.found.values())
        else:
            for own in counts:
                found[list(own)] += 1
            corpus = Corpus(n, sum(map(len, self.words)), max(map(len, self.words), default=1), {})
        self.idf = np.log(1 + (corpus.n - found + 0.5) / (found + 0.5))
        mean = corpus.n_words / max(1, corpus.n)
        postings: list[list[tuple[int, float]]] = [[] for _ in range(size)]
        for d, own in enumerate(counts):
            norm = K1 * (1 - B + B * len(self.words[d]) / mean)
            impact = {t: self.idf[t] * f * (K1 + 1) / (f + norm) for t, f in own.items()}
            whole = sum(impact.values())
            for t, x in impact.items():
                postings[t].append((d, x / whole))
        #: Postings of all terms behind each other; a list is a term's postings in one block of items.
        self.docs = np.array([d for p in postings for d, _ in p], np.int64)
        self.impacts = np.array([x for p in postings for _, x in p])
        sizes = np.array([len(p) for p in postings], np.int64)
        term = np.repeat(np.arange(size), sizes)
        self.n_blocks = -(-n // BLOCK)
        key = term * max(1, self.n_blocks) + self.docs // BLOCK
        self.list_starts = np.flatnonzero(np.diff(key, prepend=-1))
        self.list_ends = np.append(self.list_starts[1:], len(key))
        self.list_block = self.docs[self.list_starts] // BLOCK
        self.list_bound = np.maximum.reduceat(self.impacts, self.list_starts) if len(key) else np.zeros(0)
        #: The lists of term t are those from term_lists[t] to term_lists[t + 1].
        self.term_lists = np.searchsorted(term[self.list_starts], np.arange(size + 1))
        self.bound = np.array([max((x for _, x in p), default=0.0) for p in postings])
        #: A passage has room for two of the longest item, so each item is inside one of them.
        self.passage = 2 * corpus.longest

    def traverse(self, lists: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """Items of one block that reach the threshold, by WAND with the block's bounds."""
        cursors = []
        for k in lists.tolist():
            part = slice(self.list_starts[k], self.list_ends[k])
            cursors.append([self.docs[part].tolist(), self.impacts[part].tolist(), 0, float(self.list_bound[k])])
        out = []
        while cursors:
            cursors.sort(key=lambda c: c[0][c[2]])
            total, pivot = 0.0, -1
            for c in cursors:
                total += c[3]
                if total >= threshold - _SLACK:
                    pivot = c[0][c[2]]
                    break
            if pivot < 0:
                break
            target = pivot
            if cursors[0][0][cursors[0][2]] == pivot:
                score = sum(c[1][c[2]] for c in cursors if c[0][c[2]] == pivot)
                if score >= threshold - _SLACK:
                    out.append((pivot, score))
                target = pivot + 1
            for c in cursors:
                while c[2] < len(c[0]) and c[0][c[2]] < target:
                    c[2] += 1
            cursors = [c for c in cursors if c[2] < len(c[0])]
        return out

    def search(self, docs: list[list[str]], threshold: float) -> list[dict[int, float]]:
        """Best score of each retrieved item over the passages of each document.

        Sums of the terms' bounds drop passages, sums of the blocks' bounds
        drop blocks of items for all passages at once, and what stays is traversed.
        """
        best: list[dict[int, float]] = [{} for _ in docs]
        sizes = np.array([len(d) for d in docs], np.int64)
        terms = np.fromiter(map(self.terms.get, chain.from_iterable(docs), repeat(0)), np.int64, int(sizes.sum()))
        ends_of = np.cumsum(sizes)
        stride = max(1, self.passage // 2)
        per_doc = -(-np.maximum(1, sizes - stride) // stride)
        doc_of = np.repeat(np.arange(len(docs)), per_doc)
        starts = (ends_of - sizes)[doc_of] + _places(per_doc) * stride
        ends = np.minimum(starts + self.passage, ends_of[doc_of])
        sums = np.concatenate([[0.0], np.cumsum(self.bound[terms])])
        left = np.flatnonzero(sums[ends] - sums[starts] >= threshold - 1e-6)  # running sums are less exact
        step = max(1, _CELLS // max(1, self.n_blocks * self.passage))
        for low in range(0, len(left), step):
            part = left[low : low + step]
            words = ends[part] - starts[part]
            found = terms[np.repeat(starts[part], words) + _places(words)]
            own = np.unique((np.repeat(np.arange(len(part)), words) * len(self.bound) + found)[found > 0])
            passage, term = own // len(self.bound), own % len(self.bound)
            n_lists = self.term_lists[term + 1] - self.term_lists[term]
            lists = np.repeat(self.term_lists[term], n_lists) + _places(n_lists)
            cells = np.repeat(passage, n_lists) * self.n_blocks + self.list_block[lists]
            reached = np.bincount(cells, self.list_bound[lists], len(part) * self.n_blocks) >= threshold - 2 * _SLACK
            kept = np.flatnonzero(reached[cells])
            kept = kept[np.argsort(cells[kept], kind="stable")]
            cuts = np.flatnonzero(np.diff(cells[kept])) + 1
            for group in np.split(kept, cuts) if len(kept) else ():
                scores = best[doc_of[part[cells[group[0]] // self.n_blocks]]]
                for item, score in self.traverse(lists[group], threshold):
                    scores[item] = max(scores.get(item, 0.0), score)
        return best

    def overlaps(self, item: int, words: list[str], shingles: dict[int, set]) -> tuple[float, float]:
        """Shares of the question's and the answer's words that lie in shingles of the document.

        ``shingles`` keeps the document's shingles by size for its other items.
        """
        own = self.words[item]
        size = min(SHINGLE, len(own))
        if size not in shingles:
            shingles[size] = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}
        seen = shingles[size]
        covered = np.zeros(len(own), bool)
        for k in range(len(own) - size + 1):
            if tuple(own[k : k + size]) in seen:
                covered[k : k + size] = True
        at = self.answers[item]
        return float(covered[:at].mean()) if at else 1.0, float(covered[at:].mean())


def item_terms(items: DataFrame) -> DataFrame:
    """Rows (shard, n_words, terms): length and distinct terms of each item with words."""

    def work():
        def handle(batch):
            words = [words_of(t) for t in batch.column("text").to_pylist()]
            return {
                "shard": batch.column("shard"),
                "n_words": pa.array([len(w) for w in words], pa.int64()),
                "terms": pa.array([sorted(set(w)) for w in words], pa.list_(pa.string())),
            }

        return handle

    return map_text(items, ["shard", "text"], work, "shard long, n_words long, terms array<string>").where("n_words > 0")


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (doc_id, item_id, score, question_overlap, answer_overlap): verified leaks.

    One row for each document and item whose passage scores at least
    ``threshold`` of the item's own score and whose question and answer are
    found in the text. Null and empty texts and items match nothing, repeated
    rows match alike; a null doc_id is kept as it is. Other columns are not
    read. Items are searched in shards of about SHARD_ITEMS or SHARD_BYTES at
    most, each index is sent to all tasks; scores don't depend on the shards.
    """
    items = benchmark.select("item_id", "text").where("item_id is not null and text is not null").dropDuplicates()
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n_bytes")).first()
    shards = max(1, -(-size["n"] // SHARD_ITEMS), -(-size["n_bytes"] // SHARD_BYTES))
    if shards > 1:
        items = pin(items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards))))
        listed = pin(item_terms(items))
        whole = listed.agg(F.count("*"), F.sum("n_words"), F.max("n_words")).first()
        pairs = listed.select("shard", F.explode("terms").alias("term"))
        found = pairs.groupBy("term").agg(F.count("*").alias("n_items"))
        held = pin(pairs.distinct().join(found, "term"))
    out = None
    for shard in range(shards):
        own = items.where(f"shard = {shard}") if shards > 1 else items
        rows = sorted((r["item_id"], r["text"]) for r in own.select("item_id", "text").collect())
        corpus = None
        if shards > 1:
            terms = held.where(f"shard = {shard}").select("term", "n_items").collect()
            corpus = Corpus(whole[0], whole[1] or 0, whole[2] or 1, {r["term"]: r["n_items"] for r in terms})
        index = Index(rows, corpus)

        def work(index=index):
            def handle(batch):
                rows = {k: [] for k in ("doc_id", "item_id", "score", "question_overlap", "answer_overlap")}
                if not index.ids:
                    return None
                texts = [words_of(t) for t in batch.column("text").to_pylist()]
                for doc, words, found in zip(batch.column("doc_id").to_pylist(), texts, index.search(texts, threshold), strict=True):
                    shingles: dict[int, set] = {}
                    for item, score in found.items():
                        question, answer = index.overlaps(item, words, shingles)
                        if question >= QUESTION_OVERLAP and answer >= ANSWER_OVERLAP:
                            for name, value in zip(rows, (doc, index.ids[item], score, question, answer), strict=True):
                                rows[name].append(value)
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                return {name: pa.array(v, kind) for (name, v), kind in zip(rows.items(), kinds, strict=True)}

            return handle

        found = map_text(
            docs, ["doc_id", "text"], work,
            "doc_id long, item_id long, score double, question_overlap double, answer_overlap double",
        )
        out = found if out is None else out.unionByName(found)
    return out

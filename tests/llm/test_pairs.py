from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import AWKWARD, docs, words
from hypothesis import given, settings
from hypothesis import strategies as st

from candlemill.llm import repeats
from candlemill.llm.common import WordHashes, components, shingle_hashes, words_of
from candlemill.llm.embed_dedup import near_vectors
from candlemill.llm.ngram_jaccard import jaccard_classes


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_jaccard_equals_brute_force(spark, size, percent):
    rng = random.Random(3)
    base = [words(rng, n) for n in (30, 60, 150)]
    rows = []
    for k in range(90):
        w = base[k % 3].split()
        for _ in range(k % 7):
            w[rng.randrange(len(w))] = f"new{rng.randrange(50)}"
        rows.append((k, " ".join(w)))
    rows += [(200 + k, words(rng, rng.randrange(1, 40))) for k in range(40)] + AWKWARD + [(5, rows[5][1])]
    got = {r.doc_id: r for r in jaccard_classes(docs(spark, rows), size, percent).collect()}
    texts = dict(r for r in rows if r[0] is not None)
    hashes = WordHashes()
    sets = {k: set(shingle_hashes(hashes.of(words_of(t)), size).tolist()) for k, t in texts.items()}
    parent = {k: k for k in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(parent, a), find(parent, b)
                parent[max(x, y)] = min(x, y)
    assert {k: got[k].component_id for k in sets} == {k: find(parent, k) for k in sets}
    assert {k: got[k].n_shingles for k in sets} == {k: len(s) for k, s in sets.items()}
    assert got[None].component_id is None
    assert len({find(parent, k) for k in range(90)}) < 90


def test_pairs_of_an_empty_table(spark):
    assert jaccard_classes(docs(spark, [(1, "x")]).limit(0)).count() == 0
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert repeats.remove_repeats(docs(spark, [(1, "x")]).limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def brute_repeats(rows, length):
    counts = Counter()
    raw = [(i, (t or "").encode()) for i, t in rows]
    for _, d in raw:
        counts.update(d[k : k + length] for k in range(len(d) - length + 1))
    out = {}
    for i, d in raw:
        on = np.zeros(len(d), bool)
        for k in range(len(d) - length + 1):
            if counts[d[k : k + length]] > 1:
                on[k : k + length] = True
        kept = np.frombuffer(d, np.uint8)[~on].tobytes()
        out[i] = (len(d), int(on.sum()), int((np.diff(np.append(False, on).astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("crowd", [64, 3])
def test_repeats_equal_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    rng = random.Random(5)
    passage = ["".join(rng.choice("abcd é") for _ in range(900)) for _ in range(4)]
    noise = lambda: "".join(rng.choice("abxyz ") for _ in range(rng.randrange(600)))
    rows = [(i, noise() + passage[i % 4][rng.randrange(300) : rng.randrange(600, 900)] + noise()) for i in range(60)]
    rows += [(100, "a" * 1500), (101, "ab" * 700), (102, "q" * 400), (103, "z" * 399), (104, "k" * 399 + "é"), *AWKWARD]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(docs(spark, rows)).collect()}
    assert got == brute_repeats(rows, 400)


def test_repeats_keep_the_first(spark):
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefgh") for _ in range(900))
    rows = {r.doc_id: r for r in repeats.remove_repeats(docs(spark, [(k, text) for k in range(5)]), keep_first=True).collect()}
    assert sorted(r.n_removed for r in rows.values()) == [0, 900, 900, 900, 900]


@pytest.mark.parametrize("crowd", [64, 1])
def test_the_copy_of_the_least_id_stays(spark, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    rng = random.Random(7)
    passage = "".join(rng.choice("abcdefgh") for _ in range(700))
    noise = lambda: "".join(rng.choice("abxyz ") for _ in range(300))
    ids = [5, -3, 2**62, 0, None, 12]
    rows = [(k, f"{noise()}{edge}{passage}{edge}{noise()}") for k, edge in zip(ids, "ABCDEF", strict=True)] + [(7, noise() + "q" * 900)]
    got = {r.doc_id: r.n_removed for r in repeats.remove_repeats(docs(spark, rows), keep_first=True).collect()}
    # Of a run of 900 equal bytes all strings but the first are later copies.
    assert got == {-3: 0, **dict.fromkeys([5, 2**62, 0, None, 12], 700), 7: 899}


def brute_factors(data, starts, places, length):
    def common(i, j):
        return next((k for k in range(length) if data[i + k] != data[j + k]), length)

    pairs = list(zip(starts, places, strict=True))
    return [
        [max((common(i, j) for j, q in pairs if before(q, p)), default=0) for i, p in pairs] for before in (int.__lt__, int.__gt__)
    ]


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 40), st.text("ab", min_size=40, max_size=120), st.randoms())
def test_longest_factors_equal_brute_force(length, text, rng):
    data = text.encode()
    starts = list(range(len(data) - length + 1))
    places = rng.sample(range(1000), len(starts))
    got = repeats.longest_factors(repeats.doubled_ranks(np.frombuffer(data, np.uint8), length), np.array(starts), np.array(places), length)
    least = min(8, length)
    for found, want in zip(got, brute_factors(data, starts, places, length), strict=True):
        # Whole below the length of the search only up to the least width of a rank.
        assert all(g <= w < g + least or g == w for g, w in zip(found.tolist(), want, strict=True))
        assert [g == length for g in found.tolist()] == [w == length for w in want]


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((6, 16))
    rows = [(k, (base[k % 6] + 0.05 * rng.standard_normal(16)).tolist()) for k in range(60)]
    rows += [(100 + k, rng.standard_normal(16).tolist()) for k in range(60)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (302, [x * 1e200 for x in rows[1][1]])]
    odd = [(400, None), (401, [0.0] * 16), (402, [None] * 16), (403, [float("nan")] * 16), (404, []), (405, [1.0, 2.0]), (None, [1.0] * 16)]
    got = {r.vec_id: r for r in near_vectors(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")).collect()}
    near = {a: {b for b, y in rows if a != b and cosine(x, y) >= 0.9} for a, x in rows}
    assert {k: got[k].n_links for k in near} == {k: len(v) for k, v in near.items()}
    for k, v in near.items():
        assert all(got[b].component_id == got[k].component_id for b in v)
    assert all(got[k].n_links == 0 and got[k].component_id == k and got[k].kept for k, _ in odd if k)
    assert got[None].component_id is None and not got[None].kept


def cosine(x, y):
    x, y = np.array(x), np.array(y)
    x, y = x / np.abs(x).max(), y / np.abs(y).max()
    return x @ y / np.sqrt((x @ x) * (y @ y))

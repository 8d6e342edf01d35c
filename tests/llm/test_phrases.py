"""Phrases against plain counting, and the filters they are counted in."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import DOCS

from candlemill.llm import phrases
from candlemill.llm import quotient_filter as qf
from candlemill.llm.phrases import collocations


def plain(rows, least=10, kept=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, own in f.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            if any(100 * b >= 50 * a and p in (q[:2], q[1:]) for q, b in candidates.items() if len(q) > len(p)):
                continue
            cuts = [(1_000_000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((score, a, " ".join(p), own[p[:k]], own[p[k:]]))
        rows.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, rank, r[2], r[1], r[3], r[4], n[lang], r[0]) for rank, r in enumerate(rows[:kept], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(
        [(k, t, lang, None, 0, 0.5, "x", None) for k, (lang, t) in enumerate(rows)], DOCS
    ).repartition(3)


def some_rows(seed=1, n=1500):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "cat", "of", "new", "york", "city", "é", "漢字", "a", "a", "x-y", "\x00", "ß", "\x1cz"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "?"]
    rows = [(rng.choice(["en", "en", "de", None]), "".join(rng.choice(vocabulary) + rng.choice(ends) for _ in range(rng.randrange(60))))
            for _ in range(n)]
    return rows + [("en", None), (None, ""), ("fr", "too few words"), ("en", "new york city " * 12), ("en", "new york city " * 12)]


@pytest.mark.parametrize("shard", [2_000_000, 50])
def test_equals_plain_counting(spark, monkeypatch, shard):
    monkeypatch.setattr(phrases, "GRAMS_A_SHARD", shard)
    rows = some_rows()
    got = sorted(map(tuple, collocations(frame(spark, rows)).collect()))
    assert got == plain(rows) and len(got) > 50
    got = sorted(map(tuple, collocations(frame(spark, rows), least=3, kept=7).collect()))
    assert got == plain(rows, 3, 7)


def test_slices_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SLICE_BYTES", 200)
    monkeypatch.setattr(phrases, "GRAMS_AT_ONCE", 100)
    rng = random.Random(5)
    rows = [("en", " ".join(f"w{rng.randrange(30)}" for _ in range(20_000))), *some_rows(2, 40)]
    rows += [("en", " ".join(f"once{k}" for k in range(70_000)))]  # more words than 16 bits number
    assert sorted(map(tuple, collocations(frame(spark, rows)).collect())) == plain(rows)


def test_nothing_to_count(spark):
    assert collocations(frame(spark, [("en", None), (None, " .. \n")])).count() == 0
    assert collocations(frame(spark, [("en", "a b")]).limit(0)).count() == 0


def test_scores_are_exact(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        a = rng.randrange(1, 10 ** rng.randrange(1, 15))
        rows.append((a, a + rng.randrange(0, 10 ** rng.randrange(1, 15)) % 10**14, a + rng.randrange(0, 3)))
    df = spark.createDataFrame(rows, "a long, l long, r long").withColumn("score", phrases.score_of("a", "l", "r"))
    for r in df.collect():
        assert r.score == 1_000_000 * r.a * r.a // (r.l * r.r)


@pytest.mark.parametrize("bits", [1, 2, 7, 17, 21, 22, 30, 42])
def test_filters_lose_nothing(bits):
    rng = np.random.default_rng(bits)
    numbers = qf.Permutation(bits)
    ids = [rng.integers(0, 1 << bits, 4000, dtype=np.uint64) for _ in range(3)]
    high, low = numbers.forward(*ids)
    assert all((x == y).all() for x, y in zip(ids, numbers.back(high, low), strict=True))
    at = rng.integers(0, 4000, 15_000)
    want = Counter(zip(high[at].tolist(), low[at].tolist(), strict=True))
    entries = qf.counted(high[at], low[at])
    assert list(zip(*(x.tolist() for x in entries), strict=True)) == [(*k, want[k]) for k in sorted(want)]
    entries.counts[0], entries.counts[1], entries.counts[-1] = 255, 300, 1 << 40
    for shard_bits in (0, 1, 2):
        left = numbers.high_bits - shard_bits
        parts = qf.shards_of(entries, numbers.high_bits, shard_bits)
        back = [qf.decode(qf.encode(part, left, numbers.low_bits), k, left) for k, part in parts]
        whole = qf.merged(back + back)
        assert (whole.high == entries.high).all() and (whole.low == entries.low).all()
        assert (whole.counts == 2 * entries.counts).all()


def test_permutation_of_all_numbers():
    numbers = qf.Permutation(3)
    high, _ = numbers.forward(*np.array(list(itertools.product(range(8), repeat=3)), np.uint64).T)
    assert sorted(high.tolist()) == list(range(512))


def test_like_leading_bits_are_told_apart():
    high, low = np.array([5, 5, 5, 4], np.uint64), np.array([9, 2, 9, 1], np.uint64)
    got = qf.counted(high, low)
    assert [x.tolist() for x in got] == [[4, 5, 5], [1, 2, 9], [1, 1, 2]]

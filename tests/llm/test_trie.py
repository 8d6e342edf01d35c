"""The trie of conversations against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

from candlemill.llm import conversation_trie as module
from candlemill.llm.conversation_trie import conversation_trie, trie, turns_of

SCHEMA = "conv_id long, turn long, role string, text string, depth int, path string, key string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "p", None) for r in rows], SCHEMA).repartition(3)


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def plain(rows, group=100, most=6):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0), digest(role, text), role, text))
    turns = {c: [(role, text) for _, _, role, text in sorted(x)] for c, x in own.items()}

    def first_of(c):
        return c - (c % group if c >= 0 else -(-c % group))

    whole = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % most
        whole[c] = tuple(turns.get(first_of(c), [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = defaultdict(list)
    for s in members:
        if s:
            children[s[:-1]].append(s)
    leaves, saved = {}, {}
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = sum(leaves[x] for x in children[s]) or 1
        saved[s] = sum(saved[x] for x in children[s]) + ((len(members[s]) - 1) * len(s[-1][1]) if s else 0)
    out = []
    for s, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if whole[c] == s)
        parent = min(members[s[:-1]]) if s else None
        out.append((min(m), len(s), parent, len(m), len(children[s]), leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows):
    got = sorted(map(tuple, conversation_trie(frame(spark, rows)).collect()), key=repr)
    assert got == plain(rows)
    return got


def random_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 900), n):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "bot", None]), rng.choice(["a", "bb", "é漢", None, "", "long " * 5])))
    return rows


def test_equals_plain_python(spark):
    for seed in (1, 2):
        assert len(check(spark, random_rows(seed, 250))) > 400


def test_awkward_rows(spark):
    rows = [(None, 0, "user", "x"), (5, 0, None, None), (5, 0, "", ""), (5, None, "u", "z"), (5, 0, "u", "b"), (5, 0, "u", "a")]
    rows += [(200, 0, "user", "hi"), (200, 0, "user", "hi"), (207, 3, "a:", "b"), (208, 3, "a", ":b")]
    check(spark, rows)
    assert conversation_trie(frame(spark, rows[:1])).count() == 0
    assert conversation_trie(frame(spark, rows).limit(0)).count() == 0


def test_copies_and_a_shared_beginning(spark, monkeypatch):
    """Most conversations are copies of one, or go on from one long beginning."""
    monkeypatch.setattr(module, "IDS_AT_ONCE", 7)
    rows = [(1000 + 100 * k, t, "user", f"same {t}") for k in range(60) for t in range(3)]
    rows += [(9000 + 100 * k, t, "user", f"same {t}" if t < 12 else f"own {k}") for k in range(25) for t in range(13 + k % 3)]
    rows += [(20_000, t, "bot", f"turn {t}") for t in range(2500)] + [(30_000, t, "bot", f"turn {t}") for t in range(12)]
    got = check(spark, rows)
    assert max(r[3] for r in got if r[1] == 1) == 85


def test_conversations_as_they_are(spark):
    """Without rebuilding, through the operator's own interface."""
    rows = [(k, t, "user", f"{k % 3} {t}") for k in range(9) for t in range(4)]
    got = trie(turns_of(frame(spark, rows))).collect()
    assert len(got) == 1 + 3 * 4
    assert sorted((r.conv_id, r.n_convs, r.n_children) for r in got if r.depth == 1) == [(0, 3, 1), (1, 3, 1), (2, 3, 1)]
    (root,) = (r for r in got if r.depth == 0)
    assert (root.parent_conv_id, root.n_convs, root.n_children, root.n_leaves, root.saved_tokens) == (None, 9, 3, 3, 3 * 4 * 2 * 3)

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from helpers import AWKWARD, docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from candlemill.llm.packing import configuration_plan, pack
from candlemill.llm.tokens import VOCABULARY, WordEncoder
from candlemill.llm.training_order import Permutation, materialise, read_sequences

ENCODER = WordEncoder()
ODD = [
    "It's don't WE'LL ''' 's 'x' a'sb", "naïve ÉCOLE İstanbul ΣΑΣ ς ß ẞ ǅ", "é café ﬁ", "a b c\x1cd\x85e", "日本 ไทย 😀👍🏽",
    "<|endoftext|> x", "12 345 6x7", "a.'s b,'t !'s word's.", "hello\tworld\r\nnew\x0bline",
]


def exact(text):
    return ENCODER.model.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_ids_are_those_of_the_whole_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts] + ODD
    assert [x.tolist() for x in ENCODER.encode(texts)] == [exact(t) for t in texts]


def test_added_tokens_in_texts():
    fresh = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    added = [t.content for t in fresh.get_added_tokens_decoder().values()]
    texts = [f"{a}{t}{b}" for t in [*added, *(t.upper() for t in added)] for a in ("", "a ", "日本", "é") for b in ("", " b", "x", "\u0338", "日本")]
    texts += [added[0] * 3, "plain", None, "", "<|endoftext", "endoftext|> x"]
    assert [x.tolist() for x in ENCODER.encode(texts)] == [fresh.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert fresh.token_to_id("<|endoftext|>") in ENCODER.encode(["a <|endoftext|> b"])[0]


def test_every_piece_has_a_place(spark):
    rows = [(k, " ".join(["word", "token", "x"][: 1 + k % 3] * (k * 37 % 900))) for k in range(60)] + AWKWARD + [(3, "again")]
    got = pack(docs(spark, rows), capacity=256).collect()
    want = {}
    for i, t in rows:
        ids = np.array([*exact(t), 0], "<u4")
        for p, low in enumerate(range(0, len(ids), 256)):
            part = ids[low : low + 256]
            want.setdefault((i, p, low, len(part), zlib.crc32(part.tobytes())), 0)
            want[i, p, low, len(part), zlib.crc32(part.tobytes())] += 1
    found = {}
    for r in got:
        key = (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
        found[key] = found.get(key, 0) + 1
    assert found == want
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(by) <= -(-sum(r.length for r in got) // 256) + 2
    assert pack(docs(spark, rows).limit(0)).count() == 0


def test_plan_serves_every_length_once():
    rng = np.random.default_rng(2)
    for capacity, size in ((50, 30), (200, 500), (2048, 3000)):
        counts = np.bincount(rng.integers(1, capacity + 1, size), minlength=capacity + 1)
        served = np.zeros(capacity + 1, int)
        plan = configuration_plan(counts, capacity)
        for pattern, number in plan:
            assert sum(s * t for s, t in pattern) <= capacity
            for s, t in pattern:
                served[s] += t * number
        assert (served == counts).all()


def test_permutation_and_its_inverse():
    for size in (1, 2, 3, 100, 1023, 1025, 70_001):
        order = Permutation(size, 9)
        slots = order.slots(np.arange(size))
        assert (np.sort(slots) == np.arange(size)).all()
        assert (order.numbers(slots) == np.arange(size)).all()


def test_shards_hold_the_stream(spark, tmp_path):
    rows = [(k, " ".join(["alpha", "beta"] * (k % 50))) for k in range(80)] + AWKWARD
    folder = f"file://{tmp_path}/shards"
    got = materialise(docs(spark, rows), folder, key=4, length=64, shard_sequences=8).collect()
    data = read_sequences(folder, 0, len(got))
    assert [zlib.crc32(x.tobytes()) for x in data] == [r.ids_crc32 for r in sorted(got, key=lambda r: r.slot)]
    assert (read_sequences(folder, 5, 19) == data[5:19]).all()
    stream = np.concatenate([data[r.slot] for r in sorted(got, key=lambda r: r.sequence)])
    total = sum(r.n_tokens for r in got)
    assert total == sum(len(exact(t)) + 1 for _, t in rows)
    assert sorted(stream[:total].tolist()) == sorted(x for _, t in rows for x in [*exact(t), 0])
    assert {i for r in got for i in r.doc_ids} == {i for i, _ in rows}
    assert materialise(docs(spark, rows).limit(0), f"{folder}-none").count() == 0


def test_records_are_where_they_should_be(spark, tmp_path):
    """Slots, offsets, lengths and the order of ids, against the texts themselves."""
    rows = [(k, " ".join(["alpha", "beta", "c"] * (k * 7 % 50))) for k in range(90)] + AWKWARD + [(95, "long " * 3000)]
    length, per_shard, key = 64, 8, 4
    got = materialise(docs(spark, rows), f"file://{tmp_path}/s", key=key, length=length, shard_sequences=per_shard).collect()
    order = Permutation(len(got), key)
    texts = dict(rows)
    width = 2
    stream, owners = [], []
    for r in sorted(got, key=lambda r: r.sequence):
        assert r.slot == order.slots(np.array([r.sequence]))[0] and r.shard == r.slot // per_shard
        assert r.byte_offset == r.slot % per_shard * length * width
        raw = (tmp_path / f"s/shard-{r.shard:06d}.bin").read_bytes()[r.byte_offset : r.byte_offset + length * width]
        assert zlib.crc32(raw) == r.ids_crc32
        ids = np.frombuffer(raw, "<u2")
        assert (ids[r.n_tokens :] == 0).all() and (r.n_tokens == length or r.sequence == len(got) - 1)
        stream += ids[: r.n_tokens].tolist()
        # A document that goes on from the sequence before is named in both.
        owners += r.doc_ids[1:] if owners and owners[-1] == r.doc_ids[0] else r.doc_ids
    assert sorted(map(str, owners)) == sorted(str(k) for k, _ in rows)
    assert stream == [x for k in owners for x in [*exact(texts[k]), 0]]

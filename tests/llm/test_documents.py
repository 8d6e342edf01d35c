from __future__ import annotations

import random
import re
import zlib

import numpy as np
from helpers import AWKWARD, docs, words
from pyspark.sql import functions as F

import corpus_pipeline
from candlemill.llm import decontaminate, sampling
from candlemill.llm.decontaminate import Index, leaks
from candlemill.llm.language import language
from candlemill.llm.pii import base_spans, disclosing_terms, luhn, sanitise
from candlemill.llm.quality import quality
from candlemill.llm.toxicity import toxicity

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain_spans(text):
    out = []
    for k, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if k == 1 and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if k == 2 and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if k == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_plain_patterns():
    rng = random.Random(1)
    parts = ["@", "a", "B.", "1", "23", " ", "-", "+", "(", "5.6", ".", "%", "_", "é", "x@y.z", "+1 (26", "9.9.9.9", "4111 1111 1111 111", "\n"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        assert base_spans(text) == plain_spans(text)
    assert base_spans("a" * 200_000 + "@") == base_spans("7" * 200_000) == []


def test_terms_of_one_person_go(spark):
    rows = [(k, f"report {k} says zanzibor and {['blue', 'red', 'green'][k % 3]} wrote bob@mail.com about w{k}") for k in range(12)]
    rows += [(100 + k, f"plain text {k} says nothing and wrote blue red green") for k in range(60)] + AWKWARD
    frame = docs(spark, rows)
    risky = {r.term for r in disclosing_terms(frame).collect()}
    assert "zanzibor" in risky and not risky & {"and", "blue", "text", "nothing"}
    got = {r.doc_id: r for r in sanitise(frame).collect()}
    assert "bob@mail.com" not in got[1].text and "zanzibor" not in got[1].text and "[EMAIL]" in got[1].text
    assert got[1].n_email == 1 and got[1].spans.startswith("term:") and got[101].text == rows[13][1]
    assert got[9001].text is None and got[9002].text == "" and got[9001].spans == ""
    # Copies are one context and disclose nothing.
    same = docs(spark, [(k, rows[0][1]) for k in range(20)])
    assert disclosing_terms(same).count() == 0
    assert sanitise(frame.limit(0)).count() == 0


def test_terms_go_whatever_stands_around_them(spark):
    far = [f"{'.' * 700} report {k} by _Zanzibor_ of 3quibble room 4711 {' ' * 900} bob@mail.com {'.' * 700} w{k} {'-' * 400}" for k in range(12)]
    plain = [f"plain text {k} says room 12 and report by of" for k in range(60)]
    lone = ["_Zanzibor was here", "see 3quibble_", "call 4711."]
    frame = docs(spark, [*enumerate(far), *((100 + k, t) for k, t in enumerate(plain)), *((200 + k, t) for k, t in enumerate(lone))])
    risky = {r.term for r in disclosing_terms(frame, threshold=0.5).collect()}
    assert {"zanzibor", "quibble", "4711"} <= risky and not risky & {"report", "room", "by", "of"}
    got = {r.doc_id: r for r in sanitise(frame, generalise=0.5, remove=2).collect()}
    assert [got[200 + k].text for k in range(3)] == ["_[NAME] was here", "see 3[WORD]_", "call [WORD]."]
    assert [got[200 + k].spans for k in range(3)] == ["term:1:9", "term:5:12", "term:5:9"]
    assert all("anzibor" not in got[k].text and "quibble" not in got[k].text and "4711" not in got[k].text for k in range(12))


def test_wand_equals_exhaustive_scores():
    rng = random.Random(2)
    index = Index([(k, words(rng, rng.randrange(1, 50), 120) + ". " + words(rng, 4, 120)) for k in range(70)] + [(99, ""), (98, None)])
    for _ in range(100):
        own = rng.choice(index.words)
        terms = {index.terms[w] for w in rng.sample(sorted(index.terms), 15) + own[: rng.randrange(len(own) + 1)]}
        lists = np.concatenate([np.arange(index.term_lists[t], index.term_lists[t + 1]) for t in terms])
        scores = np.zeros(len(index.ids))
        for k in lists:
            part = slice(index.list_starts[k], index.list_ends[k])
            scores[index.docs[part]] += index.impacts[part]
        for threshold in (0.05, 0.3, 0.8):
            for block in range(index.n_blocks):
                got = dict(index.traverse(lists[index.list_block[lists] == block], threshold))
                want = {k for k in np.flatnonzero(scores >= threshold - 1e-9) if k // decontaminate.BLOCK == block}
                assert set(got) == want and all(abs(got[k] - scores[k]) < 1e-9 for k in want)


def test_block_search_equals_exhaustive_scores():
    rng = random.Random(21)
    index = Index([(k, words(rng, rng.randrange(1, 50), 120) + ". " + words(rng, 4, 120)) for k in range(70)] + [(99, ""), (98, None)])
    # Shorter than a passage, so that each text is one.
    texts = [(words(rng, 20, 120) + " " + " ".join(rng.choice(index.words)[: rng.randrange(40)])).split() for _ in range(60)]
    for threshold in (0.05, 0.3, 0.8):
        for text, got in zip(texts, index.search(texts, threshold), strict=True):
            scores = np.zeros(len(index.ids))
            for t in {index.terms[w] for w in text if w in index.terms}:
                low, high = index.term_lists[t], index.term_lists[t + 1]
                for k in range(low, high):
                    part = slice(index.list_starts[k], index.list_ends[k])
                    scores[index.docs[part]] += index.impacts[part]
            want = {k: scores[k] for k in np.flatnonzero(scores >= threshold - 1e-9)}
            assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_shards_score_like_one_index(spark, monkeypatch):
    rng = random.Random(22)
    items = [(k, words(rng, rng.randrange(5, 60), 60) + ". " + words(rng, 5, 60)) for k in range(40)] + [(50, ""), (51, "?!")]
    rows = [(k, words(rng, 30, 60) + " " + " ".join(items[k % 40][1].split()[: 8 + k]) + " " + words(rng, 30, 60)) for k in range(80)]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def found():
        return sorted((r.doc_id, r.item_id, round(r.score, 9)) for r in leaks(docs(spark, rows), bench, 0.4).collect())

    one = found()
    assert len(one) > 20
    monkeypatch.setattr(decontaminate, "SHARD_ITEMS", 15)
    assert found() == one
    monkeypatch.setattr(decontaminate, "SHARD_ITEMS", 1000)
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 3000)
    assert found() == one


def test_leaks_are_found_and_others_left(spark):
    rng = random.Random(4)
    items = [(k, words(rng, 30, 5000) + ". " + words(rng, 8, 5000)) for k in range(25)] + [(50, None), (51, ""), (None, "x y z")]
    rows = [(k, words(rng, 200, 5000)) for k in range(30)]
    rows += [(100 + k, words(rng, 37 * k, 5000) + " " + items[k][1].upper() + " " + words(rng, 90, 5000)) for k in range(25)] + AWKWARD
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks(docs(spark, rows), bench).collect()}
    assert got == {(100 + k, k) for k in range(25)}
    assert leaks(docs(spark, rows), bench.limit(0)).count() == leaks(docs(spark, rows).limit(0), bench).count() == 0


def labelled(n=400):
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(n):
        toxic, junk = k % 5 == 0, k % 4 == 1
        w = ["the", "of", "and", *words(rng, 60, 300).split()]
        if toxic:
            w[7] = w[30] = rng.choice(["gruntle", "gruntlest", "snarfing"])
        text = " ".join(w) + "."
        rows.append((k, "### $$$ " * 30 + text.upper() if junk else text))
        labels.append((k, int(not junk), int(toxic)))
    return rows, labels


def test_classifiers_on_held_out_rows(spark):
    rows, marks = labelled()
    labels = spark.createDataFrame([*marks, (None, 1, 1), (9001, None, None), (1, 0, 0)], "doc_id long, quality int, toxic int")
    frame = docs(spark, rows + AWKWARD)
    truth = {k: (q, t) for k, q, t in marks}
    for fit, at in ((toxicity, 1), (quality, 0)):
        got = fit(frame, labels).collect()
        assert len(got) == len(rows) + len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
        for r in got:
            assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        held = [r for r in got if r.held_out and r.doc_id in truth]
        right = sum(r.predicted == truth[r.doc_id][at] for r in held)
        assert right >= 0.9 * len(held)
        assert fit(frame, labels.limit(0)).count() == len(got)
        assert fit(frame.limit(0), labels).count() == 0


def test_languages(spark):
    rng = random.Random(9)
    kinds = {"aa": "abcde", "bb": "vwxyz", "cc": "mnopq"}
    rows = [(k, " ".join("".join(rng.choice(kinds[lang]) for _ in range(5)) for _ in range(30)), lang) for k, lang in enumerate(["aa", "bb", "cc"] * 60)]
    odd = [(500, None, "aa"), (501, "", "bb"), (502, "123 !!", "cc"), (503, "abcab", None), (None, "vwxvw", "aa")]
    frame = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language(frame).collect()}
    held = [k for k, _, _ in rows if got[k].held_out]
    assert all(got[k].lang_pred == rows[k][2] for k in held) and held
    assert [got[k].lang_pred for k in (500, 501, 502, 503, None)] == ["und", "und", "und", "aa", "bb"]
    assert got[500].score == 0.0
    assert {r.lang_pred for r in language(frame.where("lang is null")).collect()} == {"und"}


def test_every_language_is_learned(spark):
    rng = random.Random(12)
    kinds = {f"l{k:03}": [chr(0x4E00 + 9 * k + j) for j in range(9)] for k in range(215)}
    rows = [(k, "".join(rng.choice(kinds[lang]) for _ in range(30)), lang) for k, lang in enumerate(sorted(kinds) * 5)]
    # Common languages first, so that those with fewest rows are the further ones.
    rows += [(5000 + k, "".join(rng.choice(kinds["l000"]) for _ in range(30)), "l000") for k in range(60)]
    got = {r.doc_id: r.lang_pred for r in language(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)).collect()}
    assert {got[k] for k, _, _ in rows} == set(kinds)
    assert sum(got[k] == lang for k, _, lang in rows) > 0.95 * len(rows)


def test_sample_of_every_class(spark, monkeypatch):
    monkeypatch.setattr(sampling, "MAX_ROWS", 30)
    rows = [(1, f"t{k}", "big") for k in range(400)] + [(2, "same", "copies")] * 300 + [(k, f"x{k}", f"c{k}") for k in range(20)]
    frame = spark.createDataFrame([*rows, (None, "n", None)], "doc_id long, text string, lang string")
    got = sampling.class_sample(frame, "lang", 10, ["doc_id", "text"]).distinct().collect()
    assert {r.lang for r in got} == {"big", "copies", *(f"c{k}" for k in range(20))} and len(got) < 40
    monkeypatch.setattr(sampling, "MAX_ROWS", 12_000)
    got = sampling.class_sample(frame, "lang", 100, ["doc_id", "text"]).distinct().collect()
    assert 60 < sum(r.lang == "big" for r in got) < 140


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    """Columns named like those that stages make."""
    rng = random.Random(41)
    a, item = words(rng, 60, 5000), words(rng, 40, 9000) + ". the answer is forty two here"
    rows = [(1, a), (2, a + " x"), (3, item), (4, words(rng, 60, 5000)), (4, words(rng, 60, 5000)), (None, None)]
    frame = docs(spark, rows).withColumns({c: F.lit("own") for c in ("row_key", "text_key", "component_id", "n_shingles", "rows", "head")})
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.decontamination_stage(spark, corpus_pipeline.near_copies_stage(spark, frame, str(tmp_path)), str(tmp_path))
    assert got.columns == frame.columns
    found = got.collect()
    assert sorted((r.doc_id for r in found), key=repr) == [1, 4, 4, None]
    assert {(r.row_key, r.text_key, r.component_id) for r in found} == {("own",) * 3}


def test_near_copies_are_told_by_row(spark):
    rng = random.Random(11)
    a, b, c, d, e, f = (words(rng, 60, 5000) for _ in range(6))
    rows = [(7, a), (7, b), (7, b), (3, c), (5, c), (5, d), (None, e), (None, e), (None, c), (None, e + " more"), (-2, f), (None, f)]
    rows += [(8, None), (8, ""), (None, None), (None, " "), (8, "")]
    got = corpus_pipeline.near_copies_stage(spark, docs(spark, rows), "")
    assert got.columns == docs(spark, rows).columns
    found = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)
    either = [x for x in found if x[1] in (e, e + " more")]
    assert len(either) == 1 and either[0][0] is None
    want = [(7, a), (7, b), (3, c), (5, d), (-2, f), *either, *rows[-5:]]
    assert found == sorted(want, key=repr)


def test_every_stage_on_awkward_rows(spark, tmp_path):
    rows, marks = labelled(120)
    rng = random.Random(1)
    item = words(rng, 40, 9000) + ". the answer is forty two here"
    folder = str(tmp_path)
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    extra = [(1000, item), (1001, "mail me at joe@site.org now"), (1002, words(rng, 80)), (1002, words(rng, 80))]
    docs(spark, rows + AWKWARD + extra).write.parquet(f"{folder}/documents.parquet")
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    columns = frame.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frame, folder).write.parquet(f"{folder}/{name}")
        frame = spark.read.parquet(f"{folder}/{name}")
        if name != "packing":
            assert frame.columns == columns
            ids = [r.doc_id for r in frame.select("doc_id").collect()]
            assert 9001 in ids and 9002 in ids and None in ids
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/pii").collect()}
    assert 1000 not in texts and texts[1001] == "mail me at [EMAIL] now" and 9005 not in texts
    assert {r.doc_id for r in frame.collect()} == set(texts)


def test_long_texts_are_learned_from(spark):
    """Labelled texts that are all long, and one language of long texts only."""
    rng = random.Random(31)
    kinds = {"aa": "abcde", "bb": "vwxyz"}

    def text(lang, n):
        return " ".join("".join(rng.choice(kinds[lang]) for _ in range(5)) for _ in range(n))

    rows = [(k, text("aa" if k % 2 else "bb", 3500 if k < 40 or k % 2 else 40), "aa" if k % 2 else "bb") for k in range(100)]
    for part in (rows[:40], rows):
        got = {r.doc_id: r.lang_pred for r in language(spark.createDataFrame(part, "doc_id long, text string, lang string")).collect()}
        assert all(got[k] == lang for k, _, lang in part)
    texts = [(k, words(rng, 5000) + (" gruntle" * (k % 4 == 0))) for k in range(120)]
    labels = spark.createDataFrame([(k, int(k % 4 > 0), int(k % 4 == 0)) for k in range(120)], "doc_id long, quality int, toxic int")
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in toxicity(docs(spark, texts), labels).collect())
    assert len({r.score for r in quality(docs(spark, texts), labels).collect()}) > 1


def test_long_texts_mean_fewer_rows(spark, monkeypatch):
    rows = [(k, "x" * (10 + 90 * (k % 10)), "a" if k % 3 else "b") for k in range(300)] + [(900, "y" * 5000, "c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(sampling, "MAX_BYTES", 3000)
    got = sampling.within_bytes(frame, "lang", ["doc_id"]).collect()
    sizes = {lang: sum(len(r.text) for r in got if r.lang == lang) for lang in "abc"}
    assert sizes["c"] == 5000 and 0 < sizes["a"] <= 1000 and 0 < sizes["b"] <= 1000
    monkeypatch.setattr(sampling, "MAX_BYTES", 1 << 20)
    assert len(sampling.within_bytes(frame, "lang", ["doc_id"]).collect()) == 301


def test_rejected_rows_keep_all_columns(spark):
    """Columns named like those that scoring makes, in any order."""
    from candlemill.llm.toxicity import without_toxic

    rows, marks = labelled(200)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    frame = docs(spark, rows).selectExpr("score", "c0 AS c1", "text", "'k' AS `score of text`", "doc_id", "terms AS n_chars")
    got = without_toxic(frame, labels)
    assert got.columns == frame.columns
    kept = got.collect()
    assert {(r["score"], r["c1"], r["score of text"]) for r in kept} == {(0.5, "x", "k")}
    assert {r.text for r in kept} <= {t for _, t in rows} and 140 < len(kept) < 190


def naive_score(net, text):
    """Convolution, greatest response and logistic layer, word by word."""
    from candlemill.llm import toxicity as module

    words_ = module.Words()
    at = words_.of(text)
    vectors = [sum(net.table[i].astype(float) for i in words_.ids[k]) for k in at]
    vectors += [np.zeros(module.WIDTH)] * module._PAD
    features = []
    for width, kernel in net.filters.items():
        best = net.bias[width].astype(float)
        for start in range(len(at)):
            h = sum(vectors[start + k] @ kernel[k] for k in range(width)) + net.bias[width]
            best = np.maximum(best, h)
        features.append(np.maximum(best, 0))
    return np.concatenate(features) @ net.out + net.constant


def test_network_equals_naive_convolution():
    from candlemill.llm import toxicity as module

    rows, marks = labelled(120)
    net = module.train([t for _, t in rows], [t for _, _, t in marks])
    known = module.Words()
    texts = [t for _, t in rows[:12]] + ["", "one", "gruntle snarfing", "the " * 40]
    own = [known.of(t) for t in texts]
    places, starts, pads = module.layout(own)
    table = net.vectors(known.ids)
    x = table[np.where(pads, len(table) - 1, places)]
    got = net.logits(x, starts, pads)
    assert np.allclose(got, [naive_score(net, t) for t in texts], atol=1e-3)

"""Small tables with every awkward row, and a frame for them."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, c0 string, terms string"


def docs(spark, rows):
    """(doc_id, text) rows with further columns, some named like results."""
    return spark.createDataFrame(
        [(i, t, "en", None, len(t or ""), 0.5, "x", None) for i, t in rows], DOCS
    ).repartition(3)


def words(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


AWKWARD = [(9001, None), (9002, ""), (9003, " \n\t "), (9004, "one"), (9005, "one"), (None, "no id here at all"), (9006, "é" * 30), (9007, "Tab\tand line\n" * 3)]

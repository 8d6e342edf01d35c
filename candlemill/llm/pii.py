"""Personal data: patterns, and terms that disclose protected values by co-occurrence.

The patterns find addresses and numbers. Each value found is a protected
entity. A term near an entity discloses it in part: how much is the pointwise
mutual information of term and entity in the corpus, as a share of the entity's
own information. Where a term is seen with one entity in several different
contexts and hardly without it, the share nears 1: above ``GENERALISE`` the
term is replaced by its kind, above ``REMOVE`` it is dropped. Copies of a text
are one context, so a copied page discloses nothing by itself.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import ddl, map_text
from candlemill.session import pin

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: Words on each side of a value that are its context.
CONTEXT_WORDS = 8
#: Different contexts in which a term must be seen with a value.
SUPPORT = 3
#: Least share of a term's contexts that are contexts of the one value.
SPECIFIC = 0.6
GENERALISE = 0.8
REMOVE = 0.95

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9]){13,}")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A word begins with a letter and ends before closing underscores, or is a run of digits; so ``_Anna_`` and ``3anna`` hold ``anna``.
_WORD = re.compile(r"[^\W\d_]\w*[^\W_]|\d{2,}")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain, in time linear in the text."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            end = m.end()
        else:
            end = at + 1  # nothing before this @ can be part of a later match
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches that hold, in order."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group())
        if len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def entity(text: str, span: tuple[int, int, int]) -> str:
    """The protected value: kind and characters without separators."""
    start, kind, end = span
    raw = text[start:end].lower()
    return KINDS[kind] + ":" + (raw if kind < 2 else "".join(c for c in raw if c.isdigit()))


def words_outside(text: str, spans: list[tuple[int, int, int]]) -> Iterator[re.Match]:
    """Matches of the words that don't touch a value, in order."""
    k, reach = 0, -1
    for m in _WORD.finditer(text):
        while k < len(spans) and spans[k][0] < m.end():
            reach = max(reach, spans[k][2])
            k += 1
        if m.start() >= reach:
            yield m


def contexts(text: str, spans: list[tuple[int, int, int]]):
    """(entity, hash of the context, its distinct terms) around each value.

    The context are the CONTEXT_WORDS nearest words outside all values on each
    side, however far away. A term is a word of two characters or more.
    """
    # Places only: a text may be long.
    starts, ends = array("q"), array("q")
    for m in words_outside(text, spans):
        starts.append(m.start()), ends.append(m.end())
    for span in spans:
        k = bisect_left(starts, span[0])
        near = range(max(0, k - CONTEXT_WORDS), min(len(starts), k + CONTEXT_WORDS))
        words = [text[starts[j] : ends[j]].lower() for j in near]
        if words:
            yield entity(text, span), xxhash.xxh3_64_intdigest(" ".join(words)), sorted(set(words))


def text_key():
    """A hash of the text that stands for it in joins; a null text has that of an empty one."""
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def text_words(keyed: DataFrame) -> DataFrame:
    """Rows (key, term): the words of each text, values or not."""

    def work():
        def handle(batch):
            found = [sorted({w.lower() for w in _WORD.findall(t or "")}) for t in batch.column("text").to_pylist()]
            return {"key": batch.column("key"), "terms": pa.array(found, pa.list_(pa.string()))}

        return handle

    return map_text(keyed, ["key", "text"], work, "key binary, terms array<string>").select("key", F.explode("terms").alias("term"))


def disclosing_terms(docs: DataFrame, support: int = SUPPORT, threshold: float = GENERALISE) -> DataFrame:
    """Rows (term, entity, share): terms that disclose an entity, over all documents.

    ``n_te``, ``n_e`` and ``n_t`` count different contexts of term and entity,
    contexts of the entity, and different texts with the term; ``n`` counts the
    different texts. At least SPECIFIC of the term's contexts must be the
    entity's; then share = log(n_te n / (n_e' n_t)) / log(n / n_e') with
    n_e' = max(n_e, n_te): the mutual information over the entity's own.
    """

    def work():
        def handle(batch):
            entities, hashes, terms = [], [], []
            for text in batch.column("text").to_pylist():
                if not text:
                    continue
                if spans := base_spans(text):
                    for value, h, words in contexts(text, spans):
                        entities.append(value), hashes.append(h - (1 << 63)), terms.append(words)
            return {"entity": pa.array(entities, pa.string()), "context": pa.array(hashes, pa.int64()), "terms": pa.array(terms, pa.list_(pa.string()))}

        return handle

    found = pin(map_text(docs, ["text"], work, "entity string, context long, terms array<string>").distinct())
    pairs = found.select("entity", "context", F.explode("terms").alias("term"))
    near = pin(pairs.groupBy("term", "entity").agg(F.count("*").alias("n_te")))
    by_term = near.groupBy("term").agg(F.sum("n_te").alias("n_near"))
    likely = (
        near.where(F.col("n_te") >= support)
        .join(by_term, "term")
        .where(F.col("n_te") >= SPECIFIC * F.col("n_near"))
        .select("term", "entity", "n_te")
    )
    likely = pin(likely)
    if likely.isEmpty():
        return likely.select("term", "entity", F.lit(0.0).alias("share")).limit(0)
    of_entity = found.groupBy("entity").agg(F.count("*").alias("n_e"))
    keyed = docs.select(text_key().alias("key"), "text").where(F.length("text") > 0)
    n = keyed.select("key").distinct().count()
    # Different texts are counted by their keys; the texts themselves don't leave their tasks.
    seen = text_words(keyed).join(likely.select("term").distinct(), "term").distinct()
    of_term = seen.groupBy("term").agg(F.count("*").alias("n_t"))
    own = F.greatest("n_e", "n_te")
    total = F.greatest(F.lit(float(n)), own + 1, F.col("n_t").cast("double"))
    share = F.log(F.col("n_te") * total / (own * F.greatest("n_t", "n_te"))) / F.log(total / own)
    return (
        likely.join(of_entity, "entity")
        .join(of_term, "term")
        .select("term", "entity", share.alias("share"))
        .where(F.col("share") >= threshold)
    )


def sanitise(
    docs: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE, carry: list[str] | None = None
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_email, n_ip, n_card, n_phone, n_term, base_sha256, spans, text).

    ``carry`` names further columns of ``docs`` that stay as they are.

    Values are replaced by their kind in brackets; disclosing terms by their
    kind, or by nothing from ``remove`` on. ``spans`` lists kind:start:end of
    values and terms by start, then kind, in code points; ``base_sha256`` is the
    hash of the same list without terms. A null text has no spans and stays
    null; an empty one stays empty. Repeated rows are treated alike; other
    columns are not read.
    """
    risky = pin(disclosing_terms(docs, support, generalise).groupBy("term").agg(F.max("share").alias("share")))
    carry = carry or []
    rows = docs.select("doc_id", "text", *carry)
    if risky.isEmpty():
        held = rows.withColumn("terms", F.expr("cast(null as map<string,double>)"))
    else:
        keyed = rows.withColumn("key", text_key())
        found = text_words(keyed.where(F.length("text") > 0)).join(risky, "term").distinct()
        own = found.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("term", "share"))).alias("terms"))
        # Pinned, so that Spark knows its size before it chooses how to join the texts.
        own = pin(own)
        held = keyed.join(own, "key", "left").select("doc_id", "text", *carry, "terms")

    def work():
        def handle(batch):
            out = {k: [] for k in (*(f"n_{k}" for k in KINDS), "n_term", "base_sha256", "spans", "clean")}
            terms = batch.column("terms").to_pylist()
            for text, own in zip(batch.column("text").to_pylist(), terms, strict=True):
                found = base_spans(text or "")
                counts = [0] * len(KINDS)
                for _, kind, _ in found:
                    counts[kind] += 1
                base = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)
                cuts = [(a, b, f"[{KINDS[k].upper()}]") for a, k, b in found]
                extra = []
                if own and text:
                    shares = dict(own)
                    for m in words_outside(text, found):
                        share = shares.get(m.group().lower())
                        if share is not None:
                            extra.append((m.start(), len(KINDS), m.end()))
                            cuts.append((m.start(), m.end(), "" if share >= remove else ("[NAME]" if m.group()[0].isupper() else "[WORD]")))
                spans = ",".join(f"{(*KINDS, TERM)[k]}:{a}:{b}" for a, k, b in sorted([*found, *extra]))
                clean, at = [], 0
                for a, b, by in sorted(cuts):
                    if b <= at:
                        continue  # inside another value
                    clean += [text[at : max(a, at)], by]
                    at = b
                for k, n in zip(KINDS, counts, strict=True):
                    out[f"n_{k}"].append(n)
                out["n_term"].append(len(extra))
                out["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
                out["spans"].append(spans)
                out["clean"].append(None if text is None else "".join([*clean, text[at:]]))
            kinds = {"base_sha256": pa.string(), "spans": pa.string(), "clean": pa.string()}
            return {c: batch.column(c) for c in ("doc_id", *carry)} | {k: pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()}

        return handle

    return map_text(
        held, ["doc_id", "text", *carry, "terms"], work,
        "doc_id long" + ddl(rows, carry)
        + ", n_email long, n_ip long, n_card long, n_phone long, n_term long, base_sha256 string, spans string, clean string",
    ).withColumnRenamed("clean", "text")

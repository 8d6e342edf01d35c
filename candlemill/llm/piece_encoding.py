"""Piece ids of whole texts by exact merges, found with backtracking, and back to text.

A text's encoding is the only sequence of pieces in which every two neighbours
are compatible: merging their joined characters again gives just these two. So
the longest piece at each place (Aho-Corasick) is tried first, shorter prefixes
of it next, and a piece is taken if it is compatible with the one before. Places
from which nothing fits are marked in a field of bits and never tried again,
which bounds the work by the text's length.

Texts are cut where no piece reaches across, as before space marks, and every
distinct segment is encoded once by a worker.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from candlemill.llm.common import map_text

#: Letters and digits after which a text may be cut, as a class of characters.
LETTERS = "A-Za-z0-9À-ÖØ-öø-ɏ"
MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Distinct segments and ids that a worker keeps before it starts again.
MAX_SEGMENTS = 600_000
MAX_IDS = 4_000_000
#: Compatible and incompatible pairs that a worker remembers.
MAX_PAIRS = 1_000_000


def segment_pattern(pieces: list[str]) -> str:
    """Pattern of segments that no merge can cross.

    A text may be cut between two characters that stand side by side in no
    piece: before a space mark after another character, and between a letter or
    digit and each sign that never follows one. Signs of which this isn't known
    stay with what is before them.
    """
    beside = {piece[k : k + 2] for piece in pieces for k in range(len(piece) - 1)}
    if any(a != SPACE and b == SPACE for a, b in beside):
        return "(?s:.+)"
    letter = re.compile(f"[{LETTERS}]")
    follow = {b for a, b in beside if letter.match(a)}
    signs = [chr(k) for k in range(1, 128) if not letter.match(chr(k)) and chr(k) not in follow]
    never = re.escape("".join(signs))
    others = f"[^{SPACE}{LETTERS}]*"
    words = f"(?:[{LETTERS}]+(?:[^{SPACE}{LETTERS}{never}]{others})?)*"
    return f"{SPACE}+{others}{words}|[^{SPACE}{LETTERS}]+{words}|[{LETTERS}]+(?:[^{SPACE}{LETTERS}{never}]{others}{words})?"


class PieceEncoder(dict):
    """Encodes texts as the model's own library does. Maps a segment to its ids."""

    def __init__(self, path: str | None = None):
        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(MODEL))
        size = self.model.get_piece_size()
        special = {
            k for k in range(size)
            if self.model.is_control(k) or self.model.is_unknown(k) or self.model.is_byte(k) or self.model.is_unused(k)
        }
        self.ids = {self.model.id_to_piece(k): k for k in range(size) if k not in special}
        self.score = {piece: self.model.get_score(k) for piece, k in self.ids.items()}
        self.bytes = [self.model.piece_to_id(f"<0x{k:02X}>") for k in range(256)]
        if any(self.model.is_unknown(k) for k in self.bytes):
            raise ValueError("the model has no pieces for bytes")
        # Equal scores are decided by place; only runs of one character may have them.
        tied: dict[float, int] = {}
        for piece, score in self.score.items():
            if len(piece) > 1 and len(set(piece)) > 1:
                tied[score] = tied.get(score, 0) + 1
        if any(n > 1 for n in tied.values()):
            raise ValueError("the model breaks ties in another way")
        self.segments = re.compile(segment_pattern(list(self.ids)))
        #: Pieces that merges can make at all; the others never occur.
        self.reached = {piece: k for piece, k in self.ids.items() if len(piece) == 1 or self.merge(piece) == [piece]}
        self.text_of = {k: piece for piece, k in self.reached.items()}
        self.longest = ahocorasick.Automaton()
        for piece, k in self.reached.items():
            self.longest.add_word(piece, (len(piece), k))
        self.longest.make_automaton()
        #: The longest shorter piece that a piece begins with.
        self.shorter = {
            k: next((self.reached[piece[:n]] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.reached), -1)
            for piece, k in self.reached.items()
        }
        self.size = {k: len(piece) for piece, k in self.reached.items()}
        self.halves = {k: self.last_merge(piece) for piece, k in self.reached.items()}
        self.steady = self._steady()
        self.known = frozenset(piece for piece in self.ids if len(piece) == 1)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.n_ids = 0

    def normalised(self, text: str) -> str:
        return self.model.normalize(text)

    def merge(self, text: str, until: int = 1) -> list[str]:
        """Pieces of a short text by plain merges: the best pair first, the first one of equal pairs."""
        parts = list(text)
        while len(parts) > until:
            pairs = [self.score.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
            best = max((x for x in pairs if x is not None), default=None)
            if best is None:
                break
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def last_merge(self, piece: str) -> tuple[int, int] | None:
        """The two pieces whose merge makes a piece; none of a single character."""
        if len(piece) == 1:
            return None
        left, right = self.merge(piece, 2)
        return self.reached[left], self.reached[right]

    def _steady(self) -> set[int]:
        """Pieces made of better ones only, so that merges go down the scores."""
        steady: set[int] = set()
        for piece, k in sorted(self.reached.items(), key=lambda x: len(x[0])):
            halves = self.halves[k]
            if halves is None or all(
                h in steady and (self.halves[h] is None or self.score[self.text_of[h]] > self.score[piece]) for h in halves
            ):
                steady.add(k)
        return steady

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the characters of both again gives just these two pieces."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            if left in self.steady and right in self.steady:
                known = self._stay_apart(left, right)
            else:
                a, b = self.text_of[left], self.text_of[right]
                known = self.merge(a + b) == [a, b]
            self.pairs[left, right] = known
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        """The same for steady pieces, by looking only at the pieces beside the border.

        Merges of either side come in the order of their scores. Taken back from
        the last one, they give every pair that ever met at the border; it would
        have been merged if it had come before the merge that ended it.
        """
        text, score, halves = self.text_of, self.score, self.halves
        ended, by_left = float("-inf"), False
        while True:
            across = score.get(text[left] + text[right])
            # Of equal merges the one further left comes first.
            if across is not None and (across > ended or (across == ended and not by_left)):
                return False
            if halves[left] is None and halves[right] is None:
                return True
            of_left = float("inf") if halves[left] is None else score[text[left]]
            of_right = float("inf") if halves[right] is None else score[text[right]]
            if of_left < of_right:
                ended, by_left, left = of_left, True, halves[left][1]
            else:
                ended, by_left, right = of_right, False, halves[right][0]

    def backtrack(self, run: str) -> list[int]:
        """Ids of a run of known characters."""
        longest = [-1] * (len(run) + 1)
        for end, (length, k) in self.longest.iter(run):
            longest[end - length + 1] = k  # a longer one ends later
        failed = bytearray(len(run) // 8 + 1)
        size, shorter, pairs = self.size, self.shorter, self.pairs
        out: list[int] = []
        at, piece, last, n = 0, longest[0], -1, len(run)
        while at < n:
            end = at + size[piece]
            fits = not failed[end >> 3] >> (end & 7) & 1
            if fits and last >= 0:
                fits = pairs.get((last, piece))
                if fits is None:
                    fits = self.compatible(last, piece)
            if fits:
                out.append(piece)
                at, last, piece = end, piece, longest[end]
            elif shorter[piece] >= 0:
                piece = shorter[piece]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                last = out[-1] if out else -1
                at -= size[piece]
        return out

    def encode_segment(self, segment: str) -> list[int]:
        """Ids of a segment; characters that no piece holds become bytes."""
        if self.known.issuperset(segment):
            return self.backtrack(segment)
        out: list[int] = []
        low = 0
        for k, char in enumerate(segment):
            if char not in self.known:
                out += self.backtrack(segment[low:k])
                out += [self.bytes[b] for b in char.encode("utf-8")]
                low = k + 1
        return out + self.backtrack(segment[low:])

    def __missing__(self, segment: str) -> list[int]:
        ids = self[segment] = self.encode_segment(segment)
        self.n_ids += len(ids)
        return ids

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text between the ids of begin and end."""
        if len(self) > MAX_SEGMENTS or self.n_ids > MAX_IDS:
            self.clear()
            self.n_ids = 0
        out = [self.model.bos_id()]
        if text:
            out.extend(chain.from_iterable(map(self.__getitem__, self.segments.findall(self.normalised(text)))))
        out.append(self.model.eos_id())
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids by the model's library."""
        return self.model.decode(ids)


_ENCODERS: dict[str | None, PieceEncoder] = {}


def worker_pieces(path: str | None = None) -> PieceEncoder:
    """The encoder of this Python worker, kept over its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def with_pieces(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Rows (doc_id, ids, decoded): ids of each whole text and the text they decode to.

    One row per row, also of repeated ones and null ids. A null text counts as
    empty: it has the ids of begin and end and decodes to an empty text. Other
    columns are not read.
    """

    def work():
        pieces = worker_pieces(path)

        def handle(batch):
            ids = [pieces.encode(t) for t in batch.column("text").to_pylist()]
            return {
                "doc_id": batch.column("doc_id").cast(pa.int64()),
                "ids": pa.array(ids, pa.list_(pa.int32())),
                "decoded": pa.array([pieces.decode(x) for x in ids], pa.string()),
            }

        return handle

    return map_text(docs, ["doc_id", "text"], work, "doc_id long, ids array<int>, decoded string")


def piece_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256) of the ids and texts of ``with_pieces``.

    Digests are made beside the ids, so that neither ids nor texts leave the worker.
    """

    def work():
        pieces = worker_pieces(path)

        def handle(batch):
            n, ids_sha, text_sha = [], [], []
            for text in batch.column("text").to_pylist():
                ids = pieces.encode(text)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
                text_sha.append(hashlib.sha256(pieces.decode(ids).encode("utf-8")).hexdigest())
            return {
                "doc_id": batch.column("doc_id").cast(pa.int64()),
                "n_tokens": pa.array(n, pa.int64()),
                "ids_sha256": pa.array(ids_sha, pa.string()),
                "decoded_sha256": pa.array(text_sha, pa.string()),
            }

        return handle

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_text(docs, ["doc_id", "text"], work, schema)

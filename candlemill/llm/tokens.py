"""Token ids of whole texts with a public vocabulary.

The vocabulary is word-based: a pattern cuts a text into words, digits and
punctuation, and the last token of each carries the mark of an end. So each
distinct piece is encoded once and kept by the worker, and the ids of a text
are gathered with numpy. The ids are those of encoding the whole text at once.
"""

from __future__ import annotations

import json
import re

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer, normalizers, pre_tokenizers

VOCABULARY = "word_bpe_49k.json"
END_MARK = "</w>"
#: Characters up to U+00FF by kind; there a lower-case text is composed already.
LATIN = {
    r"[\p{L}]+": "[a-zªµºß-öø-ÿ]+",
    r"[\p{N}]": "[0-9²³¹¼-¾]",
    r"[^\s\p{L}\p{N}]+": "[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼-¾]+",
}


def latin_pattern(path: str) -> re.Pattern:
    """The vocabulary's own pattern, with its classes of characters up to U+00FF."""
    with open(path, encoding="utf-8") as file:
        pattern = json.load(file)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    for of_all, of_latin in LATIN.items():
        if of_all not in pattern:
            raise ValueError("the vocabulary cuts words in another way")
        pattern = pattern.replace(of_all, of_latin)
    return re.compile(pattern)


class WordEncoder(dict):
    """Token ids of texts. Maps a piece of text to its place in a table of ids.

    The table is forgotten when it holds ``limit`` pieces, so memory is bounded
    whatever the texts.
    """

    def __init__(self, path: str | None = None, limit: int = 300_000):
        super().__init__()
        path = path or public_tokenizers.path(VOCABULARY)
        self.model = Tokenizer.from_file(path)
        #: Added tokens; texts that hold one are encoded as a whole.
        self.added = [token.content for token in self.model.get_added_tokens_decoder().values()]
        if any(token.normalized for token in self.model.get_added_tokens_decoder().values()):
            raise ValueError("the vocabulary finds added tokens in another way")
        self.pattern = latin_pattern(path)
        # For pieces that are cut and in lower case already, only white space separates.
        self.merges = Tokenizer.from_file(path)
        self.merges.encode_special_tokens = True
        self.merges.normalizer = normalizers.Sequence([])
        self.merges.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.model.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(END_MARK)]] = True
        self.kind = np.uint16 if len(self.ends) <= 1 << 16 else np.uint32
        self.limit = limit
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.flat = np.zeros(0, self.kind)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)

    def __missing__(self, piece: str) -> int:
        place = self[piece] = len(self.start) + len(self.new)
        self.new.append(piece)
        return place

    def pieces(self, text: str) -> list[str]:
        """Lower-case pieces of the Latin parts of a text; other parts stay as they are between spaces."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            out = []
            for part in re.split("[\t-\r ]+", text):
                out.extend(self.pattern.findall(part.lower()) if _latin(part) else [part])
            return [part for part in out if part]
        return self.pattern.findall(text.lower())

    def _learn(self) -> None:
        """Encode the new pieces: Latin ones many in one text, the ends of words tell them apart."""
        if not self.new:
            return
        latin = np.array([_latin(piece) for piece in self.new])
        ids: list[np.ndarray] = []
        length = np.zeros(len(self.new), np.int64)
        order = []
        where = np.flatnonzero(latin)
        for low in range(0, len(where), 20_000):
            part = where[low : low + 20_000]
            got = np.array(self.merges.encode(" ".join([self.new[k] for k in part]), add_special_tokens=False).ids, self.kind)
            cut = np.flatnonzero(self.ends[got]) + 1
            if len(cut) != len(part):
                raise ValueError("the vocabulary doesn't mark the ends of words")
            length[part] = np.diff(np.concatenate([[0], cut]))
            ids.append(got)
            order.append(part)
        where = np.flatnonzero(~latin)
        if len(where):
            coded = [np.array(e.ids, self.kind) for e in self.model.encode_batch([self.new[k] for k in where], add_special_tokens=False)]
            length[where] = [len(x) for x in coded]
            ids.extend(coded)
            order.append(where)
        order = np.concatenate(order)
        start = np.empty(len(length), np.int64)
        start[order] = len(self.flat) + np.cumsum(length[order]) - length[order]
        self.flat = np.concatenate([self.flat, *ids])
        self.start = np.concatenate([self.start, start])
        self.length = np.concatenate([self.length, length])
        self.new = []

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; of a null text none."""
        if len(self) > self.limit:
            self._reset()
        places, whole = [], {}
        for k, text in enumerate(texts):
            if text and any(token in text for token in self.added):
                whole[k] = np.array(self.model.encode(text, add_special_tokens=False).ids, self.kind)
            pieces = self.pieces(text) if text and k not in whole else []
            places.append(np.fromiter(map(self.__getitem__, pieces), np.int64, len(pieces)))
        self._learn()
        out = []
        for k, place in enumerate(places):
            if k in whole:
                out.append(whole[k])
                continue
            length = self.length[place]
            ends = np.cumsum(length)
            total = int(ends[-1]) if len(ends) else 0
            out.append(self.flat[np.repeat(self.start[place] - (ends - length), length) + np.arange(total)])
        return out


def _latin(text: str) -> bool:
    return text.isascii() or max(text) <= "\xff"


_ENCODERS: dict[str | None, WordEncoder] = {}


def worker_encoder(path: str | None = None) -> WordEncoder:
    """The encoder of this Python worker, kept over its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def vocabulary_size(path: str | None = None) -> int:
    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        return len(json.load(file)["model"]["vocab"])

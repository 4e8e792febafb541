"""Whole-text tokenisation on the executors with a public tokenizer file, never trained here.

The tokenizer's rules never look across white space, so a text's ids are those of its
white-space separated units in order. Units repeat, so each Python worker keeps a bounded
memory of unit -> ids and hands only new units to the tokenizer. The letters of a unit, maybe with
closing marks behind them, are one piece for the tokenizer's rules and go to its model directly.
"""

from __future__ import annotations

import os
import string
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

DEFAULT_VOCABULARY = "word_bpe_49k.json"
#: Units one worker remembers, about 160 bytes each; those that weren't met since the half of them go first.
MEMORY_UNITS = 600_000
SYMBOLS = string.punctuation.encode()


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class UnitTokenizer(dict):
    """unit -> ids as little-endian uint16, equal to the tokenizer's own ``encode`` without special tokens."""

    def __init__(self, name: str = DEFAULT_VOCABULARY, memory: int = MEMORY_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(vocabulary_path(name))
        # A special token's own text stands for its id; such texts go to the tokenizer whole, and units are plain text.
        self.whole.encode_special_tokens = True
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values() if t.special]
        if self.whole.get_vocab_size() > 1 << 16:
            raise ValueError("a vocabulary of at most 65,536 ids is asked for")
        self.model, self.memory, self.older = self.whole.model, memory, {}
        # Byte-level alphabet of the vocabulary: printable bytes stand for themselves, the others follow from 256 on.
        kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        self.alphabet = {b: b if b in kept else next(others) for b in range(256)}

    def encoded(self, unit: bytes) -> bytes:
        return np.array(self.whole.encode(unit.decode(), add_special_tokens=False).ids, dtype="<u2").tobytes()

    def __missing__(self, unit: bytes) -> bytes:
        if 2 * len(self) >= self.memory:
            self.older = dict(self)
            self.clear()
        if (ids := self.older.get(unit)) is None:
            ids = self.looked_up(unit)
        self[unit] = ids
        return ids

    def looked_up(self, unit: bytes) -> bytes:
        stem = unit.rstrip(SYMBOLS)
        if stem.isalpha():  # ASCII letters, which are lower case here
            word = stem.decode()
        else:
            word = stem.decode()
            # Letters of other alphabets are lower-cased one by one, as the tokenizer does; only a sigma hangs on its neighbours in Python.
            if not (word.isalpha() and unicodedata.is_normalized("NFC", word) and "\u03a3" not in word and (word := word.lower()).isalpha()):
                return self.encoded(unit)
            word = word.encode().decode("latin-1").translate(self.alphabet)
        # Marks behind letters are a piece of their own, and a unit like any other.
        return array("H", [p.id for p in self.model.tokenize(word)]).tobytes() + (self[unit[len(stem) :]] if len(stem) < len(unit) else b"")

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        """ids of each text; None counts as empty."""
        get = self.__getitem__
        for text in texts:
            if text and any(t in text for t in self.special):
                self.whole.encode_special_tokens = False
                whole = self.encoded(text.encode("utf-8", "replace"))
                self.whole.encode_special_tokens = True
                yield whole
                continue
            # The tokenizer lower-cases; bytes.split() cuts at ASCII white space, which it drops as well.
            yield b"".join(map(get, (text or "").encode("utf-8", "replace").lower().split()))


@lru_cache(maxsize=1)
def worker_tokenizer(name: str, memory: int) -> UnitTokenizer:
    """One for all tasks of a Python worker, which thus begin with the units of those before."""
    return UnitTokenizer(name, memory)

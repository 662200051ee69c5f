"""Token ids of whole texts: the public tokenizer with a cache of word encodings.

Both vocabularies split a text into words before merging, and no merge crosses
a word.  So a text's ids are the ids of its words in a row, and a word that was
met before need not be encoded again.  The library encodes every new word; the
split is done here for plain Latin text, and any text beyond that range (or with
a special string, where the split differs) goes to the library as a whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

import numpy as np

from billing_guard.llm.common import RecentWords

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"

# The split patterns of the two vocabularies, for Latin text (letters
# first, as no other branch begins with one).
_LETTERS = "[a-zA-Zªµºß-öø-ÿÀ-ÖØ-ÞĀ-ɏ]"
_SPLIT = {
    BYTE_BPE: re.compile(rf" ?{_LETTERS}++|'(?:[stmd]|re|ve|ll)| ?[0-9]++| ?(?:[^\s\w]|_)++|\s+(?!\S)|\s+"),
    WORD_BPE: re.compile(rf"{_LETTERS}++|'(?:[stmd]|re|ve|ll)|[0-9]|(?:[^\s\w]|_)++"),
}
# Characters whose class differs between this split and the libraries', and all beyond Latin.
_UNUSUAL = re.compile("[^\u0000-\u001b -±´-¸º»¿-ɏ‐-‧€]")


def tokenizer_path(name: str) -> str:
    """Where the installed public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_symbols() -> dict[int, str]:
    """The character that stands for each byte in both vocabularies: itself where it
    is printable Latin-1, else the next free code point from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in printable}
    return table | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(table)))}


class Splitter:
    """Splits Latin text as the vocabulary does; ``None`` where it cannot tell."""

    def __init__(self, name: str, specials: Iterable[str]):
        self.lower = name == WORD_BPE
        self.findall = _SPLIT[name].findall
        self.specials = tuple(s.lower() if self.lower else s for s in specials)

    def __call__(self, text: str) -> list[str] | None:
        if _UNUSUAL.search(text):
            return None
        if "<|" in text and any(s in (text.lower() if self.lower else text) for s in self.specials):
            return None
        return self.findall(text.lower() if self.lower else text)


class Encoder:
    """text -> little-endian unsigned 32-bit ids, as the library gives them."""

    def __init__(self, name: str, path: str | None = None, cache_words: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path or tokenizer_path(name))
        self.merge, self.symbols = self.library.model.tokenize, byte_symbols()
        self.space = self.symbols[ord(" ")]
        self.four = [i.to_bytes(4, "little") for i in range(self.library.get_vocab_size())]
        self.split = Splitter(name, [t.content for t in self.library.get_added_tokens_decoder().values()])
        self.cache = RecentWords(cache_words, self._word)

    def _word(self, word: str) -> bytes:
        """Ids of a single word: the library's merges on the word's byte symbols."""
        if word.isascii():
            # printable ones stand for themselves, but for the space
            symbols = word.replace(" ", self.space) if word.isprintable() else word.translate(self.symbols)
        else:
            symbols = word.encode().decode("latin-1").translate(self.symbols)
        four = self.four
        return b"".join([four[t.id] for t in self.merge(symbols)])

    def _encode(self, texts: list[str]) -> list[bytes]:
        encoded = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in encoded]

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        pieces = self.split(text)
        if pieces is None:
            return self._encode([text])[0]
        return b"".join(map(self.cache.__getitem__, pieces))


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(name: str, path: str | None = None) -> Encoder:
    """One encoder per Python worker, kept for its later tasks."""
    if (name, path) not in _ENCODERS:
        _ENCODERS[name, path] = Encoder(name, path)
    return _ENCODERS[name, path]

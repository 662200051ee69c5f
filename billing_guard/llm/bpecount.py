"""Token counts by heap-and-linked-list byte-pair merging.

A word's bytes form a linked list of symbols; a heap holds the adjacent pairs that the
vocabulary merges, by rank and then place.  The lowest is popped again and again: a
pair whose symbols changed since is stale and skipped, else its two symbols become one
and the two new neighbouring pairs are pushed.  The number of tokens is the number of
initial symbols minus the number of merges; no identifier is ever looked up.

The vocabulary file (``word_bpe_49k.json`` by default) gives the merges, the split into
words and the special strings.  Words are counted once per worker and kept in a bounded
cache.  A text beyond plain Latin (or with a special string) is normalised and split by
the library's own normaliser and splitter, then counted by the same merging.

Edge cases: NULL and empty texts have 0 bytes and 0 tokens; texts of any length are
counted whole; repeated rows each get their row; only doc_id and text are read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billing_guard.llm.common import WordCache
from billing_guard.llm.encode import (
    WORD_BPE,
    Splitter,
    byte_symbols,
    tokenizer_path,
)


def count_merges(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many merges the vocabulary makes on a word's symbols."""
    size = len(symbols)
    following = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    rank = ranks.get
    heap = []
    for i in range(size - 1):
        r = rank((symbols[i], symbols[i + 1]))
        if r is not None:
            heap.append((r, i, symbols[i], symbols[i + 1]))
    heapify(heap)
    merges = 0
    while heap:
        _, i, left, right = heappop(heap)
        j = following[i]
        if symbols[i] != left or j >= size or symbols[j] != right:
            continue  # stale: a symbol of this pair was merged meanwhile
        merges += 1
        joined = symbols[i] = left + right
        symbols[j] = ""
        k = following[i] = following[j]
        if k < size:
            before[k] = i
            r = rank((joined, symbols[k]))
            if r is not None:
                heappush(heap, (r, i, joined, symbols[k]))
        h = before[i]
        if h >= 0:
            r = rank((symbols[h], joined))
            if r is not None:
                heappush(heap, (r, h, symbols[h], joined))
    return merges


class Counter:
    """Counts the tokens of texts for one vocabulary file of words with end marks."""

    def __init__(self, path: str | None = None, cache_words: int = 500_000):
        from tokenizers import Tokenizer

        file = path or tokenizer_path(WORD_BPE)
        with open(file, encoding="utf-8") as f:
            model = json.load(f)
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"])
        self.ranks = {(a, b): r for r, (a, b) in enumerate(pairs)}
        self.end = model["model"]["end_of_word_suffix"] or ""
        specials = [t["content"] for t in model["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, specials)) or r"(?!)")
        library = Tokenizer.from_file(file)
        self.normalise = library.normalizer.normalize_str
        self.presplit = library.pre_tokenizer.pre_tokenize_str
        self.split = Splitter(WORD_BPE, specials)
        self.symbols = byte_symbols()
        self.cache = WordCache(cache_words)

    def _symbols_count(self, mapped: str) -> int:
        symbols = list(mapped)
        symbols[-1] += self.end
        return len(symbols) - count_merges(symbols, self.ranks)

    def _words(self, words: list[str]) -> list[int]:
        one, table = self._symbols_count, self.symbols
        return [one(w if w.isascii() and w.isalnum() else w.encode().decode("latin-1").translate(table))
                for w in words]

    def _slow(self, text: str) -> int:
        """The library's normaliser and splitter; a special string is one token."""
        total = len(self.special.findall(text))
        for part in self.special.split(text):
            if part:
                total += sum(self._symbols_count(w) for w, _ in self.presplit(self.normalise(part)))
        return total

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        pieces = self.split(text)
        if pieces is None:
            return self._slow(text)
        self.cache.fill(pieces, self._words)
        return sum(map(self.cache.__getitem__, pieces))


_COUNTERS: dict[str | None, Counter] = {}


def count_tokens(text: str | None, path: str | None = None) -> int:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path](text)


def token_count_column(text: Column, path: str | None = None) -> Column:
    """Number of tokens of a whole text."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([count_tokens(t, path) for t in texts], dtype="int64")

    return count.asNondeterministic()(text)


def count_documents(docs: DataFrame, limit: int = 2048, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``."""
    return docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        token_count_column(F.col("text"), path).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)

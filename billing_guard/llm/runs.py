"""Periodic runs of words, found by catching squares online over dyadic blocks.

A run is a stretch of words with smallest period q (words q apart are identical) and at
least ``max(MIN_LENGTH, 2 q)`` words that no neighbouring word extends keeping q.  Every
run begins with a square, two equal neighbours of q words each.

:class:`SquareCatcher` is fed word after word.  Level k covers the periods from
``2^(k+1) - 1`` to ``2^(k+2) - 2``: the part of a run that repeats q words later is then long
enough to hold a whole block of 2^k words that begins at a multiple of 2^k.  Such a
block, once complete, is a catcher: while the distance lasts, each appended word asks
whether the last 2^k words are the block again.  A level has two catchers of fitting
distance at any time, so a word costs O(log n).  What a catcher finds is compared backwards
to the first word of the stretch, which tells at which later word it would complete a
square; when that word is appended, the suffix since the last comparison is compared (by
prefix hashes), and a square is reported.  A reported square is a run that advances by one
comparison a word until a word breaks it.  Squares inside a run whose period divides theirs
merge into it; a stretch reported with several periods keeps the smallest.

The hashes only decide what to look at: every run is compared word by word before it is
returned, and a text on which a hash misled is read again with another base.

Edge cases: NULL and texts without words have no run and an empty collapsed text; words are
compared as they are (case and punctuation count); a NULL id is kept; repeated rows each
get their row; texts are read whole, with about 200 bytes of memory a word of one text;
columns other than the id and the text are not read.
"""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: the least number of words of a run
MIN_LENGTH = 12
RUNS = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"

_MODULUS = (1 << 61) - 1
_WORD_BITS = 15          # of each word in the key of four words; a filter, so clashes are harmless
_WORD_MASK = (1 << _WORD_BITS) - 1
_PLAIN = 64              # from here on hashes are compared instead of words


class _Misled(Exception):
    """Two different stretches had one hash."""


class SquareCatcher:
    """Reports the runs of a sequence that arrives word by word."""

    def __init__(self, min_length: int = MIN_LENGTH, base: int = 0x1F3D5B79A2C4E681 % _MODULUS):
        if min_length < 12:
            raise ValueError("the catchers need runs of at least 12 words")
        self.min_length, self.base = min_length, base
        self.numbers: dict = defaultdict()      # word -> number, by order of arrival
        self.numbers.default_factory = self.numbers.__len__
        self.ids: list[int] = []                # the words so far
        self.prefix = [0]                       # hashes of prefixes, as far as needed
        self.keys = np.zeros(0, np.int64)       # the four-word stretches so far
        self.streak = 0                         # words up to now that end a stretch seen before
        self.last = -1                          # the last of them
        self.runs: dict[int, int] = {}          # period -> first word of a run that goes on
        self.pending: dict[int, list[int]] = {} # period -> first word, last word compared
        self.due: dict[int, list[tuple[int, int]]] = {}   # word that completes a square -> (period, first)
        self.found: dict[tuple[int, int], int] = {}       # (first, end) -> smallest period

    def feed(self, words: list) -> None:
        """Append words.

        A word that ends four words never seen together breaks every comparison, as each
        covers more than four words; only the others are looked at one by one.
        """
        ids, runs, due = self.ids, self.runs, self.due
        ids += map(self.numbers.__getitem__, words)
        for t in self._repeating(len(words)):
            if t != self.last + 1:
                self._break()
                self.streak = 0
            self.last = t
            self.streak += 1
            if runs:
                x = ids[t]
                for q in [q for q in runs if ids[t - q] != x]:
                    self._close(q, runs.pop(q), t)
            if t in due:
                for q, first in due.pop(t):
                    self._complete(q, first, t)
            self._catch(t, self.streak + 3)

    def finish(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs, by start and period."""
        self._break()
        return sorted((a, end - a, q) for (a, end), q in self.found.items())

    def _repeating(self, added: int) -> list[int]:
        """Those of the last ``added`` words that end four words seen before."""
        start = max(3, len(self.ids) - added)
        w = np.array(self.ids[start - 3:], np.int64) & _WORD_MASK
        if len(w) < 4:
            return []
        keys = ((w[:-3] << _WORD_BITS | w[1:-2]) << _WORD_BITS | w[2:-1]) << _WORD_BITS | w[3:]
        distinct, first = np.unique(keys, return_index=True)
        again = np.ones(len(keys), bool)
        again[first] = np.isin(distinct, self.keys) if len(self.keys) else False
        self.keys = np.concatenate([self.keys, keys])
        return (np.flatnonzero(again) + start).tolist()

    def _break(self) -> None:
        """No run goes beyond the last word that ended four words seen before."""
        for q, first in self.runs.items():
            self._close(q, first, self.last + 1)
        self.runs.clear()

    def _same(self, a: int, b: int, size: int) -> bool:
        """The ``size`` words from a and those from b are the same (many: have one hash)."""
        if size <= _PLAIN:
            return self.ids[a:a + size] == self.ids[b:b + size]
        p, base = self.prefix, self.base
        h = p[-1]
        for x in self.ids[len(p) - 1:max(a, b) + size]:
            h = (h * base + x + 1) % _MODULUS
            p.append(h)
        return (p[a + size] - p[b + size] - (p[a] - p[b]) * pow(base, size, _MODULUS)) % _MODULUS == 0

    def _catch(self, t: int, longest: int) -> None:
        """Ask the catchers of all levels about the words up to t, of which at most the
        last ``longest`` have occurred before."""
        ids, runs = self.ids, self.runs
        x = ids[t]
        for q in range(1 + t % 2, 7, 2):  # level 1: blocks of two words, periods up to 6
            if t > q and ids[t - q] == x and ids[t - 1 - q] == ids[t - 1] and q not in runs:
                self._caught(t - 1 - q, q, t)
        k, size = 2, 4
        while size <= longest:
            c = t + 1 - size
            near = c - 2 * size + 1 >> k << k
            if near < 0:
                break
            if not self._inside(near - size, size):
                for b in (near, near - size):
                    q = c - b
                    if (b >= 0 and ids[t - q] == x and ids[b] == ids[c] and q not in runs
                            and self._same(b, c, size)):
                        self._caught(b, q, t)
            k += 1
            size += size

    def _inside(self, b: int, size: int) -> bool:
        """A run that goes on holds everything from b, and its period is at most ``size``:
        a block in it comes again at multiples of that period only, which merge into it."""
        for p, first in self.runs.items():
            if first <= b and p <= size:
                return True
        return False

    def _caught(self, b: int, q: int, t: int) -> None:
        """The words from b have come again q words later, up to t."""
        if any(q % p == 0 and first <= b for p, first in self.runs.items()):
            return  # part of a run with a period that divides q
        held = self.pending.get(q)
        if held and (held[1] >= t or self._same(held[1] + 1 - q, held[1] + 1, t - held[1])):
            held[1] = t
            return
        first = b - self._back(b, b + q)
        whole = first + max(self.min_length, 2 * q) - 1
        if whole <= t:
            self.pending.pop(q, None)
            self._report(q, first)
        else:
            self.pending[q] = [first, t]
            self.due.setdefault(whole, []).append((q, first))

    def _back(self, a: int, b: int) -> int:
        """How many words in front of a and of b are the same."""
        ids, m = self.ids, 0
        while m < a and m < _PLAIN and ids[a - m - 1] == ids[b - m - 1]:
            m += 1
        if m < _PLAIN or m == a:
            return m
        low, high = m, a  # the answer lies in low..high
        while low < high:
            middle = low + high + 1 >> 1
            if self._same(a - middle, b - middle, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def _complete(self, q: int, first: int, t: int) -> None:
        """The word t completes a square of period q from ``first``, if the words since its
        last comparison repeat too."""
        held = self.pending.get(q)
        if not held or held[0] != first:
            return
        del self.pending[q]
        if held[1] >= t or self._same(held[1] + 1 - q, held[1] + 1, t - held[1]):
            self._report(q, first)

    def _report(self, q: int, first: int) -> None:
        if not any(q % p == 0 and a <= first for p, a in self.runs.items()):
            self.runs[q] = first

    def _close(self, q: int, first: int, end: int) -> None:
        ids = self.ids
        if ids[first:end - q] != ids[first + q:end] or (first and ids[first - 1] == ids[first - 1 + q]):
            raise _Misled
        self.found[first, end] = min(q, self.found.get((first, end), q))


def word_runs(words: list, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a list of words."""
    catcher = SquareCatcher(min_length)
    while True:
        try:
            catcher.feed(words)
            return catcher.finish()
        except _Misled:
            catcher = SquareCatcher(min_length, random.randrange(1 << 40, _MODULUS))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run holds after its first period."""
    kept, at = [], 0
    for start, end in sorted((start + period, start + length) for start, length, period in runs):
        if end > at:
            kept += words[at:max(start, at)]
            at = end
    return kept + words[at:]


def read_text(text: str | None, min_length: int = MIN_LENGTH) -> tuple[int, list, str]:
    """Words, runs and collapsed text of one text.

    Splitting UTF-8 bytes cuts at the ASCII blanks 0x20 and 0x09 to 0x0D only.
    """
    words = text.encode().split() if text else []
    runs = word_runs(words, min_length) if len(words) >= min_length else []
    return len(words), runs, b" ".join(collapse(words, runs)).decode()


def runs_column(text: Column, min_length: int = MIN_LENGTH) -> Column:
    """A struct of RUNS for every text."""
    @F.pandas_udf(RUNS)
    def read(texts: pd.Series) -> pd.DataFrame:
        rows = [read_text(t, min_length) for t in texts]
        return pd.DataFrame({
            "n_words": [n for n, _, _ in rows],
            "runs": [[{"start": s, "length": z, "period": q} for s, z, q in found] for _, found, _ in rows],
            "collapsed": [c for _, _, c in rows]})
    return read(text)


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
              min_length: int = MIN_LENGTH) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (by start, then period) and ``collapsed`` of every row."""
    found = docs.select(F.col(doc_id), runs_column(F.col(text), min_length).alias("found"))
    return found.select(doc_id, "found.n_words", "found.runs", "found.collapsed")

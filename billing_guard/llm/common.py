"""Table access, folds and words shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billing_guard.session import written

__all__ = ["WORD", "RecentWords", "WordCache", "fold", "share_package", "table", "word_hashes", "words", "written"]

#: A word: a run of letters, digits and underscores of the lower-cased text.
WORD = re.compile(r"\w+")


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package where it lies at the driver's path.

    A cluster gets the package by ``--py-files`` or an installation; this covers a
    session whose workers were started without the repository on PYTHONPATH.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark only (any file system)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: str, folds: int) -> Column:
    """``crc32(doc_id as text) mod folds``; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def words(text: str | None) -> list[str]:
    """Lower-cased words of a text; none for NULL."""
    return WORD.findall(text.lower()) if text else []


class WordCache(dict):
    """word -> value, filled in batches and emptied when it holds ``limit`` words."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def fill(self, pieces: Iterable[str], values) -> None:
        """Add ``values(missing)`` for the pieces that are not held yet."""
        pieces = set(pieces)
        missing = [p for p in pieces if p not in self]
        if missing:
            if len(self) + len(missing) > self.limit:
                self.clear()
                missing = list(pieces)
            self.update(zip(missing, values(missing)))


class RecentWords(dict):
    """word -> ``value(word)``, found when it is first asked for; holds ``limit`` words at most.

    When half of them are new the older ones are given up, but for those asked for since:
    frequent words stay.
    """

    def __init__(self, limit: int, value: Callable[[str], object]):
        super().__init__()
        self.half, self.value = max(1, limit // 2), value
        self.older: dict[str, object] = {}

    def __missing__(self, word: str):
        found = self.older.pop(word, None)
        if found is None:
            found = self.value(word)
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


def _digests(missing: list[str]) -> list[int]:
    return [int.from_bytes(hashlib.blake2b(w.encode("utf-8", "replace"), digest_size=8).digest(), "little")
            for w in missing]


#: One per Python worker, for all operators that hash words.
_HASHES = WordCache(200_000)


def word_hashes(found: list[str]) -> np.ndarray:
    """64-bit hashes of words."""
    _HASHES.fill(found, _digests)
    return np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))

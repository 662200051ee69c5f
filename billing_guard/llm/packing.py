"""Best-fit packing of token sequences by minimum bin slack.

Texts are cut into pieces of at most ``capacity`` tokens (only longer documents are
cut: whole pieces of ``capacity``, the remainder first).  How pieces fill sequences
depends on their lengths alone, and there are at most ``capacity`` lengths, so the
packing is planned on the histogram of lengths: for each bin, the longest remaining
length is placed and a bitset subset-sum over the available lengths finds the fullest
feasible combination for the rest.  That combination is removed as often as the counts
allow (each removal would choose it again), so the number of planning steps depends on
``capacity`` and not on the number of documents.  Each piece then finds its place by its
rank among the pieces of its length.  Ranks are counted per (length, salt) group and
offset by the groups before it, so one length may hold any share of all pieces.

Edge cases: NULL and empty texts are one piece holding the end id; documents of any
length are packed whole; an empty table packs into no sequence; repeated rows (also of
one id) are packed each for itself; a NULL id is packed like any other; only doc_id and
text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billing_guard.llm.common import written
from billing_guard.llm.encode import BYTE_BPE, encoder

CAPACITY = 2048
END_ID = 0
_GROUP_ROWS = 100_000  # pieces ranked in one group, about

_PIECES = "array<struct<piece: int, start: long, length: long, ids_crc32: long>>"


def cut(ids: bytes, capacity: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's little-endian 32-bit ids."""
    size = len(ids) // 4
    first = size if size <= capacity else (size % capacity or capacity)
    starts = [0, *range(first, size, capacity)]
    ends = [*starts[1:], size]
    return [(k, a, b - a, zlib.crc32(ids[4 * a:4 * b])) for k, (a, b) in enumerate(zip(starts, ends))]


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = BYTE_BPE,
                 end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document."""

    @F.pandas_udf(_PIECES)
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(vocabulary, path)
        end = end_id.to_bytes(4, "little")
        for texts in batches:
            yield pd.Series([[dict(zip(("piece", "start", "length", "ids_crc32"), p))
                              for p in cut(encode(t) + end, capacity)] for t in texts], dtype=object)

    cut_docs = docs.select("doc_id", pieces.asNondeterministic()(F.col("text")).alias("p"))
    return cut_docs.select("doc_id", F.inline("p"))


# --- planning on the histogram ---------------------------------------------------------
@dataclass(frozen=True)
class Pattern:
    """A combination of lengths, used for ``times`` sequences."""

    times: int
    lengths: tuple[tuple[int, int], ...]  # (length, how many of it)


def fullest(counts: dict[int, int], order: list[int], room: int) -> dict[int, int]:
    """The lengths that fill ``room`` best: bitset subset-sum, longest lengths first.

    Bit s of the set says that a total of s can be reached.  Lengths are added one by
    one (copies in binary portions) until ``room`` itself is reached.
    """
    reach, limit = 1, (1 << (room + 1)) - 1
    added: list[tuple[int, int, int]] = []
    for length in order:
        if length > room:
            continue
        copies = min(counts[length], room // length)
        portion = 1
        while copies > 0:
            take = min(portion, copies)
            added.append((length, take, reach))
            reach |= (reach << (length * take)) & limit
            copies -= take
            portion *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, take, before in reversed(added):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Minimum bin slack: patterns that use up the histogram of lengths."""
    counts = {length: n for length, n in histogram.items() if n > 0}
    order = sorted(counts, reverse=True)
    patterns = []
    while order:
        seed = order[0]
        counts[seed] -= 1
        chosen = fullest(counts, order, capacity - seed)
        counts[seed] += 1
        chosen[seed] = chosen.get(seed, 0) + 1
        times = min(counts[length] // k for length, k in chosen.items())
        patterns.append(Pattern(times, tuple(sorted(chosen.items(), reverse=True))))
        for length, k in chosen.items():
            counts[length] -= times * k
        order = [length for length in order if counts[length]]
    return patterns


class Places:
    """(length, rank among its length) -> (sequence, offset), from the patterns."""

    def __init__(self, patterns: list[Pattern]):
        given: dict[int, int] = {}
        by_length: dict[int, list[tuple[int, int, int, int]]] = {}
        sequence = 0
        for p in patterns:
            offset = 0
            for length, k in p.lengths:
                rank = given.get(length, 0)
                by_length.setdefault(length, []).append((rank, p.times, sequence, offset))
                given[length] = rank + k * p.times
                offset += k * length
            sequence += p.times
        self.sequences = sequence
        self.table = {length: np.array(rows, dtype=np.int64).T for length, rows in by_length.items()}

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequences, offsets = np.empty_like(ranks), np.empty_like(ranks)
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            first, times, sequence, offset = self.table[int(length)]
            row = np.searchsorted(first, ranks[at], side="right") - 1
            nth = ranks[at] - first[row]
            sequences[at] = sequence[row] + nth % times[row]
            offsets[at] = offset[row] + (nth // times[row]) * length
        return sequences, offsets


# --- placing ---------------------------------------------------------------------------
def ranked(pieces: DataFrame, rows: int) -> DataFrame:
    """``pieces`` with ``rank``: 0, 1, ... among the pieces of one length."""
    salts = max(1, -(-rows // _GROUP_ROWS))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (salted.groupBy("length", "salt").count()
               .withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
               .select("length", "salt", "before"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32", "start")
    return (salted.withColumn("nth", F.row_number().over(within) - 1)
            .join(offsets, ["length", "salt"])
            .withColumn("rank", (F.col("before") + F.col("nth")).cast("long")))


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # <= capacity rows
    places = Places(plan(histogram, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sequence, offset = places.find(lengths.to_numpy(np.int64), ranks.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return (ranked(pieces, sum(histogram.values()))
            .withColumn("at", place("length", "rank"))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack every row of ``docs``; the pieces are written once."""
    return pack_pieces(written(token_pieces(docs, capacity), "token_pieces"), capacity)

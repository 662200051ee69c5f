"""The word 3-gram model of ``quality`` met by the texts in passes, in blocks of numpy arrays.

Every word of a text stands once as the middle of a row (a, b, c): the word before it (START
before the first word), itself and the word after it (END after the last); START has a row too.
Rows are dealt to buckets by their middle word, so a bucket holds all of a context (a, b),
of a 2-gram (b, c) and of a context (b): it builds its part of the model from the rows of the
trusted texts and adds up what the n-grams of the rows of all texts are worth, without any
table of 3-grams.  A hot middle word is dealt over several buckets by the word before it;
counts of its 2-grams and its sums are then put together from the buckets' parts, and what
its 2-grams are worth is added in a row (b, c) of its own, dealt by the word after it.

Counts of single words need all buckets: each asks for the words it holds, in order, and
gets their counts and spelling (``answers``), again without a table of n-grams.  A bucket's
rows are read in a stream; it holds its part of the model, never the texts' rows.

Rows travel as blocks, a few arrays for each piece of about ``PIECE`` bytes of text and
bucket.  Buckets come in ``PASSES`` groups, one after the other, each reading the texts
again, so a group's rows are all that lies in shuffle files at a time.
"""

from __future__ import annotations

import struct
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billing_guard.session import delete_path, delete_work, work_count, work_path, written

PASSES = 6
COUNT_AT_ONCE = 3     # passes counted together: only trusted rows, without their texts
PIECE = 8_000_000     # bytes of text made into blocks at a time
ROWS_AT_ONCE = 1 << 16
ASKED_AT_ONCE = 1 << 19  # words that buckets ask for, answered by one task
SPOOLED = 32_000_000  # bytes of a bucket's trusted rows held in memory, more in a temporary file
MERGE_AT = 1 << 20    # trusted rows gathered before equal ones are put together
WORDS = 3             # word n-grams up to this order
HOT_BUCKETS = 4       # a word with more rows than so many buckets hold is hot
LEAST = 1e-12         # weight of what no discount leaves anything for
SCALE = 1e9           # logarithms are summed as whole numbers of this part
START, END = np.uint64(0), np.uint64(0xFFFFFFFFFFFFFFFF)
ANSWER, KNOWN, MODEL, NAMES, TEXT, PAIRS, ASKED, STATS, HOT = range(9)
BLOCKS = "bucket int, kind int, id long, data binary"

_AT_ONCE = 1 << 15
_LONG = 64            # bytes; longer words are hashed byte by byte
_ROOT = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ROOT), -1, 1 << 64))
_MASKS = np.array([0, *((1 << 8 * k) - 1 for k in range(1, 9))], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _ROOT)


def _long_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of long words by a polynomial over their bytes."""
    stops = np.cumsum(sizes)
    begins = stops - sizes
    data = data[np.arange(stops[-1]) + np.repeat(starts - begins, sizes)]
    powers = np.cumprod(np.full(len(data), _ROOT, np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * powers)])
    back = np.cumprod(np.full(len(data), _INVERSE, np.uint64))
    return (sums[stops] - sums[begins]) * back[begins]


def hashed_words(data: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of the joined texts (none empty, ``stops`` their ends) end, and their hashes.

    A word is a run of bytes up to and with its white space.
    """
    last = (data - np.uint8(ord("\t"))) < 5  # or a line's or page's end
    last |= data == ord(" ")
    last[stops - 1] = True
    ends = np.flatnonzero(last) + 1
    starts = np.empty_like(ends)
    starts[:1], starts[1:] = 0, ends[:-1]
    sizes = ends - starts
    padded = np.zeros(len(data) // 8 + 3, np.uint64)
    padded.view(np.uint8)[:len(data)] = data
    words = np.empty(len(ends), np.uint64)
    for i in range(0, len(ends), _AT_ONCE):  # what stays in the processor's cache
        words[i:i + _AT_ONCE] = _hashes(data, padded, starts[i:i + _AT_ONCE], sizes[i:i + _AT_ONCE])
    return ends, words


def _hashes(data: np.ndarray, padded: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    def step(words: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        place, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
        piece = (padded[place] >> shift) | ((padded[place + 1] << np.uint64(1)) << (np.uint64(63) - shift))
        piece &= _MASKS[np.minimum(sizes, 8)]
        return mixed((words ^ piece) * _ROOT)  # another number for each piece

    words = step(np.zeros(len(sizes), np.uint64), starts, sizes)
    rest, at = np.flatnonzero((sizes > 8) & (sizes <= _LONG)), 8
    while len(rest):
        words[rest] = step(words[rest], starts[rest] + at, sizes[rest] - at)
        at += 8
        rest = rest[sizes[rest] > at]
    long = np.flatnonzero(sizes > _LONG)
    if long.size:
        words[long] = _long_hashes(data, starts[long], sizes[long])
    return mixed(words + sizes.astype(np.uint64) * _ROOT)


def gram_keys(*words: np.ndarray) -> np.ndarray:
    """64-bit keys of n-grams, the order in them."""
    key = np.full(len(words[0]), len(words), np.uint64)
    for w in words:
        key = mixed(key * _ROOT + w)
    return key


def discounts_of(n: list[int]) -> dict[str, float]:
    """Modified Kneser-Ney discounts for counts of 1, 2, and 3 or more, by how many are 1, 2, 3 and 4."""
    n = dict(enumerate(n, 1))
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    out = {}
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k + 1] / n[k] if n[k] else y * min(k, 1)
        out[f"d{k}"] = min(max(d, 0.0), float(k))
    return out


# --- how rows are dealt ---------------------------------------------------------------
class Deal(NamedTuple):
    """Buckets by middle word; hot ones (sorted) over ``shares`` buckets by a word beside them."""

    buckets: int
    hot: np.ndarray
    shares: np.ndarray
    marks: np.ndarray  # by a word's lowest 16 bits: may it be hot?
    stride: int        # from one of a hot word's buckets to the next

    @classmethod
    def of(cls, buckets: int, counts: dict[int, int], total: int, stride: int = 1) -> Deal:
        """``counts``: of words that may be hot."""
        most = -(-total // buckets)
        found = sorted((w, -(-n // most)) for w, n in counts.items() if n > HOT_BUCKETS * most)
        hot = np.array([w for w, _ in found], np.uint64)
        marks = np.zeros(1 << 16, bool)
        marks[(hot & np.uint64(0xFFFF)).astype(np.int64)] = True
        return cls(buckets, hot, np.array([min(s, buckets) for _, s in found], np.uint64), marks, stride)

    def place(self, words: np.ndarray) -> np.ndarray:
        """The place of each word in ``hot``, -1 of others."""
        out = np.full(len(words), -1, np.int64)
        maybe = np.flatnonzero(self.marks[(words & np.uint64(0xFFFF)).astype(np.int64)])
        if maybe.size:
            at = np.minimum(np.searchsorted(self.hot, words[maybe]), len(self.hot) - 1)
            out[maybe] = np.where(self.hot[at] == words[maybe], at, -1)
        return out

    def share(self, place: np.ndarray, beside: np.ndarray) -> np.ndarray:
        """The buckets of hot words by their places and the words beside them."""
        share = ((mixed(beside + _ROOT) >> np.uint64(32)) * self.shares[place]) >> np.uint64(32)
        return (_part(self.hot[place], self.buckets) + share.astype(np.int64) * self.stride) % self.buckets

    def chosen(self, words: np.ndarray, starts: np.ndarray, low: int, high: int) -> tuple[np.ndarray, ...]:
        """Places of the middle words with rows for these buckets, and the buckets; the same
        for the rows (b, c) of hot words.

        ``words`` holds START where ``starts``, before the words of each text.
        """
        bucket = _part(words, self.buckets)
        keep = (bucket >= low) & (bucket < high)
        pairs, pair_bucket = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(self.hot):
            place = self.place(words)
            hot = np.flatnonzero(place >= 0)
            bucket[hot] = self.share(place[hot], np.where(starts[hot], START, words[hot - 1]))
            keep[hot] = (bucket[hot] >= low) & (bucket[hot] < high)
            pairs = hot[~starts[hot + 1]]
            pair_bucket = self.share(place[pairs], words[np.minimum(pairs + 1, len(words) - 1)])
            own = (pair_bucket >= low) & (pair_bucket < high)
            pairs, pair_bucket = pairs[own], pair_bucket[own]
        at = np.flatnonzero(keep)
        return at, bucket[at], pairs, pair_bucket


def _part(words: np.ndarray, parts: int) -> np.ndarray:
    """Which of so many equal ranges of hashes each is in."""
    return (((words >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def pieces(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of the non-empty texts, about ``PIECE`` bytes at a time; their bytes, and where each ends."""
    column = column.cast(pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    sizes = np.diff(offsets)
    if column.null_count:
        sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False), sizes, 0)
    rows = np.flatnonzero(sizes > 0)
    stops = np.cumsum(sizes[rows])
    first = 0
    while first < len(rows):
        base = stops[first] - sizes[rows[first]]
        last = max(first + 1, int(np.searchsorted(stops, base + PIECE, side="right")))
        own = rows[first:last]
        low, high = offsets[own[0]], offsets[own[-1]] + sizes[own[-1]]
        data = np.frombuffer(column.buffers()[2], np.uint8)[low:high]
        if high - low != sizes[own].sum():  # something lies under a NULL
            data = np.concatenate([data[offsets[r] - low:offsets[r] - low + sizes[r]] for r in own])
        yield own, data, np.cumsum(sizes[own])
        first = last


def middles(data: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words with START before those of each text, and where START is (and after the end)."""
    ends, words = hashed_words(data, stops)
    counts = np.diff(np.searchsorted(ends, stops, side="right"), prepend=0)
    at = np.cumsum(counts + 1) - counts - 1
    starts = np.zeros(len(words) + len(stops) + 1, bool)
    starts[at], starts[-1] = True, True
    out = np.zeros(len(words) + len(stops), np.uint64)
    out[~starts[:-1]] = words
    return out, starts


def _batch(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    columns = [list(x) for x in zip(*rows)] if rows else [[], [], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, kind in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.binary()))],
        names=["bucket", "kind", "id", "data"])


def _packed(*arrays: np.ndarray) -> bytes:
    """The arrays in one piece, each with its type and length before it."""
    out = []
    for x in arrays:
        out += [x.dtype.str.encode().ljust(8), np.int64(len(x)).tobytes(), x.tobytes()]
    return b"".join(out)


def _unpacked(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        kind, n = np.dtype(data[at:at + 8].decode().strip()), int(np.frombuffer(data, np.int64, 1, at + 8)[0])
        out.append(np.frombuffer(data, kind, n, at + 16))
        at += 16 + n * kind.itemsize
    return out


def word_counts(buckets: int):
    """w, n of words that are frequent in a piece of text; all rows under END."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, stops in pieces(batch.column("text")):
                words = middles(data, stops)[0]
                total, ends = len(words), (words & np.uint64(0xFFFF)).astype(np.int64)
                least = total / (2 * buckets)
                words, n = np.unique(words[(np.bincount(ends) > least)[ends]], return_counts=True)
                words, n = np.append(words[n > least], END), np.append(n[n > least], total)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["w", "n"])

    return count


def deal_of(docs: DataFrame, each: int) -> Deal:
    """Buckets for PASSES passes of ``each``; those of a hot word lie in different passes."""
    buckets = each * PASSES
    found = written(docs.select("text").mapInArrow(word_counts(buckets), "w long, n long").groupBy("w")
                    .agg(F.sum("n").alias("n")), "frequent")
    n = found.where(F.col("w") == -1).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = found.where((F.col("w") != -1) & (F.col("n") * buckets > n)).collect()
    return Deal.of(buckets, {r.w % (1 << 64): r.n for r in rows}, n, each + 1)


def blocks(deal: Deal, low: int, high: int, scored: bool):
    """Blocks of the rows for the buckets from ``low`` to below ``high``: a, b, c sorted by b.

    To be ``scored`` with the row's text in the piece (MODEL of trusted texts, TEXT of others),
    PAIRS, and a block of the pieces' names ``t`` with whether they are ``wanted``; else of
    kind MODEL alone.
    """

    def by_bucket(bucket: np.ndarray, own_kind: int, name: int, *columns: np.ndarray) -> list[tuple]:
        order = np.argsort(columns[1])
        order = order[np.argsort(bucket[order].astype(np.uint16 if high < 1 << 16 else np.int64), kind="stable")]
        bucket, columns = bucket[order], [x[order] for x in columns]
        edges = np.flatnonzero(np.append(np.diff(bucket, prepend=-1) != 0, True))
        return [(int(bucket[i]), own_kind, name, _packed(*(x[i:j] for x in columns)))
                for i, j in zip(edges[:-1], edges[1:])]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for rows, data, stops in pieces(batch.column("text")):
                words, starts = middles(data, stops)
                at, bucket, pairs, pair_bucket = deal.chosen(words, starts, low, high)
                name, after = task + number, np.minimum(np.arange(1, len(words) + 1), len(words) - 1)
                columns = [np.where(starts[at], START, words[at - 1]), words[at],
                           np.where(starts[at + 1], END, words[after[at]])]
                if not scored:
                    out = by_bucket(bucket, MODEL, name, *columns)
                else:
                    own = (np.cumsum(starts[:-1]) - 1).astype(np.uint16 if len(rows) < 1 << 16 else np.uint32)
                    t, wanted, trusted = (batch.column(k).to_numpy(zero_copy_only=False)[rows]
                                          for k in ("t", "wanted", "trusted"))
                    columns.append(own[at])
                    model = trusted[columns[-1]]
                    out = [(low + name % (high - low), NAMES, name, _packed(t, wanted)),
                           *by_bucket(pair_bucket, PAIRS, name, words[after[pairs]], words[pairs], own[pairs])]
                    for of_kind, some in ((MODEL, np.flatnonzero(model)), (TEXT, np.flatnonzero(~model))):
                        out += by_bucket(bucket[some], of_kind, name, *(x[some] for x in columns))
                number += 1
                yield _batch(out)

    return cut


# --- a bucket's part of the model -----------------------------------------------------
def _merged(a, b, c, n) -> tuple[np.ndarray, ...]:
    """Distinct rows in order of their keys, with the sums of n."""
    keys = gram_keys(a, b, c)
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    at = order[first]
    return a[at], b[at], c[at], np.add.reduceat(n[order], first) if len(first) else n


class Counted:
    """Trusted rows of a bucket, equal ones put together."""

    def __init__(self) -> None:
        self.parts, self.rows, self.most = [], 0, MERGE_AT

    def add(self, a, b, c) -> None:
        self.parts.append((a, b, c, np.ones(len(a), np.int64)))
        self.rows += len(a)
        if self.rows >= self.most:
            self.parts = [self.merged()]
            self.rows = len(self.parts[0][0])
            self.most = max(MERGE_AT, 2 * self.rows)

    def merged(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return *(np.zeros(0, np.uint64) for _ in "abc"), np.zeros(0, np.int64)
        return _merged(*(np.concatenate(x) for x in zip(*self.parts)))


def _context_sums(rank: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """Of each context the sum of counts, and how many of them are 1, 2, and 3 or more."""
    return np.array([np.bincount(rank, n, size), *(np.bincount(rank, w, size) for w in (n == 1, n == 2, n > 2))])


def _how_many(n: np.ndarray) -> list[int]:
    return [int((n == k).sum()) for k in (1, 2, 3, 4)]


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in order, a place and the count of each; and the rank of every key."""
    order = np.argsort(keys)
    keys = keys[order]
    edge = np.ones(len(keys), bool)
    edge[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(edge)
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(edge) - 1
    return keys[first], order[first], np.diff(first, append=len(keys)), rank


class Held:
    """What a bucket holds of the trusted texts' n-grams, in orders that depend on them alone."""

    def __init__(self, counted: Counted, deal: Deal) -> None:
        a, b, c, n = counted.merged()
        real = c != END
        middle = b[b != START]
        a, b, c, self.n3 = a[real], b[real], c[real], n[real]
        self.words = np.unique(np.concatenate([c, middle]))
        self.abc = gram_keys(a, b, c)
        self.ab, _, _, self.of_ab = ranked(gram_keys(a, b))
        self.bc, first, self.n2, self.of_bc = ranked(gram_keys(b, c))
        self.b, _, _, self.of_b = ranked(b[first])
        self.c = Found(self.words, np.arange(len(self.words)))(c[first])[0]
        place = deal.place(b[first])
        hot = np.flatnonzero(place >= 0)
        self.hot = hot[np.lexsort((place[hot], self.c[hot]))]  # 2-grams of hot words, by their second word
        self.place = place[self.hot]
        self.cold = place < 0

    def requests(self, bucket: int) -> list[tuple[int, int, int, bytes]]:
        """The words, in how many cold 2-grams they end; of the hot 2-grams the hot word, the
        second word's place, the count here."""
        cold = np.bincount(self.c[self.cold], minlength=len(self.words)).astype(np.uint32)
        stats = [*_how_many(self.n3), *_how_many(self.n2[self.cold]), len(self.words)]
        return [(bucket, ASKED, bucket, _packed(
            self.words, cold, *(x.astype(np.uint32) for x in (self.place, self.c[self.hot], self.n2[self.hot])))),
            (bucket, STATS, bucket, _packed(np.array(stats)))]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple[int, int, bytes]]]]:
    """Sorted rows by bucket: kind, id, data."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(k).to_pylist() for k in ("bucket", "kind", "id")), batch.column("data"))

    for bucket, own in groupby(rows(), lambda r: r[0]):
        yield bucket, ((kind, name, data.as_py()) for _, kind, name, data in own)


def counted(deal: Deal):
    """The requests of the buckets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _groups(batches):
            trusted = Counted()
            for _, _, data in rows:
                trusted.add(*_unpacked(data))
            yield _batch(Held(trusted, deal).requests(bucket))

    return count


def asked_blocks(parts: int):
    """The requests by the range of their words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _groups(batches):
            for _, _, data in rows:
                words, cold, place, c, n2 = _unpacked(data)
                edges = np.searchsorted(_part(words, parts), np.arange(parts + 1))
                hot_edges = np.searchsorted(c, edges)
                yield _batch([(int(k), ASKED, bucket, _packed(
                    words[edges[k]:edges[k + 1]], cold[edges[k]:edges[k + 1]],
                    *(x[hot_edges[k]:hot_edges[k + 1]] for x in (place, (c - edges[k]).astype(np.uint32), n2))))
                    for k in np.flatnonzero(np.diff(edges))])

    return cut


def spelled_blocks(parts: int):
    """Blocks of c, p0 by the range of c."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, p0 = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("c", "p0"))
            order = np.argsort(c.view(np.uint64))
            c, p0 = c.view(np.uint64)[order], p0[order]
            edges = np.searchsorted(_part(c, parts), np.arange(parts + 1))
            yield _batch([(k, MODEL, 0, _packed(c[i:j], p0[i:j]))
                          for k, (i, j) in enumerate(zip(edges[:-1], edges[1:])) if i < j])

    return cut


def answers(deal: Deal):
    """To each request the counts and spelling of its words, and the counts of its hot
    2-grams, under the bucket that asked; KNOWN hot 2-grams under the buckets of their rows;
    STATS; and of each of the hot words its sums, its count and the bits of its spelling."""
    hot = max(1, len(deal.hot))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _groups(batches):
            spelled, asked = [], []
            for kind, bucket, data in rows:
                (spelled if kind == MODEL else asked).append((bucket, _unpacked(data)))
            if not asked:
                continue
            known, p0 = (np.concatenate(x) for x in zip(*(x for _, x in spelled)))
            order = np.argsort(known)
            known, p0 = known[order], p0[order]
            n = np.zeros(len(known), np.int64)
            places = [np.searchsorted(known, x[0]) for _, x in asked]
            for at, (_, x) in zip(places, asked):
                n[at] += x[1]  # no word twice in a request
            pairs = [at[x[3]] * hot + x[2] for at, (_, x) in zip(places, asked)]
            pair, rank = np.unique(np.concatenate(pairs), return_inverse=True)
            n2 = np.bincount(rank, np.concatenate([x[4] for _, x in asked]), len(pair)).astype(np.int64)
            word, place = pair // hot, pair % hot
            n += np.bincount(word, minlength=len(known))
            edges = np.cumsum([0, *(len(x) for x in pairs)])
            yield _batch([(bucket, ANSWER, part, _packed(n[at].astype(np.uint32), p0[at], n2[rank[i:j]].astype(np.uint32)))
                          for (bucket, _), at, i, j in zip(asked, places, edges[:-1], edges[1:])])
            sums = np.zeros((6, hot), np.int64)
            if len(pair):
                sums[:4] = _context_sums(place, n2, hot)
                bucket = deal.share(place, known[word])
                order = np.argsort(bucket, kind="stable")
                bucket, word, place, n2_of = bucket[order], word[order], place[order], n2[order]
                edges = np.flatnonzero(np.append(np.diff(bucket, prepend=-1) != 0, True))
                yield _batch([(int(bucket[i]), KNOWN, part, _packed(
                    place[i:j].astype(np.uint32), known[word[i:j]], n2_of[i:j].astype(np.uint32),
                    n[word[i:j]].astype(np.uint32), p0[word[i:j]])) for i, j in zip(edges[:-1], edges[1:])])
            if len(deal.hot):
                at = np.minimum(np.searchsorted(known, deal.hot), len(known) - 1)
                own = known[at] == deal.hot
                sums[4], sums[5] = np.where(own, n[at], 0), np.where(own, p0[at].view(np.int64), 0)
            stats = [*_how_many(n), int(n.sum()), int((n > 2).sum()), *_how_many(n2)]
            yield _batch([(-1, STATS, part, _packed(np.array(stats))),
                          *((-1, HOT, int(k), _packed(sums[:, k].copy())) for k in np.flatnonzero(sums.any(0)))])

    return answer


class Weights(NamedTuple):
    """What the parts of the model have in common."""

    cuts: dict[int, dict[str, float]]  # discounts by order
    total: int                         # of all words' counts
    gamma: float                       # of the empty context
    hot: np.ndarray                    # of the hot words their contexts' sums, as ``_context_sums`` has them
    hot_n: np.ndarray                  # and their counts and spelling
    hot_p0: np.ndarray

    def left_over(self, k: int, sums: np.ndarray) -> np.ndarray:
        """The back-off weights of contexts of order ``k`` by their sums."""
        d = self.cuts[k]
        return np.maximum((sums[1] * d["d1"] + sums[2] * d["d2"] + sums[3] * d["d3"]) / np.maximum(sums[0], 1), LEAST)

    def p1(self, n: np.ndarray, p0: np.ndarray) -> np.ndarray:
        return self.seen(1, n.astype(float), self.total) + self.gamma * p0

    def p2(self, n: np.ndarray, total: np.ndarray, gamma: np.ndarray, p1: np.ndarray) -> np.ndarray:
        return self.seen(2, n, total) + gamma * p1

    def d1(self, n: np.ndarray, p0: np.ndarray) -> np.ndarray:
        return _whole(_log(self.p1(n, p0)) - (_log(p0) + np.log(self.gamma)))

    def seen(self, k: int, n: np.ndarray, total: np.ndarray) -> np.ndarray:
        d = self.cuts[k]
        return (n - np.where(n == 1, d["d1"], np.where(n == 2, d["d2"], d["d3"]))) / total


def _whole(x: np.ndarray) -> np.ndarray:
    return np.rint(np.nan_to_num(x * SCALE, nan=0.0)).astype(np.int64)


def _log(x: np.ndarray) -> np.ndarray:
    return np.log(np.where(x > 0, x, np.nan))


class Part:
    """A bucket's part of the model: what its n-grams add to the logarithm of a text.

    With S1(c) = the logarithm of c's probability without context, G(h) that of a context's
    back-off weight and L that of an n-gram in the model, the logarithm for c after a, b is
    S1(c) + G(b) + G(ab) + [bc known] (L(bc) - G(b) - L(c)) + [abc known] (L(abc) - G(ab) - L(bc)),
    as all ends of a known n-gram are known.  For a single word the bracket is what L(c) is
    above the weight times the spelling; it is added where the word is the middle of a row.
    """

    def __init__(self, held: Held, deal: Deal, weights: Weights, answered: list[list[np.ndarray]]) -> None:
        n, p0, hot = (np.concatenate(x) for x in zip(*answered)) if answered else (np.zeros(0),) * 3
        if len(n) != len(held.words) or len(hot) != len(held.hot):
            raise RuntimeError("a bucket's words and the answers differ")
        self.deal = deal
        n2 = held.n2.astype(float)
        n2[held.hot] = hot
        sums = _context_sums(held.of_b, n2, len(held.b))
        place = deal.place(held.b)
        sums[:, place >= 0] = weights.hot[:, place[place >= 0]]
        gamma2 = weights.left_over(2, sums)
        gamma_b, p1_c = gamma2[held.of_b], weights.p1(n, p0)[held.c]
        p2 = weights.p2(n2, sums[0][held.of_b], gamma_b, p1_c)
        sums = _context_sums(held.of_ab, held.n3, len(held.ab))
        gamma3 = weights.left_over(3, sums)
        gamma_ab, p2_bc = gamma3[held.of_ab], p2[held.of_bc]
        p3 = weights.seen(3, held.n3, sums[0][held.of_ab]) + gamma_ab * p2_bc
        self.d1 = Found(held.words, weights.d1(n, p0))
        self.g2 = Found(held.b, _whole(_log(gamma2)))
        self.d2 = Found(held.bc, _whole(_log(p2) - (_log(gamma_b) + _log(p1_c))))
        self.g3 = Found(held.ab, _whole(_log(gamma3)))
        self.d3 = Found(held.abc, _whole(_log(p3) - (_log(gamma_ab) + _log(p2_bc))))
        # of hot words, whatever this bucket has of them
        self.hot_d1 = np.where(weights.hot_n > 0, weights.d1(weights.hot_n, weights.hot_p0), 0)
        self.hot_known = weights.hot[0] > 0
        self.hot_g2 = np.where(self.hot_known, _whole(_log(weights.left_over(2, weights.hot))), 0)

    def __call__(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        """What each row adds; a hot word's without its 2-gram."""
        edge = np.append(True, b[1:] != b[:-1])
        own, run = b[edge], np.cumsum(edge) - 1
        place = self.deal.place(own)
        hot = place >= 0
        alone = np.where(hot, self.hot_d1[place], self.d1(own)[0])
        out = np.where(own == START, 0, alone)[run]
        g, known = self.g2(own)
        g, known = np.where(hot, self.hot_g2[place], g), np.where(hot, self.hot_known[place], known)
        at = np.flatnonzero(known[run] & (c != END))
        a, b, c, run = a[at], b[at], c[at], run[at]
        g3, ab = self.g3(gram_keys(a, b))
        d2, bc = self.d2(gram_keys(b, c))
        more = g[run] + g3 + np.where(hot[run], 0, d2)
        both = np.flatnonzero(ab & bc)
        more[both] += self.d3(gram_keys(a[both], b[both], c[both]))[0]
        out[at] += more
        return out


class HotPairs:
    """What the hot words' 2-grams of a bucket add."""

    def __init__(self, deal: Deal, weights: Weights, known: list[list[np.ndarray]]) -> None:
        place, c, n2, n, p0 = (np.concatenate(x) for x in zip(*known)) if known else (
            np.zeros(0, np.int64), np.zeros(0, np.uint64), *(np.zeros(0),) * 3)
        gamma, p1 = weights.left_over(2, weights.hot)[place], weights.p1(n, p0)
        p2 = weights.p2(n2.astype(float), weights.hot[0][place], gamma, p1)
        keys = gram_keys(deal.hot[place], c)
        order = np.argsort(keys)
        self.d2 = Found(keys[order], _whole(_log(p2) - (_log(gamma) + _log(p1)))[order])

    def __call__(self, c: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.d2(gram_keys(b, c))[0]


class Found:
    """Values of 64-bit keys that are spread evenly, sorted."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(1, len(keys)).bit_length() + 1
        self.shift = np.uint64(64 - bits)
        counts = np.bincount((keys >> self.shift).astype(np.int64), minlength=1 << bits)
        self.first = np.cumsum(counts) - counts
        self.keys, self.values, self.count = np.append(keys, END), np.append(values, 0), len(keys)

    def __call__(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the keys asked for (0 of others), and which there are."""
        at = self.first[(asked >> self.shift).astype(np.int64)]
        less = np.flatnonzero(self.keys[at] < asked)
        while len(less):
            at[less] += 1
            less = less[self.keys[at[less]] < asked[less]]
        there = (self.keys[at] == asked) & (at < self.count)
        return np.where(there, self.values[at], 0), there


def scored(deal: Deal, weights: Weights):
    """For each block of texts the sums of its rows by text: the piece's id, the texts, the sums."""

    def sums(worth: Part | HotPairs, some: list[tuple[int, list[np.ndarray]]]) -> pa.RecordBatch:
        *columns, own = (np.concatenate(x) for x in zip(*(x for _, x in some)))
        sizes = [int(x[-1].max()) + 1 for _, x in some]
        edges = np.cumsum([0, *sizes])
        at = own + np.repeat(edges[:-1], [len(x[0]) for _, x in some])
        total, met = np.zeros(edges[-1], np.int64), np.zeros(edges[-1], bool)
        np.add.at(total, at, worth(*columns))
        met[at] = True
        out = []
        for (name, x), i, j in zip(some, edges[:-1], edges[1:]):
            text = np.flatnonzero(met[i:j])
            out.append((0, TEXT, name, _packed(text.astype(x[-1].dtype), total[i:j][text])))
        return _batch(out)

    def in_groups(worth: Part | HotPairs, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        some, size = [], 0
        for name, data in rows:
            some.append((name, _unpacked(data)))
            size += len(some[-1][1][0])
            if size >= ROWS_AT_ONCE:
                yield sums(worth, some)
                some, size = [], 0
        if some:
            yield sums(worth, some)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches):
            answered, known, trusted, part = [], [], Counted(), None
            with tempfile.SpooledTemporaryFile(SPOOLED) as spool:
                for kind, of_kind in groupby(rows, lambda r: r[0]):
                    if kind == NAMES:
                        yield _batch([(0, NAMES, name, data) for _, name, data in of_kind])
                    elif kind in (ANSWER, KNOWN):
                        (answered if kind == ANSWER else known).extend(_unpacked(data) for _, _, data in of_kind)
                    elif kind == MODEL:
                        for _, name, data in of_kind:
                            trusted.add(*_unpacked(data)[:3])
                            spool.write(struct.pack("<qq", name, len(data)) + data)
                        part, trusted = Part(Held(trusted, deal), deal, weights, answered), Counted()
                        spool.seek(0)
                        yield from in_groups(part, iter(lambda: _read(spool), None))
                    else:
                        if kind == TEXT and part is None:
                            part = Part(Held(trusted, deal), deal, weights, answered)
                        worth = part if kind == TEXT else HotPairs(deal, weights, known)
                        yield from in_groups(worth, ((name, data) for _, name, data in of_kind))

    return score


def _read(spool) -> tuple[int, bytes] | None:
    head = spool.read(16)
    if not head:
        return None
    name, size = struct.unpack("<qq", head)
    return name, spool.read(size)


def by_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """t, more: the sums of each piece's wanted texts; rows sorted by piece, names first."""
    names, total, piece = None, None, None

    def done() -> pa.RecordBatch:
        t, wanted = names
        return pa.RecordBatch.from_arrays([pa.array(t[wanted]), pa.array(total[wanted])], names=["t", "more"])

    for batch in batches:
        for kind, name, data in zip(batch.column("kind").to_pylist(), batch.column("id").to_pylist(), batch.column("data")):
            arrays = _unpacked(data.as_py())
            if kind == NAMES:
                if names is not None:
                    yield done()
                names, total, piece = arrays, np.zeros(len(arrays[0]), np.int64), name
            elif name != piece:
                raise RuntimeError("sums without their texts")
            else:
                total[arrays[0]] += arrays[1]
    if names is not None:
        yield done()


# --- the jobs -------------------------------------------------------------------------
@contextmanager
def job_settings(spark: SparkSession, rows: int = 2000) -> Iterator[None]:
    """Shuffle files go when the query that wrote them ends, not when the driver collects its
    garbage; so many ``rows`` reach Python at a time, a few if they are texts."""
    settings = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
                "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _dealt(rows: DataFrame, low: int, partitions: int) -> DataFrame:
    """The rows of each bucket in one partition, its kinds one after the other."""
    return rows.repartitionById(partitions, F.col("bucket") - F.lit(low)).sortWithinPartitions("bucket", "kind", "id")


def _added(stats: DataFrame) -> np.ndarray | int:
    """The sum of the rows' arrays."""
    return reduce(np.add, (_unpacked(bytes(r.data))[0] for r in stats.select("data").toLocalIterator()), 0)


def _added_by_id(rows: pa.Table) -> pa.Table:
    total = reduce(np.add, (_unpacked(x.as_py())[0] for x in rows.column("data")))
    return pa.table({"id": rows.column("id").slice(0, 1), "sums": pa.array([total.tolist()], pa.list_(pa.int64()))})


def word_sums(texts: DataFrame, spelled_path: str, path: str) -> float | None:
    """Writes t, more to ``path``, PASSES rows for each row of ``texts`` with a text that is wanted.

    ``texts`` has t, text, trusted, wanted.  ``more`` is what the n-grams of the trusted ones
    add to the logarithm of the text's probability, in parts of 1 / SCALE; ``spelled_path`` has
    the hash c of each trusted word and its probability p0, and is deleted.  Returns the logarithm of a word's
    weight on its spelling; None, and nothing is written, without any trusted word.
    """
    spark = texts.sparkSession
    each = int(spark.conf.get("spark.sql.shuffle.partitions"))
    since, answered = work_count(), work_path(spark, "answers")
    deal = deal_of(texts, each)
    asked = work_path(spark, "requests")
    training = texts.where("trusted").select("text")
    for low in range(0, deal.buckets, each * COUNT_AT_ONCE):
        rows = training.mapInArrow(blocks(deal, low, min(low + each * COUNT_AT_ONCE, deal.buckets), False), BLOCKS)
        _dealt(rows, low, each).mapInArrow(counted(deal), BLOCKS).write.mode("append").parquet(asked)
    requests = spark.read.schema(BLOCKS).parquet(asked)
    counts = _added(requests.where(F.col("kind") == STATS))
    if not np.any(counts):
        delete_work(spark, since)
        return None
    parts = -(-int(counts[8]) // ASKED_AT_ONCE)
    rows = (requests.where(F.col("kind") == ASKED).mapInArrow(asked_blocks(parts), BLOCKS)
            .unionByName(spark.read.schema("c long, p0 double").parquet(spelled_path).mapInArrow(spelled_blocks(parts), BLOCKS)))
    (_dealt(rows, 0, parts).mapInArrow(answers(deal), BLOCKS)
     .withColumn("turn", F.floor(F.col("bucket") / each).cast("int")).write.partitionBy("turn").parquet(answered))
    delete_work(spark, since + 1)
    delete_path(spark, spelled_path)
    found = spark.read.schema(f"{BLOCKS}, turn int").parquet(answered)
    ones = _added(found.where((F.col("turn") == -1) & (F.col("kind") == STATS)))
    cuts = {1: discounts_of(ones[:4].tolist()), 2: discounts_of((counts[4:8] + ones[6:]).tolist()),
            3: discounts_of(counts[:4].tolist())}
    total, many = int(ones[4]), (*ones[:2].tolist(), int(ones[5]))
    gamma = max(sum(cuts[1][f"d{k}"] * n for k, n in zip((1, 2, 3), many)) / total, LEAST)
    hot = np.zeros((6, max(1, len(deal.hot))), np.int64)
    for r in (found.where((F.col("turn") == -1) & (F.col("kind") == HOT)).groupBy("id")
              .applyInArrow(_added_by_id, "id long, sums array<long>").collect()):
        hot[:, r.id] = r.sums
    weights = Weights(cuts, total, gamma, hot[:4].astype(float), hot[4], hot[5].view(float))
    for turn in range(PASSES):
        low = turn * each
        rows = (found.where(F.col("turn") == turn).drop("turn")
                .unionByName(texts.mapInArrow(blocks(deal, low, low + each, True), BLOCKS)))
        (_dealt(rows, low, each).mapInArrow(scored(deal, weights), BLOCKS)
         .repartition("id").sortWithinPartitions("id", "kind").mapInArrow(by_text, "t long, more long")
         .write.mode("append").parquet(path))
    delete_work(spark, since)
    return float(np.log(gamma))

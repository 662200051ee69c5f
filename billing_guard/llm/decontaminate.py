"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over ``SPAN`` successive words of which some positions are
ignored; the hash of the others at every place of the benchmark items and of the
documents is joined.  A hit names an alignment of an item with a document; the whole
alignment (no gaps) is then checked word by word, and its best stretch, +1 for an equal
and -1.5 for a substituted word, is the overlap.  An overlap of at least ``least_words``
equal words (or the whole item, if it is shorter) contaminates the document.  Items
shorter than the span are sought by all their words.

The join is a partitioned hash join between all documents and the benchmark as a stated
query set.  Items are dealt by hash to blocks of about ``BLOCK_WORDS`` words, written as a
table in the shared folder.  The documents are scanned once and never moved: a task hashes
the words of a portion of its documents and holds them against block after block, which
it reads from that table and indexes; it keeps at most ``_KEPT_BLOCKS`` indexes.  So nothing
of the benchmark passes through the driver or a broadcast, a benchmark of any size is
joined in bounded memory by one scan, and a small one is a block that each worker reads once.

Edge cases: NULL, empty and wordless texts, of documents or items, overlap with nothing;
an empty benchmark contaminates nothing; repeated documents each get their rows; repeated
items are items of their own; a document may overlap with many items; very long texts are
read whole; only doc_id and text, item_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billing_guard.llm.common import word_hashes, words
from billing_guard.llm.tokenfile import open_path
from billing_guard.session import qualified, work_path

#: Care positions of the masks; their ignored places differ.
MASKS = ("11011010111", "11101100111", "11110011011")
SPAN = 11
LEAST_WORDS = 13
BLOCK_WORDS = 500_000
_PENALTY = 1.5
_AT_ONCE = 400_000  # words held against the blocks at a time
_KEPT_BLOCKS = 4    # indexes a worker keeps
_BITS = 20

_rng = np.random.default_rng(4)
_FACTORS = _rng.integers(2**62, 2**63, SPAN, dtype=np.int64).astype(np.uint64) | np.uint64(1)


def seed_hashes(h: np.ndarray, mask: str) -> np.ndarray:
    """The mask's hash at every place it fits."""
    size = len(h) - len(mask) + 1
    total = np.zeros(max(0, size), np.uint64)
    for k, care in enumerate(mask):
        if care == "1" and size > 0:
            total += h[k:k + size] * _FACTORS[k]
    return total


@dataclass
class Index:
    """The seeds of a block of items: per mask, sorted hashes with item and place."""

    item_ids: list[int | None]
    tokens: list[np.ndarray]
    seeds: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, items: list[tuple[int | None, str | None]]) -> Index:
        kept = [(i, h) for i, h in ((i, word_hashes(words(t))) for i, t in items) if len(h)]
        found: dict[str, list[tuple[np.ndarray, int]]] = {}
        for n, (_, h) in enumerate(kept):
            for mask in (MASKS if len(h) >= SPAN else ("1" * len(h),)):
                found.setdefault(mask, []).append((seed_hashes(h, mask), n))
        seeds = {}
        for mask, parts in found.items():
            hashes = np.concatenate([p for p, _ in parts])
            item = np.repeat([n for _, n in parts], [len(p) for p, _ in parts])
            place = np.concatenate([np.arange(len(p)) for p, _ in parts])
            order = np.argsort(hashes, kind="stable")
            marked = np.zeros(1 << _BITS, bool)
            marked[hashes >> np.uint64(64 - _BITS)] = True
            seeds[mask] = (hashes[order], item[order], place[order], marked)
        return cls([i for i, _ in kept], [h for _, h in kept], seeds)

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, diagonal) of all seed hits in a run of words; diagonal = word - place."""
        items, diagonals = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for mask, (hashes, item, place, marked) in self.seeds.items():
            own = seed_hashes(h, mask)
            at = np.flatnonzero(marked[own >> np.uint64(64 - _BITS)])
            first = np.searchsorted(hashes, own[at], side="left")
            count = np.searchsorted(hashes, own[at], side="right") - first
            at, first, count = at[count > 0], first[count > 0], count[count > 0]
            entry = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
            items.append(item[entry])
            diagonals.append(np.repeat(at, count) - place[entry])
        return np.concatenate(items), np.concatenate(diagonals)


def best_stretch(equal: np.ndarray) -> tuple[int, int]:
    """[first, last) of the highest-scoring stretch; the earliest and shortest of ties."""
    total = np.concatenate([[0.0], np.cumsum(np.where(equal, 1.0, -_PENALTY))])
    lowest = np.minimum.accumulate(total)
    last = int(np.argmax(total - lowest))
    first = int(np.flatnonzero(total[:last + 1] == lowest[last])[-1])
    return first, last


def overlaps(index: Index, texts: list[np.ndarray], least_words: int) -> list[list[dict]]:
    """For each text (its word hashes) its overlaps: the best one of every item."""
    out: list[list[dict]] = [[] for _ in texts]
    owners = [k for k, h in enumerate(texts) if len(h)]
    if not owners:
        return out
    starts = np.cumsum([0, *(len(texts[k]) for k in owners)])
    h = np.concatenate([texts[k] for k in owners])
    items, diagonals = index.hits(h)
    # the same words may not reach over the end of a text: the check below
    # compares inside the text that holds the hit, so name it by a word of the hit
    pairs = np.unique(np.column_stack([items, diagonals]), axis=0) if len(items) else np.zeros((0, 2), np.int64)
    best: dict[tuple[int, int], tuple] = {}
    for n, diagonal in pairs.tolist():
        tokens = index.tokens[n]
        lo = int(np.searchsorted(starts, max(diagonal, 0), side="right")) - 1
        while lo < len(owners) and starts[lo] < diagonal + len(tokens):
            a = max(diagonal, int(starts[lo]))
            b = min(diagonal + len(tokens), int(starts[lo + 1]))
            equal = h[a:b] == tokens[a - diagonal:b - diagonal]
            if int(equal.sum()) >= min(least_words, len(tokens)):
                first, last = best_stretch(equal)
                same = int(equal[first:last].sum())
                if same >= min(least_words, len(tokens)):
                    found = (same, -(a + first), last - first, len(tokens), a + first - int(starts[lo]))
                    key = (owners[lo], n)
                    best[key] = max(best.get(key, found), found)
            lo += 1
    for (owner, n), (same, _, length, size, place) in sorted(best.items()):
        out[owner].append({"item_id": index.item_ids[n], "first_word": place, "n_words": length,
                           "n_equal": same, "coverage": same / size})
    return out


def portions(texts: list[str | None]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Word hashes of the texts in portions of about ``_AT_ONCE`` words; where each begins."""
    first, held, size = 0, [], 0
    for text in texts:
        h = word_hashes(words(text))
        held.append(h)
        size += len(h)
        if size >= _AT_ONCE:
            yield first, held
            first, held, size = first + len(held), [], 0
    if held:
        yield first, held


_OVERLAP = "array<struct<item_id: long, first_word: long, n_words: long, n_equal: long, coverage: double>>"


@dataclass(frozen=True)
class Blocks:
    """The benchmark as a table of blocks in the shared folder."""

    folder: str
    count: int

    @classmethod
    def write(cls, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Blocks:
        spark = benchmark.sparkSession
        items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
        size = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
        count = max(1, -(-size // block_words))
        folder = qualified(spark, work_path(spark, "benchmark_blocks"))
        (items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(count)))
         .repartition(count, "block").write.partitionBy("block").parquet(folder))
        return cls(folder, count)

    def index(self, block: int) -> Index:
        """A block's index, read from its files; a worker keeps the last ones."""
        if (self.folder, block) not in _INDEXES:
            while len(_INDEXES) >= _KEPT_BLOCKS:
                _INDEXES.pop(next(iter(_INDEXES)))
            _INDEXES[self.folder, block] = Index.of(self._items(block))
        return _INDEXES[self.folder, block]

    def _items(self, block: int) -> list[tuple[int | None, str]]:
        import pyarrow.dataset as ds
        from pyarrow import fs

        store, inner = open_path(f"{self.folder}/block={block}")
        if store.get_file_info(inner).type == fs.FileType.NotFound:
            return []
        rows = ds.dataset(inner, filesystem=store, format="parquet").to_table(["item_id", "text"]).to_pylist()
        return sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


_INDEXES: dict[tuple[str, int], Index] = {}


def overlap_column(blocks: Blocks, text: Column, least_words: int) -> Column:
    """Overlaps of a whole text with the items of all blocks."""

    @F.pandas_udf(_OVERLAP)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found: list[list[dict]] = [[] for _ in texts]
            for first, held in portions(texts.tolist()):
                for block in range(blocks.count):
                    for k, more in enumerate(overlaps(blocks.index(block), held, least_words), first):
                        found[k] += more
            yield pd.Series(found, dtype=object)

    return find.asNondeterministic()(text)


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS,
                       block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id, first_word, n_words, n_equal, coverage of every overlap."""
    blocks = Blocks.write(benchmark, block_words)
    return docs.select("doc_id", F.inline(overlap_column(blocks, F.col("text"), least_words)))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS,
                      block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that overlap with no item; columns of any name are kept."""
    found = overlap_column(Blocks.write(benchmark, block_words), F.col("text"), least_words)
    return (docs.select(F.struct("*").alias("row"), found.alias("found"))
            .where(F.size("found") == 0).select("row.*"))

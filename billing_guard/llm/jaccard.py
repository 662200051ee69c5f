"""N-gram Jaccard join with Bayesian candidate pruning.

A document is the set of its hashed ``n``-word shingles (all words together where it has
fewer; the stripped text where it has no word).  Documents with equal sets are one class
with a multiplicity.  Links (Jaccard >= threshold) between classes are found in four steps:

1. *Candidates.*  ``BANDS`` bands of ``ROWS`` MinHash values; classes that share a band
   value are candidates.  A pair at the threshold shares none with probability
   (1 - 0.8^5)^40 = 1.2e-7.
2. *Bayesian pruning.*  MinHash values are compared ``STEP`` at a time.  After n of them
   with m agreements the similarity has a Beta(m + 1, n - m + 1) posterior (uniform prior);
   a pair is dropped as soon as its probability of reaching the threshold is below
   ``TOLERANCE``.  It runs in the buckets first, on one byte of each value (equal bytes of
   unequal values only keep more pairs).  A bucket returns a forest of what survives,
   never its pairs; the forests' components are the groups, so classes that share a band
   by chance or through a common passage chain no groups together.
3. *Tiles.*  A bucket or group of any size is cut into blocks by class and a task compares
   two blocks, so it may hold any share of the classes without meeting in one task.  The
   pairs of a group are pruned by whole values.
4. *Exact check.*  The remaining pairs' shingle sets are intersected in full.

A tile returns one row per linked class (links, least partner), so the output is linear.

Edge cases: NULL and blank texts link with nothing and form their own groups; repeated
rows are documents of their own, linked with each other; very long texts are compared
whole; a NULL doc_id is linked like any other and its group's id is the least non-NULL
one; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billing_guard.llm.common import word_hashes, words, written
from billing_guard.llm.embeddings import TILE_ROWS, tile_links, with_components
from billing_guard.llm.graph import components, local_roots, tile_places

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 5
TOLERANCE = 1e-7
STEP = 20           # MinHash values compared at a time
BLOCK = 1024        # classes of a block, about
BLOCK_SHINGLES = 1_500_000  # shingles of a block, about
_COLUMNS = 2048     # shingles of one intersection product

_rng = np.random.default_rng(20)
_A = (_rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1))
_B = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
_MIX = [np.uint64(int(m) | 1) for m in _rng.integers(2**62, 2**63, 64)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX[0]
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; none for a blank text."""
    if not text or text.isspace():
        return np.zeros(0, np.uint64)
    h = word_hashes(words(text) or [text.strip()])
    size = min(n, len(h))
    total = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        total = _mixed(total + h[k:len(h) - size + 1 + k] * _MIX[k + 1])
    return np.unique(total)


def signature(hashes: np.ndarray) -> np.ndarray:
    """MinHash values of a non-empty shingle set."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(_A), 2**32 - 1, np.uint32)
    for a in range(0, len(x), 512):  # products that stay in the cache
        values = x[a:a + 512, None] * _A
        values += _B
        np.minimum(out, values.min(axis=0), out=out)
    return out


def band_values(sig: np.ndarray) -> np.ndarray:
    """One 64-bit value per band."""
    parts = sig.reshape(BANDS, ROWS).astype(np.uint64)
    total = np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX[60]
    for k in range(ROWS):
        total = _mixed(total + parts[:, k] * _MIX[50 + k])
    return total.view(np.int64)


def least_agreements(threshold: float, tolerance: float, steps: range) -> dict[int, int]:
    """For each number of compared values, the fewest agreements that keep a pair.

    With a uniform prior P(J >= t | m of n) = P(Bin(n + 1, t) <= m).
    """
    least = {}
    for n in steps:
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        least[n] = m
    return least


def surviving(left: np.ndarray, right: np.ndarray, threshold: float, tolerance: float) -> np.ndarray:
    """Pairs (as a matrix of booleans) of two blocks' signatures that are not pruned."""
    size = left.shape[1]
    least = least_agreements(threshold, tolerance, range(STEP, size + 1, STEP))
    agree = np.zeros((len(left), len(right)), np.uint8)
    for k in range(STEP):
        agree += left[:, k, None] == right[None, :, k]
    alive = agree >= least[STEP]
    i, j = np.nonzero(alive)
    if len(i) * 8 > alive.size:  # most pairs live: go on with the whole matrix
        for n in range(2 * STEP, size // 2 + 1, STEP):
            for k in range(n - STEP, n):
                agree += left[:, k, None] == right[None, :, k]
            alive &= agree >= least[n]
        return alive
    count = agree[i, j].astype(np.int64)
    for n in range(2 * STEP, size + 1, STEP):
        if not len(i):
            break
        part = slice(n - STEP, n)
        for a in range(0, len(i), 100_000):
            rows = slice(a, a + 100_000)
            count[rows] += (left[i[rows], part] == right[j[rows], part]).sum(axis=1)
        keep = count >= least[n]
        i, j, count = i[keep], j[keep], count[keep]
    alive[:] = False
    alive[i, j] = True
    return alive


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products over the shingles that both sides hold."""
    flat_l, flat_r = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(flat_l, flat_r)
    rows_l = np.repeat(np.arange(len(left)), [len(s) for s in left])
    rows_r = np.repeat(np.arange(len(right)), [len(s) for s in right])

    def columns(flat: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(shared, flat), max(0, len(shared) - 1))
        held = shared[at] == flat if len(shared) else np.zeros(len(flat), bool)
        order = np.argsort(at[held], kind="stable")
        return at[held][order], rows[held][order]

    (col_l, row_l), (col_r, row_r) = columns(flat_l, rows_l), columns(flat_r, rows_r)
    total = np.zeros((len(left), len(right)), np.float32)
    for a in range(0, len(shared), _COLUMNS):
        sides = []
        for col, row, size in ((col_l, row_l, len(left)), (col_r, row_r, len(right))):
            part = slice(*np.searchsorted(col, [a, a + _COLUMNS]))
            m = np.zeros((size, min(_COLUMNS, len(shared) - a)), np.float32)
            m[row[part], col[part] - a] = 1
            sides.append(m)
        total += sides[0] @ sides[1].T
    return total.astype(np.int64)


def _tile(threshold: float, tolerance: float):
    top = round(threshold * 1000)

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key", kind="stable", ignore_index=True)
        own = rows["own"].to_numpy()
        i, j = int(rows["i"].iloc[0]), int(rows["j"].iloc[0])
        sets = [shingles(t) for t in rows["text"]]
        sizes = np.array([len(s) for s in sets])
        sigs = np.stack([signature(s) for s in sets])
        first, second = np.flatnonzero(own == i), np.flatnonzero(own == j)
        left = right = np.zeros(0, np.int64)
        if len(first) and len(second):
            alive = surviving(sigs[first], sigs[second], threshold, tolerance)
            if i == j:
                alive = np.triu(alive, 1)
            l_rows, r_rows = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
            if len(l_rows):
                a, b = first[l_rows], second[r_rows]
                common = intersections([sets[k] for k in a], [sets[k] for k in b])
                union = sizes[a][:, None] + sizes[b][None, :] - common
                # J >= threshold without rounding
                linked = alive[np.ix_(l_rows, r_rows)] & (1000 * common >= top * union)
                p, q = np.nonzero(linked)
                left, right = a[p], b[q]
        return tile_links(rows["key"].to_numpy(), rows["size"].to_numpy(np.int64), left, right)
    return join


_FEATURES = "key binary, n int, bands array<long>, bytes binary"


def features(docs: DataFrame) -> DataFrame:
    """doc_id, tie (a hash of the text), key (identity of the shingle set; NULL for a
    blank text), n (shingles), bands, bytes (the lowest one of each MinHash value)."""

    @F.pandas_udf(_FEATURES)
    def describe(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                found = shingles(text)
                if not len(found):
                    rows.append((None, 0, None, None))
                    continue
                sig = signature(found)
                rows.append((hashlib.blake2b(found.tobytes(), digest_size=16).digest(), len(found),
                             band_values(sig), sig.astype(np.uint8).tobytes()))
            yield pd.DataFrame({name: pd.Series([r[k] for r in rows], dtype=kind) for k, (name, kind) in enumerate(
                [("key", object), ("n", "int32"), ("bands", object), ("bytes", object)])})

    return docs.select("doc_id", F.xxhash64("text").alias("tie"),
                       describe.asNondeterministic()(F.col("text")).alias("f")).select("doc_id", "tie", "f.*")


def bucket_survivors(tile: np.ndarray, own: np.ndarray, cross: np.ndarray, values: np.ndarray,
                     least: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of equal ``tile`` (rows in its order) that are not pruned; where
    ``cross`` is set only those of unequal ``own``."""
    lefts, rights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lag in range(1, len(tile)):
        left = np.flatnonzero(tile[:-lag] == tile[lag:])
        if not len(left):
            break  # tiles are runs: no longer one either
        left = left[~cross[left] | (own[left] != own[left + lag])]
        count = np.zeros(len(left), np.int64)
        for n, fewest in least.items():
            part = slice(n - STEP, n)
            count += (values[left, part] == values[left + lag, part]).sum(axis=1)
            keep = count >= fewest
            left, count = left[keep], count[keep]
            if not len(left):
                break
        lefts.append(left)
        rights.append(left + lag)
    return np.concatenate(lefts), np.concatenate(rights)


def _bucket_ties(threshold: float, tolerance: float):
    least = least_agreements(threshold, tolerance, range(STEP, BANDS * ROWS + 1, STEP))

    def ties(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def forest(rows: pd.DataFrame) -> pd.DataFrame:
            tile = rows.groupby(["band", "i", "j"], sort=False).ngroup().to_numpy()
            values = np.frombuffer(b"".join(rows["bytes"]), np.uint8).reshape(len(rows), -1)
            left, right = bucket_survivors(tile, rows["own"].to_numpy(), (rows["i"] != rows["j"]).to_numpy(),
                                           values, least)
            roots = local_roots(len(rows), left, right)
            at = np.flatnonzero(roots != np.arange(len(rows)))
            keys = rows["key"].to_numpy()
            return pd.DataFrame({"a": keys[at], "b": keys[roots[at]]})

        rest = None  # the last tile of a batch may go on in the next one
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if not len(rows):
                continue
            places = rows[["band", "i", "j"]].to_numpy()
            changes = np.flatnonzero((places[1:] != places[:-1]).any(axis=1)) + 1
            cut = int(changes[-1]) if len(changes) else 0
            if cut:
                yield forest(rows.iloc[:cut])
            rest = rows.iloc[cut:]
        if rest is not None and len(rest):
            yield forest(rest)
    return ties


def candidate_groups(classes: DataFrame, threshold: float = THRESHOLD,
                     tolerance: float = TOLERANCE) -> DataFrame:
    """(node, root) over classes (key, bands, bytes): groups tied by pairs that share a
    band value and survive the pruning."""
    banded = classes.select("key", F.explode("bands").alias("band"))
    buckets = (banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
               .select("band", F.ceil(F.col("n") / BLOCK).alias("blocks")))
    # Buckets, classes and texts grow with the documents: sort-merge joins at every size.
    # The bytes join after the buckets of one class are gone.
    tiles = (banded.join(buckets.hint("merge"), "band")
             .join(classes.select("key", "bytes").hint("merge"), "key")
             .withColumn("t", F.explode(tile_places(F.col("key"), F.col("blocks"))))
             .select("band", "t.i", "t.j", "t.own", "key", "bytes"))
    ties = (tiles.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
            .mapInPandas(_bucket_ties(threshold, tolerance), "a binary, b binary"))
    return components(ties)


def linked_documents(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, tie, class_id, n_links, group_id, kept, root for every row of ``docs``.

    ``class_id`` is the least doc_id with the same shingle set, ``n_links`` counts the
    documents linked directly, ``group_id`` is the least doc_id reachable by links.
    """
    rows = written(features(docs), "shingle_features")
    # copies collapse before the shuffle; a representative row names where the text is
    classes = written(rows.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("size"), F.min("n").alias("n"),
        F.min(F.struct("doc_id", "tie")).alias("at"), F.first(F.struct("bands", "bytes")).alias("f")).select("*", "f.*").drop("f"), "shingle_classes")
    groups = candidate_groups(classes, threshold, tolerance)
    members = written(classes.drop("bands", "bytes").join(groups.withColumnRenamed("node", "key"), "key"),
                      "candidate_members")
    blocks = (members.groupBy("root").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
              .select("root", F.greatest(F.ceil(F.col("c") / BLOCK), F.ceil(F.col("s") / BLOCK_SHINGLES))
                      .alias("blocks")))
    texts = docs.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    # repeated rows of one id and text must not repeat a class
    placed = (members.join(texts.hint("merge"), F.col("at.doc_id").eqNullSafe(F.col("doc_id"))
                           & (F.col("at.tie") == F.col("tie")))
              .groupBy("key").agg(F.first("root").alias("root"), F.first("size").alias("size"),
                                  F.first("text").alias("text")))
    tiles = (placed.join(blocks, "root")
             .withColumn("t", F.explode(tile_places(F.col("key"), F.col("blocks"))))
             .select("root", "t.i", "t.j", "t.own", "key", "size", "text"))
    found = written(tiles.groupBy("root", "i", "j").applyInPandas(_tile(threshold, tolerance), TILE_ROWS),
                    "document_links")
    keyed = rows.select(F.struct("doc_id", "tie").alias("row"), "key", "doc_id")
    linked = with_components(keyed.select("doc_id", "key", "row"), classes, found, "doc_id", ("row",))
    return linked.select("doc_id", "row.tie", "class_id", "n_links",
                         F.col("component_id").alias("group_id"), "kept", "root")


def keep_one_of_each_group(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the document with the
    least id (and text hash) stays, and of repeated rows of that id and text the one whose
    other columns come first in order (they must have an order, which maps have not)."""
    linked = linked_documents(docs, threshold)
    # by the group's root, not its least id: ids may be NULL or repeated
    least = (linked.where(F.col("root").isNotNull()).groupBy("root")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie")).alias("kept"))
             .select("kept.doc_id", "kept.tie"))
    kept = (least.unionByName(linked.where(F.col("root").isNull()).select("doc_id", "tie"))
            .select(F.col("doc_id").alias("kept_id"), F.col("tie").alias("kept_tie")).distinct())
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select("doc_id", F.xxhash64("text").alias("tie"), "text", (F.struct(*others) if others else F.lit(0)).alias("others"))
    one = (rows.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("tie") == F.col("kept_tie")),
                     "left_semi")
           .groupBy("doc_id", "tie").agg(F.first("text").alias("text"), F.min("others").alias("others")))
    return one.select(*[c if c in ("doc_id", "text") else F.col("others")[c].alias(c) for c in docs.columns])

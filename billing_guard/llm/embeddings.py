"""Near-duplicate vectors by quantised tile products with error bounds.

Vectors of one label (and one dimension) are cut into blocks; every pair of blocks is a
tile, and a task multiplies its two blocks.  Unit vectors are quantised to int8 with one
scale each; integer products are exact in single precision, as their sums stay below
2^24 up to 1,040 dimensions (longer vectors are multiplied in slices).  With x = x' + e,
|x.y - x'.y'| <= |e_x| |y'| + |x'| |e_y| + |e_x| |e_y|: only pairs that this bound leaves
possibly above the threshold are recomputed, in double precision from the given
components, so no link is lost and none is invented.

Equal vectors of one label are one class with a multiplicity, before any tile.  A tile
returns one row per linked class: its link count and its least partner in the tile's own
components - never the pairs - so what leaves a tile is linear in its rows even where
everything is linked with everything.

Edge cases: vectors that are NULL, empty, zero or hold NULL or non-finite components, and
those with a NULL label, link with nothing and form their own components; repeated rows
are vectors of their own (linked with each other); vectors of different dimension are
never compared; a row with a NULL vec_id is linked like any other, and its component id is
the least non-NULL one, if any; only vec_id, embedding and label are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billing_guard.llm.common import written
from billing_guard.llm.graph import components, local_roots, tile_places

THRESHOLD = 0.93
BLOCK = 2048     # vectors of a block, about
_SLICE = 1024    # dimensions of one exact single-precision product
_RECOMPUTED = 50_000  # pairs recomputed at a time
_SLACK = 1e-9    # covers the rounding of the bound itself

TILE_ROWS = "key binary, links long, root binary"


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, lengths of the coded vectors and of their errors."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    coded = codes * scale[:, None]
    return (codes, scale, np.linalg.norm(coded, axis=1), np.linalg.norm(unit - coded, axis=1))


def linked_pairs(x: np.ndarray, y: np.ndarray, threshold: float, same: bool):
    """Index pairs with cosine >= threshold; with ``same`` only those above the diagonal.

    Yields (left, right) arrays, a bounded number of recomputed pairs at a time.
    """
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    qx, sx, lx, ex = quantise(x / nx[:, None])
    qy, sy, ly, ey = quantise(y / ny[:, None])
    step = max(1, 2_000_000 // max(1, len(y)))
    for a in range(0, len(x), step):
        rows = slice(a, a + step)
        product = np.zeros((len(qx[rows]), len(y)))
        for d in range(0, x.shape[1], _SLICE):
            dims = slice(d, d + _SLICE)
            product += qx[rows, dims].astype(np.float32) @ qy[:, dims].T.astype(np.float32)
        product *= sx[rows, None]
        product *= sy
        product += ex[rows, None] * ly
        product += (lx[rows] + ex[rows])[:, None] * ey
        left, right = np.nonzero(product >= threshold - _SLACK)
        left += a
        if same:
            above = left < right
            left, right = left[above], right[above]
        for p in range(0, len(left), _RECOMPUTED):
            i, j = left[p:p + _RECOMPUTED], right[p:p + _RECOMPUTED]
            cosine = np.einsum("nd,nd->n", x[i], y[j]) / (nx[i] * ny[j])
            found = cosine >= threshold
            if found.any():
                yield i[found], j[found]


def tile_links(keys: np.ndarray, weights: np.ndarray, left: np.ndarray, right: np.ndarray) -> pd.DataFrame:
    """Rows of TILE_ROWS: for every linked class its links and its least partner."""
    links = np.zeros(len(keys), np.int64)
    np.add.at(links, left, weights[right])
    np.add.at(links, right, weights[left])
    roots = local_roots(len(keys), left, right)
    at = np.flatnonzero(links)
    return pd.DataFrame({"key": keys[at], "links": links[at], "root": keys[roots[at]]})


def _tile(threshold: float):
    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key", kind="stable", ignore_index=True)
        vectors = np.array(rows["embedding"].tolist(), dtype=np.float64)
        own = rows["own"].to_numpy()
        i, j = int(rows["i"].iloc[0]), int(rows["j"].iloc[0])
        first, second = np.flatnonzero(own == i), np.flatnonzero(own == j)
        lefts, rights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(first) and len(second):
            for a, b in linked_pairs(vectors[first], vectors[second], threshold, i == j):
                lefts.append(first[a])
                rights.append(second[b])
        return tile_links(rows["key"].to_numpy(), rows["size"].to_numpy(np.int64),
                          np.concatenate(lefts), np.concatenate(rights))
    return join


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``."""
    rows = vectors.select("vec_id", "embedding", "label")
    usable = (F.col("label").isNotNull() & (F.size("embedding") > 0)
              & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v)
                         & (F.abs(v.cast("double")) < float("inf")))
              & F.exists("embedding", lambda v: v != 0))
    key = F.unhex(F.md5(F.concat_ws(";", F.col("label").cast("string"),
                                    F.array_join(F.transform("embedding", lambda v: (v + 0).cast("string")), ","))))
    rows = written(rows.withColumn("key", F.when(F.coalesce(usable, F.lit(False)), key)), "vectors")
    classes = (rows.where(F.col("key").isNotNull()).groupBy("key")
               .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("size"),
                    F.min(F.struct("label", "embedding")).alias("v"))
               .select("key", "least", "size", "v.label", "v.embedding", F.size("v.embedding").alias("dim")))
    classes = written(classes, "vector_classes")
    blocks = (classes.groupBy("label", "dim").count()
              .select("label", "dim", F.ceil(F.col("count") / block).alias("blocks")))
    tiles = (classes.join(blocks, ["label", "dim"])
             .withColumn("t", F.explode(tile_places(F.col("key"), F.col("blocks"))))
             .select("label", "dim", "t.i", "t.j", "t.own", "key", "size", "embedding"))
    found = written(tiles.groupBy("label", "dim", "i", "j").applyInPandas(_tile(threshold), TILE_ROWS),
                    "vector_links")
    return with_components(rows, classes, found, "vec_id")


def with_components(rows: DataFrame, classes: DataFrame, found: DataFrame, row_id: str,
                    also: tuple[str, ...] = ()) -> DataFrame:
    """Rows (``row_id``, key, ``also``) with their links and components, from tile results;
    ``root`` is the component's own key (NULL without a key), whatever the ids are."""
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    known = written(classes.select("key", "least", "size").join(links, "key", "left")
                    .join(roots.withColumnRenamed("node", "key"), "key", "left")
                    .select("key", "least", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n"),
                            F.coalesce("root", "key").alias("root")), "class_components")
    least = known.groupBy("root").agg(F.min("least").alias("component"))
    known = known.join(least, "root").select("key", "least", "n", "component", "root")
    joined = rows.where(F.col("key").isNotNull()).join(known, "key")
    result = [F.col(row_id), *also, F.col("n").cast("long").alias("n_links"),
              F.col("component").alias("component_id"),
              F.coalesce(F.col(row_id) == F.col("component"), F.col("component").isNull()).alias("kept")]
    alone = rows.where(F.col("key").isNull()).select(
        row_id, *also, F.lit(0).cast("long").alias("n_links"), F.col(row_id).alias("component_id"),
        F.lit(True).alias("kept"))
    return joined.select(*result, F.col("least").alias("class_id"), "root").unionByName(
        alone.withColumn("class_id", F.col(row_id)).withColumn("root", F.lit(None).cast("binary")))

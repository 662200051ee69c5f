"""Connected components and tiles, shared by the two similarity joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billing_guard.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root``: the least node of each component of ``edges`` (a, b).

    Contraction: every node points at its least neighbour (or itself); edges then join
    what their ends point at, and those inside one such group fall away.  Every node
    with a lesser neighbour disappears in its round, so the rounds are logarithmic in
    the longest path.  Each round's tables are written, which cuts the lineage; the
    aggregation for the least neighbour is combined before its shuffle, so a node with
    any number of links is no hot spot.
    """
    def ordered(a: Column, b: Column) -> list[Column]:
        return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]

    current = written(edges.where("a <> b").select(*ordered(F.col("a"), F.col("b"))).distinct(), "edges")
    roots = None
    while not current.isEmpty():
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                         .select("node", F.least("node", "least").alias("up")), "points")
        if roots is None:
            roots = points.withColumnRenamed("up", "root")
        else:
            step = points.select(F.col("node").alias("root"), "up")
            roots = written(roots.join(step, "root", "left")
                            .select("node", F.coalesce("up", "root").alias("root")), "roots")
        ends = (current.join(points.select(F.col("node").alias("a"), F.col("up").alias("ua")), "a")
                .join(points.select(F.col("node").alias("b"), F.col("up").alias("ub")), "b"))
        current = written(ends.where("ua <> ub").select(*ordered(F.col("ua"), F.col("ub"))).distinct(),
                          "edges")
    if roots is None:
        return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


def tile_places(key: Column, blocks: Column) -> Column:
    """The tiles (i <= j) of a group cut into ``blocks`` blocks that a row belongs to,
    as array of struct(i, j, own): ``own`` is the row's block."""
    own = F.pmod(F.xxhash64(key), blocks).cast("int")
    return F.transform(F.sequence(F.lit(0), (blocks - 1).cast("int")), lambda other: F.struct(
        F.least(own, other).alias("i"), F.greatest(own, other).alias("j"), own.alias("own")))


def local_roots(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0..size-1, the least node of each one's component."""
    root = np.arange(size)
    while True:
        least = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], least)
        np.minimum.at(new, root[right], least)
        while not np.array_equal(new, jumped := new[new]):
            new = jumped
        if np.array_equal(new, root):
            return root
        root = new

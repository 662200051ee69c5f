"""Keys that hold a large share of all rows: found in one narrow pass, dealt over many tasks.

A key that holds a large share of the rows would send all of them to one reduce task.

* :func:`hot_shares` names such keys.  It reads the key columns once; every task keeps a
  bounded frequency sketch of key hashes (``approx_top_k``), the sketches are merged per
  group of tasks, and only the few candidates that they return are shuffled.  Nothing the
  size of the keys moves, and the answer has at most ``HOT_PARTS x partitions`` keys whatever
  the data: a bound by arithmetic, not a cap.
* :func:`hot_split_join` joins a large side once.  Rows of a key with share s are dealt over
  about ``SHARES x partitions x s`` salts and the few rows of the other side that belong to
  hot keys are repeated for each; all other rows have the salt 0.  One ordinary join follows,
  so chained joins read and shuffle their rows once each, and nothing is broadcast but the
  list of hot keys.

The lists only decide where a row is processed, never what comes out: a key missed by the
sketch, or a cold key whose hash collides with a hot one, gives the same rows.  NULL keys
count like any other.  A row's salt comes from its partition and its content, so a retried
task deals it as before.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil, isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: a key is hot from this part of an average shuffle partition's rows on: 1 / HOT_PARTS
HOT_PARTS = 2
#: how many shares an average shuffle partition's rows of a hot key are cut into
SHARES = 8
#: keys that a sketch follows per shuffle partition (its error is 3.5 / entries of its rows)
SKETCH_ENTRIES = 32
#: the most that ``approx_top_k`` follows
_SKETCH_LIMIT = 1_000_000


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def key_hash(keys: Sequence[str | Column]) -> Column:
    """One 64-bit number for a key, NULL parts included."""
    return F.xxhash64(*keys)


def hot_shares(df: DataFrame, *key_lists: Sequence[str], parts: int | None = None) -> list[dict[int, int]]:
    """For every list of key columns: hash of a hot key -> shares its rows are dealt over.

    One pass over the key columns for all lists.  A key is hot when it holds at least
    ``1 / parts`` of all rows (within an eighth, as the sketches see it).
    """
    return rows_and_hot_shares(df, *key_lists, parts=parts)[1]


def rows_and_hot_shares(df: DataFrame, *key_lists: Sequence[str],
                        parts: int | None = None) -> tuple[int, list[dict[int, int]]]:
    """:func:`hot_shares`, and before them the number of all rows, from the same pass."""
    spark = df.sparkSession
    parts = parts or HOT_PARTS * partitions(spark)
    entries = min(_SKETCH_LIMIT, SKETCH_ENTRIES * parts)
    groups = isqrt(parts) + 1
    rows = df.select(*[key_hash(keys).alias(f"_h{i}") for i, keys in enumerate(key_lists)],
                     (F.spark_partition_id() % groups).alias("_group"))
    sketches = rows.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"), *[
        F.expr(f"approx_top_k(_h{i}, {entries}, {entries})").alias(f"_t{i}") for i in range(len(key_lists))])

    def candidates(i: int) -> Column:
        # a hot key has a hot key's share in some groups; elsewhere it may go unseen below an eighth
        seen = F.filter(f"_t{i}", lambda t: t["count"] * (8 * parts) >= F.col("_n"))
        return F.transform(seen, lambda t: F.struct(
            F.lit(i).alias("which"), t["item"].alias("hash"), t["count"].alias("n")))

    total = F.array(F.struct(F.lit(-1).alias("which"), F.lit(0).cast("long").alias("hash"),
                             F.col("_n").alias("n")))
    found = (sketches.select(F.explode(F.concat(total, *map(candidates, range(len(key_lists))))).alias("c"))
             .groupBy("c.which", "c.hash").agg(F.sum("c.n").alias("n"))
             .orderBy(F.col("n").desc()).limit(1 + parts * len(key_lists)).collect())
    all_rows = next((r.n for r in found if r.which == -1), 0)
    shares = SHARES * partitions(spark)
    return all_rows, [
        {r.hash: ceil(shares * r.n / all_rows) for r in found if r.which == i and r.n * parts >= all_rows}
        for i in range(len(key_lists))]


def in_tasks(df: DataFrame, rows: int, most: int, keys: Sequence[str]) -> DataFrame:
    """``df``, of so many rows, exchanged by ``keys`` into tasks of about ``most`` rows at most.

    The shuffle partitions of the session, which Spark may merge, do where they are enough;
    else the number of tasks grows with the rows, so that no task's memory does.
    """
    tasks = ceil(rows / most)
    if tasks <= df.sparkSession.sparkContext.defaultParallelism:
        return df.repartition(*keys)
    return df.repartition(tasks, *keys)


def is_hot(keys: Sequence[str], shares: dict[int, int]) -> Column:
    """The row's key is in the list."""
    return key_hash(keys).isin(list(shares)) if shares else F.lit(False)


def share_of(columns: Sequence[str], shares: Column) -> Column:
    """One of ``shares`` numbers for a row, by its partition and content; NULL for NULL."""
    return F.pmod(F.xxhash64(F.spark_partition_id(), *columns), shares)


def hot_keys(counts: DataFrame, keys: list[str], count_col: str, parts: int | None = None) -> DataFrame:
    """The hot keys of a table of exact counts (one row per key), with their ``_shares``."""
    parts = parts or HOT_PARTS * partitions(counts.sparkSession)
    shares = SHARES * partitions(counts.sparkSession)
    total = counts.agg(F.sum(count_col)).scalar()
    n = F.col(count_col)
    return counts.where(n * F.lit(parts) >= total).select(
        *keys, F.ceil(n * F.lit(shares) / total).cast("int").alias("_shares"))


def row_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key in ``_n`` (combined before the shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def _same(left: list[str], right: list[str], null_safe: bool) -> Column:
    parts = [F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b)
             for a, b in zip(left, right)]
    return reduce(lambda a, b: a & b, parts)


def hot_split_join(big: DataFrame, per_key: DataFrame, keys: list[str], how: str = "left",
                   hot: DataFrame | dict[int, int] | None = None, null_safe: bool = False) -> DataFrame:
    """``big`` with the columns of ``per_key``, joined on ``keys`` (``inner`` or ``left``).

    ``hot`` lists the hot keys of ``big``, from :func:`hot_shares` (by default, by a pass of
    its own over the key columns) or :func:`hot_keys`.  ``big`` is read once.
    """
    if hot is None:
        hot, = hot_shares(big, keys)
    names = [f"_pk_{k}" for k in keys]
    types = [big.schema[k].dataType for k in keys]
    right = per_key.withColumnsRenamed(dict(zip(keys, names)))
    if isinstance(hot, dict):
        if not hot:
            return big.join(right, _same(keys, names, null_safe), how).drop(*names)
        listed = big.sparkSession.createDataFrame(list(hot.items()), "_hash long, _shares int")
    else:
        listed = hot.select(key_hash([F.col(k).cast(t) for k, t in zip(keys, types)]).alias("_hash"), "_shares")

    def tagged(df: DataFrame, key: Column) -> DataFrame:
        return df.withColumn("_key", key).join(F.broadcast(listed), F.col("_key") == F.col("_hash"), "left")

    left = (tagged(big, key_hash(keys))
            .withColumn("_salt", F.coalesce(share_of(big.columns, F.col("_shares")), F.lit(0)))
            .drop("_key", "_hash", "_shares"))
    last = F.coalesce(F.col("_shares"), F.lit(1)).cast("long") - 1
    right = (tagged(right, key_hash([F.col(n).cast(t) for n, t in zip(names, types)]))
             .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), last)))
             .drop("_key", "_hash", "_shares"))
    condition = _same(keys, names, null_safe) & (F.col("_salt") == F.col("_copy"))
    return left.join(right, condition, how).drop("_salt", "_copy", *names)

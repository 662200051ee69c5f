"""Row numbers within groups that stay distributed when one group is huge.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends each group to a single task.  Here
only groups known to be cold go that way, in one exchange.  Rows of hot groups (named by
:func:`hot_shares`, at most a bounded number of groups) are range-partitioned by ``(g, o)``
instead - sampled boundaries cut a hot group, a NULL group included, into ordered pieces -
and take their place within the sorted partition.  A row's number is its place, less the
place where its group begins in this partition, plus the group's rows in earlier
partitions.  Those two facts exist once per (partition, group): each partition boundary adds
at most one to the number of hot groups, so the table of carried offsets is bounded by
``partitions + hot groups`` and is broadcast.  Every row is exchanged once.

The hot rows are written in their partitions, because the offsets and the numbers must
come from the same boundaries.  ``strategy="window"`` is for groups known to be small.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billing_guard.operators.skew import hot_shares, is_hot
from billing_guard.operators.skew import partitions as shuffle_partitions
from billing_guard.session import written

#: the bits of ``monotonically_increasing_id`` below the partition number
_PLACE_BITS = 33


def row_number_in_groups(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                         out_col: str, strategy: str = "range", partitions: int | None = None,
                         hot: dict[int, int] | None = None) -> DataFrame:
    """Append ``out_col`` = 1, 2, ... within each group in ``order`` (ties: as given).

    NULL group values form one group, as in SQL window partitions.  ``hot`` lists the hot
    groups (:func:`hot_shares`); by default one pass over the group columns finds them.
    """
    if strategy == "window":
        return _by_window(df, group_cols, order, out_col)
    if strategy != "range":
        raise ValueError(f"unknown strategy {strategy!r}")
    if hot is None:
        hot, = hot_shares(df, group_cols)
    if not hot:
        return _by_window(df, group_cols, order, out_col)
    in_hot = is_hot(group_cols, hot)
    cold = _by_window(df.where(~in_hot), group_cols, order, out_col)
    return cold.unionByName(_by_range(df.where(in_hot), group_cols, order, out_col, partitions))


def _by_window(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
               out_col: str) -> DataFrame:
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(out_col, F.row_number().over(w))


def _by_range(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
              out_col: str, partitions: int | None) -> DataFrame:
    n = partitions or shuffle_partitions(df.sparkSession)
    keys = [*[F.col(c).asc_nulls_first() for c in group_cols], *order]
    place = F.monotonically_increasing_id()  # partition number and place in the sorted partition
    ranged = written(
        df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_at", place)
        .withColumn("_pid", F.shiftright("_at", _PLACE_BITS)), "ranked_rows")
    pieces = ranged.groupBy("_pid", *group_cols).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # one row per (partition, hot group): at most n + hot groups
    earlier = (Window.partitionBy(*group_cols).orderBy("_pid")
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = pieces.select(
        F.col("_pid").alias("_opid"), *[F.col(c).alias(f"_o_{c}") for c in group_cols],
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_carry"))
    cond = reduce(lambda a, b: a & b,
                  [F.col("_pid") == F.col("_opid")]
                  + [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in group_cols])
    return (ranged.join(F.broadcast(carried), cond, "inner")
            .withColumn(out_col, (F.col("_at") + F.col("_carry")).cast("int"))
            .drop("_at", "_pid", "_opid", "_carry", *[f"_o_{c}" for c in group_cols]))

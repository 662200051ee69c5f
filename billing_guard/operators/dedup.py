"""Keep the best row per group, pass ungrouped rows through (top-1 dedup).

Rows with an empty group key are all kept; rows sharing a non-empty key keep
only the first row in the given order.  The keyed rows pass one ``row_number() = 1``
filter, which Spark plans as a *partial* window-group-limit before the exchange and a
final one after it: each map task already reduces a hot group to its local best row,
so no task ever receives a whole hot group.  Rows without a key are not shuffled at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first_per_group(df: DataFrame, group_cols: Sequence[str], keyed: Column,
                         order: Sequence[Column], rank_col: str = "rn") -> DataFrame:
    """Top-1 per ``group_cols`` among rows where ``keyed`` holds; other rows all kept.

    ``order`` must end in enough columns to make the choice deterministic.
    The output carries ``rank_col`` = 1 on every row.
    """
    has_key = F.coalesce(keyed, F.lit(False))
    w = Window.partitionBy(*group_cols).orderBy(*order)
    best = (df.where(has_key).withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) == 1))
    return best.unionByName(df.where(~has_key).withColumn(rank_col, F.lit(1)))

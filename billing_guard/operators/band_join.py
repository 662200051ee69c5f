"""Range (band) join: attach the band whose ``[lo, hi]`` contains a value.

An equi-join on a value bucket, where each band is expanded into the buckets it
covers and the exact BETWEEN is re-checked.  Spark broadcasts the bands while their
known size is small and shuffles both sides otherwise (nothing is grouped by the bucket
afterwards, so adaptive execution can split a large bucket); either way it is a hash or
merge join, never a comparison of every row with every band.

Overlapping bands match more than once, as a SQL BETWEEN join does;
:func:`overlapping_bands` reports such bands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: values in one bucket
BUCKET_WIDTH = 64


def band_join(df: DataFrame, bands: DataFrame, value: Column, lo: str, hi: str,
              how: str = "left", width: int = BUCKET_WIDTH) -> DataFrame:
    """``df ⋈ bands ON value BETWEEN bands.lo AND bands.hi`` (``how``: left or inner)."""
    left = df.withColumn("_value", value).withColumn("_bucket", F.floor(F.col("_value") / width).cast("long"))
    right = bands.withColumn(
        "_band_bucket",
        F.explode(F.sequence(F.floor(F.col(lo) / width).cast("long"),
                             F.floor(F.col(hi) / width).cast("long"))))
    cond = (F.col("_bucket") == F.col("_band_bucket")) & F.col("_value").between(right[lo], right[hi])
    return left.join(right, cond, how).drop("_value", "_bucket", "_band_bucket")


def overlapping_bands(bands: DataFrame, lo: str, hi: str, keys: list[str] | None = None) -> DataFrame:
    """Bands (within the same ``keys``) that start before an earlier band ends.

    Bands are ordered by start; a band overlaps when its start is not after the
    largest end among the bands before it.  Empty when the table is consistent.
    A running maximum, so no pairs of bands are formed.  Without ``keys`` all bands meet in
    one task: name the rate table's keys (the tenant) wherever it has any.
    """
    keys = keys or []
    earlier = (Window.partitionBy(*keys).orderBy(F.col(lo), F.col(hi))
               .rowsBetween(Window.unboundedPreceding, -1))
    return (bands.select(*keys, lo, hi, F.max(hi).over(earlier).alias("earlier_max_hi"))
            .where(F.col(lo) <= F.col("earlier_max_hi")))

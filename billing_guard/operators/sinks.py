"""Class-partitioned Parquet sinks and their read-back; results replaced by commit."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession

from billing_guard.session import path_exists


def replace_whole(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Write a result beside ``path`` and put it in place once it is whole.

    ``write`` gets a staging folder next to ``path``.  If it fails, the staging folder is
    removed and the old result stays as it was.  The swap is two renames in one file
    system; a process that dies between them leaves the old result as ``<path>._old``,
    which the next replacement (or :func:`recover`) puts back first.
    """
    recover(spark, path)
    path = path.rstrip("/")
    staging = f"{path}._staging-{uuid.uuid4().hex[:12]}"
    fs, hadoop = _file_system(spark, path)
    try:
        write(staging)
    except BaseException:
        fs.delete(hadoop(staging), True)
        raise
    old = f"{path}._old"
    if fs.exists(hadoop(path)):
        _rename(fs, hadoop, path, old)
    _rename(fs, hadoop, staging, path)
    fs.delete(hadoop(old), True)


def recover(spark: SparkSession, path: str) -> bool:
    """Put back an old result that an interrupted :func:`replace_whole` left aside."""
    path = path.rstrip("/")
    fs, hadoop = _file_system(spark, path)
    old = f"{path}._old"
    if not fs.exists(hadoop(old)):
        return False
    if fs.exists(hadoop(path)):  # the new result is in place: only the clean-up was missed
        fs.delete(hadoop(old), True)
        return False
    _rename(fs, hadoop, old, path)
    return True


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _rename(fs, hadoop, source: str, target: str) -> None:
    if not fs.rename(hadoop(source), hadoop(target)):
        raise OSError(f"cannot rename {source} to {target}")


def write_partitioned(df: DataFrame, path: str, partition_col: str, mode: str = "overwrite",
                      dynamic_overwrite: bool = False, observation: Observation | None = None,
                      observed: Sequence[Column] = ()) -> None:
    """Write ``df`` as Parquet with one directory per value of ``partition_col``.

    ``rebalance`` lets AQE split a dominant class over several tasks and files
    (a plain repartition by class would write each class from one task) and
    merge small ones.  Overwrite replaces the whole target by commit
    (:func:`replace_whole`); ``dynamic_overwrite`` replaces only the classes present.
    ``observation`` collects the aggregates ``observed`` from the rows as they are written.
    """
    rows = df.hint("rebalance", partition_col)
    if observation is not None:
        rows = rows.observe(observation, *observed)

    def write(target: str, mode: str = "errorifexists") -> None:
        writer = rows.write.mode(mode).partitionBy(partition_col)
        if dynamic_overwrite:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.parquet(target)

    if mode == "overwrite" and not dynamic_overwrite:
        replace_whole(df.sparkSession, path, write)
    else:
        write(path, mode)


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """Read a class-partitioned result; the class column comes from the directories.

    Raises ``ValueError`` when the folder is missing or holds no data files.
    """
    if not path_exists(spark, path):
        raise ValueError(f"No result found at {path}")
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:  # empty folder: nothing to infer a schema from
        raise ValueError(f"No Parquet partitions found in {path}") from exc

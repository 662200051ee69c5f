"""SparkSession construction and the shared work folder.

Cluster jobs get their session from the launcher; these helpers only fill in
settings that are unset, so a cluster's own configuration always wins.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings a batch run of these pipelines wants.  AQE re-plans joins at runtime
# (broadcast when a shuffle stage turns out small, split skewed partitions) and
# coalesces small shuffle partitions, so shuffle.partitions is only an upper bound.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "billing_guard",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the pipeline defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_FALLBACK_ROOT: str | None = None
#: paths given out by :func:`work_path`, for :func:`delete_work`
_MADE: list[str] = []


def work_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint folder).
    Only when a session has neither (local tests) is a private folder created
    and registered as the context's checkpoint folder; the configuration entry
    itself cannot be changed at runtime and is left alone.
    """
    global _FALLBACK_ROOT
    context = spark.sparkContext
    configured = (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
                  or "").rstrip("/")
    if not configured:
        if not context.master.startswith("local"):
            # every executor would write to a folder of its own: reads would miss rows
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if _FALLBACK_ROOT is None:
            _FALLBACK_ROOT = tempfile.mkdtemp(prefix="billing_guard-")
        context.setCheckpointDir(_FALLBACK_ROOT)
        configured = _FALLBACK_ROOT
    elif not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under :func:`work_root` for a written table."""
    _MADE.append(f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}")
    return _MADE[-1]


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and authority that Spark resolves it against.

    A path without a scheme means the session's default file system to Spark, but the local
    disk to other libraries: tasks that open files themselves get the qualified form.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    if hpath.isAbsolute() and hpath.toUri().getScheme() is None:
        default = jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(conf)
        return hpath.makeQualified(default, hpath).toString()
    return hpath.getFileSystem(conf).makeQualified(hpath).toString()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the work folder and read back (cuts the lineage)."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_observed(df: DataFrame, name: str, **aggregates: Column) -> tuple[DataFrame, dict]:
    """:func:`written`, with aggregates that the writing job takes of the rows it writes.

    They stand on top of the plan, in the tasks that write, whose figures Spark counts
    once whatever is retried.
    """
    observation = Observation(name)
    landed = written(df.observe(observation, *[c.alias(k) for k, c in aggregates.items()]), name)
    return landed, observation.get


def work_count() -> int:
    """How many paths :func:`work_path` has given out and not deleted."""
    return len(_MADE)


def delete_work(spark: SparkSession, since: int = 0) -> None:
    """Delete the written tables that this process has made from number ``since`` on."""
    while len(_MADE) > since:
        delete_path(spark, _MADE.pop())


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete one written table, if it is there."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(conf).delete(hpath, True)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so plain ``os`` calls can inspect a local path."""
    return path[len("file:"):] if path.startswith("file:") else path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


__all__ = ["build_session", "qualified", "work_root", "work_path", "written", "written_observed", "delete_path", "delete_work", "work_count", "local_path", "path_exists"]

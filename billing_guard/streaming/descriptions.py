"""Incremental run of the description monitor with Structured Streaming.

The daily monitor re-reads every invoice text.  Parsing and classification
are row-local, so the same plan runs unchanged on a stream of newly landed
files: each micro-batch is parsed, its anomalies are appended to the
reason-partitioned Parquet sink (exactly once, through the sink's commit log
and the checkpoint), and per-reason running totals are kept in the state store.

Checkpoints belong in the shared work folder (``spark.checkpoint.dir``), so a
restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from billing_guard.plans.descriptions import REASON, analyse_descriptions
from billing_guard.sources.schemas import INVOICE_TEXT


def description_stream(spark: SparkSession, source_dir: str,
                       schema: StructType = INVOICE_TEXT,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Parsed and classified invoice texts from Parquet files landing in ``source_dir``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return analyse_descriptions(reader.parquet(source_dir))


def start_anomaly_sink(classified: DataFrame, output_path: str, checkpoint: str,
                       available_now: bool = True,
                       processing_time: str | None = None) -> StreamingQuery:
    """Append each batch's anomalies to a Parquet folder partitioned by reason."""
    writer = (classified.where(F.col("is_anomaly"))
              .writeStream.format("parquet")
              .partitionBy(REASON)
              .option("checkpointLocation", checkpoint)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=processing_time or "1 minute")
    return writer.start(output_path)


def reason_totals(classified: DataFrame) -> DataFrame:
    """Running row count per reason (stateful aggregation; complete or update mode)."""
    return classified.groupBy(REASON).agg(F.count(F.lit(1)).alias("record_count"))


def start_totals_sink(classified: DataFrame, table_name: str, checkpoint: str) -> StreamingQuery:
    """Keep :func:`reason_totals` in an in-memory table (small: one row per reason)."""
    return (reason_totals(classified).writeStream.format("memory").queryName(table_name)
            .outputMode("complete").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())

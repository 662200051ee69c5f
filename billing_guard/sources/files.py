"""CSV source and sink for invoice imports (typed, no schema-inference pass)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from billing_guard.sources.schemas import INVOICE


#: column of :func:`read_invoices_csv` naming a row's cells that do not parse
MALFORMED = "_malformed"
#: what :data:`MALFORMED` names when the record itself is broken, and the column with its text
RECORD = "_record"


def read_invoices_csv(spark: SparkSession, path: str, schema: StructType = INVOICE,
                      infer_schema: bool = False, mark_malformed: bool = False) -> DataFrame:
    """Read a headed CSV export.

    Columns are matched by header name and converted to ``schema``'s types with
    ``try_cast``: a malformed cell becomes NULL instead of failing the job, and
    ``mark_malformed`` adds the list of a row's malformed columns so that such rows
    can be counted and kept apart.  The list names ``_record`` for a record with too few
    or too many cells, also where an open quote swallowed some (one left open in the last
    cell loses nothing and is read as its text); the column ``_record`` then holds the
    record as it stands in the file.  All files of a folder must have one header: a
    file whose columns differ, or come in another order, stops the job instead of
    being read by position.  Columns of the schema missing from the file are left
    out, so the required-column check can report them.  ``infer_schema`` keeps the
    original's inference (it costs an extra pass over the file).
    """
    reader = spark.read.option("header", "true")
    if infer_schema:
        return reader.option("inferSchema", "true").csv(path)
    header = reader.csv(path).schema
    if mark_malformed:
        reader = reader.option("columnNameOfCorruptRecord", RECORD)
        header = StructType([*header.fields, StructField(RECORD, StringType())])
    raw = reader.option("enforceSchema", "false").schema(header).csv(path)
    given = [f for f in schema.fields if f.name in set(raw.columns)]
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in given]
    extra = [F.col(c) for c in raw.columns if c not in {f.name for f in schema.fields}]
    if mark_malformed:
        bad = [F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
               for f in given]
        broken = F.when(F.col(RECORD).isNotNull(), F.lit(RECORD))
        extra.append(F.array_compact(F.array(broken, *bad)).alias(MALFORMED))
    return raw.select(*typed, *extra)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", "true").csv(path)

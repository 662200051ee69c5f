"""billing_guard: Spark-native billing data-quality and commission-settlement engine.

Layout
------
sources/    typed inputs: schemas, CSV / Parquet / JDBC readers, test-table stand-ins
functions/  Column -> Column expressions (label parsers, date repair, money, bands)
operators/  reusable DataFrame -> DataFrame operators (structural flags, top-1 dedup,
            skew-safe ranking, range join, partitioned sinks)
plans/      the three pipelines (structural, descriptions, settlement) and reports
streaming/  incremental (Structured Streaming) run of the description pipeline
"""

from datetime import date

#: The run date every pipeline uses unless told otherwise; never the wall clock.
DEFAULT_AS_OF = date(2024, 1, 31)

__all__ = ["DEFAULT_AS_OF"]

"""Pipeline A: structural anomalies of invoice imports, reports and alert gate.

Reports (class counts, amount exposure, per-class report, rate) are formatted from one
summary row per class: of rows (``class_summary``, one exchange of three columns), of a key
table (``key_classes``) or of classified rows that were written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from billing_guard.functions.formatting import amount_2dp, markdown_row, percent_1dp
from billing_guard.functions.money import round_money_ratio
from billing_guard.operators.sinks import read_partitioned, write_partitioned
from billing_guard.operators.structural import (
    AMOUNT,
    CLEAN,
    INVOICE,
    KEYS,
    ROWS,
    classify_structural,
)
from billing_guard.session import written_observed
from billing_guard.sources.files import read_invoices_csv
from billing_guard.sources.schemas import MONEY, require_columns, require_rows

#: alert when more than this share of rows is anomalous
ANOMALY_RATE_THRESHOLD = 0.10
# --- fixed values: headings of the report -----------------------------------
BREAKDOWN_TITLE = "## Breakdown by Anomaly Type"
BREAKDOWN_HEAD = ("| Anomaly Type | Records | Unique Invoices | Total Amount |", "|---|---|---|---|")
# ---------------------------------------------------------------------------
#: closing section of the report
DEFINITIONS = (
    "## Anomaly Definitions",
    "- **EXACT_DUPLICATE**: the same invoice, case and amount imported more than once.",
    "- **AMOUNT_MISMATCH**: the same invoice and case imported with different amounts.",
    "- **CASE_MISMATCH**: the same invoice linked to more than one case.",
    "- **CLEAN**: no anomaly found.",
)
CLASS_COL = "anomaly_type"


def keys_of_classified(classified: DataFrame) -> DataFrame:
    """The key table of already classified rows, for the reports below."""
    return classified.groupBy(*KEYS, CLASS_COL).agg(F.count(F.lit(1)).alias(ROWS))


def summary_of_classified(classified: DataFrame) -> DataFrame:
    """The columns of :func:`class_summary` from rows that carry their class: one partial sum
    per invoice and class, then per class."""
    return summary_of_keys(classified.withColumn(ROWS, F.lit(1)))


def summary_of_keys(keys: DataFrame) -> DataFrame:
    """The columns of :func:`class_summary` from a key table: weighted sums per invoice and
    class, then per class (a hot invoice's keys are combined before the shuffle)."""
    n = F.col(ROWS)
    per_invoice = keys.groupBy(CLASS_COL, INVOICE).agg(
        F.sum(n).alias("_rows"),
        F.sum(F.when(F.col(AMOUNT).isNotNull(), n).otherwise(0)).alias("_with_amount"),
        F.sum(F.col(AMOUNT) * n).alias("_total"))
    named = F.col(INVOICE).isNotNull()
    return per_invoice.groupBy(CLASS_COL).agg(
        F.sum("_rows").alias("rows"),
        F.sum(F.when(named, F.col("_rows")).otherwise(0)).alias("rows_with_invoice"),
        F.sum("_with_amount").alias("rows_with_amount"),
        F.count(INVOICE).alias("invoices"),
        F.sum("_total").alias("total"))


def _summary(source: DataFrame) -> DataFrame:
    """``source`` is a summary already, or a key table."""
    return summary_of_keys(source) if ROWS in source.columns else source


def class_counts(source: DataFrame) -> DataFrame:
    """Rows per class (A8)."""
    return _summary(source).select(CLASS_COL, F.col("rows").cast("bigint").alias("record_count")).orderBy(CLASS_COL)


def amount_exposure(source: DataFrame) -> DataFrame:
    """Rows, total and average amount per class, rounded to cents (A9)."""
    return _summary(source).select(
        CLASS_COL,
        F.col("rows").cast("bigint").alias("record_count"),
        F.col("total").cast(MONEY).alias("total_amount"),
        round_money_ratio(F.col("total"), F.col("rows_with_amount")).alias("avg_amount"),
    ).orderBy(CLASS_COL)


def class_report(source: DataFrame) -> DataFrame:
    """Per class: rows with an invoice id, distinct invoices, total amount (A11)."""
    return _summary(source).select(
        CLASS_COL,
        F.col("rows_with_invoice").cast("bigint").alias("record_count"),
        F.col("invoices").cast("bigint").alias("unique_invoices"),
        F.col("total").cast(MONEY).alias("total_amount"))


def run_totals(source: DataFrame) -> DataFrame:
    """One row: total rows, anomalous rows, anomaly rate (0 for an empty input) (A10)."""
    agg = _summary(source).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("total_records"),
        F.coalesce(F.sum(F.when(F.col(CLASS_COL) != CLEAN, F.col("rows"))), F.lit(0))
        .cast("bigint").alias("anomalous_records"),
    )
    return agg.withColumn(
        "anomaly_rate",
        F.coalesce(F.try_divide(F.col("anomalous_records").cast("double"),
                                F.col("total_records").cast("double")), F.lit(0.0)),
    )


def rate_alert(totals: DataFrame, threshold: float = ANOMALY_RATE_THRESHOLD) -> DataFrame:
    """Alert decision: rate above ``threshold``; a missing rate also alerts (P18)."""
    return totals.select(
        "total_records",
        "anomalous_records",
        "anomaly_rate",
        F.lit(threshold).alias("threshold"),
        F.coalesce(F.col("anomaly_rate") > F.lit(threshold), F.lit(True)).alias("alert"),
    )


def _line(no: int, text: Column) -> Column:
    return F.struct(F.lit(no).alias("line_no"), text.alias("line"))


def report_lines(source: DataFrame, run_date: str, client: str = "XYZ") -> DataFrame:
    """The Markdown report as a DataFrame of (line_no, line) (K3).

    Only aggregated rows (one per class) feed it; write it with
    ``.orderBy("line_no").select("line").coalesce(1).write.text(path)``.
    """
    source = _summary(source)
    totals = run_totals(source)
    head = totals.select(F.explode(F.array(
        _line(0, F.lit(f"# {client} Invoice Anomaly Report")),
        _line(1, F.lit(f"**Client:** {client}  ")),
        _line(2, F.lit(f"**Run date:** {run_date}  ")),
        _line(3, F.concat(F.lit("**Total records:** "), F.col("total_records").cast("string"),
                          F.lit("  "))),
        _line(4, F.concat(F.lit("**Anomalous records:** "),
                          F.col("anomalous_records").cast("string"), F.lit(" ("),
                          percent_1dp(F.col("anomaly_rate")), F.lit(")  "))),
        _line(5, F.lit(BREAKDOWN_TITLE)),
        _line(6, F.lit(BREAKDOWN_HEAD[0])),
        _line(7, F.lit(BREAKDOWN_HEAD[1])),
        *[_line(200 + i, F.lit(text)) for i, text in enumerate(DEFINITIONS)],
    )).alias("l")).select("l.line_no", "l.line")
    rows = class_report(source).select(
        # a window over the (at most four) aggregated class rows, not over data
        (F.lit(100) + F.dense_rank().over(Window.orderBy(CLASS_COL))).alias("line_no"),
        markdown_row(F.col(CLASS_COL), F.col("record_count"), F.col("unique_invoices"),
                     amount_2dp(F.col("total_amount"))).alias("line"),
    )
    return head.unionByName(rows)


@dataclass
class StructuralRun:
    rows_read: int
    classified: DataFrame
    counts: DataFrame
    exposure: DataFrame
    alert: DataFrame


def run_structural(spark: SparkSession, input_csv: str, output_path: str,
                   strategy: str = "aggregate") -> StructuralRun:
    """End-to-end job: validate, classify, write partitioned by class, summarize."""
    given = read_invoices_csv(spark, input_csv)
    require_columns(given)
    landed, seen = written_observed(given, "invoices", rows=F.count(F.lit(1)))
    require_rows(seen["rows"])
    write_partitioned(classify_structural(landed, strategy=strategy), output_path, CLASS_COL)
    classified = read_partitioned(spark, output_path)
    summary = summary_of_classified(classified)
    return StructuralRun(
        rows_read=seen["rows"],
        classified=classified,
        counts=class_counts(summary),
        exposure=amount_exposure(summary),
        alert=rate_alert(run_totals(summary)),
    )

"""Pipeline B: anomalies in the free-text description of invoices.

Parsing and classification are one narrow projection (no shuffle); reports are
map-side-combined aggregations; the anomaly sink writes in parallel per reason.
Nothing is collected to the driver except the aggregated report rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from billing_guard.functions import dates, text
from billing_guard.functions.formatting import fixed_4dp, markdown_cell, markdown_row, percent_1dp
from billing_guard.operators.skew import hot_split_join
from billing_guard.operators.sinks import replace_whole, write_partitioned

# --- fixed values: reasons ------------------------------------------------------
BOTH = "AMBOS: MES DIVERGENTE + DPD NEGATIVO"
MONTH_MISMATCH = "MES DIVERGENTE"
NEGATIVE_DPD = "DPD NEGATIVO"
CLEAN = "CLEAN"
# -------------------------------------------------------------------------------

REASON = "motivo_erro"
# --- fixed values: headings and columns of the report ---------------------------
TITLE = "# Invoice Description Anomaly Report"
NONE_FOUND, SOME_FOUND = "## No anomalies detected", "## Anomalies Detected"
SUMMARY_HEAD = ("| Motivo | Records | Unique Invoices |", "|--------|---------|----------------|")
DETAIL_TITLE = "## Anomalous Invoice Detail"
# -------------------------------------------------------------------------------
#: closing section of the report
DEFINITIONS = (
    "## Anomaly Definitions",
    "- **MES DIVERGENTE**: the month of `Competencia:` differs from the month of `Vencimento:`.",
    "- **DPD NEGATIVO**: the days past due in `DPD:` are negative.",
    "- **AMBOS**: both conditions at once.",
)
#: alert when at least this many anomalies are found
ANOMALY_COUNT_THRESHOLD = 1
DETAIL_COLUMNS = ("invoice_id", "case_id", "invoice_number", "competencia_raw",
                  "vencimento_raw", "dpd_invoice", "vencimento_corrigido", REASON, "insert_date")


def extract_description_fields(df: DataFrame, description: str = "description",
                               ignore_case: bool = False) -> DataFrame:
    """Add the parsed fields: raw competence and due text, DPD, the two month
    segments compared, and the day/month-swapped due date."""
    d = F.col(description)
    competence = text.label_line(d, text.COMPETENCE_LABEL, ignore_case)
    due = text.label_line(d, text.DUE_LABEL, ignore_case)
    return df.withColumns({
        "competencia_raw": competence,
        "vencimento_raw": due,
        "dpd_invoice": text.dpd_line(d, ignore_case),
    }).withColumns({
        "competencia_pos4": dates.month_segment(F.col("competencia_raw")),
        "vencimento_pos4": dates.month_segment(F.col("vencimento_raw")),
        "vencimento_corrigido": dates.swapped_due_date(F.col("vencimento_raw")),
    })


def reason(month_differs: Column, negative_dpd: Column) -> Column:
    """Both > month mismatch > negative DPD > clean; unknown (NULL) tests do not fire."""
    return (F.when(month_differs & negative_dpd, F.lit(BOTH))
            .when(month_differs, F.lit(MONTH_MISMATCH))
            .when(negative_dpd, F.lit(NEGATIVE_DPD))
            .otherwise(F.lit(CLEAN)))


def classify_descriptions(df: DataFrame) -> DataFrame:
    """Add ``motivo_erro`` and ``is_anomaly`` to parsed rows."""
    month_differs = F.col("competencia_pos4") != F.col("vencimento_pos4")
    negative = F.col("dpd_invoice") < 0
    # is_anomaly is stated on the two tests rather than on the reason label, so
    # a filter on it that Catalyst pushes below the projection inlines each
    # parsed field once instead of the label's repeated branches.
    return df.withColumns({
        REASON: reason(month_differs, negative),
        "is_anomaly": F.coalesce(month_differs, F.lit(False)) | F.coalesce(negative, F.lit(False)),
    })


def analyse_descriptions(df: DataFrame, ignore_case: bool = False) -> DataFrame:
    return classify_descriptions(extract_description_fields(df, ignore_case=ignore_case))


def tenant_text_invoices(invoices: DataFrame, cases: DataFrame, client_id: int,
                         labels: tuple[str, ...] = (text.COMPETENCE_LABEL, text.DUE_LABEL)
                         ) -> DataFrame:
    """The tenant's invoices whose text carries every label (semi-join + filters).

    Same selection as the JDBC push-down query, for inputs already in Spark;
    the label filters run in the scan's projection and the semi-join only
    ships case ids.
    """
    has_labels = F.lit(True)
    for label in labels:
        has_labels = has_labels & F.col("description").contains(label)
    tenant = cases.where(F.col("client_id") == client_id).select("case_id").distinct()
    return hot_split_join(invoices.where(has_labels), tenant, ["case_id"], "inner")


# --------------------------------------------------------------------------
# reports
# --------------------------------------------------------------------------
def reason_counts(classified: DataFrame) -> DataFrame:
    """Rows per reason, all rows (A13)."""
    return classified.groupBy(REASON).agg(F.count(F.lit(1)).alias("record_count")) \
        .orderBy(REASON)


def reason_report(classified: DataFrame) -> DataFrame:
    """Per anomalous reason: rows with an invoice id and distinct invoices (A12)."""
    return (classified.where(F.col("is_anomaly"))
            .groupBy(REASON)
            .agg(F.count("invoice_id").alias("record_count"),
                 F.countDistinct("invoice_id").alias("unique_invoices")))


def anomaly_metrics(classified: DataFrame,
                    count_threshold: int = ANOMALY_COUNT_THRESHOLD) -> DataFrame:
    """One metrics row: totals, rate (0 when empty), formatted rate, alert (K5, P19)."""
    return metrics_of_counts(classified.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("is_anomaly")).alias("anomaly_count"),
    ), count_threshold)


def metrics_of_counts(agg: DataFrame, count_threshold: int = ANOMALY_COUNT_THRESHOLD) -> DataFrame:
    """:func:`anomaly_metrics` of counts that are known, ``total_records`` and ``anomaly_count``."""
    rate = F.coalesce(F.try_divide(F.col("anomaly_count").cast("double"),
                                   F.col("total_records").cast("double")), F.lit(0.0))
    return agg.select(
        "total_records",
        "anomaly_count",
        rate.alias("anomaly_rate"),
        fixed_4dp(rate).alias("anomaly_rate_text"),
        (F.coalesce(F.col("anomaly_count"), F.lit(0)) >= count_threshold).alias("alert"),
    )


def anomaly_detail(classified: DataFrame) -> DataFrame:
    """Anomalous rows, report columns that exist, by reason then newest first (O4, P16)."""
    present = [c for c in DETAIL_COLUMNS if c in classified.columns]
    # The rebalance boundary makes the sort's range-sampling pass read the
    # shuffled anomaly rows instead of parsing every description a second time.
    return (classified.where(F.col("is_anomaly")).select(*present)
            .hint("rebalance").orderBy(*_detail_order(present)))


def write_anomalies(classified: DataFrame, path: str, observation: Observation | None = None) -> None:
    """Only anomalous rows, one directory per reason (K2); ``observation`` gets their number
    as ``rows`` from the writing job."""
    write_partitioned(classified.where(F.col("is_anomaly")), path, REASON, observation=observation,
                      observed=(F.count(F.lit(1)).alias("rows"),))


def report_lines(classified: DataFrame, run_date: str, client_id: int) -> DataFrame:
    """Header, per-reason table and definitions as (line_no, line) rows.

    The whole report, with a row for every anomaly, is :func:`report_document`.
    """
    m = anomaly_metrics(classified)

    def line(no: int, value: Column) -> Column:
        return F.struct(F.lit(no).alias("line_no"), value.alias("line"))

    head = m.select(F.explode(F.array(
        line(0, F.lit(TITLE)),
        line(1, F.lit(f"**Client:** {client_id}  ")),
        line(2, F.lit(f"**Run date:** {run_date}  ")),
        line(3, F.concat(F.lit("**Total invoices analysed:** "),
                         F.col("total_records").cast("string"), F.lit("  "))),
        line(4, F.concat(F.lit("**Anomalous records:** "), F.col("anomaly_count").cast("string"),
                         F.lit(" ("), percent_1dp(F.col("anomaly_rate")), F.lit(")  "))),
        line(5, F.when(F.col("anomaly_count") == 0, F.lit(NONE_FOUND))
             .otherwise(F.lit(SOME_FOUND))),
        # the table only exists when it has rows
        line(6, F.when(F.col("anomaly_count") > 0, F.lit(SUMMARY_HEAD[0]))),
        line(7, F.when(F.col("anomaly_count") > 0, F.lit(SUMMARY_HEAD[1]))),
        *[line(200 + i, F.lit(text_)) for i, text_ in enumerate(DEFINITIONS)],
    )).alias("l")).select("l.line_no", "l.line").where(F.col("line").isNotNull())
    rows = reason_report(classified).select(
        (F.lit(100) + F.dense_rank().over(Window.orderBy(REASON))).alias("line_no"),
        markdown_row(F.col(REASON), F.col("record_count"), F.col("unique_invoices")).alias("line"),
    )
    return head.unionByName(rows)


#: place of the detail section between the summary (100 on) and the definitions (200 on)
_DETAIL_LINE = 150


def _detail_order(present: list[str]) -> list[Column]:
    """By reason, then newest first; the ids let the range partitioner split rows that share
    a reason and date (one import batch can hold a large share of anomalies)."""
    order = [F.col(REASON).asc_nulls_first()]
    if "insert_date" in present:
        order.append(F.col("insert_date").desc_nulls_last())
    return order + [F.col(c).asc_nulls_first() for c in ("invoice_id", "case_id") if c in present]


def report_document(classified: DataFrame, run_date: str, client_id: int) -> DataFrame:
    """The whole report as (line_no, line) rows in order, the anomalous rows included (K4).

    The detail's lines share one number and follow each other by reason, then newest first.
    One distributed sort orders the document; written with :func:`write_document` it is a
    folder of text parts that read in order, and no row is gathered anywhere.
    """
    present = [c for c in DETAIL_COLUMNS if c in classified.columns]
    keys = [c for c in (REASON, "insert_date", "invoice_id", "case_id") if c in present]
    detail = (classified.where(F.col("is_anomaly")).hint("rebalance").select(
        F.lit(_DETAIL_LINE + 3).alias("line_no"),
        markdown_row(*[markdown_cell(F.col(c)) for c in present]).alias("line"), *keys))
    head = (f"| {' | '.join(present)} |", "|" + "---|" * len(present))
    titles = anomaly_metrics(classified).where(F.col("anomaly_count") > 0).select(F.explode(F.array(*[
        F.struct(F.lit(_DETAIL_LINE + i).alias("line_no"), F.lit(text_).alias("line"))
        for i, text_ in enumerate((DETAIL_TITLE, *head))])).alias("l")).select("l.line_no", "l.line")
    others = report_lines(classified, run_date, client_id).unionByName(titles)
    whole = others.unionByName(detail, allowMissingColumns=True)
    return whole.orderBy("line_no", *_detail_order(present)).select("line_no", "line")


def write_document(document: DataFrame, path: str) -> None:
    """Write the ordered lines of :func:`report_document` as text parts."""
    replace_whole(document.sparkSession, path, lambda target: document.select("line").write.text(target))

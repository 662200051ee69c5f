"""Command-line jobs (for ``spark-submit`` or ``python -m billing_guard``).

    structural    --input invoices.csv --output DIR [--report-dir DIR] [--run-date D]
    descriptions  (--parquet PATH | --jdbc-url URL --db-user U --db-password P)
                  --output DIR [--report-dir DIR] [--client-id N] [--run-date D]
    settlement    --tables-dir DIR --client-id N --as-of D --output DIR

Every job reads with explicit schemas, writes its results beside the old ones and puts
them in place when they are whole, and prints its metrics as ``KEY=value`` lines.  Counts
are observed by the jobs that write; only such one-row metrics reach the driver.
"""

from __future__ import annotations

import argparse
import sys
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from billing_guard.operators.band_join import overlapping_bands
from billing_guard.operators.sinks import read_partitioned, replace_whole, write_partitioned
from billing_guard.operators.structural import CLEAN, classify_structural
from billing_guard.plans import descriptions as desc
from billing_guard.plans import settlement as settle
from billing_guard.plans import structural as struct
from billing_guard.session import build_session, delete_work, work_count, written, written_observed
from billing_guard.sources import schemas
from billing_guard.sources.files import MALFORMED, RECORD, read_invoices_csv
from billing_guard.sources.jdbc import read_invoice_text_jdbc
from billing_guard.sources.testdata import SettlementInputs

#: name and schema of the settlement's input tables
SETTLEMENT_TABLES = {
    "cases": schemas.CASES, "invoice": schemas.SETTLEMENT_INVOICE, "case_attribute": schemas.CASE_ATTRIBUTE,
    "debtor": schemas.DEBTOR, "persons": schemas.PERSONS, "ptp": schemas.PTP,
    "commission_bands": schemas.COMMISSION_BANDS, "payments": schemas.PAYMENTS}


def _write_lines(lines: DataFrame, path: str) -> None:
    # a report is a handful of aggregated lines: one file is the readable form
    ordered = lines.orderBy("line_no").select("line").coalesce(1)
    replace_whole(lines.sparkSession, path, ordered.write.text)
    print(f"REPORT_PATH={path}")


def run_structural_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """One pass over the input: it is landed, classified and written once; every count comes
    from the job that writes, every report from the written classes."""
    given = read_invoices_csv(spark, args.input, mark_malformed=True)
    schemas.require_columns(given)
    landed, seen = written_observed(
        given, "invoices", rows=F.count_if(F.size(MALFORMED) == 0),
        malformed=F.count_if(F.size(MALFORMED) > 0), broken=F.count_if(F.array_contains(MALFORMED, RECORD)))
    print(f"Total records loaded: {schemas.require_rows(seen['rows'])}")
    print(f"MALFORMED_ROWS={seen['malformed']}")
    print(f"BROKEN_RECORDS={seen['broken']}")
    if seen["malformed"]:
        bad = landed.where(F.size(MALFORMED) > 0)
        replace_whole(spark, f"{args.output.rstrip('/')}_malformed", bad.write.parquet)
    df = landed.where(F.size(MALFORMED) == 0).drop(MALFORMED, RECORD)
    found = Observation("classes")
    write_partitioned(
        classify_structural(df, strategy=args.strategy), args.output, struct.CLASS_COL, observation=found,
        observed=(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(struct.CLASS_COL) != CLEAN).alias("anomalies")))
    summary = written(struct.summary_of_classified(read_partitioned(spark, args.output)), "class_summary")
    struct.class_counts(summary).show()
    struct.amount_exposure(summary).show()
    if args.report_dir:
        _write_lines(struct.report_lines(summary, args.run_date), f"{args.report_dir}/report_{args.run_date}")
    alert = struct.rate_alert(struct.run_totals(summary)).first()
    print(f"ANOMALY_COUNT={found.get['anomalies']}")
    print(f"ANOMALY_RATE={alert['anomaly_rate']:.4f}")
    print(f"ALERT={str(alert['alert']).lower()}")


def run_descriptions_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """One read of the source: the classified rows are landed once, without the text, and
    counted as they are written."""
    if args.parquet:
        texts = spark.read.schema(schemas.INVOICE_TEXT).parquet(args.parquet)
    else:
        texts = read_invoice_text_jdbc(
            spark, url=args.jdbc_url, user=args.db_user, password=args.db_password,
            client_id=args.client_id, lower_bound=args.lower_bound, upper_bound=args.upper_bound,
            num_partitions=args.num_partitions)
    classified, seen = written_observed(
        desc.analyse_descriptions(texts), "classified_texts",
        total_records=F.count(F.lit(1)), anomaly_count=F.count_if(F.col("is_anomaly")))
    desc.reason_counts(classified).show()
    desc.write_anomalies(classified, args.output)
    if args.report_dir:
        path = f"{args.report_dir}/description_anomalies_{args.run_date}"
        desc.write_document(desc.report_document(classified, args.run_date, args.client_id), path)
        print(f"REPORT_PATH={path}")
    m = desc.metrics_of_counts(spark.createDataFrame(
        [(seen["total_records"], seen["anomaly_count"])], "total_records long, anomaly_count long")).first()
    print(f"ANOMALY_COUNT={m['anomaly_count']}")
    print(f"ANOMALY_RATE={m['anomaly_rate_text']}")
    print(f"ALERT={str(m['alert']).lower()}")


def run_settlement_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """Read with explicit schemas, check the data for what would multiply rows, settle."""
    tables = {name: spark.read.schema(schema).parquet(f"{args.tables_dir}/{name}")
              for name, schema in SETTLEMENT_TABLES.items()}
    inputs = SettlementInputs(
        cases=tables["cases"], invoices=tables["invoice"],
        case_attributes=tables["case_attribute"], debtors=tables["debtor"],
        persons=tables["persons"], ptp=tables["ptp"], bands=tables["commission_bands"],
        payments=tables["payments"])
    as_of = date.fromisoformat(args.as_of)
    steps = settle.settlement_steps(inputs, args.client_id, as_of)
    fan_out = settle.duplicate_attributes(inputs.case_attributes)
    overlaps = overlapping_bands(steps.bands.withColumn("client_id", F.lit(args.client_id)),
                                 "dpd_on_payment_day_from", "dpd_on_payment_day_to", ["client_id"])
    print(f"CASES_WITH_SEVERAL_LIVE_DPD={fan_out.count()}")
    overlapping = overlaps.count()
    print(f"OVERLAPPING_BANDS={overlapping}")
    if overlapping and not args.allow_overlaps:
        raise ValueError("overlapping commission bands would pay a commission twice; see --allow-overlaps")
    steps.dedup = written(steps.dedup, "settlement_rows")
    wide = settle.wide_invoices(steps.dedup).first()
    if wide is not None:
        raise ValueError(f"invoice {wide['invoice_id']} has {wide['titles']} titles: too many for one list")
    totals = Observation("settlement")
    report = settle.ordered(steps.report).observe(
        totals, F.count(F.lit(1)).alias("n"), F.sum("valor_comissao").alias("commission"))
    replace_whole(spark, args.output, report.write.parquet)
    print(f"SETTLEMENT_ROWS={totals.get['n']}")
    print(f"COMMISSION_TOTAL={totals.get['commission']}")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="billing_guard")
    sub = parser.add_subparsers(dest="job", required=True)
    today = date.today().isoformat()

    s = sub.add_parser("structural")
    s.add_argument("--input", required=True, help="headed CSV of invoice imports")
    s.add_argument("--output", required=True, help="Parquet folder, one directory per class")
    s.add_argument("--report-dir", help="folder for the Markdown report")
    s.add_argument("--run-date", default=today)
    s.add_argument("--strategy", default="aggregate", choices=["aggregate", "window"])

    d = sub.add_parser("descriptions")
    d.add_argument("--parquet", help="Parquet invoice texts (instead of JDBC)")
    d.add_argument("--jdbc-url")
    d.add_argument("--db-user")
    d.add_argument("--db-password")
    d.add_argument("--lower-bound", type=int)
    d.add_argument("--upper-bound", type=int)
    d.add_argument("--num-partitions", type=int,
                   help="parallel JDBC reads over invoice_id (the session's parallelism by default; "
                        "bounds that are not given are asked of the database); 1 for a single connection")
    d.add_argument("--client-id", type=int, default=1)
    d.add_argument("--output", required=True, help="Parquet folder of anomalies, one per reason")
    d.add_argument("--report-dir")
    d.add_argument("--run-date", default=today)

    c = sub.add_parser("settlement")
    c.add_argument("--tables-dir", required=True,
                   help="folder with one Parquet table per settlement input")
    c.add_argument("--client-id", type=int, required=True)
    c.add_argument("--as-of", required=True, help="settlement date, YYYY-MM-DD")
    c.add_argument("--output", required=True)
    c.add_argument("--allow-overlaps", action="store_true",
                   help="settle although commission bands overlap (a value then gets several rates)")

    args = parser.parse_args(argv)
    if args.job == "descriptions" and not (args.parquet or args.jdbc_url):
        parser.error("descriptions needs --parquet or --jdbc-url")
    spark = build_session(app_name=f"billing_guard_{args.job}")
    made = work_count()
    try:
        {"structural": run_structural_job, "descriptions": run_descriptions_job,
         "settlement": run_settlement_job}[args.job](spark, args)
    finally:
        delete_work(spark, made)
    return 0


if __name__ == "__main__":
    sys.exit(main())

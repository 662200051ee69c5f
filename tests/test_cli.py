"""The three command-line jobs end to end on the smallest tables."""

import os

import pytest

from billing_guard.cli import SETTLEMENT_TABLES, main
from billing_guard.session import work_path
from billing_guard.sources import testdata as td
from billing_guard.sources.files import write_csv

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_structural_job(spark, capsys):
    csv, out, rep = (work_path(spark, n) for n in ("cli_csv", "cli_out", "cli_rep"))
    write_csv(td.structural_invoices(spark, SF), csv)
    assert main(["structural", "--input", csv, "--output", out, "--report-dir", rep,
                 "--run-date", "2024-01-31"]) == 0
    printed = capsys.readouterr().out
    assert "ANOMALY_COUNT=" in printed and "ALERT=" in printed
    assert f"REPORT_PATH={rep}/report_2024-01-31" in printed and "MALFORMED_ROWS=0" in printed
    classes = {r["anomaly_type"] for r in spark.read.parquet(out).select("anomaly_type").collect()}
    assert "CLEAN" in classes
    lines = spark.read.text(f"{rep}/report_2024-01-31").collect()
    assert lines[0]["value"].startswith("# ")


def test_descriptions_job(spark, capsys):
    src, out = work_path(spark, "cli_texts"), work_path(spark, "cli_anoms")
    td.description_invoices(spark, SF).write.parquet(src)
    assert main(["descriptions", "--parquet", src, "--output", out, "--client-id", "516"]) == 0
    printed = capsys.readouterr().out
    count = int(printed.split("ANOMALY_COUNT=")[1].split()[0])
    assert spark.read.parquet(out).count() == count


def test_malformed_rows_are_kept_apart(spark, capsys):
    csv, out = work_path(spark, "cli_bad"), work_path(spark, "cli_bad_out")
    good = td.structural_invoices(spark, SF).limit(20)
    write_csv(good.withColumn("amount", good["amount"].cast("string")).unionByName(
        good.limit(2).selectExpr("* EXCEPT (amount)", "'12,x' AS amount")), csv)
    main(["structural", "--input", csv, "--output", out])
    assert "MALFORMED_ROWS=2" in capsys.readouterr().out
    assert spark.read.parquet(out).count() == 20 and spark.read.parquet(out + "_malformed").count() == 2


def test_report_without_anomalies_has_no_table(spark, capsys):
    src, out, rep = (work_path(spark, n) for n in ("cli_clean", "cli_clean_out", "cli_clean_rep"))
    td.description_invoices(spark, SF).limit(5).selectExpr(
        "* EXCEPT (description)", "'Competencia: 01.01.2024\nVencimento: 05.01.2024\nDPD: 3' AS description") \
        .write.parquet(src)
    main(["descriptions", "--parquet", src, "--output", out, "--report-dir", rep, "--run-date", "2024-01-31"])
    path = f"{rep}/description_anomalies_2024-01-31"
    assert f"REPORT_PATH={path}" in capsys.readouterr().out
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert "## No anomalies detected" in lines and not [x for x in lines if x.startswith("|")]


def test_settlement_job(spark, capsys):
    root, out = work_path(spark, "cli_tables"), work_path(spark, "cli_settle")
    inputs = td.settlement_inputs(spark, SF)
    frames = [inputs.cases, inputs.invoices, inputs.case_attributes, inputs.debtors,
              inputs.persons, inputs.ptp, inputs.bands, inputs.payments]
    for name, df in zip(SETTLEMENT_TABLES, frames):
        df.write.parquet(f"{root}/{name}")
    assert main(["settlement", "--tables-dir", root, "--client-id", "516",
                 "--as-of", "2024-01-31", "--output", out]) == 0
    printed = capsys.readouterr().out
    rows = int(printed.split("SETTLEMENT_ROWS=")[1].split()[0])
    assert rows == spark.read.parquet(out).count() > 0


def test_run_structural_library_job(spark):
    from billing_guard.plans.structural import run_structural
    csv, out = work_path(spark, "lib_csv"), work_path(spark, "lib_out")
    write_csv(td.structural_invoices(spark, SF), csv)
    run = run_structural(spark, csv, out)
    assert run.rows_read == run.classified.count() > 0
    counts = {r["anomaly_type"]: r["record_count"] for r in run.counts.collect()}
    assert sum(counts.values()) == run.rows_read
    assert run.alert.first()["total_records"] == run.rows_read

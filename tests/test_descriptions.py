"""Pipeline B: description parsing, classification, reports and sink."""

import datetime as dt

import pytest

from billing_guard.operators.sinks import read_partitioned
from billing_guard.plans import descriptions as B
from billing_guard.session import work_path

SCHEMA = ("invoice_id long, case_id long, invoice_number string, description string, "
          "insert_date timestamp_ntz, insert_user string")


def frame(spark, texts):
    ts = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(i, 1, f"N{i}", t, ts + dt.timedelta(days=i), "u") for i, t in enumerate(texts)], SCHEMA)


def parsed(spark, texts):
    return B.analyse_descriptions(frame(spark, texts)).orderBy("invoice_id").collect()


def test_fields_and_classes(spark):
    rows = parsed(spark, [
        "Competencia: 15.01.2024\nVencimento: 15.01.2024\nDPD: 5",     # clean
        "Competencia: 15.01.2024\nVencimento: 15.02.2024\nDPD: 5",     # month differs
        "Competencia: 15.01.2024\nVencimento: 15.01.2024\nDPD: -15",   # negative dpd
        "Competencia: 15.01.2024\nVencimento: 15.03.2024\nDPD: -1",    # both
    ])
    assert [r["motivo_erro"] for r in rows] == [
        "CLEAN", "MES DIVERGENTE", "DPD NEGATIVO", "AMBOS: MES DIVERGENTE + DPD NEGATIVO"]
    assert [r["is_anomaly"] for r in rows] == [False, True, True, True]
    assert rows[2]["dpd_invoice"] == -15
    assert rows[0]["vencimento_corrigido"] == dt.date(2024, 1, 15)


def test_empty_label_captures_next_line(spark):
    # the line regex lets \s* cross the newline (documented behaviour)
    row = parsed(spark, ["Competencia:\nVencimento: 15.01.2024"])[0]
    assert row["competencia_raw"] == "Vencimento: 15.01.2024"


def test_month_year_competence_compares_positions_four_and_five(spark):
    row = parsed(spark, ["Competencia: 01.2024\nVencimento: 15.01.2024"])[0]
    assert (row["competencia_pos4"], row["vencimento_pos4"]) == ("20", "01")
    assert row["motivo_erro"] == "MES DIVERGENTE"


@pytest.mark.parametrize("due, expected", [
    ("15.01.2024", dt.date(2024, 1, 15)),   # swap then month.day parse cancel out
    ("05.01.2024", dt.date(2024, 1, 5)),
    ("13.13.2024", None),
    ("xx", None),
])
def test_swapped_due_date(spark, due, expected):
    row = parsed(spark, [f"Competencia: 15.01.2024\nVencimento: {due}"])[0]
    assert row["vencimento_corrigido"] == expected


@pytest.mark.parametrize("line, expected", [
    ("", None), ("DPD:", None), ("DPD: -", None), ("DPD: 12-3", 12),
    ("DPD: -15", -15), ("DPD: 99999999999", None),
])
def test_dpd_forms_never_fail_the_job(spark, line, expected):
    row = parsed(spark, [f"Competencia: 15.01.2024\nVencimento: 15.01.2024\n{line}"])[0]
    assert row["dpd_invoice"] == expected


def test_unknown_tests_do_not_fire(spark):
    row = parsed(spark, ["Competencia: 15.01.2024\nVencimento: 1"])[0]  # no DPD, short due
    assert row["vencimento_pos4"] == ""
    assert row["motivo_erro"] == "MES DIVERGENTE"
    row = parsed(spark, [None])[0]
    assert (row["motivo_erro"], row["is_anomaly"]) == ("CLEAN", False)


def test_case_sensitive_labels_unless_asked(spark):
    df = frame(spark, ["competencia: 15.01.2024\nvencimento: 15.02.2024"])
    strict = B.analyse_descriptions(df).first()
    loose = B.analyse_descriptions(df, ignore_case=True).first()
    assert strict["competencia_raw"] == ""
    assert loose["competencia_raw"] == "15.01.2024"


def test_metrics_and_report(spark):
    cl = B.analyse_descriptions(frame(spark, [
        "Competencia: 15.01.2024\nVencimento: 15.01.2024\nDPD: 5",
        "Competencia: 15.01.2024\nVencimento: 15.02.2024\nDPD: 5",
    ]))
    m = B.anomaly_metrics(cl).first()
    assert (m["total_records"], m["anomaly_count"], m["anomaly_rate_text"], m["alert"]) == \
        (2, 1, "0.5000", True)
    report = {r["motivo_erro"]: r["unique_invoices"] for r in B.reason_report(cl).collect()}
    assert report == {"MES DIVERGENTE": 1}
    detail = B.anomaly_detail(cl).collect()
    assert [r["invoice_id"] for r in detail] == [1]
    lines = [r["line"] for r in B.report_lines(cl, "2024-01-31", 1).orderBy("line_no").collect()]
    assert lines[5] == "## Anomalies Detected"
    assert "| MES DIVERGENTE | 1 | 1 |" in lines
    assert lines[-4] == "## Anomaly Definitions"


def test_empty_input(spark):
    cl = B.analyse_descriptions(spark.createDataFrame([], SCHEMA))
    m = B.anomaly_metrics(cl).first()
    assert (m["total_records"], m["anomaly_count"], m["anomaly_rate"], m["alert"]) == (0, 0, 0.0, False)


def test_detail_sorted_by_reason_then_newest(spark):
    cl = B.analyse_descriptions(frame(spark, [
        "Competencia: 15.01.2024\nVencimento: 15.02.2024",
        "Competencia: 15.01.2024\nVencimento: 15.01.2024\nDPD: -1",
        "Competencia: 15.01.2024\nVencimento: 15.02.2024",
    ]))
    got = [(r["motivo_erro"], r["invoice_id"]) for r in B.anomaly_detail(cl).collect()]
    assert got == [("DPD NEGATIVO", 1), ("MES DIVERGENTE", 2), ("MES DIVERGENTE", 0)]


def test_anomaly_sink_round_trip_with_escaped_directory_names(spark):
    cl = B.analyse_descriptions(frame(spark, [
        "Competencia: 15.01.2024\nVencimento: 15.03.2024\nDPD: -1",
        "Competencia: 15.01.2024\nVencimento: 15.01.2024\nDPD: 1",
    ]))
    path = work_path(spark, "test_anomalies")
    B.write_anomalies(cl, path)
    back = read_partitioned(spark, path)
    assert [r["motivo_erro"] for r in back.collect()] == ["AMBOS: MES DIVERGENTE + DPD NEGATIVO"]


def test_tenant_selection_matches_push_down(spark):
    inv = frame(spark, ["Competencia: 1\nVencimento: 2", "Competencia: 1", "x"])
    cases = spark.createDataFrame([(1, 516), (2, 1)], "case_id long, client_id int")
    got = [r["invoice_id"] for r in B.tenant_text_invoices(inv, cases, 516).collect()]
    assert got == [0]
    assert B.tenant_text_invoices(inv, cases, 1).count() == 0

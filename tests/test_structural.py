"""Pipeline A: structural flags, classification, reports."""

import random
from decimal import Decimal

import pytest

from billing_guard.operators import structural as ops
from billing_guard.plans import structural as plan
from billing_guard.sources.schemas import INVOICE, validate_input

COLUMNS = ["invoice_id", "case_id", "client_id", "amount", "import_date", "status",
           "source_system", "batch_id"]
SCHEMA = ("invoice_id string, case_id string, client_id int, amount decimal(19,2), "
          "import_date string, status string, source_system string, batch_id string")


def make_df(spark, rows):
    rows = [(r[0], r[1], r[2], None if r[3] is None else Decimal(str(r[3])), *r[4:]) for r in rows]
    return spark.createDataFrame(rows, SCHEMA)


def flags(df, col):
    return {r["invoice_id"]: r[col] for r in df.collect()}


# --- flags and classes of one mixed table, group by group --------------------------------
#: (invoice, case, amount), then the flags (duplicate, amount, case) and the class
LEDGER = [
    (("A7", "north", "12.00"), (True, False, False), "EXACT_DUPLICATE"),
    (("A7", "north", "12.00"), (True, False, False), "EXACT_DUPLICATE"),
    (("A7", "north", None), (False, False, False), "CLEAN"),
    (("B2", "north", "3.10"), (False, True, False), "AMOUNT_MISMATCH"),
    (("B2", "north", "3.11"), (True, True, False), "AMOUNT_MISMATCH"),
    (("B2", "north", "3.11"), (True, True, False), "AMOUNT_MISMATCH"),
    (("C5", "east", "8.00"), (True, False, True), "CASE_MISMATCH"),
    (("C5", "east", "8.00"), (True, False, True), "CASE_MISMATCH"),
    (("C5", "west", "8.00"), (False, False, True), "CASE_MISMATCH"),
    (("D9", "south", "0.00"), (False, False, False), "CLEAN"),
    (("D9", None, "1.00"), (False, None, False), "CLEAN"),
    ((None, "south", "5.00"), (True, None, None), "EXACT_DUPLICATE"),
    ((None, "south", "5.00"), (True, None, None), "EXACT_DUPLICATE"),
    ((None, "west", "6.00"), (False, None, None), "CLEAN"),
]


def ledger(spark):
    return make_df(spark, [(i, c, 3, a, "d", "s", "x", f"row{n}") for n, ((i, c, a), _, _) in enumerate(LEDGER)])


@pytest.mark.parametrize("strategy", ["aggregate", "window"])
@pytest.mark.parametrize("place, flag, detect", [
    (0, "exact_duplicate_flag", ops.detect_exact_duplicates),
    (1, "amount_mismatch_flag", ops.detect_amount_mismatch),
    (2, "case_mismatch_flag", ops.detect_case_mismatch)])
def test_flags_of_the_ledger(spark, strategy, place, flag, detect):
    got = {r["batch_id"]: r[flag] for r in detect(ledger(spark), strategy=strategy).collect()}
    assert got == {f"row{n}": marks[place] for n, (_, marks, _) in enumerate(LEDGER)}


@pytest.mark.parametrize("strategy", ["flags", "aggregate", "window"])
def test_classes_of_the_ledger(spark, strategy):
    got = {r["batch_id"]: r["anomaly_type"] for r in _classify(ledger(spark), strategy).collect()}
    assert got == {f"row{n}": label for n, (_, _, label) in enumerate(LEDGER)}


def _classify(df, strategy):
    if strategy == "flags":
        out = ops.detect_case_mismatch(ops.detect_amount_mismatch(ops.detect_exact_duplicates(df)))
        return ops.classify_anomaly(out)
    return ops.classify_structural(df, strategy=strategy)


# --- NULL traps (T1, T2) ------------------------------------------------------
def test_null_keys_follow_aggregate_and_join_semantics(spark):
    df = make_df(spark, [
        (None, "CASE-1", 1, 100.0, "d", "s", "ANT", "b"),   # NULL invoice, twice -> exact dup
        (None, "CASE-1", 1, 100.0, "d", "s", "ANT", "b"),
        (None, "CASE-2", 1, 100.0, "d", "s", "ANT", "b"),   # NULL invoice never case mismatch
        ("INV-9", None, 1, 100.0, "d", "s", "ANT", "b"),    # NULL case: amount flag NULL
        ("INV-9", None, 1, 200.0, "d", "s", "ANT", "b"),
        ("INV-7", "CASE-7", 1, 500.0, "d", "s", "ANT", "b"),  # {500, NULL} is no mismatch
        ("INV-7", "CASE-7", 1, None, "d", "s", "ANT", "b"),
    ])
    amount = ops.detect_amount_mismatch(df).collect()
    assert all(r["amount_mismatch_flag"] is None for r in amount if r["case_id"] is None)
    assert all(r["amount_mismatch_flag"] is False for r in amount if r["invoice_id"] == "INV-7")
    case = ops.detect_case_mismatch(df).collect()
    assert all(r["case_mismatch_flag"] is None for r in case if r["invoice_id"] is None)
    for strategy in ("flags", "aggregate", "window"):
        got = sorted((r["invoice_id"] or "", r["case_id"] or "", str(r["amount"]), r["anomaly_type"])
                     for r in _classify(df, strategy).collect())
        assert got == [
            ("", "CASE-1", "100.00", "EXACT_DUPLICATE"),
            ("", "CASE-1", "100.00", "EXACT_DUPLICATE"),
            ("", "CASE-2", "100.00", "CLEAN"),
            ("INV-7", "CASE-7", "500.00", "CLEAN"),
            ("INV-7", "CASE-7", "None", "CLEAN"),
            ("INV-9", "", "100.00", "CLEAN"),
            ("INV-9", "", "200.00", "CLEAN"),
        ], strategy


def test_exact_duplicate_ignores_date_batch_and_source(spark):
    df = make_df(spark, [
        ("INV-1", "CASE-1", 1, 10.0, "2024-01-01", "IMPORTED", "ANT", "B1"),
        ("INV-1", "CASE-1", 1, 10.0, "2024-02-01", "PENDING", "PARTNER", "B2"),
    ])
    assert {r["anomaly_type"] for r in _classify(df, "aggregate").collect()} == {"EXACT_DUPLICATE"}


def test_strategies_agree_on_random_rows(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(400):
        inv = rnd.choice([None] + [f"INV-{i}" for i in range(40)])
        case = rnd.choice([None, "C1", "C2", "C3"]) if rnd.random() < 0.3 else "C1"
        amount = rnd.choice([None, 100.0, 200.0]) if rnd.random() < 0.3 else 100.0
        rows.append((inv, case, 1, amount, "d", "s", "ANT", "b"))
    df = make_df(spark, rows)

    def result(strategy):
        return sorted((r["invoice_id"] or "", r["case_id"] or "", str(r["amount"]), r["anomaly_type"])
                      for r in _classify(df, strategy).collect())

    reference = result("flags")
    assert result("aggregate") == reference
    assert result("window") == reference


def test_hot_keys_keep_every_row(spark):
    rows = [("INV-HOT", "C1", 1, 100.0, "d", "s", "ANT", "b")] * 300 + [
        ("INV-HOT", "C1", 1, 150.0, "d", "s", "ANT", "b"),
        ("INV-2", "C2", 1, 10.0, "d", "s", "ANT", "b"),
    ]
    df = make_df(spark, rows)
    out = ops.classify_structural(df)
    counts = {r["anomaly_type"]: r["count"] for r in out.groupBy("anomaly_type").count().collect()}
    assert counts == {"AMOUNT_MISMATCH": 301, "CLEAN": 1}


# --- reports -----------------------------------------------------------------
def test_reports_are_weighted_sums_over_keys(spark):
    df = make_df(spark, [
        ("INV-1", "C1", 1, 10.0, "d", "s", "ANT", "b"),
        ("INV-1", "C1", 1, 10.0, "d", "s", "ANT", "b"),
        ("INV-2", "C1", 1, 5.0, "d", "s", "ANT", "b"),
        ("INV-3", "C1", 1, 1.0, "d", "s", "ANT", "b"),
        ("INV-3", "C2", 1, 2.0, "d", "s", "ANT", "b"),
    ])
    keys = ops.key_classes(df)
    counts = {r["anomaly_type"]: r["record_count"] for r in plan.class_counts(keys).collect()}
    assert counts == {"EXACT_DUPLICATE": 2, "CLEAN": 1, "CASE_MISMATCH": 2}
    exposure = {r["anomaly_type"]: (r["total_amount"], r["avg_amount"])
                for r in plan.amount_exposure(keys).collect()}
    assert exposure["EXACT_DUPLICATE"] == (Decimal("20.00"), Decimal("10.00"))
    assert exposure["CASE_MISMATCH"] == (Decimal("3.00"), Decimal("1.50"))
    report = {r["anomaly_type"]: (r["record_count"], r["unique_invoices"])
              for r in plan.class_report(keys).collect()}
    assert report["EXACT_DUPLICATE"] == (2, 1)
    alert = plan.rate_alert(plan.run_totals(keys)).first()
    assert (alert["total_records"], alert["anomalous_records"]) == (5, 4)
    assert alert["alert"] is True


def test_average_rounds_half_away_from_zero_exactly(spark):
    df = make_df(spark, [("I1", "C", 1, 0.01, "d", "s", "A", "b"),
                         ("I2", "C", 1, 0.00, "d", "s", "A", "b")])
    # 0.005 rounds to 0.01 (a binary double would round it down)
    row = plan.amount_exposure(ops.key_classes(df)).first()
    assert row["avg_amount"] == Decimal("0.01")


def test_empty_input_has_zero_rate_and_alerts_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    totals = plan.rate_alert(plan.run_totals(ops.key_classes(df))).first()
    assert (totals["total_records"], totals["anomaly_rate"], totals["alert"]) == (0, 0.0, False)
    assert ops.classify_structural(df).count() == 0


def test_validate_input_reports_missing_columns(spark):
    df = make_df(spark, [("I", "C", 1, 1.0, "d", "s", "A", "b")]).drop("batch_id")
    row = validate_input(df).first()
    assert (row["row_count"], row["missing_columns"], row["is_valid"]) == (1, "batch_id", False)
    assert set(INVOICE.fieldNames()) >= set(COLUMNS)


def test_report_lines_are_markdown(spark):
    df = make_df(spark, [("I1", "C", 1, 1234.5, "d", "s", "A", "b")])
    lines = [r["line"] for r in plan.report_lines(ops.key_classes(df), "2024-01-31")
             .orderBy("line_no").collect()]
    assert lines[4] == "**Anomalous records:** 0 (0.0%)  "
    assert "| CLEAN | 1 | 1 | 1,234.50 |" in lines
    assert lines[-5] == "## Anomaly Definitions"


def test_window_strategy_uses_a_single_exchange(spark):
    df = make_df(spark, [("I1", "C", 1, 1.0, "d", "s", "A", "b")])
    plan_text = ops.classify_structural(df, strategy="window")._jdf.queryExecution() \
        .executedPlan().toString()
    # one hash exchange on invoice_id serves all three window specs
    assert plan_text.count("Exchange hashpartitioning") == 1


def test_single_flags_with_hot_groups(spark):
    rows = [("INV-HOT", "C1", 1, 100.0, "d", "s", "ANT", "b")] * 120 + [
        ("INV-HOT", "C2", 1, 100.0, "d", "s", "ANT", "b"),
        ("INV-HOT", "C1", 1, 150.0, "d", "s", "ANT", "b"),
        (None, "C1", 1, 1.0, "d", "s", "ANT", "b"),
        ("INV-3", "C3", 1, 5.0, "d", "s", "ANT", "b"),
    ]
    df = make_df(spark, rows)
    for fn, col in ((ops.detect_exact_duplicates, "exact_duplicate_flag"),
                    (ops.detect_amount_mismatch, "amount_mismatch_flag"),
                    (ops.detect_case_mismatch, "case_mismatch_flag")):
        def result(**kw):
            return sorted((r["invoice_id"] or "", r["case_id"], str(r["amount"]), str(r[col]))
                          for r in fn(df, **kw).collect())
        assert result(strategy="aggregate") == result(strategy="window"), col


def test_invoice_with_many_distinct_keys(spark):
    rows = [("INV-WIDE", f"C{i % 3}", 1, float(i), "d", "s", "ANT", "b") for i in range(150)]
    rows += [("INV-WIDE", "C0", 1, 0.0, "d", "s", "ANT", "b"), ("INV-9", "C9", 1, 1.0, "d", "s", "ANT", "b")]
    df = make_df(spark, rows)
    low = ops.key_classes(df)
    default = ops.key_classes(df, strategy="window")
    as_rows = lambda k: sorted(tuple(str(v) for v in r) for r in k.collect())
    assert as_rows(low) == as_rows(default)
    assert {r["anomaly_type"] for r in low.collect() if r["invoice_id"] == "INV-WIDE"} == \
        {"CASE_MISMATCH"}

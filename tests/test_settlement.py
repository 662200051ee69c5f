"""Pipeline C: settlement steps and traps."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from billing_guard.functions import dates, money, text
from billing_guard.functions.bands import fase_label
from billing_guard.operators.band_join import overlapping_bands
from billing_guard.plans import settlement as C
from billing_guard.sources import schemas
from billing_guard.sources.testdata import SettlementInputs

AS_OF = dt.date(2024, 1, 31)


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {dtype}")


def evaluate(spark, values, expr, dtype="string"):
    return [r[0] for r in one_col(spark, values, dtype).select(expr(F.col("v"))).collect()]


# --- positional text parsing --------------------------------------------------
def test_title_code_prefers_nn_and_keeps_cr(spark):
    got = evaluate(spark, ["x\nNN: 7\r\nTitulo: 9", "Titulo:  12 \nz", "none", None, "NN:\n"],
                   text.title_code)
    assert got == ["7\r", "12", None, None, ""]
    stripped = evaluate(spark, ["NN: 7\r\n"], lambda c: text.title_code(c, strip_cr=True))
    assert stripped == ["7"]


def test_label_window_reads_up_to_line_end_within_fifty_chars(spark):
    got = evaluate(spark, [
        "Competencia: 15.01.2024\nx",
        "Competencia:\nVencimento: 15.01.2024",   # empty label stays empty here
        "Competencia: " + "9" * 60,               # at most 50 characters
        "Competencia: 01.2024 \r\n",
    ], lambda c: text.label_window(c, text.COMPETENCE_LABEL))
    assert got == ["15.01.2024", "", "9" * 49, "01.2024"]


@pytest.mark.parametrize("line, zero, null", [
    ("DPD: 12", 12, 12), ("DPD: -15", -15, -15), ("DPD:", 0, None), ("DPD: -", 0, None),
    ("DPD: 12-3", None, None), ("DPD: 99999999999", None, None),
])
def test_dpd_window_forms(spark, line, zero, null):
    assert evaluate(spark, [f"Contrato 1\n{line}"], text.dpd_window) == [zero]
    assert evaluate(spark, [f"Contrato 1\n{line}"],
                    lambda c: text.dpd_window(c, empty_as_zero=False)) == [null]


def test_missing_dpd_label_reads_from_position_four(spark):
    assert evaluate(spark, ["Contrato 1"], text.dpd_window) == [0]
    assert evaluate(spark, ["NN:-4 x"], text.dpd_window) == [-4]


def test_document_type(spark):
    got = evaluate(spark, ["123.456.789-01", "12.345.678/0001-95", None], text.document_type)
    assert got == ["CPF", "CNPJ", "CPF"]


# --- dates ----------------------------------------------------------------------
@pytest.mark.parametrize("value, expected", [
    ("1.2.2024", dt.date(2024, 2, 1)), ("31.02.2024", None), ("", None),
    ("15.01.2024 ", None), ("15.01.24", None),
])
def test_parse_day_month_year(spark, value, expected):
    assert evaluate(spark, [value], dates.parse_day_month_year) == [expected]


@pytest.mark.parametrize("due, comp, expected", [
    ("15.01.2024", "10.01.2024", dt.date(2024, 1, 15)),   # same month: kept
    ("01.15.2024", "10.01.2024", dt.date(2024, 1, 15)),   # month segments differ: swapped
    ("15.02.2024", "10.01.2024", None),                   # swap gives month 15 -> fallback
    ("xx", "05.01.2024", dt.date(2024, 5, 1)),            # competence swapped
])
def test_repaired_due_date(spark, due, comp, expected):
    df = spark.createDataFrame([(due, comp)], "d string, c string")
    got = df.select(dates.repaired_due_date(F.col("d"), F.col("c"))).first()[0]
    if due == "15.02.2024":
        # the swapped due date is invalid, so the competence date swapped is used
        assert got == dt.date(2024, 10, 1)
    else:
        assert got == expected


def test_month_range_is_half_open(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 31),), (dt.date(2024, 1, 1),),
                                (dt.date(2024, 1, 31),), (dt.date(2024, 2, 1),)], "d date")
    assert df.where(dates.in_month_of(F.col("d"), AS_OF)).count() == 2


# --- bands and money ----------------------------------------------------------
@pytest.mark.parametrize("days, label", [
    (0, ""), (1, "A - 1 A 30 | 6%"), (30, "A - 1 A 30 | 6%"), (31, "B - 31 A 60 | 11%"),
    (1440, "M - 721 A 1440 | 40%"), (1441, "N - 1441 A 1800 | 40%"),
    (1800, "N - 1441 A 1800 | 40%"), (1801, "O - 1801 A 99999 | 40%"),
    (99999, "O - 1801 A 99999 | 40%"), (100000, ""), (None, ""),
])
def test_fase_band_edges(spark, days, label):
    assert evaluate(spark, [days], fase_label, "int") == [label]


def test_proportional_share_is_exact(spark):
    df = spark.createDataFrame(
        [(Decimal("10.00"), Decimal("1.00"), Decimal("3.00")),
         (Decimal("0.01"), Decimal("1.00"), Decimal("2.00")),     # 0.005 -> 0.01
         (Decimal("-0.01"), Decimal("1.00"), Decimal("2.00"))],   # -0.005 -> -0.01
        "p decimal(19,2), part decimal(19,2), whole decimal(19,2)")
    got = [r[0] for r in df.select(
        money.proportional_share(F.col("p"), F.col("part"), F.col("whole"))).collect()]
    assert got == [Decimal("3.33"), Decimal("0.01"), Decimal("-0.01")]


def test_overlapping_band_check(spark):
    bands = spark.createDataFrame([(1, 1, 30), (1, 31, 60), (1, 50, 70), (2, 1, 100)],
                                  "client_id int, lo int, hi int")
    found = overlapping_bands(bands, "lo", "hi", ["client_id"]).collect()
    assert [(r["client_id"], r["lo"], r["earlier_max_hi"]) for r in found] == [(1, 50, 60)]


# --- steps on a hand-written fixture -------------------------------------------
def _inputs(spark, invoices, attributes=None, payments=(), bands=None):
    cases = spark.createDataFrame(
        [(1, "R1", "C1", 10, 1, 516), (2, "R2", "C2", 11, 2, 516), (3, "R3", "C3", 12, 3, 1)],
        schemas.CASES)
    attributes = attributes if attributes is not None else [(1, 560, "40"), (2, 560, "n/a")]
    if bands is None:
        bands = [(516, 1, 30, Decimal("0.06"), dt.date(2024, 1, 1), dt.date(2024, 12, 31)),
                 (516, 31, 99999, Decimal("0.40"), dt.date(2024, 1, 1), dt.date(2024, 12, 31)),
                 (516, 0, 99999, Decimal("0.99"), dt.date(2023, 1, 1), dt.date(2023, 12, 31))]
    return SettlementInputs(
        cases=cases,
        invoices=spark.createDataFrame(invoices, schemas.SETTLEMENT_INVOICE),
        case_attributes=spark.createDataFrame(attributes, schemas.CASE_ATTRIBUTE),
        debtors=spark.createDataFrame([(1, 11), (2, 12)], schemas.DEBTOR),
        persons=spark.createDataFrame([(11, "123.456.789-01"), (12, "12.345.678/0001-95")],
                                      schemas.PERSONS),
        ptp=spark.createDataFrame(
            [(516, 1, dt.date(2024, 1, 5), Decimal("10.00"), dt.date(2024, 1, 2)),
             (516, 1, dt.date(2024, 1, 3), Decimal("99.00"), dt.date(2024, 1, 9))], schemas.PTP),
        bands=spark.createDataFrame(bands, schemas.COMMISSION_BANDS),
        payments=spark.createDataFrame(list(payments), schemas.PAYMENTS),
    )


def _inv(case, inv_id, desc, original, actual, day=dt.datetime(2024, 1, 10)):
    return (case, inv_id, f"N{inv_id}", desc, day, Decimal(original), Decimal(actual))


def _pay(case, pid, day, amount):
    return (case, pid, day, Decimal(amount), day, "10:00:00", "f.csv", "u")


def test_dedup_prefers_non_negative_then_largest_dpd(spark):
    inputs = _inputs(spark, [
        _inv(1, 10, "NN: 7\nDPD: -5", "100.00", "0.00"),
        _inv(1, 11, "NN: 7\nDPD: 3", "100.00", "0.00"),
        _inv(1, 12, "NN: 7\nDPD: 9", "100.00", "0.00"),
        _inv(1, 13, "no title", "100.00", "0.00"),
        _inv(1, 14, "no title", "100.00", "0.00"),
        _inv(3, 99, "NN: 7", "1.00", "0.00"),   # other tenant
    ])
    steps = C.settlement_steps(inputs, 516, AS_OF, materialize=False)
    kept = sorted(r["invoice_id"] for r in steps.dedup.collect())
    assert kept == [12, 13, 14]
    assert {r["rn_titulo"] for r in steps.dedup.collect()} == {1}


def test_equal_dpd_ties_break_on_invoice_id(spark):
    inputs = _inputs(spark, [_inv(1, 21, "NN: 7\nDPD: 4", "1.00", "0.00"),
                             _inv(1, 20, "NN: 7\nDPD: 4", "1.00", "0.00")])
    steps = C.settlement_steps(inputs, 516, AS_OF, materialize=False)
    assert [r["invoice_id"] for r in steps.dedup.collect()] == [20]


def test_duplicate_attributes_fan_out_untitled_rows(spark):
    inputs = _inputs(spark, [_inv(1, 30, "plain", "100.00", "40.00")],
                     attributes=[(1, 560, "5"), (1, 560, "6"), (1, 561, "x")])
    steps = C.settlement_steps(inputs, 516, AS_OF, materialize=False)
    row = steps.aggregate.first()
    assert row["original_capital_total"] == Decimal("200.00")   # counted twice, as the original
    assert row["live_dpd"] == 6


def test_duplicate_attribute_check(spark):
    attrs = spark.createDataFrame([(1, 560, "5"), (1, 560, "6"), (2, 560, "1"), (2, 561, "x")],
                                  schemas.CASE_ATTRIBUTE)
    assert [(r["case_id"], r["attribute_rows"]) for r in C.duplicate_attributes(attrs).collect()] \
        == [(1, 2)]


def test_aggregate_status_dpd_and_titles(spark):
    inputs = _inputs(spark, [
        _inv(1, 40, "NN: 2\nCompetencia: 01.01.2024\nVencimento: 01.01.2024\nDPD: 3", "10.00", "0.00"),
        _inv(2, 41, "Titulo: 5\nDPD: -1", "10.00", "4.00"),
        _inv(2, 42, "Competencia: 02.01.2024", "10.00", "10.00"),
    ])
    steps = C.settlement_steps(inputs, 516, AS_OF, materialize=False)
    rows = {r["invoice_id"]: r for r in steps.aggregate.collect()}
    assert rows[40]["status_pagamento"] == "PAGO TOTAL"
    assert rows[40]["dpd_final"] == 30 and rows[40]["fase"] == "A - 1 A 30 | 6%"
    assert rows[40]["codigo_titulo"] == "2"
    assert rows[41]["status_pagamento"] == "PAGO PARCIAL"
    # no due date, no usable competence: DPD from the text
    assert rows[41]["data_vencimento"] is None and rows[41]["dpd_final"] == -1
    assert rows[42]["status_pagamento"] == "EM ABERTO"
    # competence fallback: 02.01.2024 swapped -> 01.02.2024
    assert rows[42]["data_vencimento"] == dt.date(2024, 2, 1)


def test_live_dpd_fallback_needs_dpd_null(spark):
    # no DPD label: the positional read starts at character 4 ("ulo: 1" -> no digits)
    inputs = _inputs(spark, [_inv(1, 50, "Titulo: 1", "10.00", "0.00")])
    zero = C.settlement_steps(inputs, 516, AS_OF, materialize=False).aggregate.first()
    null = C.settlement_steps(inputs, 516, AS_OF, materialize=False,
                              options=C.ParseOptions(empty_dpd_as_zero=False)).aggregate.first()
    assert zero["dpd_final"] == 0        # the empty DPD text converts to 0
    assert null["dpd_final"] == 40       # NULL DPD falls back to the live value


def test_sequential_match_and_commission(spark):
    inputs = _inputs(spark, [
        _inv(1, 60, "NN: 1\nCompetencia: 01.12.2023\nVencimento: 01.12.2023", "100.00", "0.00"),
        _inv(1, 61, "NN: 2\nCompetencia: 01.12.2023\nVencimento: 01.12.2023", "50.00", "0.00"),
        _inv(1, 62, "NN: 3", "10.00", "10.00", day=dt.datetime(2023, 6, 1)),   # nothing paid
    ], payments=[_pay(1, 900, dt.date(2024, 1, 20), "30.00"),
                 _pay(1, 901, dt.date(2024, 1, 5), "15.00"),
                 _pay(1, 902, dt.date(2023, 12, 30), "99.00")])   # other month
    for strategy in ("window", "range"):
        steps = C.settlement_steps(inputs, 516, AS_OF, materialize=False, rank_strategy=strategy)
        matched = {r["invoice_id"]: r["payment_id"] for r in steps.matched.collect()}
        assert matched == {60: 901, 61: 900}, strategy
    report = {r["invoice_id"]: r for r in
              C.settle(inputs, 516, AS_OF, materialize=False).collect()}
    assert set(report) == {60, 61}
    r60 = report[60]
    # 15.00 * 100 / 150 = 10.00 ; dpd 61 -> 40 %
    assert r60["payed_capital_proporcional"] == Decimal("10.00")
    assert r60["commission_rate"] == Decimal("0.400000")
    assert r60["valor_comissao"] == Decimal("4.00")
    assert r60["documento_tipo"] == "CPF"
    assert r60["promise_capital"] == Decimal("99.00")   # independent maxima
    assert r60["promise_date"] == dt.date(2024, 1, 5)
    assert len(report[61].asDict()) == 34


def test_empty_inputs_flow_through(spark):
    inputs = _inputs(spark, [])
    assert C.settle(inputs, 516, AS_OF).count() == 0


def test_hot_case_paths_match_plain_paths(spark):
    rows = [_inv(1, 100 + i, f"NN: {i % 7}\nDPD: {i % 5}", "10.00", "1.00") for i in range(60)]
    pays = [_pay(1, 1000 + i, dt.date(2024, 1, 1 + i % 28), "2.00") for i in range(40)]
    inputs = _inputs(spark, rows, payments=pays)
    plain = C.settlement_steps(inputs, 516, AS_OF, materialize=False,
                               rank_strategy="window").report
    salted = C.settlement_steps(inputs, 516, AS_OF).report

    def rows_of(df):
        return sorted(tuple(str(v) for v in r) for r in df.collect())

    assert rows_of(plain) == rows_of(salted)

"""Pipeline C: commission settlement of one tenant's invoices and payments.

One function per step of the original script; each is a lazy DataFrame, and
:func:`settle` composes them into a single plan.  Scale notes:

* the case-level side tables are small per case, the invoice tables are not;
  invoice-to-case joins deal the invoices of cases that hold very many of them over several
  tasks (``operators/skew.py``); hot cases are looked for once per table (one narrow pass), and
  every join reads its rows once, however many joins follow each other;
* the title dedup is a ``row_number() = 1`` filter, planned as a partial
  top-1 before the exchange;
* the n-th payment ↔ n-th paid invoice match ranks with
  :func:`row_number_in_groups`, which stays distributed inside a huge case;
* the band lookup is an equi-join on value buckets;
* all other aggregations are map-side combined.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billing_guard import DEFAULT_AS_OF
from billing_guard.functions import dates, text
from billing_guard.functions.bands import fase_label
from billing_guard.functions.money import proportional_share, round_to_cents
from billing_guard.operators.band_join import band_join
from billing_guard.operators.dedup import keep_first_per_group
from billing_guard.operators.ranking import row_number_in_groups
from billing_guard.operators.skew import hot_shares, hot_split_join
from billing_guard.session import written
from billing_guard.sources.schemas import MONEY
from billing_guard.sources.testdata import LIVE_DPD_ATTRIBUTE, SettlementInputs

# --- fixed values: payment status labels ------------------------------------
PAID_IN_FULL = "PAGO TOTAL"
PAID_IN_PART = "PAGO PARCIAL"
OPEN = "EM ABERTO"
# ---------------------------------------------------------------------------

GROUP_KEYS = ["case_id", "ref_number", "client_ref_number", "invoice_id", "invoice_number"]

# --- fixed values: the columns of the settlement report, in order -------------
FINAL_COLUMNS = [
    "case_id", "ref_number", "client_ref_number", "invoice_id", "invoice_number",
    "original_capital_total", "actual_capital_total", "valor_pago", "status_pagamento",
    "competencia", "vencimento_original", "data_vencimento", "codigo_titulo", "dpd_invoice",
    "live_dpd", "dpd_final", "fase", "update_date", "promise_date", "promise_capital",
    "contact_date", "case_statute_id", "persons_born_number", "documento_tipo", "payment_id",
    "payment_date", "payed_capital_original", "payed_capital_proporcional", "commission_rate",
    "valor_comissao", "payment_insert_date", "payment_insert_time", "pay_insert_filename",
    "payment_insert_user",
]
# ---------------------------------------------------------------------------
PAYMENT_DETAIL = ["payment_insert_date", "payment_insert_time", "pay_insert_filename",
                  "payment_insert_user"]


@dataclass(frozen=True)
class ParseOptions:
    """Text-parsing switches (defaults follow the original program)."""
    empty_dpd_as_zero: bool = True
    ignore_case: bool = False
    strip_cr: bool = False


# 1 -------------------------------------------------------------------------
def tenant_cases(cases: DataFrame, client_id: int) -> DataFrame:
    return cases.where(F.col("client_id") == client_id).select(
        "case_id", "ref_number", "client_ref_number", "case_statute_id", "debtor_id")


# 2 -------------------------------------------------------------------------
def base_raw(cases_t: DataFrame, invoices: DataFrame, attributes: DataFrame,
             options: ParseOptions = ParseOptions()) -> DataFrame:
    """Tenant invoices with the case's live DPD and the parsed description fields.

    The attribute filter stays on the attribute side of the outer join; two
    attributes of the type for one case duplicate the case's invoice rows, as
    in the original.
    """
    live = (attributes.where(F.col("case_attribute_type_id") == LIVE_DPD_ATTRIBUTE)
            .select("case_id", F.col("case_attribute_value").try_cast("int").alias("live_dpd")))
    case_info = (cases_t.select("case_id", "ref_number", "client_ref_number")
                 .join(live, "case_id", "left"))
    d = F.col("description")
    rows = hot_split_join(invoices, case_info, ["case_id"], "inner")
    return rows.select(
        "case_id", "ref_number", "client_ref_number", "live_dpd", "invoice_id", "invoice_number",
        F.col("update_date").cast("date").alias("update_date"),
        F.col("original_capital").alias("invoice_original_capital"),
        F.col("actual_capital").alias("invoice_actual_capital"),
        text.title_code(d, options.ignore_case, options.strip_cr).alias("codigo_titulo"),
        text.label_window(d, text.COMPETENCE_LABEL, ignore_case=options.ignore_case)
        .alias("competencia_raw"),
        text.label_window(d, text.DUE_LABEL, ignore_case=options.ignore_case)
        .alias("vencimento_raw"),
        text.dpd_window(d, options.empty_dpd_as_zero, options.ignore_case).alias("dpd_invoice"),
    )


def duplicate_attributes(attributes: DataFrame,
                         type_id: int = LIVE_DPD_ATTRIBUTE) -> DataFrame:
    """Data check: cases with more than one attribute of ``type_id``.

    Such cases duplicate their untitled invoice rows in the settlement (the
    original joins them as they are); an empty result means no fan-out.
    """
    return (attributes.where(F.col("case_attribute_type_id") == type_id)
            .groupBy("case_id").agg(F.count(F.lit(1)).alias("attribute_rows"))
            .where(F.col("attribute_rows") > 1))


# 3 -------------------------------------------------------------------------
def base_dates(raw: DataFrame) -> DataFrame:
    """Parse competence and due date; repair swapped due dates."""
    comp, due = F.col("competencia_raw"), F.col("vencimento_raw")
    return raw.select(
        "case_id", "ref_number", "client_ref_number", "live_dpd", "invoice_id", "invoice_number",
        "update_date", "invoice_original_capital", "invoice_actual_capital", "codigo_titulo",
        "dpd_invoice",
        dates.parse_day_month_year(comp).alias("competencia_description"),
        dates.parse_day_month_year(due).alias("vencimento_original"),
        dates.repaired_due_date(due, comp).alias("vencimento_description"),
    )


# 4 -------------------------------------------------------------------------
DEDUP_ORDER_COLUMNS = ["invoice_id", "update_date", "invoice_original_capital",
                       "invoice_actual_capital", "invoice_number", "competencia_description",
                       "vencimento_original", "vencimento_description", "live_dpd"]


def dedup_by_title(base: DataFrame) -> DataFrame:
    """One row per (case, title): non-negative DPD first, then the largest DPD.

    Rows without a title are all kept.  Ties are broken by the remaining
    columns so the result is deterministic.
    """
    dpd = F.col("dpd_invoice")
    titled = F.col("codigo_titulo").isNotNull() & (F.col("codigo_titulo") != "")
    order = [F.when(dpd >= 0, 0).otherwise(1), dpd.desc_nulls_last()] + [
        F.col(c).asc_nulls_first() for c in DEDUP_ORDER_COLUMNS]
    return keep_first_per_group(base, ["case_id", "codigo_titulo"], titled, order, "rn_titulo")


# 5 -------------------------------------------------------------------------
def case_debtors(cases_t: DataFrame, debtors: DataFrame, persons: DataFrame) -> DataFrame:
    return (cases_t.select("case_id", "case_statute_id", "debtor_id")
            .join(debtors, "debtor_id")
            .join(persons, "persons_id")
            .select("case_id", "case_statute_id", "persons_born_number",
                    text.document_type(F.col("persons_born_number")).alias("documento_tipo")))


# 6 -------------------------------------------------------------------------
def promise_rollup(ptp: DataFrame, client_id: int) -> DataFrame:
    """Independent maxima of promise date, amount and contact date per case."""
    return (ptp.where(F.col("client_id") == client_id)
            .groupBy("case_id")
            .agg(F.max("promise_date").alias("promise_date"),
                 F.max("promise_capital").alias("promise_capital"),
                 F.max("contact_date").alias("contact_date")))


def active_bands(bands: DataFrame, client_id: int, as_of: date = DEFAULT_AS_OF) -> DataFrame:
    return (bands.where((F.col("client_id") == client_id)
                        & F.lit(as_of).between(F.col("date_from"), F.col("date_to")))
            .select("dpd_on_payment_day_from", "dpd_on_payment_day_to", "commission_rate"))


# 7 -------------------------------------------------------------------------
def payments_of_month(payments: DataFrame, as_of: date = DEFAULT_AS_OF) -> DataFrame:
    """The payments dated in ``as_of``'s month (range filter, pushable)."""
    return payments.where(dates.in_month_of(F.col("payment_date"), as_of))


def month_payments(payments: DataFrame, cases_t: DataFrame, as_of: date = DEFAULT_AS_OF,
                   hot: dict[int, int] | None = None) -> DataFrame:
    """The tenant's payments of the month; ``hot`` lists the cases with very many."""
    return (hot_split_join(payments_of_month(payments, as_of), cases_t.select("case_id").distinct(),
                           ["case_id"], "inner", hot=hot)
            .select("case_id", "payment_id", "payment_date", "payed_capital", *PAYMENT_DETAIL))


# 8 -------------------------------------------------------------------------
def invoice_aggregate(dedup: DataFrame, as_of: date = DEFAULT_AS_OF) -> DataFrame:
    """Per invoice: capital sums, paid value, status, dates, DPD, titles, band."""
    agg = dedup.groupBy(*GROUP_KEYS).agg(
        F.sum("invoice_actual_capital").cast(MONEY).alias("actual_capital_total"),
        F.sum("invoice_original_capital").cast(MONEY).alias("original_capital_total"),
        F.sum(F.col("invoice_original_capital") - F.col("invoice_actual_capital"))
        .cast(MONEY).alias("valor_pago"),
        F.max("live_dpd").alias("live_dpd"),
        F.max("dpd_invoice").alias("dpd_invoice"),
        F.max("competencia_description").alias("competencia"),
        F.max("vencimento_original").alias("vencimento_original"),
        F.max("vencimento_description").alias("data_vencimento"),
        F.max("update_date").alias("update_date"),
        # titles of the invoice in order; NULLs skipped, '' kept (see wide_invoices for its bound)
        F.expr("listagg(codigo_titulo, ',') WITHIN GROUP (ORDER BY codigo_titulo)").alias("codigo_titulo"),
    )
    actual, original = F.col("actual_capital_total"), F.col("original_capital_total")
    overdue = dates.days_until(F.col("data_vencimento"), as_of)
    return agg.select(
        *GROUP_KEYS,
        "actual_capital_total", "original_capital_total", "valor_pago",
        F.col("valor_pago").alias("valor_pago_invoice"),
        F.when(actual == 0, F.lit(PAID_IN_FULL)).when(actual < original, F.lit(PAID_IN_PART))
        .otherwise(F.lit(OPEN)).alias("status_pagamento"),
        "live_dpd", "dpd_invoice", "competencia", "vencimento_original", "data_vencimento",
        "update_date",
        F.when(F.col("data_vencimento").isNotNull(), overdue)
        .when(F.col("dpd_invoice").isNull(), F.col("live_dpd"))
        .otherwise(F.col("dpd_invoice")).cast("int").alias("dpd_final"),
        "codigo_titulo",
        fase_label(overdue).alias("fase"),
    )


#: the most characters that one invoice's list of titles may have
TITLES_LIMIT = 100_000_000


def wide_invoices(dedup: DataFrame, limit: int = TITLES_LIMIT) -> DataFrame:
    """Data check: invoices whose titles are too many for one list of ``limit`` characters.

    A list is as long as its group by definition, and one task holds it; this check is a
    partial sum per invoice, so it finds such an invoice without building the list.
    """
    size = F.sum(F.length("codigo_titulo") + 1)
    return (dedup.where(F.col("codigo_titulo").isNotNull()).groupBy(*GROUP_KEYS)
            .agg(F.count(F.lit(1)).alias("titles"), size.alias("title_chars"))
            .where(F.col("title_chars") > limit))


# 9 -------------------------------------------------------------------------
def paid_per_case_day(agg: DataFrame) -> DataFrame:
    return (agg.where(F.col("valor_pago_invoice") > 0)
            .groupBy("case_id", F.col("update_date").alias("update_dia"))
            .agg(F.sum("valor_pago_invoice").cast(MONEY).alias("valor_pago_total_dia")))


# 10 ------------------------------------------------------------------------
def match_payments(payments_m: DataFrame, agg: DataFrame, rank_strategy: str = "range",
                   hot_paying: dict[int, int] | None = None,
                   hot_paid: dict[int, int] | None = None) -> DataFrame:
    """Pair the n-th payment of a case (by date, id) with its n-th paid invoice
    (by invoice number, id).

    ``hot_paying`` and ``hot_paid`` list the cases with very many payments and invoices.
    """
    pg = row_number_in_groups(
        payments_m, ["case_id"],
        [F.col("payment_date").asc_nulls_first(), F.col("payment_id").asc_nulls_first(),
         F.col("payed_capital").asc_nulls_first()],
        "rn", strategy=rank_strategy, hot=hot_paying)
    inv = row_number_in_groups(
        agg.where(F.col("valor_pago_invoice") > 0).select("case_id", "invoice_id", "invoice_number"),
        ["case_id"],
        [F.col("invoice_number").asc_nulls_first(), F.col("invoice_id").asc_nulls_first()],
        "rn", strategy=rank_strategy, hot=hot_paid)
    return (inv.join(pg, ["case_id", "rn"], "inner")
            .select("invoice_id", "case_id", "payment_id", "payment_date", "payed_capital",
                    *PAYMENT_DETAIL))


# final ---------------------------------------------------------------------
DAY_KEYS = ["case_id", "update_date"]


def settlement_report(agg: DataFrame, ptp_r: DataFrame, debtors_c: DataFrame,
                      matched: DataFrame, day_totals: DataFrame, bands_a: DataFrame,
                      as_of: date = DEFAULT_AS_OF, hot_cases: dict[int, int] | None = None,
                      hot_days: dict[int, int] | None = None) -> DataFrame:
    """Invoices with paid value that were updated this month or got a payment,
    with promise, debtor, payment share and commission (34 columns).

    ``hot_cases`` and ``hot_days`` list the cases and days of a case with very many paid
    invoices; each join reads its rows once, so their number does not multiply the plan.
    """
    rows = agg.where(F.col("valor_pago") > 0)
    if hot_cases is None or hot_days is None:
        hot_cases, hot_days = hot_shares(rows, ["case_id"], DAY_KEYS)
    per_case = ptp_r.join(debtors_c, "case_id", "full")
    rows = hot_split_join(rows, day_totals.withColumnRenamed("update_dia", "update_date"),
                          DAY_KEYS, "left", hot=hot_days)
    rows = hot_split_join(rows, per_case, ["case_id"], "left", hot=hot_cases)
    rows = rows.join(matched.drop("case_id"), "invoice_id", "left")
    rows = band_join(rows, bands_a, F.col("dpd_final"),
                     "dpd_on_payment_day_from", "dpd_on_payment_day_to", "left")
    share = proportional_share(F.col("payed_capital"), F.col("valor_pago_invoice"),
                               F.col("valor_pago_total_dia"))
    rows = rows.where(dates.in_month_of(F.col("update_date"), as_of)
                      | F.col("payment_id").isNotNull())
    return rows.select(
        *[c for c in FINAL_COLUMNS[:26]],
        F.col("payed_capital").alias("payed_capital_original"),
        share.alias("payed_capital_proporcional"),
        "commission_rate",
        round_to_cents(share * F.col("commission_rate")).alias("valor_comissao"),
        *PAYMENT_DETAIL,
    )


class SettlementSteps:
    """Every intermediate of the settlement as a lazy DataFrame, built on first use.

    The invoice aggregate feeds three consumers (day totals, the payment
    match and the report).  Column pruning gives each consumer a different
    plan, so Spark could not share the work; with ``materialize`` the
    aggregate is written once as Parquet under the session's shared work
    folder (``spark.checkpoint.dir``) and the consumers read it back, which
    also cuts the lineage a lost executor would otherwise replay.
    """

    def __init__(self, inputs: SettlementInputs, client_id: int, as_of: date = DEFAULT_AS_OF,
                 options: ParseOptions = ParseOptions(),
                 rank_strategy: str = "range", materialize: bool = True):
        self.inputs, self.client_id, self.as_of = inputs, client_id, as_of
        self.options = options
        self.rank_strategy, self.materialize = rank_strategy, materialize

    @cached_property
    def cases(self) -> DataFrame:
        return tenant_cases(self.inputs.cases, self.client_id)

    @cached_property
    def base_raw(self) -> DataFrame:
        return base_raw(self.cases, self.inputs.invoices, self.inputs.case_attributes,
                        self.options)

    @cached_property
    def base(self) -> DataFrame:
        return base_dates(self.base_raw)

    @cached_property
    def dedup(self) -> DataFrame:
        return dedup_by_title(self.base)

    @cached_property
    def debtors(self) -> DataFrame:
        return case_debtors(self.cases, self.inputs.debtors, self.inputs.persons)

    @cached_property
    def ptp(self) -> DataFrame:
        return promise_rollup(self.inputs.ptp, self.client_id)

    @cached_property
    def bands(self) -> DataFrame:
        return active_bands(self.inputs.bands, self.client_id, self.as_of)

    @cached_property
    def hot_paying(self) -> dict[int, int]:
        """Cases with very many payments of the month."""
        return hot_shares(payments_of_month(self.inputs.payments, self.as_of), ["case_id"])[0]

    @cached_property
    def hot_paid(self) -> list[dict[int, int]]:
        """Cases, and days of a case, with very many paid invoices: one pass over the aggregate."""
        return hot_shares(self.aggregate.where(F.col("valor_pago") > 0), ["case_id"], DAY_KEYS)

    @cached_property
    def payments(self) -> DataFrame:
        return month_payments(self.inputs.payments, self.cases, self.as_of, self.hot_paying)

    @cached_property
    def aggregate(self) -> DataFrame:
        agg = invoice_aggregate(self.dedup, self.as_of)
        if not self.materialize:
            return agg
        return written(agg, "invoice_aggregate")

    @cached_property
    def day_totals(self) -> DataFrame:
        return paid_per_case_day(self.aggregate)

    @cached_property
    def matched(self) -> DataFrame:
        return match_payments(self.payments, self.aggregate, self.rank_strategy, self.hot_paying,
                              self.hot_paid[0])

    @cached_property
    def report(self) -> DataFrame:
        return settlement_report(self.aggregate, self.ptp, self.debtors, self.matched,
                                 self.day_totals, self.bands, self.as_of, *self.hot_paid)


def settlement_steps(inputs: SettlementInputs, client_id: int, as_of: date = DEFAULT_AS_OF,
                     **kwargs) -> SettlementSteps:
    return SettlementSteps(inputs, client_id, as_of, **kwargs)


def settle(inputs: SettlementInputs, client_id: int, as_of: date = DEFAULT_AS_OF,
           **kwargs) -> DataFrame:
    """The settlement report, ordered by case and invoice number."""
    return ordered(settlement_steps(inputs, client_id, as_of, **kwargs).report)


def ordered(report: DataFrame) -> DataFrame:
    return report.orderBy(F.col("case_id").asc_nulls_first(),
                          F.col("invoice_number").asc_nulls_first(),
                          F.col("invoice_id").asc_nulls_first())
